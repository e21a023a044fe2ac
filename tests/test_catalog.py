"""Queries against their SQL in DuckDB, and what the driver asks of the entry module."""

import duckdb
import pytest

import __spark_entry__
from methylspark import catalog
from methylspark.derived import TABLES

QUICK = ["call_cg_taps", "call_ch_emseq", "call_aggregate", "ref_site_classes", "overlap_resolution", "reads_per_spot", "flagstat", "mbias_cycles", "expected_unique", "extract_rejections", "extract_reject_counts", "barcode_exact", "insert_conversion_by_position", "pool_sort", "vmr_windows", "linker_within_2", "call_cg_bias_trims", "per_spot_summary", "sample_summary_counted", "saturation_summary"]


def rows(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    return sorted(map(repr, frame.where(frame.notna(), None).itertuples(index=False, name=None)))


@pytest.mark.parametrize("name", QUICK)
def test_as_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    got, want = catalog.QUERIES[name](spark, sf_dir).toPandas(), con.execute(catalog.ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(catalog.ORACLE_SQL)
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0


def test_keys_are_unique(spark, sf_dir):
    from methylspark.derived import tables

    reads, whitelist = tables(spark, sf_dir, "reads", "whitelist")
    assert reads.count() == reads.select("ordinal").distinct().count()
    assert whitelist.count() == whitelist.select("seq").distinct().count()
