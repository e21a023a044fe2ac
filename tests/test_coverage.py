"""Coverage files: their names, their order, and what an unfinished write leaves."""

import pytest
from pyspark.sql import functions as F

from methylspark import catalog
from methylspark.operators import calls
from methylspark.sinks import coverage
from methylspark.sources import files, reports

CALLS = "spot_id string, rname string, pos int, context string, strand string, meth bigint, unmeth bigint, pct double"
ROWS = [
    ("00_01", "chr10", 5, "CG", "+", 1, 1, 50.0), ("00_01", "chr2", 9, "CG", "+", 1, 31, 3.12), ("00_01", "chr2", 3, "CG", "+", 5, 27, 15.62), ("00_01", "alt", 1, "CG", "+", 1, 0, 100.0),
    ("00_01", "chr2", 4, "CA", "-", 0, 2, 0.0), ("00_01", "chr2", 4, "CA", "+", 0, 1, 0.0), ("12_00", "chr2", 8, "CT", "-", 2, 0, 100.0),
]
CONTIGS = ["chr2", "chr10"]


def found(folder):
    return {str(p.relative_to(folder)): p.read_text() for p in folder.rglob("*") if p.is_file() and not p.name.endswith(".crc")}


def test_spot_files(spark, tmp_path):
    df = spark.createDataFrame(ROWS, CALLS).repartition(5)
    coverage.write_spot_coverage(df, str(tmp_path), CONTIGS)
    want = {
        "host/00/00_01.CG.cov": "chr2\t3\t3\t15.62\t5\t27\nchr2\t9\t9\t3.12\t1\t31\nchr10\t5\t5\t50.00\t1\t1\nalt\t1\t1\t100.00\t1\t0\n",
        "host/00/00_01.CA.cov": "chr2\t4\t4\t0.00\t0\t1\tCA\t+\nchr2\t4\t4\t0.00\t0\t2\tCA\t-\n",
        "host/12/12_00.CT.cov": "chr2\t8\t8\t100.00\t2\t0\tCT\t-\n",
    }
    assert found(tmp_path) == want
    coverage.write_spot_coverage(df.where("context = 'CG'").drop("context", "strand"), str(tmp_path), CONTIGS)
    assert found(tmp_path) == {k: v for k, v in want.items() if ".CG." in k}


def test_target_files(spark, tmp_path):
    df = spark.createDataFrame(ROWS, CALLS).drop("spot_id")
    for name, rows in (("lambda", df.where("context = 'CT'")), ("puc19", df.where("pos < 0")), ("host_mito", df)):
        coverage.write_target_coverage(rows, str(tmp_path), name, ("CG", "CA", "CC", "CT"), CONTIGS)
    got = found(tmp_path)
    assert len(got) == 12 and got["lambda.CT.cov"] == "chr2\t8\t8\t100.00\t2\t0\tCT\t-\n"
    assert [n for n, text in got.items() if n.startswith(("lambda", "puc19")) and text] == ["lambda.CT.cov"]
    assert reports.spike_names(spark, str(tmp_path), ("CG", "CT")) == ["lambda", "puc19"]


def test_a_failed_write_leaves_nothing(spark, tmp_path):
    coverage.write_spot_coverage(spark.createDataFrame(ROWS, CALLS), str(tmp_path), CONTIGS)
    before = found(tmp_path)
    bad = spark.createDataFrame(ROWS, CALLS).withColumn("meth", F.when(F.col("context") == "CT", F.raise_error(F.lit("spoiled")).cast("bigint")).otherwise(7))
    with pytest.raises(Exception, match="spoiled"):
        coverage.write_spot_coverage(bad, str(tmp_path), CONTIGS)
    assert found(tmp_path) == before


def test_calls_written_and_read_again(spark, sf_dir, tmp_path):
    called = catalog.host_all(spark, sf_dir).where(F.col("meth") + F.col("unmeth") > 0)
    coverage.write_spot_coverage(called, str(tmp_path), ["chr3", "chr1"])
    for context in ("CG", "CA", "CC", "CT"):
        read = files.read_coverage(spark, str(tmp_path), context)
        shown = ("spot_id", "rname", F.col("start").alias("pos"), "meth", "unmeth")
        want = called.where(F.col("context") == context).select("spot_id", "rname", "pos", "meth", "unmeth")
        assert sorted(read.select(*shown).collect()) == sorted(want.collect())
    manifest = calls.spot_keys(spark.createDataFrame([(0, "00", "AC")], "ord int, barcode_index string, seq string"))
    assert manifest.first().spot_id == "00_00"
