"""A whole sample, its files, and running counts."""

import gzip

import pytest

from methylspark import catalog
from methylspark.derived import tables
from methylspark.operators import barcodes, calls, mbias
from methylspark.plans.sample import SampleConfig, sample, saturation_of
from methylspark.sinks import files as sinks
from methylspark.sources import files as sources
from methylspark.streaming import counts


@pytest.fixture(scope="module")
def made(spark, sf_dir):
    reads, blocks, whitelist = tables(spark, sf_dir, "reads", "ref_blocks", "whitelist")
    config = SampleConfig(calls=calls.CallConfig(trims=catalog.TRIMS), bias=mbias.BiasConfig(r1_length=30), reads_above=20)
    return reads, blocks, whitelist, config


def test_sample(spark, sf_dir, made, tmp_path):
    reads, blocks, whitelist, config = made
    found = sample(reads, blocks, whitelist, config)
    host = catalog.QUERIES["call_cg_taps"](spark, sf_dir).where("rname <> 'chrM'")
    assert sorted(found.cg.collect()) == sorted(host.select(found.cg.columns).collect())
    assert saturation_of(found, config).count() == 1
    path = str(tmp_path / "cov")
    sinks.write_coverage(found.cg, found.manifest, path)
    lines = sorted(r.value for r in spark.read.text(path).select("value").collect())
    assert lines == sorted(f"{r.rname}\t{r.pos}\t{r.pos}\t{r.pct:.2f}\t{r.meth}\t{r.unmeth}" for r in found.cg.collect())
    with pytest.raises(Exception, match="whitelist"):
        sample(reads, blocks, whitelist, SampleConfig(strict=True)).cg.collect()


def test_running_counts(spark, made, tmp_path):
    reads, _, whitelist, _ = made
    spots = calls.cb_to_spot(calls.spot_keys(whitelist))
    folder = str(tmp_path / "in")
    cbs = reads.select("ordinal", "cb")
    cbs.repartition(4).write.parquet(folder)
    running = counts.reads_per_spot(counts.arriving(spark, folder, "ordinal bigint, cb string", 1), spots)
    counts.keep(running, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    from methylspark.operators.summary import reads_per_spot

    assert sorted(spark.read.parquet(str(tmp_path / "out")).collect()) == sorted(reads_per_spot(reads, spots).collect())


def test_fastq_of_kept_and_rejected(spark, sf_dir, made, tmp_path):
    pairs, whitelist = tables(spark, sf_dir, "pairs", "whitelist")
    pairs = pairs.selectExpr("*", "h1 as h2", "'ACGT' as s2", "'IIII' as q2")
    found = barcodes.rejections(pairs, whitelist, barcodes.Layout())
    sinks.write_fastq(found, str(tmp_path / "out"))
    counted = barcodes.reject_counts(found).first()
    inserts = {r.h1[1:]: r.s1[r.insert_start :] for r in found.where("size(reasons) = 0").collect()}
    assert {len(x) for x in inserts.values()} == {29, 30}  # 29 where the seed lacked a base
    n = 0
    for p in (tmp_path / "out" / "status=kept" / "mate=R1").glob("*.gz"):
        lines = gzip.decompress(p.read_bytes()).decode().splitlines()
        n += len(lines) // 4
        assert all(lines[k].startswith("@") and "+" in lines[k] and inserts[lines[k].split(":", 1)[1]] == lines[k + 1] and len(lines[k + 1]) == len(lines[k + 3]) for k in range(0, len(lines), 4))
    assert n == counted.kept_reads
    sinks.write_stats(barcodes.reject_counts(found), str(tmp_path / "stats"))
    assert spark.read.json(str(tmp_path / "stats")).first().total_reads == counted.total_reads
    assert sources.FASTQ
