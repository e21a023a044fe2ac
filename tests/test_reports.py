"""Reports of earlier steps as input, and targets."""

import pytest

from methylspark import catalog
from methylspark.derived import tables
from methylspark.operators import calls, mbias
from methylspark.plans.sample import SampleConfig, sample
from methylspark.sources import reports


def put(path, text):
    path.write_text(text)
    return str(path)


def test_pair(spark, tmp_path):
    for name in ("x_R1_001.fastq.gz", "x_r2_001.fq", "notes.txt"):
        put(tmp_path / name, "@a\nA\n+\nI\n")
    first, second = reports.find_pair(spark, str(tmp_path))
    assert first.endswith("x_R1_001.fastq.gz") and second.endswith("x_r2_001.fq")
    put(tmp_path / "y_R1.fastq", "@a\nA\n+\nI\n")
    with pytest.raises(ValueError, match="not two"):
        reports.find_pair(spark, str(tmp_path))


def test_tables_of_trims(spark, tmp_path):
    bias = put(tmp_path / "bias.tsv", "read\tcycle\tcoverage\tmethylation_rate\nR1\t1\t5\t0.5\nR2\t2\t0\tNA\nR3\t1\t1\t1.0\n")
    assert reports.read_bias(spark, bias).collect() == [("R1", 1, 5, 0.5)]
    with pytest.raises(ValueError, match="coverage"):
        reports.read_bias(spark, put(tmp_path / "bad.tsv", "read\tcycle\tmethylation_rate\n"))
    head = "read\ta\tb\tc\td\te\tleft\tright\n"
    row = lambda r, left, right: "\t".join([r, *"12345", left, right]) + "\n"
    good = put(tmp_path / "cut.tsv", head + row("R1", "9", "9") + row("R1", "1", "2") + row("R2", "0", "3"))
    assert reports.read_trims(spark, good) == {"R1": (1, 2), "R2": (0, 3)}
    for rest in ("", row("R2", "x", "3"), row("R2", "-1", "3")):
        with pytest.raises(ValueError, match="trims"):
            reports.read_trims(spark, put(tmp_path / "cut2.tsv", head + row("R1", "1", "2") + rest))


@pytest.mark.parametrize(("text", "reads", "gbp", "barcoded"), [
    ('{"summary": {"before_filtering": {"total_reads": 8, "total_bases": 2e9}, "after_filtering": {"total_bases": 0}, "total_reads": 7}}', 8, 2.0, None),
    ('{"summary": {"total_reads": "7", "after_filtering": {"total_bases": 500000000}}, "kept_reads": 3}', 7, 0.5, 6),
    ('{"total_reads": 6.9}', 6, None, None), ("not json", None, None, None),
])
def test_json_reports(spark, tmp_path, text, reads, gbp, barcoded):
    path = put(tmp_path / "r.json", text)
    assert (reports.read_raw_reads(spark, path).first()[0], reports.read_gbp(spark, path).first()[0], reports.read_barcoded_reads(spark, path).first()[0]) == (reads, gbp, barcoded)


def test_names(spark, tmp_path):
    assert reports.read_saturation_rate(spark, put(tmp_path / "s.tsv", "a\tsaturation_rate\n1\t 55.5 \n2\t9\n")) == "55.5"
    assert reports.read_saturation_rate(spark, put(tmp_path / "t.tsv", "a\tsaturation_rate\n1\t\n")) is None
    blocks = spark.createDataFrame([("c", 0, "A"), ("d", 0, "A")], "contig string, block_start int, seq string")
    assert reports.checked_contigs(reports.contig_list(" c,, d "), blocks) == ["c", "d"]
    with pytest.raises(ValueError, match="x"):
        reports.checked_contigs(["c", "x"], blocks)
    for name in ("host_mito.CG.cov", "lambda.CG.cov", "phix.CH.cov", "other.XX.cov"):
        put(tmp_path / name, "x")
    assert reports.spike_names(spark, str(tmp_path), ("CG", "CH")) == ["lambda", "phix"]


def test_sample_of_targets(spark, sf_dir):
    """Spikes aren't the host's; found trims are used where both reads have some."""
    reads, blocks, whitelist = tables(spark, sf_dir, "reads", "ref_blocks", "whitelist")
    config = SampleConfig(calls=calls.CallConfig(trims=catalog.TRIMS), bias=mbias.BiasConfig(r1_length=30), mode="cg", spikes={"lambda": ("lambda",)}, found_trims=True)
    found = sample(reads, blocks, whitelist, config)
    assert {r.rname for r in found.cg.select("rname").distinct().collect()} == {"chr1", "chr2", "chr3"}
    assert {r.rname for r in found.spikes["lambda"][0].select("rname").distinct().collect()} == {"lambda"}
    cuts = "read string, left_trim int, right_trim int"
    assert calls.trims_of(spark.createDataFrame([("R1", 1, 2)], cuts), catalog.TRIMS).collect() == [(3, 2, 1, 0)]
    assert calls.trims_of(spark.createDataFrame([("R1", 1, 2), ("R2", 3, 4)], cuts), catalog.TRIMS).collect() == [(1, 2, 3, 4)]
    with pytest.raises(ValueError, match="two targets"):
        calls.with_target(reads, {"a": ["x"], "b": ["x"]})
