"""Configuration files, and manifests written and read."""

import pytest

from methylspark.functions.chemistry import Assay
from methylspark.operators import calls
from methylspark.plans import settings
from methylspark.sinks import files as sinks
from methylspark.sources import reports

TEXT = """#!/bin/bash
# a comment
SCRATCH=${SCRATCH:-/tmp/x}   # where
export WORK=${WORK:-${SCRATCH:-none}/work}
declare -A SPIKES=(
    [lambda]="${SCRATCH}/lambda.fa"
    [puc19]=""
)
MBIAS_MIN_BASE_QUALITY=${MBIAS_MIN_BASE_QUALITY:-31}
CALL_MIN_BASE_QUALITY=${MBIAS_MIN_BASE_QUALITY}
MBIAS_HOST_SUBSAMPLE_FRACTION=${MBIAS_HOST_SUBSAMPLE_FRACTION:-0.1}
CALL_CHROMOSOMES="chr1, chr2"
CALL_MAX_DEPTH=${CALL_MAX_DEPTH:-}
BARCODE_LINKER_EDIT_DISTANCE=${BARCODE_LINKER_EDIT_DISTANCE:-2}
if [[ -n "$X" ]]; then echo no; fi
"""


def test_settings():
    found = settings.parse(TEXT, {})
    assert found["WORK"] == "/tmp/x/work" and found["SPIKES"] == {"lambda": "/tmp/x/lambda.fa", "puc19": ""} and found["CALL_MIN_BASE_QUALITY"] == "31"
    own = settings.parse(TEXT, {"SCRATCH": "/data", "MBIAS_MIN_BASE_QUALITY": "20", "CALL_MAX_DEPTH": "", "WORK": ""})
    assert own["WORK"] == "/data/work" and own["SPIKES"]["lambda"] == "/data/lambda.fa" and own["CALL_MIN_BASE_QUALITY"] == "20"


def test_sample_of_settings(tmp_path):
    path = tmp_path / "config.sh"
    path.write_text(TEXT)
    config = settings.sample_config(settings.read_settings(str(path), {"CALL_CONTEXT_MODE": "cg"}), Assay.EMSEQ, {"lambda": ["L1", "L2"]})
    assert config.calls == calls.CallConfig(Assay.EMSEQ, 10, 31, 50_000) and config.chromosomes == ("chr1", "chr2") and config.mito == ("chrM",)
    assert (config.bias.fraction, config.bias.min_base_quality, config.bias.replay, config.mode, config.spikes) == (0.1, 31, True, "both", {"lambda": ("L1", "L2")})
    assert settings.layout(settings.read_settings(str(path), {}), Assay.TAPS).linker_edits == 2
    with pytest.raises(ValueError, match="CALL_MAX_DEPTH"):
        settings.sample_config(settings.parse(TEXT, {"CALL_MAX_DEPTH": "deep"}), Assay.TAPS)


def test_manifest(spark, tmp_path):
    whitelist = spark.createDataFrame([(0, "00", "AACC"), (1, "01", "GGTT")], "ord int, barcode_index string, seq string")
    manifest = calls.spot_keys(whitelist)
    sinks.write_manifest(manifest, str(tmp_path / "m"))
    (path,) = (tmp_path / "m").glob("*.csv")
    assert path.read_text().splitlines()[:2] == ["spot_id\tbarcode1_index\tbarcode2_index\tbarcode1\tbarcode2\traw_cb", "00_00\t00\t00\tAACC\tAACC\tAACC+AACC"]
    read = reports.read_manifest(spark, str(path))
    assert sorted(read.collect()) == sorted(manifest.select("spot_id", "x", "y", "raw_cb").collect())
    assert sorted(calls.cb_to_spot(read).collect()) == sorted(calls.cb_to_spot(manifest).collect())
    other = tmp_path / "other.tsv"
    other.write_text("raw_cb\tspot_id\tbarcode2_index\tbarcode1_index\naa+cc\ts1\t2\t1\n\ts2\t1\t1\ngg\ts3\tx\t1\nAA+CC\ts4\t4\t3\n")
    assert reports.read_manifest(spark, str(other)).collect() == [("s4", 3, 4, "AA+CC")]
    assert sorted(r.spot_id for r in reports.read_manifest(spark, str(other), indexed=False).collect()) == ["s3", "s4"]
    for text, error in (("spot_id\traw_cb\ns\tA\n", "barcode1_index"), ("\t".join(reports.MANIFEST) + "\n", "usable"), ("", "column")):
        other.write_text(text)
        with pytest.raises(ValueError, match=error):
            reports.read_manifest(spark, str(other))
