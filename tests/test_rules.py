"""The assays' rules on cases derived by hand."""

import pytest
from pyspark.sql import functions as F

from methylspark.functions import chemistry, dna, formats
from methylspark.functions.chemistry import Assay
from methylspark.operators import aligned, barcodes, calls, mbias, saturation, summary


def value(spark, column, **columns):
    return spark.range(1).select(*(F.lit(v).alias(k) for k, v in columns.items())).select(column.alias("v")).first().v if columns else spark.range(1).select(column.alias("v")).first().v


@pytest.mark.parametrize(("pair", "taps", "emseq"), [("TG", True, False), ("CA", True, False), ("CG", False, True), ("AG", None, None)])
def test_cg_rule(spark, pair, taps, emseq):
    for assay, want in ((Assay.TAPS, taps), (Assay.TAPS_V2, taps), (Assay.EMSEQ, emseq), (Assay.CABERNET, emseq)):
        assert value(spark, chemistry.cg_methylated(F.lit(pair), assay)) is want


@pytest.mark.parametrize(("base", "strand", "taps"), [("T", "+", True), ("C", "+", False), ("G", "-", False), ("A", "-", True), ("G", "+", None), ("C", "-", None)])
def test_ch_rule(spark, base, strand, taps):
    assert value(spark, chemistry.ch_methylated(F.lit(base), F.lit(strand), Assay.TAPS)) is taps
    assert value(spark, chemistry.ch_methylated(F.lit(base), F.lit(strand), Assay.EMSEQ)) is (None if taps is None else not taps)


def sites(spark, *blocks):
    rows = aligned.reference_sites(spark.createDataFrame(blocks, "contig string, block_start int, seq string")).collect()
    return {(r.contig, r.pos): (r.context, r.strand) for r in rows}


def test_reference_sites(spark):
    assert sites(spark, ("a", 0, "CGCAGT")) == {("a", 0): ("CG", "+"), ("a", 2): ("CA", "+"), ("a", 4): ("CT", "-")}
    assert sites(spark, ("a", 0, "AAC")) == {}
    assert sites(spark, ("a", 0, "CGC"), ("a", 3, "AGT"), ("b", 0, "cc")) == {("a", 0): ("CG", "+"), ("a", 2): ("CA", "+"), ("a", 4): ("CT", "-"), ("b", 0): ("CC", "+")}


@pytest.mark.parametrize(("flag", "qpos", "cut"), [(99, 4, True), (99, 5, False), (83, 95, True), (83, 94, False), (1, 0, False)])
def test_trims(spark, flag, qpos, cut):
    assert value(spark, chemistry.trimmed(F.lit(flag), F.lit(qpos), F.lit(100), {"R1": (5, 0), "R2": (0, 0)})) is cut


def test_cycles(spark):
    for flag, qpos in ((99, 0), (83, 69)):
        assert value(spark, chemistry.cycle(F.lit(flag), F.lit(qpos), F.lit(70), 150)) == 81
    with pytest.raises(Exception, match="longer"):
        value(spark, chemistry.cycle(F.lit(99), F.col("q"), F.lit(151), 150), q=0)


@pytest.mark.parametrize(("m", "u", "want"), [(1, 31, 3.12), (5, 27, 15.62), (0, 0, 0.0), (1, 2, 33.33)])
def test_percent(spark, m, u, want):
    assert value(spark, formats.percent(F.lit(m), F.lit(u))) == want


def test_formats(spark):
    assert value(spark, formats.fixed(F.lit(0.5), 6)) == "0.500000"
    assert value(spark, formats.fixed(F.lit(None).cast("double"), 2)) == "NA"
    assert value(spark, formats.rate_percent(F.lit(1), F.lit(0))) == "NA"
    assert value(spark, formats.rate_percent(F.lit(1), F.lit(8))) == "12.50%"
    assert [value(spark, formats.lenient_int(F.lit(x))) for x in ("7", "7.9", "x")] == [7, 7, None]


def test_dna(spark):
    assert value(spark, dna.sequenced(F.lit("AACG"), F.lit(True))) == "CGTT"
    assert value(spark, dna.hamming(F.lit("ACGT"), F.lit("AGGA"))) == 2
    assert value(spark, dna.exact_positions(F.lit("AAAA"), "AA", 0, 4)) == [0, 1, 2]
    assert value(spark, dna.exact_positions(F.lit("AAAA"), "AA", 3, 4)) == []
    assert value(spark, dna.c_t_mismatches(F.lit("TAC"), F.lit("CAC"))) == 0
    assert value(spark, dna.c_t_mismatches(F.lit("AAC"), F.lit("CAC"))) is None
    assert value(spark, dna.annotated_header(F.lit("@r1 1:N"), F.lit("AA"), F.lit("CC"))) == "@AA+CC:r1 1:N"
    assert value(spark, dna.conversion(F.lit("ACGT"), [1, 3, 9])) == ["C", "T", "."]


RECORD = "ordinal bigint, qname string, flag int, rname string, pos int, mapq int, cigar string, seq string, qual array<int>, cb string, nh string"


def records(spark, *rows):
    return spark.createDataFrame([(k, f"q{k}", *r) for k, r in enumerate(rows)], RECORD)


def test_aligned_blocks(spark):
    frame = records(spark, (99, "a", 10, 60, "2S3M1I2M2D1M3H", "ACGTACGTA", [30] * 9, None, None))
    rows = aligned.bases(frame, "ordinal").orderBy("qpos").collect()
    assert [(r.qpos, r.pos, r.base, r.next_base) for r in rows] == [(2, 10, "G", "T"), (3, 11, "T", "A"), (4, 12, "A", "C"), (6, 13, "G", "T"), (7, 14, "T", "A"), (8, 17, "A", None)]
    assert rows[0].length == 9


def test_overlaps(spark):
    frame = records(spark, (99, "a", 0, 60, "2M", "AC", [20, 35], None, None), (147, "a", 0, 60, "2M", "AG", [20, 10], None, None)).withColumn("qname", F.lit("q"))
    rows = aligned.overlaps_resolved(aligned.bases(frame, "ordinal", "qname", "rname")).orderBy("pos", "ordinal").collect()
    assert [r.qual for r in rows] == [40, 0, 28, 0]


def test_minus_strand_evidence_is_as_sequenced(spark):
    """A reverse read that agrees with the reference G was sequenced as C and says nothing."""
    blocks = spark.createDataFrame([("a", 0, "TTAGTT")], "contig string, block_start int, seq string")
    frame = records(spark, (99, "a", 2, 60, "3M", "AGT", [40] * 3, "x", None), (83, "a", 2, 60, "3M", "AGT", [40] * 3, "x", None), (83, "a", 2, 60, "3M", "ACT", [40] * 3, "x", None))
    rows = calls.call_ch(frame, blocks, calls.CallConfig(), ("cb",)).collect()
    assert [(r.pos, r.context, r.strand, r.meth, r.unmeth) for r in rows] == [(3, "CT", "-", 0, 2)]


def test_spots_know_both_spellings(spark):
    whitelist = spark.createDataFrame([(0, "00", "AACGTGAT"), (1, "01", "AAACATCG")], "ord int, barcode_index string, seq string")
    spots = calls.cb_to_spot(calls.spot_keys(whitelist), converted=True)
    frame = spark.createDataFrame([("AACGTGAT+AAACATCG",), ("aacgtgatAAACATCG",), ("AATGTGAT+AAATATTG",), ("x",), (None,)], "cb string")
    assert summary.reads_per_spot(frame, spots).collect() == [("00_01", 3)]
    assert calls.unknown_cbs(frame, spots).collect() == [("X", 1)]


def test_nearest_barcode(spark):
    whitelist = spark.createDataFrame([("AAAA",), ("TTTT",), ("AATT",)], "seq string")
    seen = spark.createDataFrame([("AAAA",), ("AAAC",), ("AAAT",), ("GGGG",), ("TTNT",), (None,)], "observed string")
    got = {r.observed: (r.barcode, r.distance) for r in barcodes.nearest(seen, whitelist).collect()}
    assert got == {"AAAA": ("AAAA", 0), "AAAC": ("AAAA", 1), "AAAT": (None, None), "GGGG": (None, None), "TTNT": ("TTTT", 1)}


def test_saturation(spark):
    histogram = spark.createDataFrame([("s", 1, 2), ("s", 2, 1)], "spot_id string, depth int, sites int")
    got = {r.fraction: r.expected for r in saturation.expected_unique(histogram, (0.5, 1.0)).collect()}
    assert got == {0.5: pytest.approx(1.75), 1.0: pytest.approx(3)}
    values = spark.createDataFrame([(1.0, x) for x in (1.0, 5.0, 2.5, 9.0, 7.25, 3.0)], "fraction double, expected double")
    row = saturation.medians(values).first()
    assert (row["median"], row.low, row.high) == (4, 1.375, 2.6875)
    row = saturation.medians(values.limit(1)).first()
    assert (row.low, row.high) == (0, 0)
    straight = spark.createDataFrame([(f, 10 * f) for f in saturation.FRACTIONS], "fraction double, median double")
    row = saturation.summary(straight, 3).first()
    assert (row.extrapolation_model, row.saturation_rate, row.predicted_median_unique_cpgs_at_2x, row.hq_spot_count) == ("linear", None, 20, 3)
    import math

    curve = spark.createDataFrame([(f, 500 * (1 - math.exp(-2.5 * f))) for f in saturation.FRACTIONS], "fraction double, median double")
    fit = saturation.saturation_fit(curve).first()
    assert fit.maximum == pytest.approx(500, rel=1e-3) and fit.rate == pytest.approx(2.5, rel=1e-3)


def test_cutoffs(spark):
    rates = [0.9, 0.8, 0.5, *[0.4] * 24, 0.6, 0.8, 0.9]
    points = spark.createDataFrame([("R2", k + 1, 100, r) for k, r in enumerate(rates)], "read string, cycle int, coverage bigint, methylation_rate double")
    row = mbias.cutoffs(points, mbias.CutoffConfig(run=5)).first()
    assert (row.axis_start, row.axis_end, row.stable_start, row.stable_end, row.left_trim, row.right_trim) == (1, 30, 4, 27, 3, 3)
    assert mbias.cutoffs(points.where("cycle < 6"), mbias.CutoffConfig()).count() == 0


def test_uniquely_mapped(spark):
    for flag, mapq, nh, want in ((99, 60, "2", False), (99, 60, "1", True), (99, 60, "x", True), (99, 60, None, True), (4, 60, None, False), (99, 5, None, False)):
        assert value(spark, chemistry.uniquely_mapped(F.lit(flag), F.lit(mapq), F.lit(nh).cast("string"), 10)) is want


def test_spot_means(spark):
    stats = spark.createDataFrame([("a", 50.0, 1), ("b", 80.0, 3)], "spot_id string, mean double, sites bigint")
    assert tuple(summary.spot_means(stats, "mean", "median").first()) == (72.5, 2.0)


def test_calls_count_what_mates_both_cover_once(spark):
    blocks = spark.createDataFrame([("a", 0, "TTACGTTTTAGTT")], "contig string, block_start int, seq string")

    def called(one, other, q1, q2, call, pos):
        frame = records(spark, (99, "a", pos, 60, f"{len(one)}M", one, [q1] * len(one), "x", None), (147, "a", pos, 60, f"{len(other)}M", other, [q2] * len(other), "x", None))
        found = [[(r.meth, r.unmeth) for r in call(f, blocks, calls.CallConfig(), ("cb",)).collect()] for f in (frame.withColumn("qname", F.lit("q")), frame.withColumn("qname", F.lit("*")), frame.drop("qname"))]
        assert found[1] == found[2]
        return found[:2]

    assert called("CG", "CG", 40, 35, calls.call_cg, 3) == [[(0, 1)], [(0, 2)]]
    assert called("CG", "TG", 38, 40, calls.call_cg, 3) == [[(1, 0)], [(1, 1)]]
    assert called("CG", "TG", 35, 34, calls.call_cg, 3) == [[], [(1, 1)]]
    # mates agree along the reference, though they were sequenced in opposite directions
    assert called("AGT", "AGT", 20, 20, calls.call_ch, 9) == [[(0, 1)], []]


@pytest.mark.parametrize(("text", "place"), [("xxABCDEFGHxx", 2), ("xxABCDXFGHxx", 2), ("xxABCEFGHxx", 2), ("xxABCDxEFGHxx", 2), ("ABCDEFGHABCDEFGH", None), ("ABXDEFGHABCDXFGH", None), ("xxABXDXFGHxx", None), ("xBCDEFGH", 0), ("", None), (None, None)])
def test_near_position(spark, text, place):
    assert value(spark, dna.near_position(F.col("t"), "ABCDEFGH", 1), t=text or "") == place


def test_near_position_within_two_edits(spark):
    """Against all parts of random texts by the edit distance written out."""
    import random

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            before, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
        return row[-1]

    rng = random.Random(1)
    pattern = "ACGTTGCA"
    texts = []
    for _ in range(150):
        p = list(pattern)
        for _ in range(rng.randrange(4)):
            k = rng.randrange(len(p))
            p[k : k + 1] = rng.choice([[], [rng.choice("ACGT")], [p[k], rng.choice("ACGT")]])
        texts.append("".join(rng.choice("ACGT") for _ in range(rng.randrange(8))) + "".join(p) + "".join(rng.choice("ACGT") for _ in range(rng.randrange(8))))
    for most in (0, 1, 2):
        rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", dna.near_position(F.col("t"), pattern, most).alias("at")).collect()
        for r in rows:
            tried = [(d, a, n) for a in range(len(r.t)) for n in range(max(1, 8 - most), 9 + most) if a + n <= len(r.t) and (d := distance(r.t[a : a + n], pattern)) <= most]
            least = min((d for d, *_ in tried), default=None)
            best = [(a, n) for d, a, n in tried if d == least]
            want = None
            if best:
                first = min(a for a, _ in best)
                ends = [first + n for a, n in best if a == first]
                # of matches that begin at the first place any may be taken; another behind them all makes it unclear
                if all(a < min(ends) for a, _ in best):
                    want = first
                elif any(a < max(ends) for a, _ in best if a >= min(ends)):
                    continue
            assert r.at == want, r.t


def test_corrections_within_a_distance(spark):
    whitelist = spark.createDataFrame([("AAAA",), ("AATT",), ("CCGG",)], "seq string")
    one, two = ({r.observed: (r.barcode, r.distance) for r in barcodes.corrections(whitelist, d).collect()} for d in (1, 2))
    assert one["AAAA"] == ("AAAA", 0) and one["CAAA"] == ("AAAA", 1) and "AAAT" not in one and "CCTT" not in one
    assert two["AGGA"] == ("AAAA", 2) and two["CAAA"] == ("AAAA", 1) and "AAAT" not in two
    assert {r.barcode for r in barcodes.corrections(whitelist, 0, True).collect()} == {"AAAA", "AATT", "TTGG"}


def test_mates_count_once_and_depth_is_capped(spark):
    """A site under both mates of a pair; and one under more records than the cap."""
    quals = [35] * 4
    pair = [(0, "p", 99, "c", 0, 60, "4M", "TGAA", quals, "x", "1"), (1, "p", 147, "c", 0, 60, "4M", "TGAA", quals, "x", "1")]
    blocks = spark.createDataFrame([("c", 0, "CGAA")], "contig string, block_start int, seq string")
    config = calls.CallConfig(max_depth=3)
    (row,) = calls.call_cg(spark.createDataFrame(pair, RECORD), blocks, config).collect()
    assert (row.meth, row.unmeth) == (1, 0)
    apart = [(k, f"q{k}", 99, "c", 0, 60, "4M", "TGAA" if k < 2 else "CGAA", quals, "x", "1") for k in range(6)]
    (row,) = calls.call_cg(spark.createDataFrame(apart, RECORD), blocks, config).collect()
    assert (row.meth, row.unmeth) == (2, 1)
