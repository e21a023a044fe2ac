"""All queries over the driver's tables, by name, with the same in DuckDB's SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from methylspark import oracle as sql
from methylspark.derived import tables
from methylspark.functions import dna
from methylspark.functions.chemistry import Assay
from methylspark.operators import aligned, barcodes, calls, mbias, saturation, summary, vmr

Query = Callable[[SparkSession, str], DataFrame]
FLAGSHIP = "call_cg_taps"
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}

TRIMS = {"R1": (3, 2), "R2": (1, 0)}
#: Thresholds that fit the derived reads' depth.
READS_ABOVE = 20
BIAS = mbias.BiasConfig(r1_length=30, max_cycle=30)
CUTOFF = mbias.CutoffConfig(r1_length=30, rate_tolerance=0.2, coverage_fraction=0.2, min_coverage=3, run=3)
POSITIONS = dna.methylated_positions("3,6,10", barcodes.INSERT_LEFT)


def query(name: str, twin: str) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[name] = f
        ORACLE_SQL[name] = twin
        return f

    return register


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calls.spot_keys(tables(spark, sf_dir, "whitelist")[0])


def spot_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calls.with_spot(tables(spark, sf_dir, "reads")[0], calls.cb_to_spot(manifest(spark, sf_dir)))


def host_cg(spark: SparkSession, sf_dir: str, assay: Assay = Assay.TAPS) -> DataFrame:
    config = calls.CallConfig(assay, trims=TRIMS)
    return calls.call_cg(spot_records(spark, sf_dir), tables(spark, sf_dir, "ref_blocks")[0], config, ("spot_id",))


def host_ch(spark: SparkSession, sf_dir: str, assay: Assay = Assay.TAPS) -> DataFrame:
    config = calls.CallConfig(assay, trims=TRIMS)
    return calls.call_ch(spot_records(spark, sf_dir), tables(spark, sf_dir, "ref_blocks")[0], config, ("spot_id",))


def host_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calls.call_all(spot_records(spark, sf_dir), tables(spark, sf_dir, "ref_blocks")[0], calls.CallConfig(trims=TRIMS), ("spot_id",))


for _assay in Assay:
    _name = _assay.value.replace("-", "_")
    query(f"call_cg_{_name}", sql.query(sql.SITES, sql.BASES, sql.SPOTS, sql.cg_calls(_assay, TRIMS, True, "cg"), "SELECT * FROM cg"))(lambda spark, d, a=_assay: host_cg(spark, d, a))
    query(f"call_ch_{_name}", sql.query(sql.SITES, sql.BASES, sql.SPOTS, sql.ch_calls(_assay, TRIMS, True, "ch"), "SELECT * FROM ch"))(lambda spark, d, a=_assay: host_ch(spark, d, a))


@query("call_aggregate", sql.query(sql.SITES, sql.BASES, sql.cg_calls(Assay.TAPS, TRIMS, False, "cg"), sql.ch_calls(Assay.TAPS, TRIMS, False, "ch"), "SELECT rname, pos, 'CG' AS context, '+' AS strand, meth, unmeth, pct FROM cg WHERE rname IN ('chrM', 'lambda') UNION ALL SELECT rname, pos, context, strand, meth, unmeth, pct FROM ch WHERE rname IN ('chrM', 'lambda')"))
def call_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    reads, blocks = tables(spark, sf_dir, "reads", "ref_blocks")
    blocks, reads = blocks.where("role <> 'host'"), reads.where(F.col("rname").isin("chrM", "lambda"))
    return calls.call_all(reads, blocks, calls.CallConfig(trims=TRIMS))


TARGETS = {"host": ["chr1", "chr2", "chr3"], "host_mito": ["chrM"], "lambda": ["lambda"]}


@query("target_records", sql.query("SELECT CASE WHEN role = 'spike' THEN contig WHEN role = 'mito' THEN 'host_mito' ELSE 'host' END AS target, count(*) AS records, count(DISTINCT rname) AS contigs FROM reads JOIN contigs ON contig = rname GROUP BY ALL"))
def target_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calls.with_target(tables(spark, sf_dir, "reads")[0], TARGETS).groupBy("target").agg(F.count("*").alias("records"), F.count_distinct("rname").alias("contigs"))


@query("call_totals", sql.query(sql.SITES, sql.BASES, sql.SPOTS, sql.cg_calls(Assay.TAPS, TRIMS, True, "cg"), "SELECT rname, count(*) AS processed, count(*) FILTER (meth + unmeth > 0) AS covered FROM cg GROUP BY rname"))
def call_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calls.totals(host_cg(spark, sf_dir), "rname")


@query("first_records", sql.query("SELECT ordinal, qname, flag FROM reads WHERE mapq >= 10 ORDER BY ordinal LIMIT 100"))
def first_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mbias.first_records(tables(spark, sf_dir, "reads")[0].where("mapq >= 10"), 100, "ordinal").select("ordinal", "qname", "flag")


FOUND_TRIMS = {"R1": (2, 1), "R2": (1, 2)}


@query("call_cg_found_trims", sql.query(sql.SITES, sql.BASES, sql.SPOTS, sql.cg_calls(Assay.TAPS, FOUND_TRIMS, False, "cg"), "SELECT * FROM cg"))
def call_cg_found_trims(spark: SparkSession, sf_dir: str) -> DataFrame:
    reads, blocks = tables(spark, sf_dir, "reads", "ref_blocks")
    cutoffs = spark.createDataFrame([(r, *cut) for r, cut in FOUND_TRIMS.items()], "read string, left_trim int, right_trim int")
    return calls.call_cg(reads, blocks, calls.CallConfig(trims=TRIMS), trims=calls.trims_of(cutoffs, TRIMS))


@query("spot_manifest", sql.query(sql.SPOTS, "SELECT * FROM manifest"))
def spot_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(spark, sf_dir)


@query("cb_to_spot", sql.query(sql.SPOTS, "SELECT cb, spot_id FROM spots UNION SELECT translate(cb, 'C', 'T'), spot_id FROM spots"))
def cb_to_spot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calls.cb_to_spot(manifest(spark, sf_dir), converted=True)


@query("unknown_cbs", sql.query(sql.SPOTS, "SELECT upper(cb) AS cb, count(*) AS records FROM reads WHERE cb IS NOT NULL AND upper(cb) NOT IN (SELECT cb FROM spots) GROUP BY ALL"))
def unknown_cbs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calls.unknown_cbs(tables(spark, sf_dir, "reads")[0], calls.cb_to_spot(manifest(spark, sf_dir)))


@query("reads_per_spot", sql.query(sql.SPOTS, sql.READS_PER_SPOT, "SELECT * FROM spot_reads"))
def reads_per_spot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.reads_per_spot(tables(spark, sf_dir, "reads")[0], calls.cb_to_spot(manifest(spark, sf_dir)))


@query("mapped_valid_reads", sql.query(f"SELECT count(*) FILTER ({sql.MAPPED}) AS mapped, count(*) FILTER ({sql.MAPPED} AND {sql.PAIRED}) AS valid FROM reads"))
def mapped_valid_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.mapped_valid(tables(spark, sf_dir, "reads")[0])


def _bits(n: int) -> str:
    return f"(flag & {n}) > 0"


@query("flagstat", sql.query(f"SELECT count(*) AS total, count(*) FILTER (p) AS primary, count(*) FILTER ({_bits(256)}) AS secondary, count(*) FILTER ({_bits(2048)}) AS supplementary, count(*) FILTER ({_bits(1024)}) AS duplicates, count(*) FILTER (NOT {_bits(4)}) AS mapped, count(*) FILTER (p AND {_bits(1)}) AS paired, count(*) FILTER (p AND {_bits(1)} AND {_bits(64)}) AS read1, count(*) FILTER (p AND {_bits(1)} AND {_bits(128)}) AS read2, count(*) FILTER (p AND {_bits(1)} AND {_bits(2)} AND NOT {_bits(4)}) AS properly_paired, count(*) FILTER (p AND {_bits(1)} AND NOT {_bits(4)} AND NOT {_bits(8)}) AS both_mapped, count(*) FILTER (p AND {_bits(1)} AND NOT {_bits(4)} AND {_bits(8)}) AS singletons FROM (SELECT *, (flag & 2304) = 0 AS p FROM reads)"))
def flagstat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.flagstat(tables(spark, sf_dir, "reads")[0])


@query("ref_site_classes", sql.query(sql.SITES, "SELECT * FROM sites"))
def ref_site_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aligned.reference_sites(tables(spark, sf_dir, "ref_blocks")[0])


@query("aligned_bases", sql.query(sql.BASES, "SELECT ordinal, qpos, rpos AS pos, base, next_base, q AS qual, coalesce(next_q, -1) AS next_qual FROM bases"))
def aligned_bases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aligned.bases(tables(spark, sf_dir, "reads")[0], "ordinal").drop("length").withColumn("next_qual", F.coalesce("next_qual", F.lit(-1)))


OVERLAP_SQL = sql.query(sql.BASES, "SELECT ordinal, qpos, rpos AS pos, base, CAST(CASE WHEN n = 2 THEN CASE WHEN k > 1 THEN 0 WHEN lo = hi THEN least(total, 200) ELSE floor(q * 0.8::DOUBLE) END ELSE q END AS INTEGER) AS qual FROM (SELECT *, count(*) OVER w AS n, row_number() OVER (w ORDER BY q DESC, ordinal) AS k, min(base) OVER w AS lo, max(base) OVER w AS hi, sum(q) OVER w AS total FROM bases WINDOW w AS (PARTITION BY qname, rname, rpos))")


@query("overlap_resolution", OVERLAP_SQL)
def overlap_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = aligned.bases(tables(spark, sf_dir, "reads")[0], "ordinal", "qname", "rname")
    return aligned.overlaps_resolved(placed).select("ordinal", "qpos", "pos", "base", "qual")


@query("depth_cap", sql.query(sql.BASES, "SELECT ordinal, qpos, pos FROM (SELECT ordinal, qpos, rpos AS pos, row_number() OVER (PARTITION BY rname, rpos ORDER BY ordinal, qpos) AS k FROM bases) WHERE k <= 40"))
def depth_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    reads = tables(spark, sf_dir, "reads")[0]
    return aligned.depth_capped(aligned.bases(reads, "ordinal", "rname"), 40, reads).select("ordinal", "qpos", "pos")


MBIAS = f"""mbias AS (SELECT CASE WHEN (flag & 64) > 0 THEN 'R1' ELSE 'R2' END AS read, CAST(CASE WHEN (flag & 64) > 0 THEN {BIAS.r1_length} - len ELSE 0 END + CASE WHEN (flag & 16) > 0 THEN len - qpos ELSE qpos + 1 END AS INTEGER) AS cycle,
  count(*) FILTER (concat(base, next_base) IN ('TG', 'CA')) AS methylated_count, count(*) FILTER (concat(base, next_base) = 'CG') AS unmethylated_count FROM bases JOIN sites ON sites.contig = rname AND sites.pos = rpos AND context = 'CG'
  WHERE {sql.PAIRED} AND mapq >= 10 AND q >= 30 AND next_q >= 30 AND concat(base, next_base) IN ('TG', 'CA', 'CG') AND next_base IS NOT NULL GROUP BY ALL),
points AS (SELECT *, methylated_count + unmethylated_count AS coverage, round_even(methylated_count / (methylated_count + unmethylated_count), 6) AS methylation_rate FROM mbias WHERE cycle BETWEEN 1 AND {BIAS.max_cycle})"""


def bias_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    reads, blocks = tables(spark, sf_dir, "reads", "ref_blocks")
    return mbias.cycles(reads, blocks, BIAS)


@query("mbias_cycles", sql.query(sql.SITES, sql.BASES, MBIAS, "SELECT * FROM points"))
def mbias_cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bias_points(spark, sf_dir)


@query("mbias_plot_points", sql.query(sql.SITES, sql.BASES, MBIAS, "SELECT read, cycle, round_even(methylation_rate * 100, 4) AS percent FROM points"))
def mbias_plot_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bias_points(spark, sf_dir).select("read", "cycle", F.bround(F.col("methylation_rate") * 100, 4).alias("percent"))


@query("mbias_rolling_median", sql.query(sql.SITES, sql.BASES, MBIAS, "SELECT read, cycle, coverage, round_even(quantile_cont(CASE WHEN coverage >= 3 THEN methylation_rate END, 0.5) OVER w, 6) AS local_rate, count(CASE WHEN coverage >= 3 THEN 1 END) OVER w AS local_points FROM points WINDOW w AS (PARTITION BY read ORDER BY cycle RANGE BETWEEN 2 PRECEDING AND 2 FOLLOWING)"))
def mbias_rolling_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mbias.rolling_median(bias_points(spark, sf_dir), F.lit(3), 5)
    return found.select("read", "cycle", "coverage", F.bround("local_rate", 6).alias("local_rate"), "local_points")


CUTOFFS_SQL = f"""SELECT a.read, a.read_length, axis_start, axis_end, stable_start, stable_end, stable_start - axis_start AS left_trim, axis_end - stable_end AS right_trim, round_even(baseline, 6) AS baseline_methylation_rate, threshold AS coverage_threshold
FROM axis a JOIN central USING (read) JOIN (SELECT read, min(a) AS stable_start, max(z) AS stable_end FROM runs GROUP BY read) USING (read)"""
CUTOFF_PARTS = f"""first AS (SELECT read, greatest({CUTOFF.min_coverage}, CAST(round_even(median(coverage) * {CUTOFF.coverage_fraction}, 0) AS INTEGER)) AS preliminary FROM points WHERE coverage >= {CUTOFF.min_coverage} GROUP BY read),
ends AS (SELECT read, min(cycle) FILTER (coverage >= preliminary) AS supported, max(cycle) AS longest FROM points JOIN first USING (read) GROUP BY read),
axis AS (SELECT *, axis_end - axis_start + 1 AS read_length FROM (SELECT read, CASE WHEN read = 'R1' THEN supported ELSE 1 END AS axis_start, CASE WHEN read = 'R1' THEN {CUTOFF.r1_length} ELSE longest END AS axis_end FROM ends WHERE supported IS NOT NULL) WHERE axis_start <= axis_end),
central AS (SELECT read, median(methylation_rate) AS baseline, greatest({CUTOFF.min_coverage}, CAST(round_even(median(coverage) * {CUTOFF.coverage_fraction}, 0) AS INTEGER)) AS threshold FROM points JOIN axis USING (read)
  WHERE coverage >= {CUTOFF.min_coverage} AND cycle BETWEEN axis_start + read_length // 4 AND axis_end - read_length // 4 GROUP BY read HAVING count(*) >= {CUTOFF.run}),
judged AS (SELECT p.*, threshold, baseline, axis_start, axis_end, quantile_cont(CASE WHEN coverage >= threshold THEN methylation_rate END, 0.5) OVER w AS local_rate, count(CASE WHEN coverage >= threshold THEN 1 END) OVER w AS local_points
  FROM points p JOIN central USING (read) JOIN axis USING (read) WINDOW w AS (PARTITION BY p.read ORDER BY cycle RANGE BETWEEN 2 PRECEDING AND 2 FOLLOWING)),
stable AS (SELECT read, cycle, cycle - row_number() OVER (PARTITION BY read ORDER BY cycle) AS island FROM judged WHERE coverage >= threshold AND local_points >= 3 AND abs(local_rate - baseline) <= {CUTOFF.rate_tolerance} AND cycle BETWEEN axis_start AND axis_end),
runs AS (SELECT read, island, min(cycle) AS a, max(cycle) AS z FROM stable GROUP BY ALL HAVING count(*) >= {CUTOFF.run})"""


@query("mbias_cutoffs", sql.query(sql.SITES, sql.BASES, MBIAS, CUTOFF_PARTS, CUTOFFS_SQL))
def mbias_cutoffs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mbias.cutoffs(bias_points(spark, sf_dir), CUTOFF)


#: Trims that the cycles show; without those of both reads there are no calls.
BIAS_TRIMS = {r: tuple(f"(SELECT max({side}_trim) FILTER (read = '{r}') FROM cut)" for side in ("left", "right")) for r in ("R1", "R2")}


@query("call_cg_bias_trims", sql.query(sql.SITES, sql.BASES, MBIAS, CUTOFF_PARTS, f"cut AS ({CUTOFFS_SQL})", sql.cg_calls(Assay.TAPS, BIAS_TRIMS, False, "cg"), "SELECT * FROM cg WHERE (SELECT count(DISTINCT read) FROM cut) = 2"))
def call_cg_bias_trims(spark: SparkSession, sf_dir: str) -> DataFrame:
    reads, blocks = tables(spark, sf_dir, "reads", "ref_blocks")
    found = calls.trims_of(mbias.cutoffs(bias_points(spark, sf_dir), CUTOFF), None)
    return calls.call_cg(reads, blocks, calls.CallConfig(trims=TRIMS), trims=found)


CG = (sql.SITES, sql.BASES, sql.SPOTS, sql.cg_calls(Assay.TAPS, TRIMS, True, "cg"))


#: Calls of spots with enough reads, as saturation takes them.
GOOD = (*CG, sql.READS_PER_SPOT, f"good AS (SELECT spot_id FROM spot_reads WHERE reads > {READS_ABOVE} AND spot_id IN (SELECT spot_id FROM cg))", sql.HISTOGRAM)


def histogram_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return saturation.depth_histogram(host_cg(spark, sf_dir), reads_per_spot(spark, sf_dir), READS_ABOVE)


def curve_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return saturation.medians(saturation.expected_unique(histogram_of(spark, sf_dir)))


@query("depth_histogram", sql.query(*GOOD, "SELECT * FROM histogram"))
def depth_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return histogram_of(spark, sf_dir)


@query("good_spots", sql.query(*CG, sql.READS_PER_SPOT, f"SELECT spot_id FROM spot_reads WHERE reads > {READS_ABOVE} AND spot_id IN (SELECT spot_id FROM cg)"))
def good_spots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return saturation.good_spots(reads_per_spot(spark, sf_dir), host_cg(spark, sf_dir), READS_ABOVE)


@query("expected_unique", sql.query(*GOOD, sql.EXPECTED, "SELECT spot_id, fraction, round_even(expected, 6) AS expected FROM expected"))
def expected_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return saturation.expected_unique(histogram_of(spark, sf_dir)).withColumn("expected", F.bround("expected", 6))


@query("saturation_medians", sql.query(*GOOD, sql.EXPECTED, sql.CURVE, "SELECT fraction, round_even(median, 6) AS median, round_even(greatest(0, median - q1), 6) AS low, round_even(greatest(0, q3 - median), 6) AS high FROM curve"))
def saturation_medians(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curve_of(spark, sf_dir).select("fraction", *(F.bround(c, 6).alias(c) for c in ("median", "low", "high")))


@query("saturation_linear_fit", sql.query(*GOOD, sql.EXPECTED, sql.CURVE, sql.LINEAR, "SELECT round_even(slope, 6) AS slope, round_even(r2, 6) AS r2 FROM linear"))
def saturation_linear_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return saturation.linear_fit(curve_of(spark, sf_dir)).select(F.bround("slope", 6).alias("slope"), F.bround("r2", 6).alias("r2"))


@query("saturation_exp_fit", sql.query(*GOOD, sql.EXPECTED, sql.CURVE, sql.FIT, "SELECT round_even(maximum, 4) AS maximum, round_even(rate, 6) AS rate FROM fit3"))
def saturation_exp_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return saturation.saturation_fit(curve_of(spark, sf_dir)).select(F.bround("maximum", 4).alias("maximum"), F.bround("rate", 6).alias("rate"))


SUMMARY_SQL = """SELECT CAST(round_even(observed, 0) AS BIGINT) AS observed_median_unique_cpgs, CAST(round_even(CASE WHEN r2 < 0.99 AND maximum > 0 THEN maximum END, 0) AS BIGINT) AS theoretical_max_median_unique_cpgs,
CAST(round_even(CASE WHEN r2 >= 0.99 THEN slope * 2 WHEN maximum > 0 THEN maximum * (1 - exp(-rate * 2)) END, 0) AS BIGINT) AS predicted_median_unique_cpgs_at_2x, round_even(CASE WHEN r2 < 0.99 AND maximum > 0 THEN observed / maximum * 100 END, 4) AS saturation_rate,
CASE WHEN r2 >= 0.99 THEN 'linear' ELSE 'saturation' END AS extrapolation_model, (SELECT count(DISTINCT spot_id) FROM histogram) AS hq_spot_count FROM linear, fit3, (SELECT arg_max(median, fraction) AS observed FROM curve)"""


@query("saturation_summary", sql.query(*GOOD, sql.EXPECTED, sql.CURVE, sql.LINEAR, sql.FIT, SUMMARY_SQL))
def saturation_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return saturation.summary(curve_of(spark, sf_dir))


BOTH = (*CG, sql.ch_calls(Assay.TAPS, TRIMS, True, "ch"))
CONTEXTS = ("CG", "CA", "CC", "CT")


def stats_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.context_stats(host_all(spark, sf_dir))


STATS = tuple(sql.stats("cg" if c == "CG" else "ch", f"stats_{c.lower()}", "true" if c == "CG" else f"context = '{c}'") for c in CONTEXTS)
_SHOWN = ", ".join(f"{c.lower()}.mean AS {summary.names_of(c)[0]}, CAST({c.lower()}.sites AS DOUBLE) AS {summary.names_of(c)[1]}" for c in CONTEXTS)
_KEYS = " UNION ".join(f"SELECT spot_id FROM {t}" for t in ("manifest", "spot_reads", *(f"stats_{c.lower()}" for c in CONTEXTS)))


@query("spot_context_stats", sql.query(*BOTH, *STATS, " UNION ALL ".join(f"SELECT '{c}' AS context, * FROM stats_{c.lower()}" for c in CONTEXTS)))
def spot_context_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats_of(spark, sf_dir)


PER_SPOT_SQL = f"SELECT x AS X_index, y AS Y_index, k.spot_id AS spot, {_SHOWN}, coalesce(reads, 0) AS reads FROM ({_KEYS}) k LEFT JOIN manifest USING (spot_id) LEFT JOIN spot_reads USING (spot_id) " + " ".join(f"LEFT JOIN stats_{c.lower()} {c.lower()} USING (spot_id)" for c in CONTEXTS)


@query("per_spot_summary", sql.query(*BOTH, sql.READS_PER_SPOT, *STATS, PER_SPOT_SQL))
def per_spot_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = summary.per_spot(manifest(spark, sf_dir), reads_per_spot(spark, sf_dir), stats_of(spark, sf_dir), CONTEXTS)
    return rows.withColumns({c: F.col(c).cast("double") for c in (summary.names_of(c)[1] for c in CONTEXTS)})


@query("heatmap_points", sql.query(*CG, STATS[0], "SELECT x, y, mean AS value FROM manifest LEFT JOIN stats_cg USING (spot_id)"))
def heatmap_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = summary.context_stats(host_cg(spark, sf_dir))
    return manifest(spark, sf_dir).join(found, "spot_id", "left").select("x", "y", F.col("mean").alias("value"))


@query("violin_values", sql.query(*BOTH, *STATS, " UNION ALL ".join(f"SELECT '{c}' AS context, count(*) AS n, min(mean) AS least, max(mean) AS most, round_even(median(mean), 6) AS median FROM stats_{c.lower()}" for c in CONTEXTS)))
def violin_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spot_context_stats(spark, sf_dir)
    return found.groupBy("context").agg(F.count("*").alias("n"), F.min("mean").alias("least"), F.max("mean").alias("most"), F.bround(F.median("mean"), 6).alias("median"))


SAMPLE_SQL = f"""SELECT 20000 AS raw_reads, 15000 AS barcoded_reads, '75.00%' AS barcoded_reads_rate, host.mapped AS host_mapped_reads, host.valid AS host_valid_reads, printf('%.2f%%', round_even(host.valid / 20000 * 100, 2)) AS valid_reads_rate, spike.mapped AS lambda_mapped_reads,
host_spot_mean_methylation, host_spot_median_cpg_sites, (SELECT round_even(sum(CAST(round_even(pct * 100, 0) AS BIGINT)) / 100 / count(*), 6) FROM whole WHERE rname = 'lambda') AS lambda_mean_methylation
FROM (SELECT count(*) FILTER ({sql.MAPPED}) AS mapped, count(*) FILTER ({sql.MAPPED} AND {sql.PAIRED}) AS valid FROM reads WHERE rname LIKE 'chr%') host, (SELECT count(*) FILTER ({sql.MAPPED}) AS mapped FROM reads WHERE rname = 'lambda') spike,
(SELECT round_even(CAST(sum(CAST(mean AS DECIMAL(18,6)) * sites) AS DOUBLE) / sum(sites), 6) AS host_spot_mean_methylation, median(sites) AS host_spot_median_cpg_sites FROM stats_cg) means"""


@query("sample_summary", sql.query(*CG, STATS[0], sql.cg_calls(Assay.TAPS, TRIMS, False, "whole"), SAMPLE_SQL))
def sample_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample_row_of(spark, sf_dir, 20_000, 15_000)


def sample_row_of(spark: SparkSession, sf_dir: str, raw: int | DataFrame, barcoded: int | DataFrame) -> DataFrame:
    reads, blocks = tables(spark, sf_dir, "reads", "ref_blocks")
    spike = reads.where("rname = 'lambda'")
    called = calls.call_cg(spike, blocks.where("contig = 'lambda'"), calls.CallConfig(trims=TRIMS))
    means = [summary.spot_means(summary.context_stats(host_cg(spark, sf_dir)), "host_spot_mean_methylation", "host_spot_median_cpg_sites"), summary.aggregate_mean(called, "lambda_mean_methylation")]
    return summary.sample_row(raw, barcoded, summary.mapped_valid(reads.where("rname like 'chr%'")), {"lambda": summary.mapped_valid(spike)}, means)


@query("barcode_exact", sql.query(sql.PLACED, "SELECT ordinal, linker_at, observed2, ord FROM placed JOIN whitelist ON seq = observed2"))
def barcode_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs, whitelist = tables(spark, sf_dir, "pairs", "whitelist")
    return barcodes.placed(pairs, barcodes.Layout()).join(whitelist, F.col("seq") == F.coalesce("observed2", F.lit(""))).select("ordinal", "linker_at", "observed2", "ord")


@query("barcode_nearest", sql.query(sql.PLACED, sql.NEAREST, "SELECT DISTINCT p.observed1 AS observed, barcode, coalesce(distance, -1) AS distance FROM placed p LEFT JOIN known ON known.observed = p.observed1 WHERE p.observed1 IS NOT NULL"))
def barcode_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs, whitelist = tables(spark, sf_dir, "pairs", "whitelist")
    seen = barcodes.placed(pairs, barcodes.Layout()).select(F.col("observed1").alias("observed"))
    return barcodes.nearest(seen, whitelist).withColumn("distance", F.coalesce("distance", F.lit(-1)))


REJECTIONS_SQL = "SELECT ordinal, barcode1, barcode2, array_to_string(reasons, ',') AS reasons, coalesce(insert_at + 34, -1) AS insert_start, CASE WHEN len(reasons) = 0 THEN concat('@', barcode1, '+', barcode2, ':', substr(h1, 2)) END AS header FROM judged"


def rejected(spark: SparkSession, sf_dir: str, assay: Assay = Assay.TAPS) -> DataFrame:
    pairs, whitelist = tables(spark, sf_dir, "pairs", "whitelist")
    return barcodes.rejections(pairs, whitelist, barcodes.Layout(assay))


def rejections_of(spark: SparkSession, sf_dir: str, assay: Assay) -> DataFrame:
    header = F.when(F.size("reasons") == 0, dna.annotated_header(F.col("h1"), F.col("barcode1"), F.col("barcode2")))
    return rejected(spark, sf_dir, assay).select("ordinal", "barcode1", "barcode2", F.concat_ws(",", "reasons").alias("reasons"), F.coalesce("insert_start", F.lit(-1)).alias("insert_start"), header.alias("header"))


for _assay in Assay:
    _name = "extract_rejections" if _assay == Assay.TAPS else f"extract_rejections_{_assay.value.replace('-', '_')}"
    query(_name, sql.query(sql.placed_sql(_assay), sql.nearest_sql(_assay in barcodes.CONVERTED), sql.REJECTED, REJECTIONS_SQL))(lambda spark, d, a=_assay: rejections_of(spark, d, a))


@query("extract_reject_counts", sql.query(sql.PLACED, sql.NEAREST, sql.REJECTED, "SELECT count(*) AS total_reads, count(*) FILTER (len(reasons) = 0) AS kept_reads, " + ", ".join(f"count(*) FILTER (list_contains(reasons, '{r}')) AS {r}" for r in barcodes.REASONS) + " FROM judged"))
def extract_reject_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return barcodes.reject_counts(rejected(spark, sf_dir))


_COUNTED = SAMPLE_SQL.replace("20000 AS raw_reads, 15000 AS barcoded_reads, '75.00%' AS barcoded_reads_rate", "raw AS raw_reads, kept AS barcoded_reads, printf('%.2f%%', round_even(kept / raw * 100, 2)) AS barcoded_reads_rate").replace("host.valid / 20000 * 100", "host.valid / raw * 100") + ", (SELECT 2 * count(*) AS raw, 2 * count(*) FILTER (len(reasons) = 0) AS kept FROM judged)"


@query("sample_summary_counted", sql.query(*CG, STATS[0], sql.cg_calls(Assay.TAPS, TRIMS, False, "whole"), sql.PLACED, sql.NEAREST, sql.REJECTED, _COUNTED))
def sample_summary_counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sample's row with raw and barcoded reads as extraction counts them."""
    counted = barcodes.reject_counts(rejected(spark, sf_dir))
    raw, kept = counted.select(F.col("total_reads") * 2), counted.select(F.col("kept_reads") * 2)
    return sample_row_of(spark, sf_dir, raw, kept)


#: The insert-left that taps-v2 found in kept pairs, and its places of C.
INSERTS = (sql.placed_sql(Assay.TAPS_V2), sql.NEAREST, sql.REJECTED, "seen AS (SELECT ordinal, substr(s1, CAST(insert_at AS INTEGER) + 1, 34) AS insert FROM judged WHERE len(reasons) = 0)")
C_PLACES = dna.c_positions(barcodes.INSERT_LEFT)


def inserts_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return barcodes.found_inserts(rejected(spark, sf_dir, Assay.TAPS_V2), barcodes.Layout(Assay.TAPS_V2))


@query("insert_conversion_by_position", sql.query(*INSERTS, f"letters AS (SELECT position, substr(insert, CAST(position AS INTEGER) + 1, 1) AS b FROM (SELECT insert, unnest({C_PLACES}) AS position FROM seen))", "SELECT position, count(*) FILTER (b = 'T') AS t_count, count(*) FILTER (b = 'C') AS c_count, count(*) FILTER (b NOT IN ('T', 'C')) AS other_count FROM letters GROUP BY position"))
def insert_conversion_by_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    return barcodes.insert_conversion(inserts_of(spark, sf_dir), C_PLACES)[0]


@query("insert_conversion_qc", sql.query(*INSERTS, "letters AS (SELECT ordinal, concat(substr(insert, 4, 1), substr(insert, 7, 1), substr(insert, 11, 1)) AS s FROM seen)", "numbers AS (SELECT ordinal, s, length(replace(replace(replace(s, 'A', ''), 'G', ''), 'C', '')) AS t, length(replace(replace(replace(s, 'A', ''), 'G', ''), 'T', '')) AS c FROM letters)", "SELECT count(*) AS reads, count(*) FILTER (t + c > 0) AS informative, round_even(avg(CASE WHEN t + c > 0 THEN t / (t + c) END), 6) AS mean_rate, count(*) FILTER (s = 'TTT') AS fully_converted FROM numbers"))
def insert_conversion_qc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return barcodes.insert_conversion(inserts_of(spark, sf_dir), POSITIONS)[1]


for _edits in (2, 3):
    _twin = sql.query(sql.nearest_part_sql("found", "(SELECT ordinal, substr(s1, 1, 60) AS w FROM pairs)", barcodes.LINKER, _edits), "SELECT p.ordinal, coalesce(place, -1) AS place FROM pairs p LEFT JOIN found USING (ordinal)")
    query(f"linker_within_{_edits}", _twin)(lambda spark, d, k=_edits: linkers_within(spark, d, k))


def linkers_within(spark: SparkSession, sf_dir: str, edits: int) -> DataFrame:
    window = F.left("s1", F.lit(60))
    return tables(spark, sf_dir, "pairs")[0].select("ordinal", F.coalesce(dna.near_position(window, barcodes.LINKER, edits), F.lit(-1)).cast("bigint").alias("place"))


CT_PATTERN = "CAC"
CT_SQL = """costs AS (SELECT ordinal, i, CASE WHEN substr(seq, i + 1, 1) NOT IN ('C', 'T') OR substr(seq, i + 3, 1) NOT IN ('C', 'T') THEN NULL ELSE CAST(substr(seq, i + 2, 1) <> 'A' AS INTEGER) END AS cost FROM (SELECT ordinal, seq, CAST(unnest(range(0, 23)) AS INTEGER) AS i FROM reads)),
least AS (SELECT ordinal, min(cost) AS cost FROM costs WHERE cost <= 1 GROUP BY ordinal),
found AS (SELECT ordinal, CASE WHEN count(*) = 1 THEN min(i) END AS place FROM costs JOIN least USING (ordinal, cost) GROUP BY ordinal)"""


@query("ct_pattern_search", sql.query(CT_SQL, "SELECT reads.ordinal, coalesce(place, -1) AS place FROM reads LEFT JOIN found USING (ordinal)"))
def ct_pattern_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables(spark, sf_dir, "reads")[0].select("ordinal", F.coalesce(dna.c_t_position(F.col("seq"), CT_PATTERN, 1), F.lit(-1)).alias("place"))


@query("pool_sort", sql.query("SELECT c_ord, rname, pos, ordinal, row_number() OVER (PARTITION BY rname ORDER BY pos, ordinal) AS place FROM reads JOIN contigs ON contig = rname"))
def pool_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql.window import Window

    reads, contigs = tables(spark, sf_dir, "reads", "contigs")
    halves = reads.where("ordinal % 2 = 0").unionByName(reads.where("ordinal % 2 <> 0"))
    placed = halves.join(contigs, F.col("contig") == F.col("rname")).repartitionByRange("c_ord", "pos").sortWithinPartitions("c_ord", "pos", "ordinal")
    place = F.row_number().over(Window.partitionBy("rname").orderBy("pos", "ordinal"))
    return placed.select("c_ord", "rname", "pos", "ordinal", place.alias("place"))


VMR = vmr.VmrConfig(bandwidth=40, window=60, step=20, share=0.2, min_sites=5)


@query("vmr_min_sites", sql.query(*CG, f"SELECT spot_id, count(*) AS sites FROM cg GROUP BY spot_id HAVING count(*) >= {VMR.min_sites}"))
def vmr_min_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vmr.enough_sites(host_cg(spark, sf_dir), VMR.min_sites)


VMR_PARTS = vmr.oracle_parts(VMR)


@query("vmr_smooth", sql.query(*CG, *VMR_PARTS[:3], "SELECT rname, pos, round_even(smooth, 6) AS smooth FROM smoothed"))
def vmr_smooth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vmr.smoothed(vmr.binary(host_cg(spark, sf_dir)), VMR).select("rname", "pos", F.bround("smooth", 6).alias("smooth"))


@query("vmr_windows", sql.query(*CG, *VMR_PARTS[:6], "SELECT rname, start, round_even(variance, 6) AS variance, spots FROM variances"))
def vmr_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vmr.windows(vmr.binary(host_cg(spark, sf_dir)), VMR).select("rname", "start", F.bround("variance", 6).alias("variance"), "spots")


@query("vmr_matrix", sql.query(*CG, *VMR_PARTS, "SELECT spot_id, rname, a AS start, z AS \"end\", methylated_sites, total_sites, round_even(methylated_sites / total_sites, 6) AS methylation_fraction, round_even(r / (total_sites + 1), 6) AS mean_shrunken_residual FROM cells"))
def vmr_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    sites = vmr.binary(host_cg(spark, sf_dir))
    return vmr.matrix(sites, vmr.regions(vmr.windows(sites, VMR), VMR), VMR)
