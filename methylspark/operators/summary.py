"""Reports by spot and by sample."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from methylspark.functions import chemistry, formats


def reads_per_spot(records: DataFrame, spots: DataFrame) -> DataFrame:
    """(spot_id, reads): every record whose CB is known, whatever its flags."""
    return records.where("cb is not null").select(F.upper("cb").alias("cb")).join(spots, "cb").groupBy("spot_id").agg(F.count("*").alias("reads"))


def mapped_valid(records: DataFrame, min_mapq: int = 10) -> DataFrame:
    """One row: mapped (uniquely mapped records) and valid (those of them in proper pairs)."""
    mapped = F.coalesce(chemistry.uniquely_mapped(F.col("flag"), F.col("mapq"), F.col("nh"), min_mapq), F.lit(False))
    return records.agg(F.count_if(mapped).alias("mapped"), F.count_if(mapped & F.col("flag").isin(*chemistry.PAIRED_FLAGS)).alias("valid"))


def flagstat(records: DataFrame) -> DataFrame:
    """One row of counters by flag bits."""
    has = lambda bit: F.col("flag").bitwiseAND(F.lit(bit)) != 0
    primary = ~has(0x900)
    paired = has(1) & primary
    return records.agg(
        F.count("*").alias("total"), F.count_if(primary).alias("primary"), F.count_if(has(0x100)).alias("secondary"), F.count_if(has(0x800)).alias("supplementary"), F.count_if(has(0x400)).alias("duplicates"), F.count_if(~has(4)).alias("mapped"),
        F.count_if(paired).alias("paired"), F.count_if(paired & has(0x40)).alias("read1"), F.count_if(paired & has(0x80)).alias("read2"), F.count_if(paired & has(2) & ~has(4)).alias("properly_paired"), F.count_if(paired & ~has(4) & ~has(8)).alias("both_mapped"), F.count_if(paired & ~has(4) & has(8)).alias("singletons"),
    )


def context_stats(calls: DataFrame) -> DataFrame:
    """(spot_id, context where the calls have it, mean, sites) of the two-place percents of called sites. Hundredths are summed as whole numbers, so the mean doesn't depend on their order."""
    keys = ["spot_id", *(["context"] if "context" in calls.columns else [])]
    hundredths = F.sum(F.bround(F.col("pct") * 100, 0).cast("bigint"))
    return calls.where(F.col("meth") + F.col("unmeth") > 0).groupBy(*keys).agg(F.bround(hundredths / 100 / F.count("*"), 6).alias("mean"), F.count("*").alias("sites"))


def all_contexts(cg: DataFrame | None, ch: DataFrame | None) -> DataFrame:
    """Calls of both kinds with their context: (spot_id, context, meth, unmeth, pct)."""
    shown = ["spot_id", "context", "meth", "unmeth", "pct"]
    parts = [c.select(shown) for c in (cg.withColumn("context", F.lit("CG")) if cg else None, ch) if c is not None]
    return reduce(DataFrame.unionByName, parts)


def names_of(context: str) -> tuple[str, str]:
    """The columns of a context's mean and number of sites."""
    return ("mean_methylation", "cpg_site_count") if context == "CG" else (f"mean_{context}_methylation", f"{context}_site_count")


def per_spot(manifest: DataFrame, reads: DataFrame, stats: DataFrame, contexts: tuple[str, ...]) -> DataFrame:
    """A row for each spot of the manifest, and any other that has reads or a call: X_index, Y_index, spot, each context's columns, reads. `stats` has a row for each spot and context."""
    wide = stats.groupBy("spot_id").pivot("context", list(contexts)).agg(F.first("mean").alias("mean"), F.first("sites").alias("sites"))
    shown = [F.col(f"{c}_{k}").alias(name) for c in contexts for k, name in zip(("mean", "sites"), names_of(c), strict=True)]
    rows = wide.join(reads, "spot_id", "full").join(manifest.select("spot_id", "x", "y"), "spot_id", "full")
    return rows.select(F.col("x").alias("X_index"), F.col("y").alias("Y_index"), F.col("spot_id").alias("spot"), *shown, F.coalesce("reads", F.lit(0)).alias("reads"))


def spot_means(stats: DataFrame, mean: str, median: str) -> DataFrame:
    """One row: the mean over spots weighted by sites, and the median number of sites."""
    weighted = F.sum(F.col("mean").cast("decimal(18,6)") * F.col("sites")).cast("double") / F.sum("sites")
    return stats.agg(F.bround(weighted, 6).alias(mean), F.median("sites").alias(median))


def aggregate_mean(calls: DataFrame, name: str) -> DataFrame:
    """One row: the mean of all sites' percents."""
    hundredths = F.sum(F.bround(F.col("pct") * 100, 0).cast("bigint"))
    return calls.agg(F.bround(hundredths / 100 / F.nullif(F.count("*"), F.lit(0)), 6).alias(name))


def sample_row(raw_reads: int | DataFrame | None, barcoded: int | DataFrame | None, host: DataFrame, spikes: dict[str, DataFrame], means: list[DataFrame]) -> DataFrame:
    """The sample's row. host and spikes are rows of `mapped_valid`; rates are of the raw reads. raw_reads and barcoded are numbers, or one-row DataFrames of one column as the readers of reports give them."""
    given = []
    for name, count in (("raw_reads", raw_reads), ("barcoded_reads", barcoded)):
        if isinstance(count, DataFrame):
            given.append(count.select(F.col(count.columns[0]).cast("bigint").alias(name)))
        else:
            host = host.withColumn(name, F.lit(count).cast("bigint"))
    rows = reduce(DataFrame.crossJoin, given, host)  # one row each
    raw, coded = F.col("raw_reads"), F.col("barcoded_reads")
    rows = rows.select(raw, coded, formats.rate_percent(coded, raw).alias("barcoded_reads_rate"), F.col("mapped").alias("host_mapped_reads"), F.col("valid").alias("host_valid_reads"), formats.rate_percent(F.col("valid"), raw).alias("valid_reads_rate"))
    for name, found in spikes.items():
        rows = rows.crossJoin(found.select(F.col("mapped").alias(f"{name}_mapped_reads")))
    return reduce(DataFrame.crossJoin, means, rows)
