"""Methylation by sequencing cycle, and the trims it suggests."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from methylspark.functions import chemistry
from methylspark.functions.chemistry import Assay
from methylspark.operators.aligned import bases, reference_sites
from methylspark.operators.prefix import first_rows, seeded_sample


@dataclass(frozen=True)
class BiasConfig:
    assay: Assay = Assay.TAPS
    min_mapq: int = 10
    min_base_quality: int = 30
    max_cycle: int = 150
    r1_length: int = 150
    fraction: float = 1.0
    seed: int = 42
    max_records: int = 0
    #: Whether records are drawn one after another by a seeded generator, in order of file and ordinal, in place of a hash of their names.
    replay: bool = False


def hash_sample(records: DataFrame, fraction: float, seed: int, *keys: str) -> DataFrame:
    """A share of records drawn by a hash of their keys: the same ones in every run and order."""
    if fraction >= 1:
        return records
    return records.where(F.pmod(F.xxhash64(*keys, F.lit(seed)), F.lit(1_000_000)) < int(fraction * 1_000_000))


def first_records(records: DataFrame, most: int, *order: str) -> DataFrame:
    """The first `most` records in this order (a file and the place in it, as a rule); all for 0. Found by counts, and then a filter."""
    return first_rows(records, most, *order) if most else records


def cycles(records: DataFrame, blocks: DataFrame, config: BiasConfig) -> DataFrame:
    """(read, cycle, methylated_count, unmethylated_count, coverage, methylation_rate) of CpG observations with enough quality at both bases."""
    kept = records.where(F.col("flag").isin(*chemistry.PAIRED_FLAGS) & (F.col("mapq") >= config.min_mapq))
    order = [c for c in ("file", "ordinal") if c in records.columns]
    drawn = seeded_sample(kept, config.fraction, config.seed, *order) if config.replay else hash_sample(kept, config.fraction, config.seed, "qname", "flag")
    kept = first_records(drawn.where("seq <> '' and rname is not null"), config.max_records, *order)
    sites = reference_sites(blocks).where("context = 'CG'").select(F.col("contig").alias("rname"), "pos")
    placed = bases(kept, "flag", "rname").join(sites, ["rname", "pos"]).where("next_base is not null")
    good = F.coalesce((F.col("qual") >= config.min_base_quality) & (F.col("next_qual") >= config.min_base_quality), F.lit(False)) if config.min_base_quality > 0 else F.lit(True)
    seen = placed.where(good).select(
        F.when(chemistry.is_read1(F.col("flag")), "R1").otherwise("R2").alias("read"),
        chemistry.cycle(F.col("flag"), F.col("qpos"), F.col("length"), config.r1_length).alias("cycle"),
        chemistry.cg_methylated(F.concat("base", "next_base"), config.assay).alias("methylated"),
    )
    counts = seen.where(F.col("methylated").isNotNull() & F.col("cycle").between(1, config.max_cycle)).groupBy("read", "cycle").agg(F.count_if("methylated").alias("methylated_count"), F.count_if(~F.col("methylated")).alias("unmethylated_count"))
    coverage = F.col("methylated_count") + F.col("unmethylated_count")
    return counts.withColumns({"coverage": coverage, "methylation_rate": F.bround(F.col("methylated_count") / coverage, 6)})


@dataclass(frozen=True)
class CutoffConfig:
    r1_length: int = 150
    rate_tolerance: float = 0.05
    coverage_fraction: float = 0.1
    min_coverage: int = 10
    window: int = 5
    run: int = 5


def rolling_median(points: DataFrame, least: Column, window: int) -> DataFrame:
    """Points (read, cycle, coverage, methylation_rate) with the median rate of those around them that have enough coverage, and their number."""
    half = window // 2
    around = Window.partitionBy("read").orderBy("cycle").rangeBetween(-half, half)
    rate = F.when(F.col("coverage") >= least, F.col("methylation_rate"))
    return points.withColumns({"local_rate": F.percentile(rate, 0.5).over(around), "local_points": F.count(rate).over(around)})


def cutoffs(points: DataFrame, config: CutoffConfig) -> DataFrame:
    """One row for each read whose cycles allow it: the axis, its first and last stable run, both trims, the central rate and coverage threshold.

    A cycle is stable where it has enough coverage and the rolling median is near the median of the axis's middle half. A read without a middle or a
    run has no row; an empty result means no cutoffs. The points, one a read and cycle, are held when this is called, since each step uses them again.
    """
    points = points.sparkSession.createDataFrame(sorted(points.collect()), points.schema)
    covered = points.where(F.col("coverage") >= config.min_coverage)
    first = covered.groupBy("read").agg(F.greatest(F.lit(config.min_coverage), F.bround(F.median("coverage") * config.coverage_fraction, 0).cast("int")).alias("preliminary"))
    ends = points.join(first, "read").groupBy("read").agg(F.min(F.when(F.col("coverage") >= F.col("preliminary"), F.col("cycle"))).alias("supported"), F.max("cycle").alias("longest"))
    is_r1 = (F.col("read") == "R1") & F.lit(config.r1_length > 0)
    axis = ends.where("supported is not null").select("read", F.when(is_r1, F.col("supported")).otherwise(1).alias("axis_start"), F.when(is_r1, config.r1_length).otherwise(F.col("longest")).alias("axis_end")).where("axis_start <= axis_end")
    axis = axis.withColumn("read_length", F.col("axis_end") - F.col("axis_start") + 1)
    quarter = F.floor(F.col("read_length") / 4)
    middle = covered.join(axis, "read").where(F.col("cycle").between(F.col("axis_start") + quarter, F.col("axis_end") - quarter))
    central = middle.groupBy("read").agg(F.count("*").alias("n"), F.median("methylation_rate").alias("baseline"), F.median("coverage").alias("middle_coverage")).where(F.col("n") >= config.run)
    central = central.select("read", "baseline", F.greatest(F.lit(config.min_coverage), F.bround(F.col("middle_coverage") * config.coverage_fraction, 0).cast("int")).alias("threshold"))
    dense = axis.select("read", F.explode(F.sequence("axis_start", "axis_end")).alias("cycle")).join(central, "read")
    filled = dense.join(points.select("read", "cycle", "coverage", "methylation_rate"), ["read", "cycle"], "left")
    # points beyond the axis count in its cycles' medians
    beyond = points.select("read", "cycle", "coverage", "methylation_rate").join(central, "read").join(dense.select("read", "cycle"), ["read", "cycle"], "left_anti")
    local = rolling_median(filled.unionByName(beyond), F.col("threshold"), config.window).join(dense.select("read", "cycle"), ["read", "cycle"], "left_semi")
    near = F.abs(F.col("local_rate") - F.col("baseline")) <= config.rate_tolerance
    stable = local.where((F.col("coverage") >= F.col("threshold")) & (F.col("local_points") >= config.window // 2 + 1) & near)
    island = F.col("cycle") - F.row_number().over(Window.partitionBy("read").orderBy("cycle"))
    runs = stable.withColumn("island", island).groupBy("read", "island").agg(F.min("cycle").alias("a"), F.max("cycle").alias("z"), F.count("*").alias("n")).where(F.col("n") >= config.run)
    found = runs.groupBy("read").agg(F.min("a").alias("stable_start"), F.max("z").alias("stable_end"))
    rows = axis.join(central, "read").join(found, "read")
    return rows.select("read", "read_length", "axis_start", "axis_end", "stable_start", "stable_end", (F.col("stable_start") - F.col("axis_start")).alias("left_trim"), (F.col("axis_end") - F.col("stable_end")).alias("right_trim"), F.bround("baseline", 6).alias("baseline_methylation_rate"), F.col("threshold").alias("coverage_threshold"))
