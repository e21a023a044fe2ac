"""Variable regions: windows whose spots differ in methylation more than others'.

Sites are 0 or 1 in each spot. A site's usual level is a kernel mean over the sites near it, and a spot's residual its distance from that. Windows of
fixed length are ranked by the variance over spots of their mean shrunken residuals; the top share's windows are joined where they overlap. The
definition is our own, with the defaults below; a cell without a site is missing, not 0.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


@dataclass(frozen=True)
class VmrConfig:
    bandwidth: int = 1000
    window: int = 2000
    step: int = 100
    share: float = 0.02
    min_sites: int = 10_000


def enough_sites(calls: DataFrame, least: int) -> DataFrame:
    return calls.groupBy("spot_id").agg(F.count("*").alias("sites")).where(F.col("sites") >= least)


def binary(calls: DataFrame) -> DataFrame:
    """(spot_id, rname, pos, value): 1 where most of a site's reads are methylated, 0 where fewer are; ties are left out."""
    return calls.where("meth <> unmeth").select("spot_id", "rname", "pos", (F.col("meth") > F.col("unmeth")).cast("int").alias("value"))


def smoothed(sites: DataFrame, config: VmrConfig) -> DataFrame:
    """(rname, pos, smooth): tricube means of all spots' values at the sites within the bandwidth. Sites meet by bins, not all with all."""
    width = config.bandwidth
    totals = sites.groupBy("rname", "pos").agg(F.sum("value").alias("m"), F.count("*").alias("n"))
    at = totals.select("rname", "pos", F.floor(F.col("pos") / width).alias("bin"))
    near = totals.select("rname", F.col("pos").alias("other"), "m", "n", F.explode(F.array(*(F.floor(F.col("pos") / width) + k for k in (-1, 0, 1)))).alias("bin"))
    weight = F.pow(1 - F.pow(F.abs(F.col("pos") - F.col("other")) / float(width), 3), 3)
    pairs = at.join(near, ["rname", "bin"]).where(F.abs(F.col("pos") - F.col("other")) < width).withColumn("weight", weight)
    return pairs.groupBy("rname", "pos").agg((F.sum(F.col("weight") * F.col("m")) / F.sum(F.col("weight") * F.col("n"))).alias("smooth"))


def residuals(sites: DataFrame, config: VmrConfig) -> DataFrame:
    return sites.join(smoothed(sites, config), ["rname", "pos"]).withColumn("residual", F.col("value") - F.col("smooth"))


def windows(sites: DataFrame, config: VmrConfig) -> DataFrame:
    """(rname, start, variance, spots) of windows that at least two spots have sites in."""
    first = F.greatest(F.lit(0), F.floor((F.col("pos") - config.window) / config.step) + 1)
    starts = F.transform(F.sequence(first, F.floor(F.col("pos") / config.step)), lambda k: k * config.step)
    placed = residuals(sites, config).withColumn("start", F.explode(starts))
    by_spot = placed.groupBy("rname", "start", "spot_id").agg((F.sum("residual") / (F.count("*") + 1)).alias("mean"))
    return by_spot.groupBy("rname", "start").agg(F.var_samp("mean").alias("variance"), F.count("*").alias("spots")).where("spots >= 2")


def regions(found: DataFrame, config: VmrConfig) -> DataFrame:
    """(rname, a, z): the windows above the variance's quantile, joined where they overlap or touch; z is exclusive. Ranks are of variances of six places."""
    limit = found.agg(F.percentile(F.bround("variance", 6), 1 - config.share).alias("limit"))
    top = found.crossJoin(F.broadcast(limit)).where(F.bround("variance", 6) >= F.col("limit")).select("rname", "start", (F.col("start") + config.window).alias("stop"))
    order = Window.partitionBy("rname").orderBy("start")
    opens = F.col("start") > F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    island = F.sum(F.coalesce(opens, F.lit(True)).cast("int")).over(order)
    return top.withColumn("island", island).groupBy("rname", "island").agg(F.min("start").alias("a"), F.max("stop").alias("z")).drop("island")


def matrix(sites: DataFrame, found: DataFrame, config: VmrConfig) -> DataFrame:
    """A row for each spot and region that has a site: methylated and total sites, fraction, mean shrunken residual. Sites find their region by bins."""
    width = config.window
    binned = found.select("rname", "a", "z", F.explode(F.sequence(F.floor(F.col("a") / width), F.floor((F.col("z") - 1) / width))).alias("bin"))
    placed = residuals(sites, config).withColumn("bin", F.floor(F.col("pos") / width)).join(binned, ["rname", "bin"]).where((F.col("pos") >= F.col("a")) & (F.col("pos") < F.col("z")))
    cells = placed.groupBy("spot_id", "rname", F.col("a").alias("start"), F.col("z").alias("end")).agg(F.sum("value").alias("methylated_sites"), F.count("*").alias("total_sites"), F.sum("residual").alias("r"))
    return cells.select("spot_id", "rname", "start", "end", "methylated_sites", "total_sites", F.bround(F.col("methylated_sites") / F.col("total_sites"), 6).alias("methylation_fraction"), F.bround(F.col("r") / (F.col("total_sites") + 1), 6).alias("mean_shrunken_residual"))


def oracle_parts(c: VmrConfig) -> tuple[str, ...]:
    """DuckDB's common table expressions from cg to cells."""
    return (
        "sitewise AS (SELECT spot_id, rname, pos, CAST(meth > unmeth AS INTEGER) AS value FROM cg WHERE meth <> unmeth)",
        "totals AS (SELECT rname, pos, sum(value) AS m, count(*) AS n FROM sitewise GROUP BY ALL)",
        f"smoothed AS (SELECT a.rname, a.pos, sum(w * b.m) / sum(w * b.n) AS smooth FROM totals a JOIN totals b ON a.rname = b.rname AND abs(a.pos - b.pos) < {c.bandwidth}, LATERAL (SELECT power(1 - power(abs(a.pos - b.pos) / {c.bandwidth}, 3), 3) AS w) GROUP BY ALL)",
        "rest AS (SELECT s.*, value - smooth AS residual FROM sitewise s JOIN smoothed USING (rname, pos))",
        f"placed AS (SELECT rest.*, k * {c.step} AS start FROM rest, (SELECT unnest(range(0, 100)) AS k) WHERE k * {c.step} <= pos AND k * {c.step} + {c.window} > pos)",
        "variances AS (SELECT rname, start, var_samp(mean) AS variance, count(*) AS spots FROM (SELECT rname, start, spot_id, sum(residual) / (count(*) + 1) AS mean FROM placed GROUP BY ALL) GROUP BY ALL HAVING count(*) >= 2)",
        f"top AS (SELECT rname, start, start + {c.window} AS stop FROM variances WHERE round_even(variance, 6) >= (SELECT quantile_cont(round_even(variance, 6), {1 - c.share}) FROM variances))",
        "opened AS (SELECT *, CASE WHEN start <= max(stop) OVER (PARTITION BY rname ORDER BY start ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS opens FROM top)",
        "islands AS (SELECT *, sum(opens) OVER (PARTITION BY rname ORDER BY start) AS island FROM opened)",
        "found AS (SELECT rname, min(start) AS a, max(stop) AS z FROM islands GROUP BY rname, island)",
        "cells AS (SELECT spot_id, rest.rname, a, z, CAST(sum(value) AS BIGINT) AS methylated_sites, count(*) AS total_sites, sum(residual) AS r FROM rest JOIN found ON found.rname = rest.rname AND pos >= a AND pos < z GROUP BY ALL)",
    )
