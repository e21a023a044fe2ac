"""How many more CpGs deeper sequencing would find."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Shares of the reads at which curves are evaluated (fixed values).
FRACTIONS = (0.01, 0.02, 0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0)
#: The rate's search: log10 range and points of the grid, then half-width, points and number of refinements.
GRID, REFINED = (-4.0, 2.0, 800), (0.7, 240, 3)


def depth_histogram(calls: DataFrame, reads: DataFrame | None = None, above: int = 0) -> DataFrame:
    """(spot_id, depth, sites) of called CpGs that have depth; with `reads` (spot_id, reads) of spots with more than `above` alone."""
    depth = F.col("meth") + F.col("unmeth")
    if reads is not None:
        calls = calls.join(reads.where(F.col("reads") > above), "spot_id", "left_semi")
    return calls.where(depth > 0).groupBy("spot_id", depth.alias("depth")).agg(F.count("*").alias("sites"))


def good_spots(reads: DataFrame, calls: DataFrame, above: int) -> DataFrame:
    """Spots of more than `above` reads that have a call."""
    return reads.where(F.col("reads") > above).join(calls.select("spot_id"), "spot_id", "left_semi").select("spot_id")


def expected_unique(histogram: DataFrame, fractions: tuple[float, ...] = FRACTIONS) -> DataFrame:
    """(spot_id, fraction, expected) CpGs seen if each read is kept with probability `fraction`."""
    at = histogram.withColumn("fraction", F.explode(F.array(*map(F.lit, fractions))))
    return at.groupBy("spot_id", "fraction").agg(F.sum(F.col("sites") * (1 - F.pow(1 - F.col("fraction"), F.col("depth")))).alias("expected"))


def medians(expected: DataFrame) -> DataFrame:
    """(fraction, median, low, high, spots): medians over spots, how far the quartiles lie off them, and the spots' number."""
    q = F.percentile("expected", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    rows = expected.groupBy("fraction").agg(q.alias("q"), F.count("*").alias("spots"))
    return rows.select("fraction", F.get("q", F.lit(1)).alias("median"), F.greatest(F.lit(0.0), F.get("q", F.lit(1)) - F.get("q", F.lit(0))).alias("low"), F.greatest(F.lit(0.0), F.get("q", F.lit(2)) - F.get("q", F.lit(1))).alias("high"), "spots")


def r_squared(curve: DataFrame, predicted: Column) -> DataFrame:
    """One row: r2 of a prediction for the curve's medians."""
    mean = curve.agg(F.avg("median").alias("mean"))
    sums = curve.crossJoin(F.broadcast(mean)).agg(F.sum(F.pow(F.col("median") - F.col("mean"), 2)).alias("total"), F.sum(F.pow(F.col("median") - predicted, 2)).alias("rest"))
    return sums.select(F.when(F.col("total") > 0, 1 - F.col("rest") / F.col("total")).when(F.col("rest") <= 0, 1.0).otherwise(0.0).alias("r2"))


def linear_fit(curve: DataFrame) -> DataFrame:
    """One row: slope through the origin and its r2."""
    f, v = F.col("fraction"), F.col("median")
    slope = curve.agg((F.sum(f * v) / F.sum(f * f)).alias("slope"))
    return slope.crossJoin(r_squared(curve.crossJoin(F.broadcast(slope)), F.col("slope") * F.col("fraction")))


def _search(fraction: np.ndarray, median: np.ndarray, low: float, high: float, count: int) -> tuple[float, float, float]:
    """Error, maximum and rate of the best point of a grid of rates; the first of equal ones."""
    rate = 10.0 ** (low + (high - low) / (count - 1) * np.arange(count))
    x = 1 - np.exp(-rate[:, None] * fraction)
    square = (x * x).sum(axis=1)
    if not len(median) or not (square > 0).any():
        return float("inf"), 0.0, 1.0
    top = np.maximum(0.0, np.divide((median * x).sum(axis=1), square, out=np.zeros(count), where=square > 0))
    error = np.where(square > 0, ((median - top[:, None] * x) ** 2).sum(axis=1), np.inf)
    k = int(error.argmin())
    return float(error[k]), float(top[k]), float(rate[k])


def held(curve: DataFrame) -> DataFrame:
    """The curve's few rows, one a fraction, as a table of their own, so that its calls aren't made again at each use."""
    rows = curve.select("fraction", "median", *(c for c in ("spots",) if c in curve.columns))
    return curve.sparkSession.createDataFrame(sorted(rows.collect()), rows.schema)


def saturation_fit(curve: DataFrame, refinements: int = REFINED[2]) -> DataFrame:
    """One row: maximum, rate and error of maximum * (1 - exp(-rate * fraction)), by a grid of rates that is refined around the best; the maximum of each has a closed form."""
    points = [(r.fraction, r.median) for r in curve.select("fraction", "median").collect() if r.median is not None]  # one row a fraction
    fraction, median = np.array(points, float).reshape(-1, 2).T
    best = _search(fraction, median, *GRID)
    for _ in range(refinements):
        center = math.log10(best[2])
        best = min(best, _search(fraction, median, center - REFINED[0], center + REFINED[0], REFINED[1]), key=lambda x: x[0])
    error, maximum, rate = best
    return curve.sparkSession.range(1).select(F.lit(maximum).alias("maximum"), F.lit(rate).alias("rate"), F.lit(error).alias("error"))


def summary(curve: DataFrame, spots: int | DataFrame | None = None, predicted_at: float = 2.0, linear_r2: float = 0.99) -> DataFrame:
    """One row: observed median, maximum and prediction, saturation rate in percent, the model chosen, and spots used (a number or one row, n; by default those that the curve's medians are of)."""
    curve = held(curve)
    observed = curve.agg(F.max_by("median", "fraction").alias("observed"))
    rows = linear_fit(curve).crossJoin(saturation_fit(curve)).crossJoin(observed)
    if spots is None:
        spots = curve.agg(F.coalesce(F.max("spots"), F.lit(0)).alias("n"))
    rows = rows.withColumn("n", F.lit(spots)) if isinstance(spots, int) else rows.crossJoin(spots.select("n"))
    straight, has_top = F.col("r2") >= linear_r2, F.col("maximum") > 0
    curved = F.col("maximum") * (1 - F.exp(-F.col("rate") * predicted_at))
    return rows.select(
        F.bround("observed", 0).cast("bigint").alias("observed_median_unique_cpgs"),
        F.bround(F.when(~straight & has_top, F.col("maximum")), 0).cast("bigint").alias("theoretical_max_median_unique_cpgs"),
        F.bround(F.when(straight, F.col("slope") * predicted_at).when(has_top, curved), 0).cast("bigint").alias("predicted_median_unique_cpgs_at_2x"),
        F.bround(F.when(~straight & has_top, F.col("observed") / F.col("maximum") * 100), 4).alias("saturation_rate"),
        F.when(straight, "linear").otherwise("saturation").alias("extrapolation_model"),
        F.col("n").cast("bigint").alias("hq_spot_count"),
    )


def plot_points(fit: DataFrame, upper: float, gbp: float | None = None, count: int = 251) -> DataFrame:
    """The fitted curve at `count` points up to `upper` times the reads: fraction (or Gbp) and expected CpGs in units of 10,000."""
    at = fit.select("*", F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias("i")).withColumn("fraction", F.col("i") * (upper / (count - 1)))
    value = F.col("maximum") * (1 - F.exp(-F.col("rate") * F.col("fraction"))) / 10_000
    return at.select("i", (F.col("fraction") * (gbp or 1.0)).alias("x"), value.alias("y"))
