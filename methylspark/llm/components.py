"""Connected components of a graph too large for one machine, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from methylspark.llm.store import discard, written


def _stars(edges: DataFrame, larger: bool) -> DataFrame:
    """Each node's neighbours (the larger ones, or itself and the smaller ones) are linked with the least node it knows."""
    if larger:
        known = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = known.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
        linked = known.where("b > a").join(least, "a").select(F.col("b").alias("x"), F.col("least").alias("y"))
    else:
        known = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = known.groupBy("a").agg(F.min("b").alias("least"))
        linked = known.join(least, "a").select(F.col("b").alias("x"), F.col("least").alias("y")).union(least.select(F.col("a").alias("x"), F.col("least").alias("y")))
    return linked.where("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct()


def connected(edges: DataFrame) -> DataFrame:
    """(id, component) for every node of the edges (a, b): the least id it can reach. Nodes without an edge to another are left out."""
    now = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = None
    while True:
        state = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if state == seen:
            return now.select(F.col("a").alias("id"), F.col("b").alias("component"))
        seen = state
        large = written(_stars(now, True), "edges")
        small = written(_stars(large, False), "edges")
        discard(now)
        discard(large)
        now = small
