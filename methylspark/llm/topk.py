"""Exact top-k search by exhaustive term-at-a-time accumulation.

Vectors are sparse rows of integer weights, one term a component. Queries go in rounds of at most ROUND, each sent to the
executors once; a round's bound is on rows, so what is sent does not grow with the table. A task inverts its candidates, a
block at a time, into postings by term. Term after term, each query's weight times the postings is added to that query's dense
array of scores; then a partition selection takes the block's best, which are merged with the task's best so far. A task sends one best list a query, and these are merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from methylspark.llm.store import written

ROUND, BLOCK = 2048, 4096
#: Weights beyond this count as this: it is the last up to which doubles hold all whole numbers.
LARGEST = 2.0**53
FOUND = "query_id bigint, vec_id bigint, score bigint"


def sparse(column: pa.Array, scale: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Which rows take part, and their entries: row among these, term, weight floor(scale * x). Null rows and those with a null or non-finite component don't."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(lengths)), np.maximum(lengths, 0))
    bad = lengths < 0
    bad[row[~np.isfinite(flat)]] = True
    starts = np.cumsum(np.maximum(lengths, 0)) - np.maximum(lengths, 0)
    term = np.arange(len(flat)) - starts[row]
    keep = ~bad[row]
    weight = np.clip(np.floor(flat[keep] * scale), -LARGEST, LARGEST).astype(np.int64)
    row, term = (np.cumsum(~bad) - 1)[row[keep]], term[keep]
    full = weight != 0
    return np.flatnonzero(~bad), row[full], term[full], weight[full]


def inverted(row: np.ndarray, term: np.ndarray, weight: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Postings: each term's rows and weights."""
    order = np.argsort(term, kind="stable")
    row, term, weight = row[order], term[order], weight[order]
    names, at = np.unique(term, return_index=True)
    cut = np.append(at, len(term))
    return {int(t): (row[a:z], weight[a:z]) for t, a, z in zip(names, cut, cut[1:], strict=False)}


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of each row's k largest scores, those at the limit by the smaller ids."""
    if scores.shape[1] > k:
        limit = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
        row, col = np.nonzero(scores >= limit[:, None])
    else:
        row, col = (x.ravel() for x in np.indices(scores.shape))
    order = np.lexsort((ids[col], -scores[row, col], row))
    row, col = row[order], col[order]
    first = np.arange(len(row)) - np.searchsorted(row, row) < k
    return row[first], col[first]


class Best:
    """Each query's `most` best candidates so far, the best first; empty places have the least score and the largest id."""

    def __init__(self, queries: int, most: int):
        self.scores = np.full((queries, most), np.iinfo(np.int64).min)
        self.ids = np.full((queries, most), np.iinfo(np.int64).max)
        self.filled = np.zeros(queries, np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        """A block's scores, a row a query and a column an id."""
        n, most = self.scores.shape
        row, col = best(scores, ids, most)
        place = np.arange(len(row)) - np.searchsorted(row, row)
        found = Best(n, most)
        found.scores[row, place], found.ids[row, place] = scores[row, col], ids[col]
        both = np.concatenate((self.scores, found.scores), axis=1), np.concatenate((self.ids, found.ids), axis=1)
        order = np.lexsort((both[1], ~both[0]), axis=1)[:, :most]  # ~ turns the order round without overflow
        self.scores, self.ids = (np.take_along_axis(x, order, axis=1) for x in both)
        self.filled = np.minimum(self.filled + np.bincount(row, minlength=n), most)


def _scored(batches: Iterator[pa.RecordBatch], asked: tuple, k: int, scale: int) -> Iterator[pa.RecordBatch]:
    query_ids, queries = asked
    held = Best(len(query_ids), k + 1)  # one more, for the query itself, which has one row
    for b in batches:
        for lo in range(0, b.num_rows, BLOCK):
            part = b.slice(lo, BLOCK)
            rows, *entries = sparse(part.column(1), scale)
            ids = part.column(0).to_numpy(zero_copy_only=False)[rows]
            postings = inverted(*entries)
            scores = np.zeros((len(query_ids), len(ids)), np.int64)
            for term, (of, weight) in queries.items():
                if term in postings:
                    at, values = postings[term]
                    if len(at) == len(ids):
                        for q, w in zip(of, weight, strict=True):
                            scores[q] += w * values
                    else:
                        for q, w in zip(of, weight, strict=True):
                            scores[q, at] += w * values
            held.add(scores, ids)
    row, col = np.nonzero((np.arange(k + 1) < held.filled[:, None]) & (held.ids != query_ids[:, None]))
    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (query_ids[row], held.ids[row, col], held.scores[row, col])], names=["query_id", "vec_id", "score"])


def single(rows: DataFrame) -> DataFrame:
    """One row for each vec_id, the first in the order of components. Only ids are counted; vectors move where some id is repeated."""
    repeated = written(rows.groupBy("vec_id").count().where("count > 1").select("vec_id"), "repeated")
    if repeated.isEmpty():
        return rows
    firsts = rows.join(repeated, "vec_id", "left_semi").groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    return written(rows.join(repeated, "vec_id", "left_anti").unionByName(firsts), "candidates")


def top_k(vectors: DataFrame, every: int = 100, k: int = 10, scale: int = 1024) -> DataFrame:
    """The k best other rows for each row whose vec_id is divisible by `every`: query_id, rank (from 1), vec_id, score.

    A component x counts as floor(scale * x); the score is the integer inner product (a shorter vector's missing
    components are 0), ties go to the smaller vec_id. All are returned where fewer than k are there. Rows whose
    vec_id is null, whose vector is null or holds a null or non-finite component take no part; an empty vector scores 0 with all.
    Scaled components beyond 2^53 count as that, and scores are numbers of 64 bits. A repeated vec_id is asked and found once, by the first of its rows in the order of components. Further columns are ignored.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).where("vec_id is not null and embedding is not null and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))")
    rows = single(rows)
    asked = written(rows.where(F.col("vec_id") % every == 0), "queries")
    rounds = max(1, -(-asked.count() // ROUND))
    found = None
    for r in range(rounds):
        mine = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(rounds)) == r).toArrow()
        if mine.num_rows == 0:
            continue
        _, *entries = sparse(mine["embedding"], scale)
        sent = spark.sparkContext.broadcast((mine["vec_id"].to_numpy(), inverted(*entries)))
        part = written(rows.mapInArrow(lambda it, sent=sent: _scored(it, sent.value, k, scale), FOUND), "found")
        sent.destroy()
        found = part if found is None else found.union(part)
    if found is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
