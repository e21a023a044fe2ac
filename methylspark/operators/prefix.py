"""Places within ordered rows by counts of what comes before: numbering, first rows, and replays of a seeded generator, without a sort of all rows in one task.

Rows are ordered by any columns and, last, a whole number `place` (such as a file and a record's ordinal in it); no two rows are alike in all of these.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Counts that one pass makes for each group, and rows of a bin that are numbered together at most, where places allow it.
BINS = 4096
#: States of the generator that are sent to tasks at most (2.5 KB each), and draws between two of them at least.
STATES, APART = 16_384, 1 << 18


def _same(names: tuple[str, ...], values: tuple) -> Column:
    out = F.lit(True)
    for n, v in zip(names, values, strict=True):
        out &= F.col(n).eqNullSafe(F.lit(v))
    return out


def last_of(rows: DataFrame, most: int, *order: str) -> tuple | None:
    """The values of `order` of row number `most` (from 1 on); None if there are fewer rows.

    Group after group of the first columns, then by digits of the place: each pass counts rows of BINS ranges, and the next looks into the range that the row lies in."""
    groups, place = order[:-1], order[-1]
    rest, known = most, ()
    for k in range(len(groups)):
        counts = rows.where(_same(groups[:k], known)).groupBy(groups[k]).agg(F.count("*").alias("n"))
        before = F.sum("n").over(Window.orderBy(F.asc_nulls_first(groups[k])).rowsBetween(Window.unboundedPreceding, 0))
        hit = counts.withColumn("until", before).where(F.col("until") >= rest).orderBy("until").select(groups[k], F.col("until") - F.col("n")).first()
        if hit is None:
            return None
        known, rest = (*known, hit[0]), rest - hit[1]
    mine = rows.where(_same(groups, known)).select(F.col(place).cast("bigint").alias("p"))
    low, high = mine.agg(F.min("p"), F.max("p")).first()
    if low is None:
        return None
    while low < high:
        width = -(-(high - low + 1) // BINS)
        bins = mine.where(F.col("p").between(low, high)).groupBy(F.floor((F.col("p") - low) / width).cast("bigint").alias("b")).agg(F.count("*").alias("n")).orderBy("b").collect()  # at most BINS rows
        for r in bins:
            if r.n >= rest:
                low, high = low + r.b * width, min(high, low + (r.b + 1) * width - 1)
                break
            rest -= r.n
        else:
            return None
    return (*known, low) if rest <= 1 else None


def first_rows(rows: DataFrame, most: int, *order: str) -> DataFrame:
    """The first `most` rows in this order, as a filter: no row is sorted or moved. Which row is the last is asked at once, by counts."""
    last = last_of(rows, most, *order)
    if last is None:
        return rows
    kept, same = F.lit(False), F.lit(True)
    for k, (name, value) in enumerate(zip(order, last, strict=True)):
        column = F.col(name)
        below = column <= value if k == len(order) - 1 else (F.lit(False) if value is None else column.isNull() | (column < value))
        kept |= same & below
        same &= column.eqNullSafe(F.lit(value))
    return rows.where(kept)


def numbered(rows: DataFrame, *order: str, name: str = "number") -> DataFrame:
    """Rows with their number in this order, from 0 on: counts of the bins before, and the rank within the row's bin."""
    groups, place = order[:-1], order[-1]
    ends = rows.agg(F.min(place).alias("low"), F.max(place).alias("high"), F.count("*").alias("n")).first()
    width = max(1, -(-((ends.high or 0) - (ends.low or 0) + 1) // max(BINS, ends.n // BINS)))
    binned = rows.withColumn("_bin", F.floor((F.col(place) - F.lit(ends.low or 0)) / width).cast("bigint"))
    keys = [*groups, "_bin"]
    counts = binned.groupBy(*keys).agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy(*(F.asc_nulls_first(k) for k in keys)).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select(*(F.col(k).alias(f"_{k}_") for k in keys), before.alias("_before"))
    joined = binned.join(offsets, [F.col(k).eqNullSafe(F.col(f"_{k}_")) for k in keys])
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(place))
    return joined.withColumn(name, F.col("_before") + rank - 1).select(*rows.columns, name)


def _states(seed: int, draws: int) -> tuple[int, list[tuple[bytes, int]]]:
    """How far apart states are, and the generator's state before every so many draws."""
    apart = max(APART, -(-draws // STATES))
    own = random.Random(seed).getstate()[1]
    machine = np.random.RandomState()
    machine.set_state(("MT19937", np.array(own[:-1], np.uint32), own[-1]))
    out = []
    for at in range(0, max(draws, 1), apart):
        _, key, place, *_ = machine.get_state()
        out.append((key.tobytes(), place))
        if at + apart < draws:
            machine.random_sample(apart)
    return apart, out


def _drawn(batches: Iterator[pa.RecordBatch], sent: Broadcast, fraction: float) -> Iterator[pa.RecordBatch]:
    """Rows whose draw is below the fraction; the last column numbers draws."""
    apart, states = sent.value
    machine = np.random.RandomState()
    at = -1  # the number of the next draw
    for b in batches:
        number = b.column(b.num_columns - 1).to_numpy()
        values = np.empty(len(number))
        edges = [0, *(np.flatnonzero(np.diff(number) != 1) + 1).tolist(), len(number)]
        for lo, hi in zip(edges, edges[1:], strict=False):
            if lo == hi:
                continue
            first = int(number[lo])
            if not at <= first < at + apart or at < 0:
                key, place = states[first // apart]
                machine.set_state(("MT19937", np.frombuffer(key, np.uint32), place))
                at = first // apart * apart
            if first > at:
                machine.random_sample(first - at)
            values[lo:hi] = machine.random_sample(hi - lo)
            at = first + hi - lo
        yield b.filter(pa.array(values < fraction)).select(b.schema.names[:-1])


def seeded_sample(rows: DataFrame, fraction: float, seed: int, *order: str) -> DataFrame:
    """Rows for which a generator with this seed, asked once for each row in order, gives less than `fraction`: the draws of Python's `random.Random(seed).random()`.

    Rows are numbered by counts; tasks take the generator up at the last of at most STATES states before their rows and skip ahead. All rows for a fraction of 1 or more."""
    if fraction >= 1:
        return rows
    counted = numbered(rows, *order, name="_number")
    sent = rows.sparkSession.sparkContext.broadcast(_states(seed, rows.count()))
    return counted.mapInArrow(lambda it: _drawn(it, sent, fraction), rows.schema)
