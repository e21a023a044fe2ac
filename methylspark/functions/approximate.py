"""Where a pattern stands in texts within some edits: a bit-parallel matcher over many texts at once.

The edits between the pattern and what ends at each place of a text are kept as one 64-bit word of vertical differences a text (Myers' method), so a step is some
operations on whole columns of letters, whatever the number of edits. The same from behind tells where such matches begin.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Letters of a pattern, one a bit.
LONGEST = 64


def _matrix(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Texts as rows of bytes, zeros at their ends, and their lengths. Letters outside Latin-1 are like no other."""
    raw = [t.encode("latin-1", "replace") for t in texts]
    sizes = np.array([len(r) for r in raw], np.int64)
    out = np.zeros((len(raw), int(sizes.max(initial=0))), np.uint8)
    out[np.arange(out.shape[1]) < sizes[:, None]] = np.frombuffer(b"".join(raw), np.uint8)
    return out, sizes


def end_distances(texts: np.ndarray, pattern: bytes) -> np.ndarray:
    """For each text and each place in it the fewest edits between the pattern and any part that ends with that letter."""
    m = len(pattern)
    if not 0 < m <= LONGEST:
        raise ValueError(f"a pattern has 1 to {LONGEST} letters")
    one, top = np.uint64(1), np.uint64(m - 1)
    bits = np.zeros(256, np.uint64)
    for k, letter in enumerate(pattern):
        bits[letter] |= one << np.uint64(k)
    bits[0] = 0
    plus, minus = np.full(len(texts), ~np.uint64(0)), np.zeros(len(texts), np.uint64)
    score = np.full(len(texts), m, np.int16)
    out = np.empty(texts.shape, np.int16)
    for j in range(texts.shape[1]):
        equal = bits[texts[:, j]]
        vertical = equal | minus
        across = (((equal & plus) + plus) ^ plus) | equal
        up, down = minus | ~(across | plus), plus & across
        score = score + ((up >> top) & one).astype(np.int16) - ((down >> top) & one).astype(np.int16)
        up, down = up << one, down << one
        plus, minus = down | ~(vertical | up), up & vertical
        out[:, j] = score
    return out


def _edits(parts: np.ndarray, sizes: np.ndarray, pattern: bytes) -> np.ndarray:
    """Edits between the pattern and each whole part (rows of bytes, their lengths)."""
    before = np.broadcast_to(np.arange(parts.shape[1] + 1), (len(parts), parts.shape[1] + 1)).copy()
    for k, letter in enumerate(pattern, 1):
        now = np.empty_like(before)
        now[:, 0] = k
        for j in range(1, before.shape[1]):
            now[:, j] = np.minimum(np.minimum(before[:, j], now[:, j - 1]) + 1, before[:, j - 1] + (parts[:, j - 1] != letter))
        before = now
    return before[np.arange(len(parts)), sizes]


def places(texts: list[str], pattern: str, most: int, grouped: bool = False) -> np.ndarray:
    """Where the pattern stands in each text with the fewest edits, at most `most`; -1 where it doesn't, or at several places.

    Of matches with the fewest edits the first counts, the longest of those that begin there, and none may begin behind its end. With `grouped`, matches that overlap
    one after another are one place, which begins where the longest of them does (the first of equally long ones). Empty parts match nothing."""
    wanted, m = pattern.encode("latin-1"), len(pattern)
    data, sizes = _matrix(texts)
    out = np.full(len(texts), -1)
    if not data.shape[1]:
        return out
    inside = np.arange(data.shape[1]) < sizes[:, None]
    ends = np.where(inside, end_distances(data, wanted), LONGEST + 1)
    best = ends.min(axis=1)
    live = np.flatnonzero((best <= most) & (best < m))
    if not len(live):
        return out
    # from behind: texts are turned about within their own lengths
    data, sizes, best = data[live], sizes[live], best[live]
    width = data.shape[1]
    turned = np.zeros_like(data)
    row, column = np.nonzero(np.arange(width) < sizes[:, None])
    turned[row, sizes[row] - 1 - column] = data[row, column]
    back = np.where(np.arange(width) < sizes[:, None], end_distances(turned, wanted[::-1]), LONGEST + 1)
    row, column = np.nonzero(back == best[:, None])
    starts = np.column_stack((row, sizes[row] - 1 - column))
    row, column = np.nonzero(ends[live] == best[:, None])
    stops = np.column_stack((row, column + 1))
    # every start with the stops that are near enough
    pairs = [np.zeros((0, 3), np.int64)]
    found = {tuple(x) for x in stops.tolist()}
    for shift in range(-most, most + 1):
        reach = starts[:, 1] + m + shift
        kept = np.array([(r, e) in found for r, e in zip(starts[:, 0].tolist(), reach.tolist(), strict=True)], bool)
        pairs.append(np.column_stack((starts[kept], reach[kept])))
    pairs = np.concatenate(pairs)
    pairs = pairs[pairs[:, 2] > pairs[:, 1]]
    size = pairs[:, 2] - pairs[:, 1]
    at = np.minimum(pairs[:, 1, None] + np.arange(m + most), width - 1)
    pairs = pairs[_edits(data[pairs[:, 0, None], at], size, wanted) == best[pairs[:, 0]]]
    pairs = pairs[np.lexsort((pairs[:, 2], pairs[:, 1], pairs[:, 0]))]
    if not len(pairs):
        return out
    begin = np.flatnonzero(np.append(True, pairs[1:, 0] != pairs[:-1, 0]))
    later = pairs[:, 0] * (4 * width + 4)  # places of later texts are larger
    # where the text's first match, or any before this one, ends
    last = np.append(begin[1:], len(pairs)) - 1
    stop = np.maximum.accumulate(pairs[:, 2] + later) - later
    if not grouped:
        long = np.array([pairs[a : z + 1][pairs[a : z + 1, 1] == pairs[a, 1], 2].max() for a, z in zip(begin, last, strict=True)])
        stop = np.repeat(long, last - begin + 1)
    apart = np.zeros(len(pairs), np.int64)
    apart[1:] = (pairs[1:, 0] == pairs[:-1, 0]) & (pairs[1:, 1] >= stop[:-1])
    single = np.add.reduceat(apart, begin) == 0
    order = np.lexsort((pairs[:, 1], pairs[:, 1] - pairs[:, 2], pairs[:, 0])) if grouped else np.arange(len(pairs))
    first = pairs[order][np.flatnonzero(np.append(True, pairs[order][1:, 0] != pairs[order][:-1, 0]))]
    out[live[first[single, 0]]] = first[single, 1]
    return out


def place(window: Column, pattern: str, most: int) -> Column:
    """`places` of a text column, in Arrow batches; null for null and where there is none."""

    @F.pandas_udf("int")
    def found(texts: pd.Series) -> pd.Series:
        known = texts.notna().to_numpy()
        out = np.full(len(texts), -1)
        if known.any():
            out[known] = places(texts[known].tolist(), pattern, most)
        return pd.Series(out, texts.index).where(pd.Series(out >= 0, texts.index)).astype("Int32")

    return found(window)
