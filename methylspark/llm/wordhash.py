"""Vectorised word tokens: texts of an Arrow column become 64-bit word hashes without a Python loop.

A word is a maximal run of bytes other than space and 0x09-0x0D after lower-casing A-Z. Every byte is
mapped to a random 64-bit number, and a word's hash is the polynomial of these numbers modulo 2**64, read
off one prefix sum over the buffer, then mixed. Two words share a hash with a probability of about 2**-64 a
pair; callers take hashes for words throughout.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text worked on at once; a longer single text is worked on whole.
SLICE_BYTES = 1 << 20

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_GAP = np.zeros(256, dtype=bool)
_GAP[[0x20, *range(0x09, 0x0E)]] = True
_BYTE = np.random.default_rng(20240501).integers(1, 1 << 63, 256, dtype=np.uint64)
_FOLDED = _BYTE[_FOLD]
_P = np.uint64(0x9E3779B97F4A7C15)
_P_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((_P, _P_INV)):
            steps = np.full(max(n, SLICE_BYTES + 1), base, np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of uint64 that spreads every bit over all others."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x7FB5D329728EA185)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x81DADEF4BC2DD44D)
    h ^= h >> np.uint64(33)
    return h


def buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and where each row begins and ends; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8), offsets


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most `limit` bytes, or of one row."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def polynomial(text: np.ndarray, folded: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of a buffer and the powers that move a part's sum to its own beginning: bytes i to j - 1 have the hash
    (total[j] - total[i]) * inverse[i], wherever they stand."""
    power, inverse = _power(len(text) + 1)
    total = np.zeros(len(text) + 1, np.uint64)
    np.multiply((_FOLDED if folded else _BYTE)[text], power[: len(text)], out=total[1:])
    np.add.accumulate(total, out=total)
    return total, inverse


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of these rows, and each row's range among them (offsets, one more than rows)."""
    base, end = int(offsets[0]), int(offsets[-1])
    text, at = data[base:end], offsets - base
    n = len(text)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(len(at), np.int64)
    total, inverse = polynomial(text, folded=True)
    solid = ~_GAP[text]
    edge = np.zeros(n + 1, bool)
    edge[at] = True
    begin, stop = solid.copy(), solid.copy()
    begin[1:] &= ~solid[:-1] | edge[1:n]
    stop[:-1] &= ~solid[1:] | edge[1:n]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(stop) + 1
    hashes = mix((total[ends] - total[starts]) * inverse[starts])
    return hashes, np.searchsorted(starts, at).astype(np.int64)
