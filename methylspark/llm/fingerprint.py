"""Document fingerprints by context-triggered piecewise hashing.

A hash rolls over the last WINDOW bytes; where its low bits are all ones, a chunk ends. Block size b (a power of two) takes log2 b
bits, so chunks of 2 b end where chunks of b do. Each chunk becomes one of 64 letters. A fingerprint is "b:letters at b:letters
at 2 b", with the least b by which LETTERS chunks of b bytes hold the text, halved while fewer than LETTERS / 4 chunks end (as in a text that repeats few lines);
what follows the last but one letter is one chunk, so that no signature is longer. Fingerprints of equal or neighbouring block sizes are compared by edit distance.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from methylspark.llm.wordhash import buffers, mix, polynomial, slices

WINDOW, LETTERS, LEAST_BLOCK = 7, 64, 4
ALPHABET = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)
_LETTER = {int(c): k for k, c in enumerate(ALPHABET)}
#: Bytes of text in a range of doc_ids that one task works through, and doc_ids that are looked at for each range's bound (about).
RANGE_BYTES, RANGE_IDS = 32 << 20, 64
SCHEMA = "doc_id bigint, text string, next_text string, edited string, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def block_size(n_bytes: int) -> int:
    b = LEAST_BLOCK
    while b * LETTERS < n_bytes:
        b *= 2
    return b


def settled(blocks: np.ndarray, rolled: np.ndarray, rows: np.ndarray) -> list[int]:
    """Each row's block size, halved while too few of its chunks end."""
    blocks = blocks.copy()
    while True:
        mask = (blocks - 1).astype(np.uint64)[rows]
        ends = np.bincount(rows[rolled & mask == mask], minlength=len(blocks))
        few = (ends < LETTERS // 4) & (blocks > LEAST_BLOCK)
        if not few.any():
            return blocks.tolist()
        blocks[few] //= 2


def _signatures(total: np.ndarray, inverse: np.ndarray, at: np.ndarray, spots: np.ndarray, rolled: np.ndarray, rows: np.ndarray, mask: np.ndarray) -> list[bytes]:
    """Letters of each row (at: the rows' offsets), given the spots where the least block size ends a chunk, and each row's block size - 1."""
    hit = rolled & mask[rows] == mask[rows]
    ends, row = spots[hit] + 1, rows[hit]
    rank = np.arange(len(row)) - np.searchsorted(row, row)
    keep = (rank < LETTERS - 1) & (ends < at[1:][row])
    last = np.flatnonzero(at[1:] > at[:-1])
    ends, row = np.concatenate((ends[keep], at[1:][last])), np.concatenate((row[keep], last))
    order = np.lexsort((ends, row))
    ends, row = ends[order], row[order]
    begins = at[:-1][row]
    same = row[1:] == row[:-1]
    begins[1:][same] = ends[:-1][same]
    letters = ALPHABET[(mix((total[ends] - total[begins]) * inverse[begins]) & np.uint64(63)).astype(np.int64)].tobytes()
    cut = np.searchsorted(row, np.arange(len(at))).tolist()
    return [letters[a:z] for a, z in zip(cut, cut[1:], strict=False)]


def fingerprints(data: np.ndarray, offsets: np.ndarray) -> list[str]:
    """The fingerprints of all rows of a string column (as `buffers` gives it)."""
    out: list[str] = []
    for lo, hi in slices(offsets):
        at = offsets[lo : hi + 1] - offsets[lo]
        text = data[offsets[lo] : offsets[hi]]
        total, inverse = polynomial(text)
        n = max(0, len(text) - WINDOW + 1)
        rolled = ((total[WINDOW : WINDOW + n] - total[:n]) * inverse[:n]) >> np.uint64(36)
        spots = np.flatnonzero(rolled & np.uint64(LEAST_BLOCK - 1) == LEAST_BLOCK - 1)
        rolled, spots = rolled[spots], spots + WINDOW - 1
        rows = np.searchsorted(at, spots, side="right") - 1
        inside = spots - at[rows] >= WINDOW - 1
        rolled, spots, rows = rolled[inside], spots[inside], rows[inside]
        blocks = settled(np.array([block_size(s) for s in np.diff(at).tolist()], np.int64), rolled, rows)
        small, large = (_signatures(total, inverse, at, spots, rolled, rows, np.array([k * b - 1 for b in blocks], np.uint64)) for k in (1, 2))
        out += [f"{b}:{x.decode()}:{y.decode()}" for b, x, y in zip(blocks, small, large, strict=True)]
    return out


def _padded(signs: list[str]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(s) for s in signs], np.int64)
    codes = np.zeros(256, np.int64)
    codes[ALPHABET] = np.arange(64)
    flat = codes[np.frombuffer("".join(s.ljust(LETTERS, "A") for s in signs).encode(), np.uint8)]
    return flat.reshape(-1, LETTERS), lengths


def common_letters(a: list[str], b: list[str]) -> np.ndarray:
    """Longest common subsequence of each two signatures, all pairs at once, with one bit for a letter of the first."""
    if not a:
        return np.zeros(0, np.int64)
    (x, n), (y, m) = _padded(a), _padded(b)
    where = np.arange(len(a))
    masks = np.zeros((len(a), 64), np.uint64)
    for i in range(int(n.max())):
        live = where[n > i]
        masks[live, x[live, i]] |= np.uint64(1 << i)
    v = np.full(len(a), 0xFFFFFFFFFFFFFFFF, np.uint64)
    for j in range(int(m.max())):
        u = v & masks[where, y[:, j]]
        v = np.where(m > j, (v + u) | (v - u), v)
    return np.bitwise_count(~v).astype(np.int64)


def _share_run(a: str, b: str) -> bool:
    """Whether a run of letters is common: 7, or half of the shorter signature where that is less. Chance makes short matches only."""
    n = min(7, (min(len(a), len(b)) + 1) // 2)
    runs = {a[k : k + n] for k in range(len(a) - n + 1)}
    return any(b[k : k + n] in runs for k in range(len(b) - n + 1))


def likeness(a: list[str], b: list[str]) -> np.ndarray:
    """How alike fingerprints are, pair by pair, from 0 to 1: 1 - d / (sum of lengths), d being the edit distance in which a
    replaced letter counts as one taken out and one put in. Signatures at the same block size are compared, and the more alike
    count; 0 for other block sizes or without a common run of letters. Equal fingerprints have 1."""
    left, right, pair = [], [], []
    for k, (x, y) in enumerate(zip(a, b, strict=True)):
        if x != y:
            bx, *sx = x.split(":")
            by, *sy = y.split(":")
            sizes = {int(bx) * (i + 1): s for i, s in enumerate(sx)}
            for i, s in enumerate(sy):
                if (other := sizes.get(int(by) * (i + 1))) and s and _share_run(other, s):
                    left.append(other)
                    right.append(s)
                    pair.append(k)
    out = np.array([float(x == y) for x, y in zip(a, b, strict=True)])
    if pair:
        np.maximum.at(out, pair, 2 * common_letters(left, right) / np.array([len(x) + len(y) for x, y in zip(left, right, strict=True)]))
    return out


def edited(text: str, following: str) -> str:
    """The last quarter of a text (code points, rounded down) replaced by the first as many of another."""
    k = len(text) // 4
    return text[: len(text) - k] + following[:k]


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str], list[str]]]:
    """Ids, texts and next texts of rows sorted by range, guard, doc_id; a guard closes its range and has no row of its own."""
    held: tuple | None = None
    for b in batches:
        ids, texts, following = [], [], []
        for row in zip(*(b.column(k).to_pylist() for k in range(4)), strict=True):
            if held is not None and not held[1] and held[0] == row[0]:
                ids.append(held[2])
                texts.append(held[3] or "")
                following.append(row[3] or "")
            held = row
        if ids:
            yield ids, texts, following


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ids, texts, following in _pairs(batches):
        for lo in range(0, len(ids), 1024):
            t, f = texts[lo : lo + 1024], following[lo : lo + 1024]
            e = [edited(x, y) for x, y in zip(t, f, strict=True)]
            own = fingerprints(*buffers(pa.array([*t, f[-1]])))
            # the next row's text is the next text, but where a range ended
            after = [own[k + 1] if k + 1 < len(t) and f[k] is t[k + 1] else None for k in range(len(t))]
            missing = [k for k, x in enumerate(after) if x is None]
            for k, x in zip(missing, fingerprints(*buffers(pa.array([f[k] for k in missing], pa.string()))), strict=True):
                after[k] = x
            changed = fingerprints(*buffers(pa.array(e)))
            columns = [(ids[lo : lo + 1024], pa.int64()), (t, pa.string()), (f, pa.string()), (e, pa.string()), ([len(x) for x in t], pa.int64()), ([hashlib.sha256(x.encode()).hexdigest() for x in e], pa.string()), (own[:-1], pa.string()), (changed, pa.string()), (likeness(own[:-1], changed), pa.float64()), (likeness(own[:-1], after), pa.float64())]
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in columns], names=["doc_id", "text", "next_text", "edited", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])


def _dealt(batches: Iterator[pa.RecordBatch], bounds: list[int], null_text: str | None, has_null: bool) -> Iterator[pa.RecordBatch]:
    """Rows with their range of doc_ids. The first document of each range also closes the range before it, and the first of all the last."""
    cut = np.array(bounds, np.int64)
    n = max(1, len(bounds))
    for b in batches:
        ids = b.column(0)
        known = ids.is_valid().to_numpy(zero_copy_only=False)
        values = ids.fill_null(0).to_numpy(zero_copy_only=False)
        part = np.where(known, np.maximum(np.searchsorted(cut, values, side="right") - 1, 0), 0)
        opens = known & np.isin(values, cut)
        if has_null:
            opens &= values != (bounds[0] if bounds else 0)
            texts = b.column(1).to_pylist()
            opens |= np.array([not known[k] and (texts[k] or "") == null_text for k in range(len(known))], bool)
        again = np.flatnonzero(opens)
        rows = np.concatenate((np.arange(len(part)), again))
        where = np.concatenate((part, (part[again] - 1) % n))
        guard = np.arange(len(rows)) >= len(part)
        take = pa.array(rows)
        yield pa.RecordBatch.from_arrays([pa.array(where.astype(np.int32)), pa.array(guard), ids.take(take), b.column(1).take(take)], names=["range", "guard", "doc_id", "text"])


def fingerprint_neighbours(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint, that of its edited text, and how near these and the next document's are.

    The next document is that of the next doc_id, after the last the first; nulls come first, equal doc_ids in order of their texts.
    Columns: doc_id, text, next_text, edited, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.
    Null texts are empty: an empty text's fingerprint has no letters. A table of one row is its own next; further columns are
    ignored; an empty table gives an empty one.

    Documents go by ranges of doc_id to tasks of about RANGE_BYTES, whose bounds are doc_ids drawn by a hash; the document at a bound goes
    to both ranges, so texts move once and no range waits for another.
    """
    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string").alias("text"))
    at = rows.agg(F.count("doc_id").alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes"), F.count_if(F.col("doc_id").isNull()).alias("nulls"), F.min(F.when(F.col("doc_id").isNull(), F.coalesce("text", F.lit("")))).alias("null_text"), F.min("doc_id").alias("least")).first()
    ranges = min(max(1, round(at.bytes / RANGE_BYTES)), max(1, at.n))
    bounds = [at.least] if at.n else []
    if ranges > 1:
        share = min(1.0, ranges * RANGE_IDS / at.n)
        drawn = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) < int(share * (1 << 40))).where("doc_id is not null").select("doc_id").toArrow()["doc_id"].to_numpy()
        bounds = sorted({at.least, *np.quantile(drawn, np.arange(1, ranges) / ranges, method="lower").tolist()}) if len(drawn) else bounds
    dealt = rows.mapInArrow(lambda it: _dealt(it, bounds, at.null_text, at.nulls > 0), "range int, guard boolean, doc_id bigint, text string")
    return dealt.repartitionById(max(1, len(bounds)), "range").sortWithinPartitions("range", "guard", "doc_id", "text").mapInArrow(_compared, SCHEMA)
