"""Near duplicates by a multi-index Hamming join of b-bit MinHash signatures.

A document's set is its distinct shingles. Equal sets collapse to one representative. A signature is VALUES MinHash values of
16 bits; documents as alike as asked differ in few of them. Values are split into CHUNKS; by the pigeonhole
principle, two signatures that differ in at most DISTANCE values have a chunk in which at most DISTANCE // CHUNKS = 1
value differs. So each signature is filed under every chunk with every one of its values left out, and two such
signatures meet under a key. No key is capped.

What meets under a key is linked in two passes, without a row for each pair of a large group. First each set is
compared with the least id under each of its keys (a star), which already joins most of a group of copies. Two sets that
meet are then members of one star at least; stars whose members are of several components are looked at again. Their
members go in blocks of BLOCK, and pairs of blocks are dealt to tasks each by itself. Pairs of blocks are compared by signature, and
the members that are within DISTANCE of one of another component are compared in full, again by pairs of blocks; a link for each two
components that are found to touch is enough. A link that is skipped joins two documents that are connected anyway. Whatever is
within DISTANCE is confirmed on the full sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from methylspark.llm.components import connected
from methylspark.llm.store import discard, written
from methylspark.llm.wordhash import buffers, mix, slices, word_hashes

VALUES, DISTANCE, CHUNKS, BLOCK, SALTS = 64, 27, 14, 256, 32
#: At similarity 0.8 a value differs with a probability of 0.2 (less a 65,536th of it); of 64 more than 27 do so about once in 100,000 pairs.
_MULTIPLIERS = np.random.default_rng(7).integers(1, 1 << 63, VALUES, dtype=np.uint64) | np.uint64(1)
_PLACES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)


def shingles(words: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Each row's distinct shingles, ascending, and the rows' ranges among them; fewer words than `size` are one shingle."""
    counts = np.diff(at)
    row = np.repeat(np.arange(len(counts)), counts)
    combined = np.zeros(len(words), np.uint64)
    for k in range(size):
        combined[: len(words) - k] += words[k:] * _PLACES[k]
    left = at[1:][row] - np.arange(len(words))
    hashed = mix(combined)
    keep = left >= size
    for r in np.flatnonzero((counts > 0) & (counts < size)):
        hashed[at[r]] = mix(np.array([(words[at[r] : at[r + 1]] * _PLACES[: counts[r]]).sum() + np.uint64(counts[r])], np.uint64))[0]
        keep[at[r]] = True
    hashed, row = hashed[keep], row[keep]
    order = np.lexsort((hashed, row))
    hashed, row = hashed[order], row[order]
    first = np.ones(len(row), bool)
    first[1:] = (hashed[1:] != hashed[:-1]) | (row[1:] != row[:-1])
    hashed, row = hashed[first], row[first]
    return hashed, np.searchsorted(row, np.arange(len(counts) + 1))


def signatures(sets: np.ndarray, at: np.ndarray) -> np.ndarray:
    """VALUES numbers for each row; no row's set may be empty."""
    out = np.empty((len(at) - 1, VALUES), np.uint16)
    for k, m in enumerate(_MULTIPLIERS):
        least = np.minimum.reduceat(sets * m, at[:-1])
        out[:, k] = mix(least) & np.uint64(65535)
    return out


def _signed(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """doc_id, number of shingles, two hashes of the set, signature."""
    for b in batches:
        data, offsets = buffers(b.column(1))
        for lo, hi in slices(offsets):
            sets, at = shingles(*word_hashes(data, offsets[lo : hi + 1]), size)
            counts = np.diff(at)
            full = np.flatnonzero(counts)
            h1, h2 = np.zeros(hi - lo, np.uint64), np.zeros(hi - lo, np.uint64)
            signs: list[bytes | None] = [None] * (hi - lo)
            if len(full):
                tight = np.append(at[:-1][full], len(sets))
                h1[full] = np.add.reduceat(mix(sets ^ np.uint64(0x5851F42D4C957F2D)), tight[:-1])
                h2[full] = np.bitwise_xor.reduceat(mix(sets + np.uint64(0x14057B7EF767814F)), tight[:-1])
                for r, s in zip(full.tolist(), signatures(sets, tight), strict=True):
                    signs[r] = s.tobytes()
            yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), pa.array(counts.astype(np.int64)), pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)), pa.array(signs, pa.binary())], names=["doc_id", "n_shingles", "h1", "h2", "signature"])


def chunk_values() -> list[np.ndarray]:
    """The numbers of the values of each chunk."""
    return np.array_split(np.arange(VALUES), CHUNKS)


def unpacked(signs: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(signs), np.uint16).reshape(-1, VALUES)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each chunk of each signature and each of its values that is left out."""
    for b in batches:
        for lo in range(0, b.num_rows, 4096):
            part = b.slice(lo, 4096)
            ids = part.column(0).to_numpy(zero_copy_only=False)
            signs = unpacked(part.column(1).to_pylist()).astype(np.uint64)
            placed = mix((signs + np.uint64(1)) * mix(np.arange(1, VALUES + 1, dtype=np.uint64)))
            keys = []
            for chunk in chunk_values():
                whole = placed[:, chunk].sum(axis=1, dtype=np.uint64)
                keys += [mix(whole - placed[:, k] + np.uint64(k)) for k in chunk]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.tile(ids, VALUES))], names=["key", "id"])


def _close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose signatures are within DISTANCE."""
    for b in batches:
        x, y = (unpacked(b.column(k).to_pylist()) for k in (2, 3))
        near = np.count_nonzero(x != y, axis=1) <= DISTANCE
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(near))


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members of two blocks of a star that are within DISTANCE of a member of another component."""
    for b in batches:
        c = {name: b.column(k) for k, name in enumerate(b.schema.names)}
        centers, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for r in range(b.num_rows):
            ids, comps = ([np.array(c[n][r].as_py(), np.int64) for n in names] for names in (("ids", "ids2"), ("components", "components2")))
            signs = [unpacked(c[n][r].as_py()) for n in ("signatures", "signatures2")]
            hit = [np.zeros(len(i), bool) for i in ids]
            for lo in range(0, len(ids[0]), 32):
                x, y = np.nonzero(comps[0][lo : lo + 32, None] != comps[1])
                close = np.count_nonzero(signs[0][lo + x] != signs[1][y], axis=1) <= DISTANCE
                hit[0][lo + x[close]] = True
                hit[1][y[close]] = True
            some = np.unique(np.concatenate([i[h] for i, h in zip(ids, hit, strict=True)]))
            found.append(some)
            centers.append(np.full(len(some), c["center"][r].as_py(), np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(centers)), pa.array(np.concatenate(found))], names=["center", "id"])


def _shared(sets: list[np.ndarray], rows: list[np.ndarray], sizes: list[int]) -> np.ndarray:
    """How many elements each set of the first group has in common with each of the second."""
    common = np.intersect1d(*sets)
    places = [np.minimum(np.searchsorted(common, s), max(0, len(common) - 1)) for s in sets]
    out = np.zeros(sizes, np.int64)
    if len(common):
        inside = [common[p] == s for p, s in zip(places, sets, strict=True)]
        for lo in range(0, len(common), 4096):
            one = []
            for p, row, ok, n in zip(places, rows, inside, sizes, strict=True):
                here = ok & (p >= lo) & (p < lo + 4096)
                x = np.zeros((n, min(4096, len(common) - lo)), np.float32)
                x[row[here], p[here] - lo] = 1
                one.append(x)
            out += (one[0] @ one[1].T).astype(np.int64)  # at most 4096 each, so exact
    return out


def _touching(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """A link for each two components that members of two blocks link."""
    for b in batches:
        c = {name: b.column(k) for k, name in enumerate(b.schema.names)}
        out = [np.zeros((0, 2), np.int64)]
        for r in range(b.num_rows):
            ids, comps = ([np.array(c[n][r].as_py(), np.int64) for n in names] for names in (("ids", "ids2"), ("components", "components2")))
            lists = [c[n][r].values for n in ("sets", "sets2")]
            counts = [x.value_lengths().to_numpy() for x in lists]
            sets = [x.flatten().to_numpy() for x in lists]
            shared = _shared(sets, [np.repeat(np.arange(len(n)), n) for n in counts], [len(n) for n in counts])
            x, y = np.nonzero((100 * shared >= percent * (counts[0][:, None] + counts[1] - shared)) & (comps[0][:, None] != comps[1]))
            pair = np.sort(np.column_stack((comps[0][x], comps[1][y])), axis=1)
            _, first = np.unique(pair, axis=0, return_index=True)
            out.append(np.column_stack((ids[0][x[first]], ids[1][y[first]])))
        links = np.concatenate(out)
        yield pa.RecordBatch.from_arrays([pa.array(links[:, 0]), pa.array(links[:, 1])], names=["a", "b"])


def _sets(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        data, offsets = buffers(b.column(1))
        for lo, hi in slices(offsets):
            sets, at = shingles(*word_hashes(data, offsets[lo : hi + 1]), size)
            lists = pa.LargeListArray.from_arrays(pa.array(at), pa.array(sets.view(np.int64)))
            yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), lists.cast(pa.list_(pa.int64()))], names=["id", "set"])


def _sets_of(ids: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """(id, set) made again from the texts of these documents alone. They are joined by a shuffle at every size, since the ids grow with the documents."""
    return written(texts.hint("merge").join(ids.distinct(), "id").select("id", "text").mapInArrow(lambda it: _sets(it, size), "id bigint, set array<bigint>"), "sets")


def _confirmed(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Those of the pairs (a, b) that are links by their full sets."""
    sets = _sets_of(pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))), texts, size)
    full = pairs.join(sets.select(F.col("id").alias("a"), F.col("set").alias("x")), "a").join(sets.select(F.col("id").alias("b"), F.col("set").alias("y")), "b")
    alike = full.withColumn("common", F.size(F.array_intersect("x", "y"))).where(100 * F.col("common") >= percent * (F.size("x") + F.size("y") - F.col("common")))
    links = written(alike.select("a", "b"), "links")
    discard(sets)
    return links


def _block_pairs(members: DataFrame, *columns: str) -> tuple[DataFrame, DataFrame]:
    """Rows (center, block, blocks, columns) as pairs of blocks, each block's columns in lists: <column>s and <column>s2. Both blocks' numbers are keys of the join, so the pairs of one center go to many tasks. Second, the table that they are read from."""
    lists = [f"{c}s" for c in columns]
    packed = written(members.groupBy("center", "block", "blocks").agg(*(F.collect_list(c).alias(n) for c, n in zip(columns, lists, strict=True))), "blocks")
    first = packed.withColumn("block2", F.explode(F.sequence("block", F.col("blocks") - 1))).drop("blocks")
    other = packed.select("center", F.col("block").alias("block2"), *(F.col(n).alias(f"{n}2") for n in lists)).withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), "block2")))
    return first.join(other, ["center", "block", "block2"]).select("center", *lists, *(f"{n}2" for n in lists)), packed


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Documents are linked where the Jaccard similarity of their sets of distinct `size`-word shingles is at least `percent`
    / 100; component_id is the least doc_id reachable, and that document is kept. Fewer words than `size` are one
    shingle; null texts and those without a word are linked with nothing, so their component is their own. Rows that repeat
    a doc_id count as one document with either text; a row with a null doc_id has null component_id and kept false, and links nothing. Further
    columns are ignored; an empty table gives an empty one.
    """
    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string").alias("text"))
    signed = written(rows.mapInArrow(lambda it: _signed(it, size), "doc_id bigint, n_shingles bigint, h1 bigint, h2 bigint, signature binary"), "signed")
    full = signed.where("doc_id is not null and n_shingles > 0")
    sets = ["h1", "h2", "n_shingles"]
    groups = written(full.groupBy(*sets).agg(F.min("doc_id").alias("id"), F.first("signature").alias("signature")), "groups")
    texts = rows.withColumnRenamed("doc_id", "id")

    keyed = groups.select("id", "signature").mapInArrow(_keys, "key bigint, id bigint")
    least = keyed.groupBy("key").agg(F.min("id").alias("least"), F.count("*").alias("n")).where("n > 1")
    shared = keyed.join(least, "key")
    starred = written(shared.where("id <> least").select(F.col("least").alias("a"), F.col("id").alias("b")).distinct(), "starred")
    signs = groups.select("id", "signature")
    stars = starred.join(signs.select(F.col("id").alias("a"), F.col("signature").alias("x")), "a").join(signs.select(F.col("id").alias("b"), F.col("signature").alias("y")), "b").select("a", "b", "x", "y")
    pairs = written(stars.mapInArrow(_close, "a bigint, b bigint"), "stars")
    links = _confirmed(pairs, texts, size, percent)
    discard(pairs)
    joined = connected(links)

    comps = groups.select("id").join(joined, "id", "left").select("id", F.coalesce("component", "id").alias("component"))
    members = written(starred.select(F.col("a").alias("center"), F.col("b").alias("id")).join(comps, "id"), "members")
    several = members.groupBy("center").agg(F.count("*").alias("n"), F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("center", F.ceil(F.col("n") / BLOCK).alias("blocks"))
    # each such star is known under SALTS keys, so that no task has all members of a large one
    salted = several.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    members_of = members.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")).join(salted, ["center", "salt"]).drop("salt")
    placed = written(members_of.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks"))), "placed")
    pairs, blocks = _block_pairs(placed.join(signs, "id"), "id", "component", "signature")
    near = written(pairs.mapInArrow(_near, "center bigint, id bigint").distinct(), "near")
    wanted = _sets_of(near.select("id"), texts, size)
    close, full_blocks = _block_pairs(placed.join(near, ["center", "id"]).join(wanted, "id"), "id", "component", "set")
    more = written(close.mapInArrow(lambda it: _touching(it, percent), "a bigint, b bigint"), "links")
    for table in (starred, members, placed, blocks, near, wanted, full_blocks):
        discard(table)
    joined = connected(links.union(more))
    discard(links)
    discard(more)

    of_set = groups.select(*sets, "id").join(joined, "id", "left").select(*sets, F.coalesce("component", "id").alias("component_id"))
    hashed = full.join(of_set, sets).select("doc_id", "n_shingles", "component_id")
    alone = signed.where("doc_id is null or n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return hashed.union(alone).select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))

