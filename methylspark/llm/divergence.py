"""Where a source's terms diverge from its language's other sources, by integer-dictionary encoding.

Terms are counted by (lang, source, term) in tasks, and again after the only shuffle of terms. Those kept of a language are dealt to chunks by a hash.
In a chunk they are a sorted array, a term's id is its place by `searchsorted`, and the counts of each source are a dense vector by `bincount`; ids keep
UTF-8 order, so an order by (value, id) settles ties. Probabilities are integers, and all arithmetic on them is exact.

A chunk holds at most about CELLS numbers, of all sources of its language, so no task holds a language or a source whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from methylspark.llm.store import written
from methylspark.llm.wordhash import buffers, slices

#: Numbers of a chunk: its terms times the sources of its language. And pairs of sources that a task makes of it.
CELLS, PAIRS = 1 << 16, 1 << 20
#: Bytes of text that are counted together before they are sent (a longer text alone); counting takes 13 to 20 times as much memory.
FLUSH_BYTES = 4 << 20
UNIT = 1_000_000_000

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_TERM = np.zeros(256, bool)
_TERM[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
COUNTED = "lang string, source string, term binary, n bigint, texts bigint"
AUDITED = "part string, source string, item string, value bigint"


def terms_of(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.LargeBinaryArray, np.ndarray]:
    """All terms of these rows, lower-cased, and the row each is of."""
    base = int(offsets[0])
    text, at = data[base : int(offsets[-1])], offsets - base
    n = len(text)
    if not n:
        return pa.array([], pa.large_binary()), np.zeros(0, np.int64)
    inside = _TERM[text]
    edge = np.zeros(n + 1, bool)
    edge[at] = True
    begin, stop = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1] | edge[1:n]
    stop[:-1] &= ~inside[1:] | edge[1:n]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(stop) + 1
    places = np.append(0, np.cumsum(ends - starts))
    terms = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(places.tobytes()), pa.py_buffer(_FOLD[text[inside]].tobytes())])
    return terms, np.searchsorted(at, starts, side="right") - 1


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n, texts) of the columns lang, source, text; each group also has a row with an empty term."""
    held: list[pa.RecordBatch] = []
    size = 0
    for b in batches:
        # a batch can hold much more text than is counted at once
        for lo, hi in slices(buffers(b.column("text"))[1], FLUSH_BYTES):
            part = b.slice(lo, hi - lo)
            if held and size + part.nbytes > FLUSH_BYTES:
                yield _count(pa.Table.from_batches(held))
                held, size = [], 0
            held.append(part)
            size += part.nbytes
    if held:
        yield _count(pa.Table.from_batches(held))


def _count(rows: pa.Table) -> pa.RecordBatch:
    groups, group = _encoded(rows.select(["lang", "source"]))
    data, offsets = buffers(rows.column("text"))
    terms, text = terms_of(data, offsets)
    coded = terms.dictionary_encode()
    ids, kinds = np.asarray(coded.indices).astype(np.int64), max(len(coded.dictionary), 1)
    # each text's different terms first, with how often each comes
    pairs, times = np.unique(text * kinds + ids, return_counts=True)
    cells, inverse = np.unique(group[pairs // kinds] * kinds + pairs % kinds, return_inverse=True)
    n, texts = np.bincount(inverse, times, len(cells)).astype(np.int64), np.bincount(inverse, minlength=len(cells))
    empty = pa.array([b""] * groups.num_rows, pa.large_binary())
    of = pa.array(np.append(cells // kinds, np.arange(groups.num_rows)))
    zero = np.zeros(groups.num_rows, np.int64)
    found = pa.concat_arrays([coded.dictionary.take(pa.array(cells % kinds)), empty]).cast(pa.binary())
    columns = [groups.column("lang").take(of).combine_chunks(), groups.column("source").take(of).combine_chunks(), found, pa.array(np.append(n, zero)), pa.array(np.append(texts, zero))]
    return pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "n", "texts"])


def _encoded(columns: pa.Table) -> tuple[pa.Table, np.ndarray]:
    """Different rows, and each row's number among them."""
    code = np.zeros(columns.num_rows, np.int64)
    for c in columns.columns:
        coded = c.combine_chunks().dictionary_encode()
        code = code * max(len(coded.dictionary), 1) + np.asarray(coded.indices)
    _, first, number = np.unique(code, return_index=True, return_inverse=True)
    return columns.take(pa.array(first)), number


def scaled(count: np.ndarray, total: np.ndarray | int) -> np.ndarray:
    """1 + floor(UNIT * count / total), by long division three digits at a time; for counts up to their total, of at most 2**63 / 1000."""
    out, rest = np.zeros(np.broadcast(count, total).shape, np.int64), np.asarray(count, np.int64)
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + rest // total
        rest = rest % total
    return out + 1


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def _audited(cells: pa.Table, groups: pa.Table, block: int, top: int) -> pa.Table:
    """Of the sources of a block: a chunk's share of each pair's value, and the source's `top` terms. cells: source, term, n, lang_n; groups: source, total, terms, lang_total, blocks, all of one language."""
    groups = groups.take(pc.sort_indices(groups["source"].cast(pa.binary())))
    names, sources = groups["source"].combine_chunks(), groups.num_rows
    terms, lang_total, blocks = (groups[c][0].as_py() for c in ("terms", "lang_total", "blocks"))
    found = np.array(cells["term"].to_pylist(), object)
    kept = np.unique(found) if len(found) else found
    ids = np.searchsorted(kept, found)
    row = np.asarray(pc.index_in(cells["source"].combine_chunks(), names), np.int64)
    # a cell has one count, exact as a float up to 2**53
    n = np.bincount(row * len(kept) + ids, cells["n"].to_numpy(), sources * len(kept)).astype(np.int64).reshape(sources, len(kept))
    lang_n = np.zeros(len(kept), np.int64)
    lang_n[ids] = cells["lang_n"].to_numpy()
    p, q = (n, lang_n) if not len(kept) else (scaled(n + 1, groups["total"].to_numpy()[:, None] + terms), scaled(lang_n + 1, lang_total + terms))
    words = pa.array([t.decode() for t in kept.tolist()], pa.string())
    every, out = np.arange(sources), []
    for k in range(block, sources, blocks):
        others = every[every != k]
        value = divergence(p[k], q)
        likely = np.flatnonzero((n[k] > 0) & (p[k] > q))
        likely = likely[np.lexsort((likely, -value[likely]))[:top]]
        for part, items, values in (("pair", names.take(pa.array(others)), divergence(p[k], p).sum(axis=1)[others]), ("term", words.take(pa.array(likely)), value[likely])):
            out.append(pa.table([pa.repeat(pa.scalar(part), len(items)), pa.repeat(names[k], len(items)), items, pa.array(values)], names=["part", "source", "item", "value"]))
    return pa.concat_tables(out)


def audit(docs: DataFrame, least: int = 3, top: int = 200) -> DataFrame:
    """How each (lang, source) of the documents differs: lang, source, part, item, value, rank.

    A language keeps the terms that are in at least `least` of its documents. With p a group's and q another's scaled probability of a term, the term's
    divergence is floor((p - q)^2 / q). Part `pair` ranks the other sources of the language by their sum over all kept terms; part `term` the `top` kept terms
    of the group that are likelier in it than in the language. Ranks begin at 1, by value descending, then by the item's UTF-8 bytes.

    A null text, lang or source is an empty one; a group without terms, or in a language that keeps none, has its pairs (there of value 0). Repeated rows
    are documents of their own; further columns are ignored; an empty table gives an empty one. Doc_ids play no part.
    """
    rows = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    found = rows.mapInArrow(_counted, COUNTED).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("texts").alias("texts"))
    same = Window.partitionBy("lang", "term")
    known = found.withColumns({"in_texts": F.sum("texts").over(same), "lang_n": F.sum("n").over(same), "first": F.min("source").over(same) == F.col("source")})
    cells = written(known.where((F.col("in_texts") >= least) | (F.octet_length("term") == 0)).select("lang", "source", "term", "n", "lang_n", "first"), "kept-terms")
    groups = written(cells.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count_if(F.col("first") & (F.octet_length("term") > 0)).alias("firsts")), "term-groups")
    langs = groups.groupBy("lang").agg(F.sum("total").alias("lang_total"), F.sum("firsts").alias("terms"), F.count("*").alias("sources"))
    langs = langs.withColumns({"chunks": F.greatest(F.lit(1), F.ceil(F.col("terms") * F.col("sources") / CELLS)), "blocks": F.least(F.col("sources"), F.ceil(F.col("sources") * F.col("sources") / PAIRS))})
    sized = groups.drop("firsts").join(langs, "lang")

    def blocks(df: DataFrame) -> DataFrame:
        return df.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))

    spread = blocks(sized.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1)))).select("lang", "chunk", "block", "source", "total", "terms", "lang_total", "blocks")
    dealt = cells.where(F.octet_length("term") > 0).join(langs.select("lang", "chunks", "blocks"), "lang").withColumn("chunk", F.pmod(F.xxhash64("term"), F.col("chunks")))
    dealt = blocks(dealt).select("lang", "chunk", "block", "source", "term", "n", "lang_n")

    def chunk(key: tuple, cells: pa.Table, groups: pa.Table) -> pa.Table:
        out = _audited(cells, groups, key[2].as_py(), top)
        return out.add_column(0, "lang", pa.repeat(key[0], out.num_rows))

    by = ("lang", "chunk", "block")
    parts = dealt.groupBy(*by).cogroup(spread.groupBy(*by)).applyInArrow(chunk, f"lang string, {AUDITED}")
    summed = parts.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item"))
    return summed.withColumn("rank", rank).where((F.col("part") == "pair") | (F.col("rank") <= top)).select("lang", "source", "part", "item", "value", "rank")
