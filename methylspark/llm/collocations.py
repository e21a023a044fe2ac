"""Collocations: phrases whose words come together far more often than apart.

Pieces of text between signs are told apart once, with how often each comes. Every word of a piece begins one window of up to WORDS words, and a
phrase is counted as a beginning of windows: all windows that may begin with it go to one of many hash buckets, where duckdb, out of core,
sums their weights over words' numbers. This is done for words and pairs first, and then for longer phrases in windows that reach as far as pairs
that are frequent (told by a bit for each pair's hash, of fixed size: a bit that another pair set keeps a window longer and changes no count). Frequent parts of a
phrase are counted in other buckets, so each phrase sends a request for every part, and requests meet counts in a shuffled join.

Windows are dealt by their first words. Where a beginning is so common that its bucket would hold more than a small share of all windows (a heavy
beginning, as those of a frequent word, pair or line), windows are dealt by one word more, and so on; the heavy beginning itself is counted in every task and its
counts are added up in its own bucket. Which beginnings are heavy is found on a share of the pieces and decides only where a phrase is counted, never
how often.
"""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from methylspark.llm.store import discard, written
from methylspark.llm.wordhash import buffers, mix, polynomial, slices

#: Words of a phrase at most.
WORDS = 5
#: Bytes of text or pieces that a task works on together, and bytes of pieces for each bucket.
FLUSH_BYTES, PART_BYTES = 6 << 20, 12 << 20
#: Bits that tell frequent pairs.
BITS = 1 << 25
#: A beginning is heavy if more than this share of windows has it (at most WORDS / HEAVY of them can be); it is looked for in one of LOOK pieces.
HEAVY, LOOK = 1 / 1000, 8
#: What duckdb may hold in memory in a task, and rows that it gets at once.
MEMORY, ROWS = "160MB", 500_000
#: Bytes of dealt windows that are sent on together.
SENT_BYTES = 4 << 20
#: Parts of a word are asked for so often that its count stands on so many rows.
SALTS = 16
PIECES = "lang string, piece binary, times bigint"
PHRASES = "lang string, phrase string, words int, n bigint"

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_SIGN = np.zeros(256, bool)
_SIGN[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09]] = True


def _batched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The same rows, at least FLUSH_BYTES together."""
    held: list[pa.RecordBatch] = []
    size = 0
    for b in batches:
        held.append(b)
        size += b.nbytes
        if size >= FLUSH_BYTES:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _slices_of(text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.LargeBinaryArray:
    """Parts of a buffer that don't overlap, in order."""
    inside = np.zeros(len(text) + 1, np.int8)
    inside[starts] += 1
    inside[ends] -= 1
    # where one part ends another may begin
    body = text[np.cumsum(inside[:-1], dtype=np.int8).view(bool)]
    places = np.append(0, np.cumsum(ends - starts))
    return pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(places.astype(np.int64).tobytes()), pa.py_buffer(body.tobytes())])


def _spans(solid: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs begin and end; a run never passes an edge."""
    n = len(solid)
    edge = np.zeros(n + 1, bool)
    edge[edges] = True
    begin, stop = solid.copy(), solid.copy()
    begin[1:] &= ~solid[:-1] | edge[1:n]
    stop[:-1] &= ~solid[1:] | edge[1:n]
    return np.flatnonzero(begin), np.flatnonzero(stop) + 1


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, piece, times) of the columns lang, text: each different piece of these texts that has a word, from its first word to its last."""
    for b in batches:
        data, offsets = buffers(b.column(1))
        langs = b.column(0).dictionary_encode()
        for lo, hi in slices(offsets, FLUSH_BYTES):
            at = offsets[lo : hi + 1] - offsets[lo]
            text = _FOLD[data[int(offsets[lo]) : int(offsets[hi])]]
            if not len(text):
                continue
            sign = _SIGN[text]
            starts, ends = _spans(~(sign | _SPACE[text]), at)
            # words of one piece: no sign and no end of a row between them
            cut, row = np.cumsum(sign, dtype=np.int32)[starts], np.searchsorted(at, starts, side="right")
            first = np.ones(len(starts), bool)
            first[1:] = (cut[1:] != cut[:-1]) | (row[1:] != row[:-1])
            begin = np.flatnonzero(first)
            if not len(begin):
                continue
            last = np.append(begin[1:], len(starts)) - 1
            pieces = _slices_of(text, starts[begin], ends[last]).dictionary_encode()
            kinds = len(pieces.dictionary)
            code = np.asarray(langs.indices).astype(np.int64)[lo + row[begin] - 1] * kinds + np.asarray(pieces.indices)
            code, times = np.unique(code, return_counts=True)
            columns = [langs.dictionary.take(pa.array(code // kinds)), pieces.dictionary.take(pa.array(code % kinds)).cast(pa.binary()), pa.array(times.astype(np.int64))]
            for k in range(0, len(code), 20_000):
                yield pa.RecordBatch.from_arrays([c.slice(k, 20_000) for c in columns], names=["lang", "piece", "times"])


def _hashes(words: pa.LargeBinaryArray) -> np.ndarray:
    """A hash of each word that is the same in every task."""
    data, offsets = buffers(words.cast(pa.large_string()))
    text, at = data[int(offsets[0]) : int(offsets[-1])], offsets - int(offsets[0])
    total, inverse = polynomial(text)
    return mix((total[at[1:]] - total[at[:-1]]) * inverse[at[:-1]] + np.diff(at).astype(np.uint64))


def _has(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = (h % np.uint64(BITS)).astype(np.int64)
    return (bits[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)).astype(bool)


class Windows:
    """The different windows of up to `size` words of some pieces, in order: words' numbers (-1 beyond a window's end), language and weight.

    With `bits`, those of at least three words that reach as far as pairs that have one."""

    def __init__(self, rows: pa.Table, size: int, bits: np.ndarray | None = None):
        data, offsets = buffers(rows.column("piece").cast(pa.large_binary()).cast(pa.large_string()))
        text, at = data[int(offsets[0]) : int(offsets[-1])], offsets - int(offsets[0])
        starts, ends = _spans(~_SPACE[text], at)
        coded = _slices_of(text, starts, ends).dictionary_encode()
        self.words, ids = coded.dictionary, np.asarray(coded.indices)
        self.hashes = _hashes(self.words)
        piece = (np.searchsorted(at, starts, side="right") - 1).astype(np.int32)
        langs = rows.column("lang").combine_chunks().dictionary_encode()
        self.langs = langs.dictionary
        self.lang_hashes = _hashes(self.langs.cast(pa.large_binary()))
        n, lang = len(starts), np.asarray(langs.indices)[piece]
        # the place after a window's last word
        stop = np.searchsorted(starts, at[1:])[piece].astype(np.int32)
        place = np.arange(n, dtype=np.int32)
        del text, starts, ends, coded
        if bits is not None and n:
            h = mix(self.lang_hashes[lang] + self.hashes[ids])
            h[:-1] = mix(h[:-1] + self.hashes[ids[1:]])
            rare = np.ones(n, bool)
            rare[:-1] = ~_has(bits, h[:-1])
            rare |= place + 1 >= stop
            # the first place from here on whose word and the next are no frequent pair
            last = np.minimum.accumulate(np.where(rare, place, n - 1)[::-1])[::-1]
            stop = np.minimum(stop, last + 1)
            place = place[stop - place > 2]
        ids = np.append(ids + np.int32(1), np.zeros(size, np.int32))
        wide = max(1, int(len(self.words)).bit_length())
        # as many columns as fit stand in one number
        keys, room = [lang[place].astype(np.int64)], 63 - max(1, len(self.langs)).bit_length()
        for k in range(size):
            c = np.where(place + k < stop[place], ids[place + k], 0).astype(np.int64)
            if room < wide:
                keys.append(c)
                room = 63 - wide
            else:
                keys[-1] <<= wide
                keys[-1] |= c
                room -= wide
        order = np.lexsort(keys[::-1]) if len(keys) > 1 else np.argsort(keys[0], kind="stable")
        new = np.ones(len(place), bool)
        new[1:] = False
        for k in keys:
            k = k[order]
            new[1:] |= k[1:] != k[:-1]
        del keys
        begin = np.flatnonzero(new)
        place = place[order]
        self.weight = np.add.reduceat(rows.column("times").to_numpy()[piece[place]], begin) if len(place) else np.zeros(0, np.int64)
        place = place[begin]
        self.lang = lang[place].astype(np.int64)
        self.ids = np.stack([np.where(place + k < stop[place], ids[place + k], 0) - np.int32(1) for k in range(size)])
        self.size = (self.ids >= 0).sum(axis=0)

    def __len__(self) -> int:
        return len(self.lang)

    def runs(self, size: int) -> np.ndarray:
        """Where windows with another beginning of `size` words come."""
        new = np.ones(len(self), bool)
        if len(self):
            new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in (self.lang, *self.ids[:size])])
        return np.flatnonzero(new)

    def beginning(self, at: int, size: int) -> tuple[str, tuple[bytes, ...]]:
        return self.langs[int(self.lang[at])].as_py(), tuple(self.words[int(w)].as_py() for w in self.ids[:size, at])


def _common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, words, n): beginnings that more than a share HEAVY / 2 of these windows has. A row without words is the number of windows."""
    for rows in _batched(batches):
        found = Windows(rows, WORDS)
        out: list[tuple] = [(None, None, len(found))]
        for size in range(1, WORDS):
            begin = found.runs(size)
            number = np.diff(np.append(begin, len(found)))
            for k in np.flatnonzero((number > len(found) * HEAVY / 2) & (found.size[begin] >= size)).tolist():
                lang, words = found.beginning(int(begin[k]), size)
                if sum(map(len, words)) < 1000:
                    out.append((lang, list(words), int(number[k])))
        lang, words, n = zip(*out, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(words, pa.list_(pa.binary())), pa.array(n, pa.int64())], names=["lang", "words", "n"])


def heavy_beginnings(pieces: DataFrame) -> list[tuple[str, tuple[bytes, ...]]]:
    """Beginnings of more than a share HEAVY of the windows of one of LOOK pieces; no more than WORDS / HEAVY come to the driver."""
    looked = pieces.where(F.pmod(F.xxhash64("piece"), F.lit(LOOK)) == 0).mapInArrow(_common, "lang string, words array<binary>, n bigint")
    summed = looked.groupBy("lang", "words").agg(F.sum("n").alias("n"))
    summed = written(summed, "beginnings")
    total = summed.where("words is null").agg(F.sum("n")).first()[0] or 0
    found = summed.where(F.col("words").isNotNull() & (F.col("n") > total * HEAVY)).select("lang", "words").collect()
    return sorted((r.lang, tuple(map(bytes, r.words))) for r in found)


def _dealt(batches: Iterator[pa.RecordBatch], sent: Broadcast, buckets: int, low: int, high: int) -> Iterator[pa.RecordBatch]:
    """Windows for phrases of `low` to `high` words by bucket: (bucket, rows, body). body holds the rows' weights, the lengths of their language and words (0: none), the fewest words of phrases that are counted there, and the language and words themselves.

    What a batch sends to a bucket becomes less the more buckets there are, so all work is on whole batches, but for the compression."""
    import zstandard

    press = zstandard.ZstdCompressor(level=1)
    heavy, bits = sent.value
    for rows in _batched(batches):
        found = Windows(rows, high, bits if low > 1 else None)
        if not len(found):
            continue
        word = {w: k for k, w in enumerate(found.words.to_pylist())} if heavy else {}
        lang = {x: k for k, x in enumerate(found.langs.to_pylist())}
        # a heavy beginning's number, by that of the beginning one word shorter and by its last word
        numbers: list[dict[tuple[int, int], int]] = [{} for _ in range(WORDS)]
        known: dict[tuple[str, tuple[bytes, ...]], int] = {}
        for name, words in sorted(heavy, key=lambda x: len(x[1])):
            before = lang.get(name) if len(words) == 1 else known.get((name, words[:-1]))
            if before is not None and words[-1] in word:
                known[name, words] = numbers[len(words)].setdefault((before, word[words[-1]]), len(numbers[len(words)]))
        kinds = len(found.words)
        least = np.full(len(found), low)
        state = found.lang.copy()
        live = np.arange(len(found))
        extra: list[tuple[int, int, int]] = []
        for size in range(1, high):
            if not numbers[size] or not len(live):
                break
            keys = np.array(sorted(numbers[size]), np.int64)
            keys = keys[:, 0] * kinds + keys[:, 1]
            number = np.array([n for _, n in sorted(numbers[size].items())])
            mine = state[live] * kinds + found.ids[size - 1, live]
            at = np.minimum(np.searchsorted(keys, mine), len(keys) - 1)
            hit = (keys[at] == mine) & (found.ids[size - 1, live] >= 0)
            live = live[hit]
            state[live] = number[at[hit]]
            if size >= low:
                least[live] = size + 1
                total, one = np.zeros(len(number), np.int64), np.zeros(len(number), np.int64)
                np.add.at(total, state[live], found.weight[live])
                one[state[live]] = live
                extra += [(int(one[k]), size, int(total[k])) for k in np.flatnonzero(total).tolist()]
        stay = np.flatnonzero(least <= found.size)
        heads, sizes, weights = (np.array([x[k] for x in extra], np.int64) for k in range(3))
        every = np.concatenate((stay, heads))
        ids = found.ids[:, every]
        ids[:, len(stay) :][np.arange(high)[:, None] >= sizes] = -1
        least = np.concatenate((least[stay], sizes))
        weight = np.concatenate((found.weight[stay], weights))
        langs = found.lang[every]
        key = found.lang_hashes[langs]
        for k in range(high):
            on = np.flatnonzero(k < least) if k >= low else slice(None)
            key[on] = mix(key[on] + found.hashes[ids[k, on]])
        bucket = key % np.uint64(buckets)
        # numpy sorts numbers of 16 bits by their digits
        order = np.argsort(bucket.astype(np.uint16 if buckets <= 1 << 16 else np.uint32), kind="stable")
        bucket = bucket[order]
        edges = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])), len(order))
        # languages stand after the words
        places = np.concatenate((langs[order, None] + kinds, ids[:, order].T), axis=1).ravel()
        told = pa.concat_arrays([found.words, found.langs.cast(pa.large_binary())]).take(pa.array(places, mask=places < 0))
        ends = np.frombuffer(told.buffers()[1], np.int64)[: len(told) + 1]
        text, lengths = memoryview(told.buffers()[2]), np.diff(ends).astype(np.int32)
        weight, least = weight[order].astype(np.int64), least[order].astype(np.int8)
        own: list[bytes] = []
        size, begin = 0, 0
        for k, (lo, hi, first, last) in enumerate(zip(edges.tolist(), edges[1:].tolist(), ends[edges * (high + 1)].tolist(), ends[edges[1:] * (high + 1)].tolist(), strict=False), 1):
            own.append(press.compress(b"".join((weight[lo:hi], lengths[lo * (high + 1) : hi * (high + 1)], least[lo:hi], text[first:last]))))
            size += len(own[-1])
            if size >= SENT_BYTES or k == len(edges) - 1:
                columns = [pa.array(bucket[edges[begin:k]].astype(np.int32)), pa.array(np.diff(edges[begin : k + 1])), pa.array(own, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["bucket", "rows", "body"])
                own, size, begin = [], 0, k


def _phrases(batches: Iterator[pa.RecordBatch], least: int, low: int, high: int) -> Iterator[pa.RecordBatch]:
    """(lang, phrase, words, n) of the buckets of one partition: phrases of `low` to `high` words that come at least `least` times. With single words also entries of 0 words, the number of words that were counted there."""
    import duckdb
    import zstandard

    expand = zstandard.ZstdDecompressor()
    spill = tempfile.mkdtemp(prefix="phrases-")
    try:
        con = duckdb.connect(":memory:", config={"threads": "1", "memory_limit": MEMORY, "temp_directory": spill, "preserve_insertion_order": "false"})
        names = [f"w{k}" for k in range(high)]
        con.execute(f"CREATE TABLE windows (weight BIGINT, lang INTEGER, {', '.join(f'{w} INTEGER' for w in names)}, least TINYINT)")
        # languages are numbered among the words
        words: dict[bytes, int] = {}
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray, memoryview]] = []
        count = 0

        def send() -> None:
            weight, lengths, least = (np.concatenate([x[k] for x in held]) for k in range(3))
            ends = np.append(0, np.cumsum(lengths, dtype=np.int64))
            told = pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(ends), pa.py_buffer(b"".join([x[3] for x in held]))]).dictionary_encode()
            number = np.array([words.setdefault(w, len(words)) for w in told.dictionary.to_pylist()], np.int32)[np.asarray(told.indices)].reshape(-1, high + 1)
            number[:, 1:][lengths.reshape(-1, high + 1)[:, 1:] == 0] = -1
            columns = [weight, *np.ascontiguousarray(number.T), least]
            con.register("part", pa.Table.from_arrays([pa.array(c) for c in columns], names=["weight", "lang", *names, "least"]))
            con.execute("INSERT INTO windows SELECT * FROM part")
            con.unregister("part")

        for b in batches:
            for n, body in zip(b.column(1).to_pylist(), b.column(2), strict=True):
                raw = expand.decompress(body.as_buffer())
                low_end = n * (8 + 4 * (high + 1))
                held.append((np.frombuffer(raw, np.int64, n), np.frombuffer(raw, np.int32, n * (high + 1), n * 8), np.frombuffer(raw, np.int8, n, low_end), memoryview(raw)[low_end + n :]))
                count += n
                if count >= ROWS:
                    send()
                    held, count = [], 0
        if held:
            send()
            held = []
        word_names = pa.array(list(words), pa.large_binary())
        words = {}
        for size in [*range(high, low - 1, -1), *([0] if low == 1 else [])]:
            by = ", ".join(["lang", *names[:size]])
            where = f"least <= {size} AND w{size - 1} >= 0" if size else "least = 1"
            having = f"HAVING sum(weight) >= {int(least)}" if size else ""
            for b in con.sql(f"SELECT {by}, CAST(sum(weight) AS BIGINT) AS n FROM windows WHERE {where} GROUP BY {by} {having}").to_arrow_reader(20_000):
                if b.num_rows:
                    parts = [word_names.take(c) for c in b.columns[1:-1]]
                    phrase = pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.large_binary())).cast(pa.binary()).cast(pa.string()) if size else pa.nulls(b.num_rows, pa.string())
                    yield pa.RecordBatch.from_arrays([word_names.take(b.column(0)).cast(pa.binary()).cast(pa.string()), phrase, pa.array(np.full(b.num_rows, size, np.int32)), b.column(b.num_columns - 1)], names=["lang", "phrase", "words", "n"])
        con.close()
    finally:
        shutil.rmtree(spill, ignore_errors=True)


def _slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(slot, mask): bits of the pairs of (lang, phrase) rows, 64 a slot."""
    for b in batches:
        if b.num_rows:
            first, second = (pa.array(x, pa.large_binary()) for x in zip(*(p.encode().split(b" ") for p in b.column(1).to_pylist()), strict=True))
            h = mix(mix(_hashes(b.column(0).cast(pa.large_binary())) + _hashes(first)) + _hashes(second))
            at = (h % np.uint64(BITS)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at >> 6), pa.array((np.uint64(1) << (at & 63).astype(np.uint64)).view(np.int64))], names=["slot", "mask"])


def frequent_pairs(pairs: DataFrame) -> np.ndarray:
    """A bit for the hash of each pair, BITS in all, which also bounds what comes to the driver."""
    slots = pairs.select("lang", "phrase").mapInArrow(_slots, "slot bigint, mask bigint").groupBy("slot").agg(F.bit_or("mask").alias("mask")).toArrow()
    out = np.zeros(-(-BITS // 64), np.uint64)
    out[slots["slot"].to_numpy()] = slots["mask"].to_numpy().view(np.uint64)
    return out


def phrase_counts(docs: DataFrame, least: int) -> DataFrame:
    """(lang, phrase, words, n): phrases of up to WORDS words that come at least `least` times in a language, and rows of 0 words whose n add up to a language's words."""
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))
    pieces = written(rows.mapInArrow(_pieces, PIECES).groupBy("lang", "piece").agg(F.sum("times").alias("times")), "pieces")
    size = pieces.agg(F.sum(F.octet_length("piece"))).first()[0] or 0
    partitions = max(1, -(-size // PART_BYTES))
    heavy = heavy_beginnings(pieces)

    def counted(low: int, high: int, bits: np.ndarray | None) -> DataFrame:
        sent = docs.sparkSession.sparkContext.broadcast((heavy, bits))
        dealt = pieces.mapInArrow(lambda it: _dealt(it, sent, partitions, low, high), "bucket int, rows bigint, body binary")
        return written(dealt.repartitionById(partitions, F.col("bucket")).mapInArrow(lambda it: _phrases(it, least, low, high), PHRASES), "phrases")

    short = counted(1, 2, None)
    long = counted(3, WORDS, frequent_pairs(short.where("words = 2")))
    discard(pieces)
    return short.unionByName(long)


def exact_score(scale: int) -> Column:
    """floor(scale * a * total / (l * r)), whole numbers of up to 38 digits on both sides."""
    wide = {c: F.col(c).cast("decimal(18,0)") for c in ("a", "total", "l", "r")}
    over, under = wide["a"] * wide["total"] * F.lit(scale).cast("decimal(4,0)"), wide["l"] * wide["r"]
    return F.call_function("div", over.cast("decimal(38,0)"), under.cast("decimal(38,0)"))


def mine(docs: DataFrame, least: int = 100, top: int = 2000, scale: int = 1000) -> DataFrame:
    """Each language's first `top` collocations of 2 to WORDS words: lang, rank, phrase, a, l, r, n, score.

    Words are what spaces and tabs part within pieces that signs or line breaks end, in lower case (A-Z); a language's (null: und) phrases are counted within pieces, overlaps included.
    a is how often the phrase comes, at least `least`; cut after its first words, l and r are the counts of both parts, n all words of the language, and the score
    floor(scale * a * n / (l * r)), in exact whole numbers; the cut of the lowest score counts, the first of equal ones. A phrase that a longer candidate with the same
    count contains is left out. Order: score and a descending, phrase ascending by its UTF-8 bytes.

    A null text has no words, nor has an empty table a row. Repeated rows count each time, doc_ids play no part, and further columns are ignored.
    """
    counts = phrase_counts(docs, least)
    phrases = counts.where("words > 0")
    totals = counts.where("words = 0").groupBy("lang").agg(F.sum("n").alias("total"))
    split = F.split("phrase", " ")
    cuts = F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("cut")
    asked = phrases.where("words > 1").select("lang", "phrase", "words", F.col("n").alias("a"), split.alias("w"), cuts)
    sides = F.explode(F.array(F.lit(False), F.lit(True))).alias("rest")
    asked = asked.select("*", sides)
    part = F.when(F.col("rest"), F.slice("w", F.col("cut") + 1, F.col("words") - F.col("cut"))).otherwise(F.slice("w", 1, F.col("cut")))
    asked = asked.select("lang", "phrase", "words", "a", "cut", "rest", F.array_join(part, " ").alias("part"), F.size(part).alias("part_words"))
    # a word's count is asked for by very many phrases: these requests are dealt over SALTS rows of it
    asked = asked.withColumn("salt", F.when(F.col("part_words") == 1, F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).cast("int")).otherwise(0))
    salts = F.when(F.col("words") == 1, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    held = phrases.where(F.col("words") < WORDS).select("lang", F.col("phrase").alias("part"), F.col("n").alias("part_n"), F.explode(salts).alias("salt"))
    told = written(asked.join(held, ["lang", "part", "salt"]).drop("salt"), "parts")
    # a longer candidate of the same count: if one contains a phrase, so does one that is a word longer
    dropped = told.where(F.col("part_n").eqNullSafe(F.col("a")) & (F.col("part_words") == F.col("words") - 1) & (F.col("part_words") > 1)).select("lang", F.col("part").alias("phrase")).distinct()
    both = told.groupBy("lang", "phrase", "a", "cut").agg(F.max(F.when(~F.col("rest"), F.col("part_n"))).alias("l"), F.max(F.when(F.col("rest"), F.col("part_n"))).alias("r"))
    scored = both.join(totals, "lang").withColumn("score", exact_score(scale))
    best = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "cut", "l", "r", F.col("total").alias("n"))).alias("b"))
    best = best.join(dropped, ["lang", "phrase"], "left_anti").select("lang", "phrase", "a", "b.l", "b.r", "b.n", "b.score")
    order = (F.desc("score"), F.desc("a"), "phrase")
    salted = best.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    some = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
