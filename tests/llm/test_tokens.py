"""Packing and token records against the tokenizer itself."""

import json
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from methylspark.llm import encoding, packing, queries, records
from methylspark.llm.store import new_path

PATH = public_tokenizers.path(queries.BYTE_BPE)
ODD = [
    "", " ", "  ", "a", " a", "a ", "a  b   c", "a\n b", "a \nb", "a\n\n  b\t c ", "don't 's it's", "x" * 5000, "é ñ 東京  タワー", "  a　b ᠎ c",
    "<|endoftext|>", "a <|endoftext|> b  c", "1,234.5 + 6%%% a&&&", "\x1c \x1d a", " ​ b", "a " * 3000, "\r\n a\r\n  b", "😀 😀😀",
]
SCHEMA = "doc_id bigint, text string, ids string, length int"


TOKENIZER = Tokenizer.from_file(PATH)


def ids_of(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, t, "x", 1) for k, t in enumerate(ODD)] + [(None, "no id here", "x", 2), (3, "a", "x", 3), (3, "a", "x", 3), (99, None, None, None)]
    return rows, spark.createDataFrame(rows, SCHEMA).repartition(3)


def test_encoder_is_the_tokenizer():
    rng = random.Random(1)
    signs = [" ", "  ", "\n", "\t", "a", "the", "The", "é", ".", "'s", "'", "12", "<", "\u00a0", "\u3000", "-", "!!", "###", "\n\n", "\x1c", "ß"]
    texts = ODD + ["".join(rng.choice(signs) for _ in range(60)) for _ in range(1500)] + ["".join(rng.choice(signs) for _ in range(3)) for _ in range(3000)]
    encode = encoding.Encoder(PATH)
    for _ in range(2):
        got = [x.tolist() for block in encode.column(pa.array(texts)) for x in block]
        for text, ids in zip(texts, got, strict=True):
            assert ids == ids_of(text), text


@pytest.mark.parametrize("change", [{"normalizer": {"type": "Lowercase"}}, {"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": True, "trim_offsets": True, "use_regex": True}}, {"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}}])
def test_encoder_of_another_kind(tmp_path, change):
    """A file that lower-cases, puts a space before, or doesn't split."""
    path = tmp_path / "other.json"
    path.write_text(json.dumps(json.loads(TOKENIZER.to_str()) | change))
    other, encode = Tokenizer.from_file(str(path)), encoding.Encoder(str(path))
    texts = ["The THE the", "a b", None, "", *ODD[:12]]
    got = [x.tolist() for block in encode.column(pa.array(texts)) for x in block]
    assert got == [other.encode(t or "", add_special_tokens=False).ids for t in texts] and not encode.plain


def test_pieces_of_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(encoding, "mix", lambda h: h % np.uint64(5))
    monkeypatch.setattr(encoding, "CHUNK_BYTES", 40)
    texts = ["one two three four five six seven", "eight nine ten", "one two", "zz two one", "a bb ccc dddd"] * 3
    got = [x.tolist() for block in encoding.Encoder(PATH).column(pa.array(texts)) for x in block]
    assert got == [ids_of(t) for t in texts]


def test_encoder_forgets_nothing(monkeypatch):
    monkeypatch.setattr(encoding, "MEMORY_PIECES", 3)
    monkeypatch.setattr(encoding, "CHUNK_BYTES", 10)
    encode = encoding.Encoder(PATH)
    texts = ["a b c d e f g", None, "h i j", "", "k b l", "a"]
    for _ in range(2):
        assert [x.tolist() for block in encode.column(pa.array(texts)) for x in block] == [ids_of(t) for t in texts]


@pytest.mark.parametrize("capacity", [1, 16, 1024])
def test_bins_take_their_class(capacity):
    """Of random lengths every token has one place, bins of class k hold k rests of that class, and nothing is padded."""
    rng = random.Random(capacity)
    lengths = [rng.choice([1, 2, 3, rng.randrange(1, 40), rng.randrange(1, 3 * capacity + 2)]) for _ in range(3000)]
    bins = packing.Bins(capacity, 7)
    for doc, n in enumerate(lengths):
        bins.add(packing.Item(doc, 0, bytes(4 * n), n))
    held = len(bins.waiting) + len(bins.open)
    bins.close()
    whole, seen = defaultdict(list), defaultdict(list)
    for item, sequence, offset, kind in bins.done:
        whole[sequence].append((offset, len(item), kind))
        seen[item.doc].append((item.start, len(item)))
    for doc, n in enumerate(lengths):
        at = 0
        for start, size in sorted(seen[doc]):
            assert start == at and size > 0
            at += size
        assert at == n
    assert sorted(whole) == list(range(7, 7 + len(whole))) and held <= 2 * capacity**0.5 + packing.WAITING + 2
    for pieces in whole.values():
        pieces.sort()
        size = sum(n for _, n, _ in pieces)
        assert [o for o, *_ in pieces] == [sum(n for _, n, _ in pieces[:k]) for k in range(len(pieces))]
        assert size == capacity or size < capacity and size & (size - 1) == 0
        kinds = {k for *_, k in pieces if k}
        if kinds:
            (kind,) = kinds
            assert sum(k == kind for *_, k in pieces) == kind and all(capacity // n == kind for _, n, k in pieces if k)
    if capacity == 1024:
        assert sum(map(len, seen.values())) < 1.6 * sum(-(-n // capacity) for n in lengths)


def packed_well(rows, docs, capacity, end_id):
    whole = defaultdict(list)
    for r in rows:
        assert r.length >= 1
        whole[r.sequence_id].append(r)
    for pieces in whole.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity and at & (at - 1) == 0
    want = sorted((d is None, d or 0, crc(ids_of(t) + [end_id])) for d, t, *_ in docs)
    assert sum(r.length for r in rows) == sum(len(ids_of(t)) + 1 for _, t, *_ in docs)
    return want


def test_packing_holds_each_id_once(docs):
    rows = packing.harmonic_pack(docs[1], PATH, 1024, 0).collect()
    packed_well(rows, docs[0], 1024, 0)
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
    for doc, text, *_ in docs[0]:
        if doc != 3:
            ids = np.concatenate([np.frombuffer(r.ids, "<u4") for r in sorted(by_doc[doc], key=lambda r: r.start)])
            assert ids.tolist() == [*ids_of(text), 0]
    assert all(r["class"] in (0, 1024 // r.length) for r in rows)


def test_packing_of_nothing(spark):
    assert packing.harmonic_pack(spark.createDataFrame([], SCHEMA), PATH).count() == 0
    with pytest.raises(ValueError):
        packing.harmonic_pack(spark.createDataFrame([], SCHEMA), PATH, 1000)


def test_packing_query(spark, sf_dir):
    rows = queries.op3_packing(spark, sf_dir).collect()
    documents = queries.table(spark, sf_dir, "documents").select("doc_id", "text").collect()
    packed_well(rows, [tuple(d) for d in documents], 1024, 0)
    text = {d.doc_id: d.text for d in documents}
    for r in rows[:50]:
        ids = [*ids_of(text[r.doc_id]), 0]
        assert r.doc_tokens == len(ids) and r.ids_crc32 == crc(ids[r.start : r.start + r.length])


@pytest.mark.parametrize("part", [1, 100, 16 << 20])
def test_records_round_trip(spark, docs, part, monkeypatch):
    monkeypatch.setattr(records, "PART_BYTES", part)
    files = records.write_records(docs[1], new_path(spark, "records"), PATH, 2)
    rows = records.read_records(spark, files).collect()
    ordered = sorted(docs[0], key=lambda d: (d[0] is not None, d[0] or 0, d[1] or ""))
    start, want = 0, []
    for doc, text, *_ in ordered:
        ids = [*ids_of(text), 2]
        want.append((doc, start, ids))
        start += len(ids)
    got = sorted((r.start, r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in rows)
    assert [(d, s, i) for s, d, i in got] == want
    for f in files.collect():
        order = list(range(f.docs))
        random.Random(2).shuffle(order)
        straight = records.read_at(f.path, list(range(f.docs)))
        assert [(d, i.tolist()) for d, i in records.read_at(f.path, order)] == [(straight[k][0], straight[k][1].tolist()) for k in order]


def test_broken_records_are_found():
    data = records.frame(b"abc") + records.frame(b"defg")
    payload, second = records.unframe(data, 0)
    assert (bytes(payload), bytes(records.unframe(data, second)[0])) == (b"abc", b"defg")
    for k in range(len(data)):
        broken = bytearray(data)
        broken[k] ^= 1
        with pytest.raises(ValueError):
            for at in (0, second):
                records.unframe(bytes(broken), at)


def test_no_records(spark):
    files = records.write_records(spark.createDataFrame([], SCHEMA), new_path(spark, "records"), PATH)
    assert records.read_records(spark, files).count() == 0


def test_records_query(spark, sf_dir):
    rows = sorted(queries.op10_token_records(spark, sf_dir).collect())
    start = 0
    for r, d in zip(rows, sorted(queries.table(spark, sf_dir, "documents").select("doc_id", "text").collect()), strict=True):
        ids = [*ids_of(d.text), 2]
        assert tuple(r) == (d.doc_id, start, len(ids), crc(ids))
        start += len(ids)
