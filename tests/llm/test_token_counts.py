"""Token counts against the tokenizers library and against merging by hand."""

import json
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from methylspark.llm import queries, token_counts
from methylspark.llm.token_counts import MergeCounter

PATH = public_tokenizers.path(queries.WORD_BPE)
SIGNS = list("abcdeABC'  \t\n\r\x0b\x0c\x1c\x1f\x85  　.,!?0123٣éÉéǅİıßΣς中文한ᄒ🙂‍\x00\x7f") + ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "the", "ing", "'ll", "'RE", "K", "'s"]
ODD = ["", None, " ", "a", "A" * 5000, "the " * 5000, "x<|endoftext|>y <|endoftext|>", "don't DON'T", "é" * 300, "\x00"]


def sizes(path, texts):
    tokenizer = Tokenizer.from_file(str(path))
    return [len(e.ids) for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def texts(seed, n):
    rng = random.Random(seed)
    return ["".join(rng.choice(SIGNS) for _ in range(rng.randrange(30))) for _ in range(n)]


@pytest.mark.parametrize("name", [queries.WORD_BPE, queries.BYTE_BPE])
def test_counts_are_the_librarys(name, monkeypatch):
    path, every = public_tokenizers.path(name), texts(1, 3000) + ODD
    count = MergeCounter(path)
    assert [count.count((t or "").encode()) for t in every] == sizes(path, every)
    monkeypatch.setattr(token_counts, "PART_BYTES", 5)
    monkeypatch.setattr(token_counts, "MEMORY", 3)
    count = MergeCounter(path)
    assert [count.count((t or "").encode()) for t in every] == sizes(path, every)


def test_merges_by_hand():
    """The lowest rank first, then the first place, one merge after another."""
    count = MergeCounter(PATH)
    symbol = (1 << token_counts._SYMBOL) - 1

    def by_hand(symbols):
        done = 0
        while True:
            found = [(count.pairs[a << token_counts._SYMBOL | b], k) for k, (a, b) in enumerate(zip(symbols, symbols[1:], strict=False)) if a << token_counts._SYMBOL | b in count.pairs]
            if not found:
                return done
            made, k = min(found)
            symbols[k : k + 2] = [made & symbol]
            done += 1

    rng = random.Random(2)
    for _ in range(500):
        word = bytes(rng.choice(b"abeinorst") for _ in range(rng.randrange(1, 25)))
        symbols = [*[count.inner[b] for b in word[:-1]], count.last[word[-1]]]
        assert count.merges(symbols[:]) == by_hand(symbols), word


def test_other_files(tmp_path):
    told = json.loads(Tokenizer.from_file(PATH).to_str())
    other = tmp_path / "other.json"
    other.write_text(json.dumps(told | {"normalizer": None}))
    every = texts(3, 500)
    count = MergeCounter(str(other))
    assert count.cut and not count.lower and [count.count(t.encode()) for t in every] == sizes(other, every)
    other.write_text(json.dumps(told | {"pre_tokenizer": {"type": "Whitespace"}}))
    with pytest.raises(ValueError, match="byte-level"):
        MergeCounter(str(other))


def test_documents_with_odd_rows(spark):
    rows = [(k, t, "clash", k) for k, t in enumerate(ODD)] + [(None, "no id", "x", 0), (3, "A" * 5000, "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_tokens string, n_bytes int").repartition(3)
    got = sorted(map(tuple, token_counts.count_tokens(docs, PATH).collect()), key=str)
    want = [(d, len((t or "").encode()), n) for (d, t, *_), n in zip(rows, sizes(PATH, [r[1] for r in rows]), strict=True)]
    assert got == sorted(want, key=str)
    assert token_counts.count_tokens(docs.limit(0), PATH).count() == 0


def test_query(spark, sf_dir):
    got = {r.doc_id: r for r in queries.op11_token_counts(spark, sf_dir).collect()}
    docs = queries.table(spark, sf_dir, "documents").collect()
    for d, n in zip(docs, sizes(PATH, [d.text for d in docs]), strict=True):
        assert tuple(got[d.doc_id]) == (d.doc_id, len((d.text or "").encode()), n, n > 2048)
