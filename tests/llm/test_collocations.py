"""Collocations against plain Python and their SQL."""

import random
import re
import time
from collections import Counter, defaultdict
from types import SimpleNamespace

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from methylspark.llm import collocations, queries

SCHEMA = "doc_id bigint, text string, lang string, phrase string, words int, score string"


def brute(docs, least, top, scale=1000):
    counts, totals = defaultdict(Counter), Counter()
    for text, lang in docs:
        lang, text = lang or "und", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", text):
            words = [w for w in re.split("[ \t]+", piece) if w]
            totals[lang] += len(words)
            for k in range(1, 6):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, count in counts.items():
        found = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in found.items():
            if any(len(q) > len(p) and f >= a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, f in found.items()):
                continue
            score, _, left, right = min((scale * a * totals[lang] // (count[p[:k]] * count[p[k:]]), k, count[p[:k]], count[p[k:]]) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, k, p.decode(), -a, left, right, totals[lang], -s) for k, (s, a, p, left, right) in enumerate(sorted(rows)[:top], 1)]
    return sorted(out)


def frame(spark, docs):
    return spark.createDataFrame([(k, *d, "x", 1, "y") for k, d in enumerate(docs)], SCHEMA).repartition(4)


def some(seed, n):
    rng = random.Random(seed)
    words = ["of", "the", "The", "é", "x-y", "a", "b", "c", "中", "\x1c", "'"] + [f"w{k}" for k in range(12)]
    gaps = [" "] * 12 + ["  ", "\t", ", ", ".", "\n", " ? "]
    docs = [("".join(rng.choice(words[:4] if rng.random() < 0.5 else words) + rng.choice(gaps) for _ in range(rng.randrange(40))), rng.choice(["en", "en", "de", None])) for _ in range(n)]
    return docs + [("a " * 3000, "en"), ("a passage that all share of the", "de")] + [("x the passage that comes again and again y", "en")] * 30 + [(None, "en"), ("", None), ("\n. ,\t ", "zz"), (" lone ", "one")]


@pytest.mark.parametrize(("heavy", "look", "flush", "part"), [(1 / 1000, 8, 16 << 20, 16 << 20), (1 / 50, 1, 3000, 4000), (1 / 500, 1, 1 << 20, 1 << 20)])
def test_mining_by_brute_force(spark, monkeypatch, heavy, look, flush, part):
    """Also with many buckets, and with heavy beginnings of every length."""
    for name, value in (("HEAVY", heavy), ("LOOK", look), ("FLUSH_BYTES", flush), ("PART_BYTES", part), ("ROWS", 100)):
        monkeypatch.setattr(collocations, name, value)
    docs = some(1, 200)
    assert sorted(map(tuple, collocations.mine(frame(spark, docs), 12, 60).collect())) == brute(docs, 12, 60)
    if heavy == 1 / 50:
        pieces = frame(spark, docs).select("lang", F.col("text")).where("lang is not null").mapInArrow(collocations._pieces, collocations.PIECES)
        assert {len(w) for _, w in collocations.heavy_beginnings(pieces)} >= {1, 2}


def test_mining_of_nothing(spark):
    assert collocations.mine(frame(spark, []), 2, 10).count() == 0
    assert collocations.mine(frame(spark, [(None, None), (" ", "en")]), 1, 10).count() == 0


def test_division_is_exact_beyond_64_bits(spark):
    rng = random.Random(4)
    rows = [(rng.randrange(10**14), rng.randrange(10**14), rng.randrange(1, 10**14), rng.randrange(1, 10**9)) for _ in range(300)]
    rows = [(a, n, left, r) for a, n, left, r in rows if 1000 * a * n // (left * r) < 2**63]
    df = spark.createDataFrame(rows, "a bigint, total bigint, l bigint, r bigint").select("*", collocations.exact_score(1000).alias("score"))
    assert len(rows) > 100 and all(x.score == 1000 * x.a * x.total // (x.l * x.r) for x in df.collect())


def test_query_as_sql(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    want = con.execute(queries.OP12_SQL).fetchall()
    got = queries.op12_collocations(spark, sf_dir)
    assert want and got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"] and sorted(map(tuple, got.collect())) == sorted(want)


def test_many_buckets_cost_little_more_than_few():
    """A batch's words are not gone through again for each bucket, on either side; nor do counts depend on the buckets. A language may have an empty name."""
    rng = random.Random(3)
    lines = [(rng.choice(["en", ""]), [f"w{rng.randrange(60_000)}" for _ in range(6)]) for _ in range(60_000)]
    pieces = pa.RecordBatch.from_arrays([pa.array([x for x, _ in lines]), pa.array([" ".join(w).encode() for _, w in lines]), pa.array([1] * len(lines))], names=["lang", "piece", "times"])
    want = Counter((x, " ".join(p)) for x, w in lines for p in [*((y,) for y in w), *zip(w, w[1:], strict=False)])
    want = {k: n for k, n in want.items() if n > 1}

    def took(buckets):
        begin, out = time.process_time(), list(collocations._dealt(iter([pieces]), SimpleNamespace(value=([], None)), buckets, 1, 2))
        assert len({k for b in out for k in b.column(0).to_pylist()}) > 0.9 * min(buckets, 4000)
        found = list(collocations._phrases(iter(out), 2, 1, 2))
        seconds = time.process_time() - begin
        rows = [r for b in found for r in b.to_pylist()]
        assert {(r["lang"], r["phrase"]): r["n"] for r in rows if r["words"]} == want and sum(r["n"] for r in rows if not r["words"]) == 360_000
        return seconds

    took(10)
    assert min(took(4000) for _ in range(2)) < 1.8 * min(took(10) for _ in range(2))
