"""The divergence audit against plain Python and its SQL."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from methylspark.llm import divergence, queries

SCHEMA = "doc_id bigint, text string, lang string, source string, term string, n int, part string"
TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def brute(docs, least, top):
    counts, within, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in docs:
        lang, source, text = lang or "", source or "", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        found = TERM.findall(text)
        counts[lang, source].update(found)
        within[lang].update(set(found))
        groups.add((lang, source))
    out = []
    for lang in {g[0] for g in groups}:
        kept = sorted(t for t, n in within[lang].items() if n >= least)
        sources = sorted(s for x, s in groups if x == lang)
        every = sum((counts[lang, s] for s in sources), Counter())

        def p(count, kept=kept):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 1) // (total + len(kept)) for t in kept}

        of, q = {s: p(counts[lang, s]) for s in sources}, p(every)
        for s in sources:
            pairs = [(-sum((of[s][t] - of[o][t]) ** 2 // of[o][t] for t in kept), o.encode(), o) for o in sources if o != s]
            terms = [(-((of[s][t] - q[t]) ** 2 // q[t]), t.encode(), t) for t in kept if counts[lang, s][t] and of[s][t] > q[t]]
            out += [(lang, s, "pair", o, -v, k) for k, (v, _, o) in enumerate(sorted(pairs), 1)]
            out += [(lang, s, "term", t, -v, k) for k, (v, _, t) in enumerate(sorted(terms)[:top], 1)]
    return sorted(out)


def frame(spark, docs):
    return spark.createDataFrame([(k, *d, "x", 1, "y") for k, d in enumerate(docs)], SCHEMA).repartition(3)


def some(seed, n):
    rng = random.Random(seed)
    words = ["The", "a", "é", "É", "中文", "x1y", "don't", "zz", "b-c", "_", "😀", "ab\x00cd", "\x7f", "of", "A" * 400] + [f"w{chr(97 + k)}" for k in range(20)]
    docs = [(" ".join(rng.choice(words) for _ in range(rng.randrange(12))), rng.choice(["en", "de"]), rng.choice("pqrsé")) for _ in range(n)]
    return docs + [(None, None, None), ("", "en", "quiet"), ("lone words", "none", "a"), ("", "none", "b"), ("a a a", None, "p"), *docs[:5] * 3]


@pytest.mark.parametrize(("cells", "pairs", "flush"), [(1 << 20, 1 << 20, 1 << 24), (40, 3, 10)])
def test_audit_by_brute_force(spark, monkeypatch, cells, pairs, flush):
    """Also with many small chunks and blocks."""
    for name, value in (("CELLS", cells), ("PAIRS", pairs), ("FLUSH_BYTES", flush)):
        monkeypatch.setattr(divergence, name, value)
    docs = some(1, 150)
    got = sorted(map(tuple, divergence.audit(frame(spark, docs), 3, 5).collect()))
    assert got == brute(docs, 3, 5)


def test_large_batches_are_counted_in_parts(monkeypatch):
    """However much text a batch holds, little is counted at once; small batches are counted together."""
    sizes, count = [], divergence._count
    monkeypatch.setattr(divergence, "FLUSH_BYTES", 1000)
    monkeypatch.setattr(divergence, "_count", lambda rows: sizes.append((rows.num_rows, pc.sum(pc.binary_length(rows["text"])).as_py() or 0)) or count(rows))
    texts = [f"a w{chr(97 + k % 26)} " * 20 for k in range(60)] + [None, "", "b " * 1500, "c"]
    whole = pa.RecordBatch.from_pydict({"lang": ["en"] * 64, "source": ["s", "t"] * 32, "text": texts})
    for batches in ([whole], [whole.slice(k, 1) for k in range(64)]):
        sizes.clear()
        got = Counter()
        for b in divergence._counted(iter(batches)):
            for row in b.to_pylist():
                got[row["source"], row["term"]] += row["n"]
        want = Counter({("s", b""): 0, ("t", b""): 0})
        for source, text in zip(["s", "t"] * 32, texts, strict=True):
            want.update((source, t.encode()) for t in TERM.findall(text or ""))
        assert dict(got) == dict(want)
        assert sum(n for n, _ in sizes) == 64 and 6 < len(sizes) < 40
        assert all(size <= 1000 or n == 1 for n, size in sizes)


def test_audit_of_nothing(spark):
    assert divergence.audit(frame(spark, []), 3, 5).count() == 0
    assert divergence.audit(frame(spark, [(None, None, None)]), 3, 5).count() == 0


def test_scaled_is_exact():
    rng = random.Random(3)
    for _ in range(2000):
        total = rng.randrange(1, 9 * 10 ** rng.randrange(1, 16))
        count = rng.randrange(total + 1)
        assert divergence.scaled(np.array([count]), total)[0] == 1 + 10**9 * count // total


def test_query_as_sql(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    want = con.execute(queries.OP13_SQL).fetchall()
    got = queries.op13_source_divergence(spark, sf_dir)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"] and sorted(map(tuple, got.collect())) == sorted(want)
