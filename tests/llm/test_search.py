"""Fingerprints, top-k search, mixing and the pipeline."""

import hashlib
import random
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from methylspark.llm import fingerprint, mixing, queries, topk, wordhash
from methylspark.llm.wordhash import buffers
from tests.llm.test_near_dup import brute

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, topic string, tokens string"


def frame(spark, docs, parts=3):
    return spark.createDataFrame([(d, t, "en", "s", len(t or ""), "x", "y") for d, t in docs], SCHEMA).repartition(parts)


def texts(seed, n):
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdeé \n") for _ in range(rng.choice([0, 1, 3, 7, 20, 300, 5000]))) for _ in range(n)]


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b):
            before, row[j + 1] = row[j + 1], before + 1 if x == y else max(row[j], row[j + 1])
    return row[-1]


def test_common_letters():
    rng = random.Random(1)
    some = ["".join(rng.choice("ABCD+/9") for _ in range(rng.randrange(1, 65))) for _ in range(80)]
    other = some[::-1]
    assert fingerprint.common_letters(some, other).tolist() == [lcs(a, b) for a, b in zip(some, other, strict=True)]


def test_fingerprints_stand_alone():
    """A text's fingerprint doesn't depend on its neighbours; signatures keep their bound; edits show little."""
    some = [*texts(2, 60), "x" * 100_000, "ab" * 40_000, "same", "same"]
    together = fingerprint.fingerprints(*buffers(pa.array(some)))
    assert together == [fingerprint.fingerprints(*buffers(pa.array([t])))[0] for t in some]
    assert together[-1] == together[-2] and all(len(s) <= fingerprint.LETTERS for x in together for s in x.split(":")[1:])
    rng = random.Random(3)
    base = "".join(rng.choice("abcdefgh ") for _ in range(20_000))
    near = base[:7000] + "inserted" + base[7000:]
    a, b, c = fingerprint.fingerprints(*buffers(pa.array([base, near, texts(9, 200)[-1] * 3 + base[::-1]])))
    assert fingerprint.likeness([a, a, a], [b, a, c]).tolist()[:2] == pytest.approx([1, 1], abs=0.1)
    assert fingerprint.likeness([a], [c])[0] < 0.3


def written_out(text):
    """A fingerprint byte by byte: the rolling hash of each window, the chunks that it ends, and a letter for each."""
    data, p, mask = text.encode(), 0x9E3779B97F4A7C15, 2**64 - 1
    number = [int(x) for x in wordhash._BYTE]
    spread = lambda h: int(wordhash.mix(np.array([h], np.uint64))[0])
    of = lambda part: sum(number[b] * pow(p, k, 2**64) for k, b in enumerate(part)) & mask
    w = fingerprint.WINDOW
    rolled = {k + w: of(data[k : k + w]) >> 36 for k in range(len(data) - w + 1)}
    b = fingerprint.LEAST_BLOCK
    while b * fingerprint.LETTERS < len(data):
        b *= 2
    while b > fingerprint.LEAST_BLOCK and sum(h % b == b - 1 for h in rolled.values()) < fingerprint.LETTERS // 4:
        b //= 2
    out = []
    for size in (b, 2 * b):
        ends = [e for e, h in rolled.items() if h % size == size - 1 and e < len(data)][: fingerprint.LETTERS - 1] + [len(data)] * bool(data)
        out.append("".join(chr(fingerprint.ALPHABET[spread(of(data[a:z])) % 64]) for a, z in zip([0, *ends], ends, strict=False)))
    return f"{b}:{out[0]}:{out[1]}"


def test_fingerprints_byte_by_byte():
    some = [*texts(6, 40), "", "é", "one line again\n" * 150]
    assert fingerprint.fingerprints(*buffers(pa.array(some))) == [written_out(t) for t in some]


def test_a_text_of_one_line_keeps_chunks():
    lines = "this line comes again and again\n" * 3000
    own, changed = fingerprint.fingerprints(*buffers(pa.array([lines, fingerprint.edited(lines, "other words " * 9000)])))
    assert len(own.split(":")[1]) >= fingerprint.LETTERS // 4 and fingerprint.likeness([own], [changed])[0] > 0.3


@pytest.mark.parametrize("parts", [1, 4])
def test_neighbours(spark, monkeypatch, parts):
    monkeypatch.setattr(fingerprint, "RANGE_BYTES", 20_000)
    docs = list(zip(range(0, 200, 2), texts(4, 100), strict=True)) + [(None, "null b"), (None, "null a"), (10, "again"), (201, None)]
    ordered = sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0, d[1] is not None, d[1] or ""))
    want = []
    for k, (d, t) in enumerate(ordered):
        following = ordered[(k + 1) % len(ordered)][1] or ""
        t = t or ""
        n = len(t) // 4
        changed = t[: len(t) - n] + following[:n]
        want.append((d, len(t), hashlib.sha256(changed.encode()).hexdigest(), *fingerprint.fingerprints(*buffers(pa.array([t, changed, following])))))
    rows = fingerprint.fingerprint_neighbours(frame(spark, docs, parts)).collect()
    key = lambda x: (x[0] is not None, x[0] or 0, *x[1:])
    assert sorted([(r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) for r in rows], key=key) == sorted([w[:5] for w in want], key=key)
    nears = {(w[0], w[1], w[2]): fingerprint.likeness([w[3], w[3]], [w[4], w[5]]).tolist() for w in want}
    assert all([r.near_edited, r.near_next] == nears[r.doc_id, r.n_chars, r.edited_sha256] for r in rows)


def test_one_document_and_none(spark):
    row = fingerprint.fingerprint_neighbours(frame(spark, [(5, "abcdefgh" * 9)])).first()
    assert row.near_next == 1 and row.next_text == row.text
    assert fingerprint.fingerprint_neighbours(frame(spark, [])).count() == 0
    assert fingerprint.fingerprint_neighbours(frame(spark, [(None, None), (None, None)])).count() == 2


def test_top_k_by_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "ROUND", 3)
    monkeypatch.setattr(topk, "BLOCK", 16)
    rng = np.random.default_rng(0)
    rows = [(k, [float(x) for x in rng.integers(-2, 3, 6) / 7], 0, 1) for k in range(100)] + [(110, None, 0, 1), (120, [1.0, None], 0, 1), (130, [float("nan")] * 6, 0, 1), (140, [float("inf")] * 6, 0, 1), (150, [], 0, 1), (160, [0.5, 2.0], 0, 1), (None, [1.0] * 6, 0, 1)]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, score int, rank int").repartition(5), every=10, k=4, scale=1024).collect()
    good = {v: np.floor(np.array(e) * 1024).astype(np.int64) for v, e, *_ in rows if v is not None and e is not None and all(x is not None and np.isfinite(x) for x in e)}
    want = []
    for q in good:
        if q % 10 == 0:
            scores = sorted((-int(np.dot(good[q][: min(len(good[q]), len(good[c]))], good[c][: min(len(good[q]), len(good[c]))])), c) for c in good if c != q)
            want += [(q, k, c, -s) for k, (s, c) in enumerate(scores[:4], 1)]
    assert sorted(map(tuple, got)) == sorted(want)
    assert topk.top_k(spark.createDataFrame([], "vec_id bigint, embedding array<float>")).count() == 0
    few = topk.top_k(spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id bigint, embedding array<double>"), 10, 4, 1)
    assert few.collect() == [(0, 1, 1, 2)]


def test_top_k_with_repeated_ids(spark):
    """The query's own rows take no places of others, and each other id is found once, by its least vector."""
    rows = [(0, [1.0, x]) for x in (3.0, 1.0, 2.0, 1.0, 5.0)] + [(k, [0.1 * k, 0.0]) for k in range(1, 7)] + [(6, [0.05, 9.0]), (6, [0.05, 9.0]), (5, [7.0, 7.0])]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").coalesce(1), every=10, k=4, scale=10).collect()
    assert sorted(map(tuple, got)) == [(0, 1, 6, 900), (0, 2, 5, 50), (0, 3, 4, 40), (0, 4, 3, 30)]


def same(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    want = con.execute(queries.ORACLE_SQL[name]).df()
    got = queries.QUERIES[name](spark, sf_dir).toPandas()
    order = sorted(want.columns)
    assert sorted(got.columns) == order
    assert sorted(map(repr, got[order].itertuples(index=False, name=None))) == sorted(map(repr, want[order].itertuples(index=False, name=None)))


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_as_sql(spark, sf_dir, name):
    same(spark, sf_dir, name)


def test_mixing_meets_its_targets(spark, sf_dir):
    docs = queries.table(spark, sf_dir, "documents")
    sums = mixing.cells_of(docs).groupBy(*mixing.AXES).sum("tokens").toDF(*mixing.AXES, "tokens")
    cells = mixing.raked(sums, {"source": 0.5, "lang": 0.7, "topic": 0.7}, 30).toPandas()
    assert cells.weight.sum() == pytest.approx(1)
    for axis in mixing.AXES:
        by = cells.groupby(axis)
        assert np.allclose(by.weight.sum(), by[f"{axis}_target"].first(), atol=2e-3)
    mixed = mixing.mix(docs).toPandas()
    expected = (mixed.tokens * mixed.probability).sum() / mixed.tokens.sum()
    assert expected == pytest.approx(mixing.KEPT_SHARE, abs=1e-6)


def test_mixing_to_given_weights(spark):
    """Against raking and the bound of 1 written out for two sources, languages and topics of a column."""
    docs = [(k, "w " * (5 + k % 7), ("x", "y", "z")[k % 3], ("en", "de")[k % 5 // 3], ("t", "u")[k % 4 // 3]) for k in range(600)]
    table = spark.createDataFrame(docs, "doc_id int, text string, source string, lang string, theme string")
    targets = {"source": {"x": 3.0, "y": 1.0, "absent": 5.0}, "lang": {"en": 0.5, "de": 0.5}}
    rows = mixing.mix(table, share=0.2, rounds=60, targets=targets, topic="theme").collect()
    cells = Counter()
    for _, text, *cell in docs:
        cells[tuple(cell)] += len(text.split())
    whole = sum(cells.values())
    share = {a: {v: sum(n for c, n in cells.items() if c[k] == v) for v in {c[k] for c in cells}} for k, a in enumerate(mixing.AXES)}
    goal = {"source": {"x": 0.75, "y": 0.25, "z": 0.0}, "lang": targets["lang"], "topic": {v: (n / whole) ** mixing.TOPIC_POWER for v, n in share["topic"].items()}}
    goal["topic"] = {v: x / sum(goal["topic"].values()) for v, x in goal["topic"].items()}
    weight = {c: n / whole for c, n in cells.items()}
    for _ in range(60):
        for k, a in enumerate(mixing.AXES):
            held = {v: sum(w for c, w in weight.items() if c[k] == v) for v in goal[a]}
            weight = {c: w * goal[a][c[k]] / held[c[k]] if held[c[k]] else 0.0 for c, w in weight.items()}
    factor = {c: weight[c] / cells[c] for c in cells}
    lo, hi = 0.0, 1e9
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if sum(min(1, mid * factor[c]) * cells[c] for c in cells) < 0.2 * whole else (lo, mid)
    assert len(rows) == 600 and rows[0].theme in ("t", "u")
    assert all(r.probability == pytest.approx(min(1, lo * factor[r.source, r.lang, r.theme]), abs=1e-6) for r in rows)
    assert not any(r.kept for r in rows if r.source == "z")


def test_mixing_keeps_columns_of_any_name(spark):
    docs = spark.createDataFrame([(k, "a b c", "s", "en", "q", "r", "c", "d", 1.5) for k in range(5)], "doc_id bigint, text string, source string, lang string, __mix_text string, __mix_tokens string, of_source string, chance string, Tokens double")
    rows = mixing.mix(docs).collect()
    assert {(r["__mix_text"], r["__mix_tokens"], r.of_source, r.chance, r.tokens) for r in rows} == {("q", "r", "c", "d", 3)}
    again = mixing.mix(docs.withColumn("doc", F.lit("e")).withColumn("whole", F.lit("f"))).collect()
    assert {(r.doc, r.whole) for r in again} == {("e", "f")}


def test_mixing_of_odd_rows(spark):
    docs = [(1, None), (None, "a b"), (2, ""), (3, "a"), (3, "a")]
    rows = mixing.mix(frame(spark, docs)).collect()
    assert len(rows) == 5 and set(rows[0].asDict()) == {"doc_id", "text", "lang", "source", "n_chars", "topic", "tokens", "probability", "kept"}
    assert all(r.kept and r.probability == 1 for r in rows if r.tokens == 0) and len({r.kept for r in rows if r.doc_id == 3}) == 1
    assert mixing.mix(frame(spark, [])).count() == 0
    assert mixing.mix(frame(spark, docs).withColumn("lang", queries.F.lit(None).cast("string"))).count() == 5


def test_pipeline_stages_stand_on_each_other(spark, sf_dir):
    docs = queries.table(spark, sf_dir, "documents").where("doc_id < 120")
    labels = {r.doc_id: r for r in queries.table(spark, sf_dir, "labels").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == list(corpus_pipeline.COLUMNS)
        after = {r.doc_id for r in docs.collect()}
        assert after <= set(before)
        if name == "toxicity":
            known = [d for d in before if d in labels]
            assert np.mean([(d in after) != bool(labels[d].toxic) for d in known]) > 0.97
        if name == "near duplicates":
            assert after == {d for d, (_, _, kept) in brute(list(before.items()), 5, 80).items() if kept}
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    assert {p.doc_id for p in pieces} == after


def test_pipeline_of_odd_rows(spark, tmp_path):
    """Nulls in any column, empty and very long texts, repeated rows and ids, columns of clashing names; and an empty table."""
    kinds = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, topic string, kept boolean, _rank int, component_id string"
    rng = random.Random(1)
    prose = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(n))
    long = prose(20_000)
    docs = [(k, prose(60), "en", "web", 360) for k in range(40)]
    docs += [(50, None, None, None, None), (51, "", "en", "web", 0), (None, prose(30), "en", None, 180), (None, None, None, "web", None), (52, long, "de", "book", len(long)), (53, long, "de", "book", len(long)), (1, docs[1][1], "en", "web", 360), (1, docs[1][1], "en", "web", 360), (2, prose(60), None, "web", 360), (54, " \t\n", "en", "web", 3)]
    for rows in (docs, []):
        folder = str(tmp_path / f"t{len(rows)}")
        spark.createDataFrame([(*d, 0.5, "x", True, 1, "y") for d in rows], kinds).write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([(k, k % 2, int(k % 5 == 0)) for k, *_ in rows if k is not None and k < 30] + [(None, 1, 1), (999, None, None)] * bool(rows), "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        now = queries.table(spark, folder, "documents")
        for name, stage in corpus_pipeline.STAGES[:-1]:
            before = now.select(*corpus_pipeline.COLUMNS)
            now = stage(spark, now, folder)
            assert now.columns == list(corpus_pipeline.COLUMNS)
            assert now.exceptAll(before).count() == 0, name
            if name == "near duplicates" and rows:
                kept = [r.doc_id for r in now.collect()]
                assert len([k for k in kept if k is not None]) == len({k for k in kept if k is not None}) and not {52, 53} <= set(kept)
        pieces = corpus_pipeline.STAGES[-1][1](spark, now, folder).collect()
        assert bool(pieces) == bool(rows)
        assert corpus_pipeline.run(spark, folder).count() == len(pieces)
