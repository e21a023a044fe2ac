"""Language model, classifiers and language identification."""

import math
import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from methylspark.llm import langid, maxent, quality, queries, toxicity
from methylspark.llm.wordhash import buffers
from tests.llm.test_near_dup import words

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, row int"


def frame(spark, docs):
    return spark.createDataFrame([(d, t, lang, "s", len(t or ""), "x", 0) for d, t, lang in docs], SCHEMA).repartition(3)


def held_out(doc, classes, rest):
    return zlib.crc32(str(doc).encode()) % classes == rest


def test_base_score_by_brute_force(spark):
    rng = random.Random(0)
    docs = [(k, " ".join(rng.choice("A a bb ccc d E f the of x1".split()) for _ in range(rng.randrange(0, 40))), "en") for k in range(60)] + [(70, None, None), (71, "zzz never seen", None), (72, "", None), (None, "a b", None), (3, "a", None)]
    rows = maxent.score(frame(spark, docs), langid.crc_class("doc_id", 7) == 2).collect()
    train = Counter()
    for d, t, _ in docs:
        if d is None or not held_out(d, 7, 2):
            train.update([*words(t), None])
    n, v = sum(train.values()), len(train)
    want = sorted((d is not None, d or 0, len(words(t)) + 1, sum(train[w] > 0 for w in [*words(t), None]), n, round(sum(math.log10((train[w] + 1) / (n + v + 1)) for w in [*words(t), None]), 6)) for d, t, _ in docs)
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows) == want
    assert all(r.score < 0 for r in rows)
    assert maxent.score(frame(spark, []), F.lit(False)).count() == 0
    alone = maxent.score(frame(spark, [(1, "a b", "en")]), F.lit(True)).first()
    assert (alone.n_known, alone.train_tokens, alone.base_score) == (0, 0, 0)


def test_words_outside_the_head_are_counted_too(spark, monkeypatch):
    monkeypatch.setattr(maxent, "HEAD", 2)
    docs = [(k, "a a a b b c d", "en") for k in range(4)]
    row = maxent.score(frame(spark, docs), F.lit(False)).first()
    assert row.n_known == row.n_tokens == 8
    n, v = 32, 5
    assert row.base_score == pytest.approx(3 * math.log10(13 / (n + v + 1)) + 2 * math.log10(9 / (n + v + 1)) + 3 * math.log10(5 / (n + v + 1)))


def test_probabilities_sum_to_one(spark):
    """Over the classes, and the counts within them; `test_trees_sum_to_one` has the trees."""
    docs = [(k, f"a b c{k % 3} a b d e f a", "en") for k in range(30)]
    known = sorted({w for _, t, _ in docs for w in words(t)})
    counts = maxent.word_counts(frame(spark, docs).select("text"))
    v = maxent.vocabulary(counts, maxent.HEAD, maxent.CLASSES)
    mass = 10.0**v.log_sums
    assert mass.sum() == pytest.approx(v.total + v.distinct + 1)
    inside = [np.sum(10.0 ** v.log_counts[v.classes == k]) + (k == maxent.CLASSES - 1) for k in range(maxent.CLASSES)]
    assert inside == pytest.approx(mass.tolist())
    p = maxent.softmax(np.random.default_rng(0).normal(size=(8, 5)).astype(np.float32), np.array([[0, 1, 2, 3]]), np.zeros(5, np.float32))
    assert p.sum() == pytest.approx(1) and len(known) == v.distinct - 1


def test_score_by_brute_force(spark, monkeypatch):
    """Token by token from random weights: the class, each branch of its tree, and what words of a leaf share."""
    rng = random.Random(3)
    pool = [f"w{k}" for k in range(120)]
    docs = [(k, " ".join(rng.choice(pool[: 5 + k]) for _ in range(rng.randrange(0, 30))), "en") for k in range(115)] + [(200, "w1 never seen w2", "en"), (201, None, "en"), (202, "w110 w111 w112", "en")]
    table = frame(spark, docs)
    apart = F.col("doc_id") % 5 == 0
    monkeypatch.setattr(maxent, "HEAD", 40)
    monkeypatch.setattr(maxent, "BATCH", 16)
    counts = maxent.word_counts(table.where(~apart).select("text"))
    v = maxent.vocabulary(counts, 40, maxent.CLASSES)
    weights = np.random.default_rng(1).normal(size=(v.rows, maxent.CLASSES)).astype(np.float32)
    bias = np.random.default_rng(2).normal(size=maxent.CLASSES).astype(np.float32)
    monkeypatch.setattr(maxent, "train", lambda *a: (weights, bias))
    got = {r.doc_id: r for r in maxent.score(table, apart).collect()}
    train = Counter(w for d, t, _ in docs if d % 5 for w in [*words(t), None])
    code = lambda w: int(maxent.END if w is None else maxent.tokens(*buffers(pa.array([w])))[0][0])
    place = {w: int(v.find(np.array([code(w)], np.uint64))[0]) for _, t, _ in docs for w in [*words(t), None]}
    assert 30 < len(v.words) < 50 and len(train) > 80 and len(place) > len(train)

    def p_of(wide, node, own, branch):
        row = wide if node is None else maxent.mix((wide + np.uint64((node + 1) * 0x9E3779B97F4A7C15 % 2**64)).astype(np.uint64))
        logits = weights[(row & np.uint64(v.rows - 1)).astype(int)].astype(float).sum(axis=0) + own
        return np.exp(logits[branch] - logits.max()) / np.exp(logits - logits.max()).sum()

    last = maxent.CLASSES - 1
    for d, t, _ in docs:
        told, total = [], 0.0
        for w in [*words(t), None]:
            at = place[w]
            kind = int(v.classes[at]) if at >= 0 else last
            name = int(v.names[at]) if 0 <= at and v.names[at] < v.named else v.named + kind
            past = [told[-k] if len(told) >= k else (-2, maxent.CLASSES) for k in (1, 2, 3)]
            (n1, c1), (n2, c2), (n3, c3) = past
            parts = [(1, n1 + 2), (2, n2 + 2), (3, n3 + 2), (4, n1 + 2, n2 + 2), (5, c1, c2, c3)]
            wide = np.array([maxent._hashed(*(np.array([x]) for x in q), rows=1 << 62)[0] for q in parts]).astype(np.uint64)
            p = p_of(wide, None, bias, kind)
            if at >= 0:
                for node, branch in zip(v.nodes[:, at], v.branches[:, at], strict=True):
                    p *= p_of(wide, int(node), v.bias[node], branch) if node >= 0 else 1
            elif w in train:
                node = v.outer
                for k in range(v.outer_levels):
                    low = code(w) >> (5 * k)
                    p *= p_of(wide, node + (code(w) & ((1 << 5 * k) - 1)), v.bias[node + (code(w) & ((1 << 5 * k) - 1))], low & 31)
                    node += 1 << 5 * k
                p *= (1 - 10.0 ** -v.log_sums[-1]) * (train[w] + 1) / 10.0 ** v.leaf_sums[code(w) & (len(v.leaf_sums) - 1)]
            else:
                p *= 10.0 ** -v.log_sums[-1]
            total += math.log10(p)
            told.append((name, kind))
        assert got[d].score == pytest.approx(total, abs=1e-3), d


def test_model_beats_its_base_where_words_follow_words(spark):
    rng = random.Random(2)
    chain = {w: [f"w{(k * 7 + j) % 40}" for j in range(2)] for k, w in enumerate(f"w{k}" for k in range(40))}

    def text():
        out = ["w0"]
        while len(out) < 60:
            out.append(rng.choice(chain[out[-1]]))
        return " ".join(out)

    docs = [(k, text(), "en") for k in range(900)]
    rows = maxent.score(frame(spark, docs), langid.crc_class("doc_id", 7) == 2).join(frame(spark, docs).select("doc_id"), "doc_id").collect()
    apart = [r for r in rows if held_out(r.doc_id, 7, 2)]
    assert sum(r.score for r in apart) > sum(r.base_score for r in apart) + 0.2 * sum(r.n_tokens for r in apart)


def test_step_by_brute_force():
    """One step of AdaGrad, with rows that are active once, a few times and in most decisions; also where logits lie far apart."""
    rng = np.random.default_rng(7)
    for rows, n, scale in ((8, 300, 1), (200, 300, 1), (1 << 14, 257, 1), (1 << 14, 1, 1), (300, 300, 60)):
        weights = (rng.normal(size=(rows, 6)) * scale).astype(np.float32)
        active, target = rng.integers(0, rows, (n, 3)), rng.integers(0, 6, n)
        active[: n // 2, 1] = rng.integers(0, 3, n // 2)
        bias = np.where(rng.random((n, 6)) < 0.1, -1e4, rng.normal(size=(n, 6)) * scale).astype(np.float32)
        local = maxent.Local(weights)
        local.step(active, target, bias)
        logits = weights.astype(float)[active].sum(axis=1) + bias
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        logs = maxent.log10_softmax(weights, active, bias, target, maxent.Scratch())
        taken = (logits - logits.max(axis=1, keepdims=True))[np.arange(n), target] - np.log(np.exp(logits - logits.max(axis=1, keepdims=True)).sum(axis=1))
        assert np.allclose(logs, taken / np.log(10), rtol=1e-4, atol=1e-3)
        p[np.arange(n), target] -= 1
        times, g = np.zeros(rows), np.zeros((rows, 6))
        np.add.at(times, active, 1)
        np.add.at(g, active, p[:, None, :])
        seen = np.flatnonzero(times)
        square = 1e-2 + (g[seen] ** 2).sum(axis=1) / times[seen]
        want = weights.astype(float)
        want[seen] -= maxent.RATE * g[seen] / np.sqrt(square * times[seen])[:, None]
        assert np.allclose(local.weights, want, rtol=1e-4, atol=2e-3)
        assert np.allclose(local.square[seen], square, rtol=1e-3) and np.array_equal(local.active, times)


def test_step_makes_no_new_tables():
    """A step of a batch writes its tables of rows where the last one did."""
    rng = np.random.default_rng(8)
    n, kinds, classes = 4096, 5, 32
    local = maxent.Local(np.zeros((1 << 16, classes), np.float32))
    active, target, bias = rng.integers(0, 1 << 16, (n, kinds)), rng.integers(0, classes, n), np.zeros((1, classes), np.float32)
    local.step(active, target, bias)
    tracemalloc.start()
    local.step(active, target, bias)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < n * kinds * classes * 4


def test_trees_learn_from_the_words_before_where_rows_are_at_their_bound(spark, monkeypatch):
    """Nodes of trees have fewer features there than the classes, what follows a word is learned, and with words outside the head all probabilities sum to 1."""
    docs = [(k, " ".join(f"a{(k + j) % 80} b{(k + j) % 80}" for j in range(60)), "en") for k in range(300)]
    counts = maxent.word_counts(frame(spark, docs).select("text"))
    wide = maxent.vocabulary(counts, maxent.HEAD, maxent.CLASSES)
    monkeypatch.setattr(maxent, "MOST_ROWS", 256)
    monkeypatch.setattr(maxent, "ROWS", 256)
    v = maxent.vocabulary(counts, maxent.HEAD, maxent.CLASSES)
    words, at = maxent.tokens(*buffers(pa.array(["a1 b1 a2 b2"])))
    bias = np.zeros(maxent.CLASSES, np.float32)
    for vocabulary, top, deep in ((wide, 5, 5), (v, 4, 2)):
        levels = maxent.decisions(words, at, vocabulary, vocabulary.rows, bias)[1]
        assert len(levels) > 1 and [active.shape[1] for _, active, _, _ in levels] == [top] + [deep] * (len(levels) - 1)
    assert maxent.Vocabulary.find(v, np.array([0, 2**64 - 1, v.words[3]], np.uint64)).tolist() == [-1, -1, 3]
    rows = maxent.score(frame(spark, docs), F.col("doc_id") % 7 == 2).collect()
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows) + 0.2 * sum(r.n_tokens for r in rows)
    monkeypatch.setattr(maxent, "HEAD", 50)
    v = maxent.vocabulary(counts, 50, maxent.CLASSES)
    assert v.outer_levels == 0 and len(v.leaf_sums) == 1 and len(v.words) < v.distinct
    weights = np.random.default_rng(0).normal(size=(v.rows, maxent.CLASSES)).astype(np.float32)
    monkeypatch.setattr(maxent, "train", lambda *a: (weights, bias))
    # each known word, and one unknown, as texts: their score less that of the end, which follows them
    asked = [(1000 + k, w, "en") for k, w in enumerate(sorted({w for _, t, _ in docs for w in t.split()}) + ["unknown"])]
    score = {r.doc_id: r.score for r in maxent.score(frame(spark, docs + asked), F.col("doc_id") >= 1000).collect()}
    ends = maxent.score(frame(spark, [*docs, (999, None, "en")]), F.col("doc_id") >= 999).where("doc_id = 999").first().score
    total = 10.0**ends
    for d, w, _ in asked:
        words, at = maxent.tokens(*buffers(pa.array([w])))
        end = sum(maxent.log10_softmax(weights, active[of == 1], own if len(own) == 1 else own[of == 1], branch[of == 1], maxent.Scratch()).sum() for of, active, branch, own in maxent.decisions(words, at, v, v.rows, bias)[1] if (of == 1).any())
        total += 10.0 ** (score[d] - end)
    assert total == pytest.approx(1, abs=1e-3)


def test_all_features_where_rows_are_at_their_bound(spark, monkeypatch):
    """The classes and every node have all five kinds, words outside the head have their tree, and with it all probabilities sum to 1."""
    docs = [(k, " ".join(f"a{(k + j) % 80} b{(k + j) % 80}" for j in range(60)), "en") for k in range(300)]
    counts = maxent.word_counts(frame(spark, docs).select("text"))
    monkeypatch.setattr(maxent, "MOST_ROWS", 256)
    monkeypatch.setattr(maxent, "ROWS", 256)
    v = maxent.vocabulary(counts, 50, maxent.CLASSES)
    assert 2 * v.distinct > v.rows == 256 and v.outer_levels == 2 and len(v.words) < v.distinct
    rows = counts.toArrow()
    words, c = rows["word"].to_numpy().view(np.uint64), rows["c"].to_numpy()
    weights, bias = np.random.default_rng(0).normal(size=(v.rows, maxent.CLASSES)).astype(np.float32), np.zeros(maxent.CLASSES, np.float32)
    # each word after the same first word, in a text of its own
    texts = np.column_stack((np.full(len(words), v.words[0]), words)).ravel()
    place, levels = maxent.decisions(texts, np.arange(0, len(texts) + 1, 2), v, v.rows, bias)
    assert len(levels) > 3 and {active.shape[1] for _, active, _, _ in levels} == {5}
    p = np.ones(len(texts))
    for of, active, branch, own in levels:
        p[of] *= maxent.softmax(weights, active, own)[np.arange(len(of)), branch]
    away = place < 0
    p[away] *= (1 - 10.0 ** -v.log_sums[-1]) * (np.repeat(c, 2)[away] + 1) / 10.0 ** v.leaf_sums[maxent._leaf(texts[away], v)]
    unknown = maxent.softmax(weights, levels[0][1][1:2], bias[None, :])[0, -1] * 10.0 ** -v.log_sums[-1]
    assert p[1::2].sum() + unknown == pytest.approx(1, abs=1e-4)
    monkeypatch.setattr(maxent, "HEAD", 50)
    found = maxent.score(frame(spark, docs), F.col("doc_id") % 7 == 2).where("doc_id % 7 = 2").collect()
    assert sum(r.score for r in found) > sum(r.base_score for r in found) + 0.2 * sum(r.n_tokens for r in found)


def prose(rng, vowel, n=60):
    return " ".join("".join(rng.choice("bdfgklmnprst") + vowel for _ in range(rng.randrange(1, 4))) for _ in range(n))


def test_languages(spark):
    rng = random.Random(1)
    docs = [(k, prose(rng, "aeo"[k % 3]), ("xa", "xe", "xo")[k % 3]) for k in range(120)]
    odd = [(200, None, None), (201, "", None), (202, "12 % !", None), (203, "é", "xa"), (None, prose(rng, "a"), None)]
    rows = langid.identify(frame(spark, docs + odd), frame(spark, docs[:90]).select("text", "lang")).collect()
    got = {r.doc_id: r for r in rows}
    assert np.mean([got[d].language == lang for d, _, lang in docs[90:]]) > 0.9
    assert all(got[d].language is None and not got[d].accepted for d in (200, 201, 202)) and got[203].language in ("xa", "xe", "xo")
    assert got[None].language == "xa" and all(0 <= r.score <= 1 for r in rows)
    assert langid.identify(frame(spark, odd), frame(spark, []).select("text", "lang")).where("language is null").count() == len(odd)
    assert langid.identify(frame(spark, []), frame(spark, docs).select("text", "lang")).count() == 0


BAD = ["idiot", "moron", "worthless"]


def labelled(rng, n):
    docs = []
    for k in range(n):
        toxic = k % 4 == 0
        w = prose(rng, "aei"[k % 3], 50).split()
        if toxic:
            w[rng.randrange(50)] = rng.choice(BAD)
        docs.append((k, " ".join(w), int(toxic)))
    return docs


def test_toxicity_on_held_out_documents(spark):
    docs = labelled(random.Random(4), 400)
    machine = toxicity.fit(spark.createDataFrame([(x, t) for _, t, x in docs[:300]], "toxic int, text string"))
    odd = [(900, None, ""), (901, "", ""), (902, "!!! ...", ""), (None, "an idiot", ""), (903, "x" * 10000 + " idiot", "")]
    rows = toxicity.detect(frame(spark, [(d, t, "en") for d, t, _ in docs[300:]] + odd), machine, ("lang", "row")).collect()
    got = {r.doc_id: r.score for r in rows}
    assert all((got[d] >= 0.7) == bool(x) for d, _, x in docs[300:])
    assert max(got[900], got[901], got[902]) < 0.3 and min(got[None], got[903]) >= 0.7
    assert {r.lang for r in rows if r.doc_id == 300} == {"en"}
    inserted = [w[:k] + x + w[k:] for w in ("idiot", "worthless") for k in range(1, len(w)) for x in "xqz"]
    for text in ("what an i.d.i.o.t you are", "what an i d i o t", "MO*RON", "w-o-r-t-h-l-e-s-s", *inserted):
        assert machine.score(*buffers(pa.array([text])))[0] >= 0.7, text


def test_toxicity_of_the_tables_labels(spark):
    """Held-out documents of sf0.01. A good part of its toxic documents hold nothing that comes again in others; those that hold an insult of several others are found."""
    docs, labels = (queries.table(spark, "/root/testdata/sf0.01", t) for t in ("documents", "labels"))
    found = queries.op5_toxicity(spark, "/root/testdata/sf0.01").join(labels, "doc_id").join(docs.select("doc_id", "text"), "doc_id").collect()
    apart, taught = ([r for r in found if r.held_out is x] for x in (True, False))

    def words(r):
        return set(re.findall("[a-z]+", (r.text or "").lower()))

    times = {t: Counter(w for r in taught if r.toxic == t for w in words(r)) for t in (0, 1)}
    insults = {w for w, n in times[1].items() if n >= 6 and not times[0][w]}
    toxic = [r for r in apart if r.toxic == 1]
    clear = [r for r in toxic if insults & words(r)]
    clean = [r for r in apart if r.toxic == 0]
    assert len(insults) >= 8 and len(clear) >= 10 and np.mean([r.predicted for r in clear]) >= 0.9
    assert np.mean([r.predicted for r in clean]) <= 0.01
    assert np.mean([(a.score > b.score) + (a.score == b.score) / 2 for a in toxic for b in clean]) > 0.88


def test_toxicity_learns_one_text_of_an_id(spark):
    docs = labelled(random.Random(4), 300)
    rows = frame(spark, [(d, t, "en") for d, t, _ in docs] + [(d, "the " * 30, "en") for d, _, x in docs if x] * 4)
    machine = toxicity.learn(rows, spark.createDataFrame([(d, x) for d, _, x in docs], "doc_id bigint, toxic int"))
    low, high = machine.score(*buffers(pa.array(["the the", "an idiot"])))
    assert low < 0.3 and high >= 0.7


def test_toxicity_without_labels(spark):
    docs = frame(spark, [(1, "a", "en")])
    assert toxicity.learn(docs, spark.createDataFrame([], "doc_id bigint, toxic int")) is None
    assert toxicity.detect(docs, None).collect() == [(1, 0.0)]
    assert toxicity.detect(frame(spark, []), None).count() == 0


def test_kernel_is_the_sum_over_subsequences():
    """Against all triples, letter by letter."""
    texts = ["idiot", "idxiot", "banana", "a"]
    rows = np.concatenate([toxicity.windows(*buffers(pa.array([t])))[0] for t in texts])

    def triples(row):
        out = Counter()
        s = [int(x) for x in row if x]
        for i in range(len(s)):
            for j in range(i + 1, len(s)):
                for k in range(j + 1, len(s)):
                    if k - i < toxicity.SPAN:
                        out[s[i], s[j], s[k]] += toxicity.DECAY ** (k - i + 1)
        return out

    found = [triples(r) for r in rows]
    energy = toxicity.energy(rows)
    assert np.allclose(energy, [max(sum(x**2 for x in f.values()) ** 0.5, toxicity.DECAY**3) for f in found])
    want = [[sum(a[t] * b[t] for t in a) / ea / eb for b, eb in zip(found, energy, strict=True)] for a, ea in zip(found, energy, strict=True)]
    assert np.allclose(toxicity.gram(rows, rows), want, rtol=1e-4)


def test_quality_on_held_out_documents(spark):
    rng = random.Random(6)
    docs = []
    for k in range(400):
        good = k % 5 != 0
        text = prose(rng, "aei"[k % 3], 80)
        if not good:
            text = rng.choice([" | ".join(text.split()), text.upper().replace(" ", "!! "), "same " * 90, text.replace(" ", "### ")])
        docs.append((k, text, "en", int(good)))
    labels = spark.createDataFrame([(d, q) for d, _, _, q in docs if d < 250], "doc_id bigint, quality int")
    table = frame(spark, [(d, t, lang) for d, t, lang, _ in docs])
    model = quality.learn(table, labels)
    rows = quality.assess(table, model, ("text",)).collect()
    right = [(r.score >= queries.QUALITY_LIMIT) == bool(docs[r.doc_id][3]) for r in rows if r.doc_id >= 250]
    assert np.mean(right) > 0.95 and all(r.text == docs[r.doc_id][1] for r in rows)
    odd = frame(spark, [(1, None, None), (None, "", None), (2, "\n\n", "en"), (3, "x" * 50000, "en"), (3, "x" * 50000, "en")])
    assert all(0 <= r.score <= 1 for r in quality.assess(odd, model).collect())
    assert quality.assess(frame(spark, []), model).count() == 0
    assert {r.score for r in quality.assess(odd, quality.learn(odd, labels.where("quality = 2"))).collect()} == {1.0}


def test_queries_on_the_tables(spark, sf_dir):
    n = queries.table(spark, sf_dir, "documents").count()
    for name, columns in (("op1_lm_scores", "doc_id held_out n_tokens n_known train_tokens base_score score"), ("op5_toxicity", "doc_id held_out score predicted"), ("op8_languages", "doc_id held_out lang_pred score"), ("op4_quality", "doc_id held_out score kept")):
        rows = queries.QUERIES[name](spark, sf_dir).collect()
        assert len(rows) == n and all(hasattr(rows[0], c) for c in columns.split())
        classes, rest = (7, 2) if name.startswith("op1") else (3, 1)
        assert all(r.held_out == held_out(r.doc_id, classes, rest) for r in rows)


def test_the_word_three_back_is_a_feature():
    """Two histories of equal classes that differ in that word alone."""
    classes, first = np.zeros(4, np.int64), np.zeros(4, np.int64)
    one, other = (maxent.features(classes, np.array([w, 1, 2, 3]), first, 1 << 16)[3] for w in (5, 6))
    assert len(one) == 5 and (one != other).sum() == 1


def test_words_of_a_class_follow_their_history(spark, monkeypatch):
    """Of words of one class the word before tells which comes; within the head, and where the words that follow are outside it."""
    rng = random.Random(5)
    pairs = [(f"a{k % 10}", f"b{k}") for k in range(200)]
    docs = [(k, " ".join(" ".join(rng.choice(pairs)) for _ in range(100)), "en") for k in range(400)]
    for head in (1 << 17, 12):
        monkeypatch.setattr(maxent, "HEAD", head)
        v = maxent.vocabulary(maxent.word_counts(frame(spark, docs).select("text")), head, maxent.CLASSES)
        place = v.find(maxent.tokens(*buffers(pa.array([" ".join(b for _, b in pairs)])))[0][:-1])
        of = np.where(place >= 0, v.classes[place] if len(v.words) else 0, maxent.CLASSES - 1)
        alike = {k: np.flatnonzero(of == c).tolist() for k, c in enumerate(of)}
        swapped = [next((j for j in alike[k] if j % 10 == (k + 1) % 10), k) for k in range(len(pairs))]
        asked = [(1000, " ".join(f"{a} {b}" for a, b in pairs), "en"), (1001, " ".join(f"{pairs[k][0]} {pairs[j][1]}" for k, j in enumerate(swapped)), "en")]
        score = {r.doc_id: r.score / r.n_tokens for r in maxent.score(frame(spark, docs + asked), F.col("doc_id") >= 1000).collect()}
        assert score[1000] > 0.2 + score[1001]


def test_trees_sum_to_one(spark):
    """All words of the head and outside it, and the unknown one, by the model's own trees with any weights."""
    docs = [(k, " ".join(f"w{j}" for j in range(k % 50 + 1)) + f" rare{k} odd{k}", "en") for k in range(200)]
    counts = maxent.word_counts(frame(spark, docs).select("text"))
    v = maxent.vocabulary(counts, 60, maxent.CLASSES)
    rows = counts.toArrow()
    words, c = rows["word"].to_numpy().view(np.uint64), rows["c"].to_numpy()
    assert len(words) - len(v.words) > 32 and v.outer_levels == 2
    weights = np.random.default_rng(0).normal(size=(v.rows, maxent.CLASSES)).astype(np.float32)
    bias = np.log(np.maximum(10.0**v.log_sums, 1e-9)).astype(np.float32)
    # each word after the same first word, in a text of its own
    texts = np.column_stack((np.full(len(words), v.words[0]), words)).ravel()
    place, levels = maxent.decisions(texts, np.arange(0, len(texts) + 1, 2), v, v.rows, bias)
    p = np.ones(len(texts))
    for of, active, branch, own in levels:
        p[of] *= maxent.softmax(weights, active, own)[np.arange(len(of)), branch]
    away = place < 0
    share = (1 - 10.0 ** -v.log_sums[-1]) * (np.repeat(c, 2) + 1) / 10.0 ** v.leaf_sums[maxent._leaf(texts, v)]
    p[away] *= share[away]
    unknown = maxent.softmax(weights, levels[0][1][1:2], bias[None, :])[0, -1] * 10.0 ** -v.log_sums[-1]
    assert p[1::2].sum() + unknown == pytest.approx(1, abs=1e-4)


def test_copies_do_not_thin_a_language(spark):
    """3 texts in 1,000 copies each, none of which a step for 3,000 texts would draw."""
    some = spark.createDataFrame([(f"uno{k} dos{k} tres{k}",) for k in range(40)], "text string").where(F.pmod(F.xxhash64("text"), F.lit(7)) != 0).limit(3)
    rows = some.crossJoin(spark.range(1000)).select("text", F.lit("es").alias("lang")).union(spark.createDataFrame([("one two three four", "en")], "text string, lang string"))
    found = langid.dictionaries(rows)
    assert list(found) == ["es", "en"]
    assert all(w in found["es"].split() for r in some.collect() for w in [langid.different_words(r.text)[0]])
