"""Near duplicates against all pairs of full sets."""

import random
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from methylspark.llm import near_dup
from methylspark.llm.components import connected
from methylspark.llm.wordhash import buffers, word_hashes

SCHEMA = "doc_id bigint, text string, id string, component string, a int"


def words(text):
    folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        folded = folded.replace(c, " ")
    return [w for w in folded.split(" ") if w]


def shingles(text, size):
    w = words(text)
    return {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()


def brute(docs, size, percent):
    sets = {d: shingles(t, size) for d, t in docs}
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(sets, 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {d: (len(sets[d]), root(d), root(d) == d) for d in sets}


def test_words_and_their_hashes():
    texts = ["Hello World\tfoo", "", None, " a  b A B ", "É é\x0b\r\nÉ", "x" * 300]
    hashes, at = word_hashes(*buffers(pa.array(texts)))
    assert np.diff(at).tolist() == [len(words(t)) for t in texts]
    flat = [w for t in texts for w in words(t)]
    assert len(set(hashes.tolist())) == len(set(flat))
    assert all((hashes[i] == hashes[j]) == (flat[i] == flat[j]) for i in range(len(flat)) for j in range(i))


def edited(rng, base, n):
    out = list(base)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"w{rng.randrange(10**6)}"
    return " ".join(out)


def made(seed):
    rng = random.Random(seed)
    docs = []
    base = [f"v{rng.randrange(500)}" for _ in range(120)]
    docs += [edited(rng, base, rng.randrange(0, 9)) for _ in range(150)]  # one group, in which most pairs are no links
    for _ in range(40):
        own = [f"u{rng.randrange(2000)}" for _ in range(rng.randrange(5, 80))]
        docs += [edited(rng, own, rng.randrange(0, 3)) for _ in range(rng.randrange(1, 5))]
    docs += ["", " ", "one", "one", "one two", "One  TWO", "a b c", "a b c d", "a b c d", "A\nb c\td"]
    rng.shuffle(docs)
    return list(enumerate(docs, 100))


@pytest.mark.parametrize(("seed", "size", "block"), [(1, 4, 256), (2, 5, 16)])
def test_as_all_pairs(spark, monkeypatch, seed, size, block):
    monkeypatch.setattr(near_dup, "BLOCK", block)
    docs = made(seed)
    frame = spark.createDataFrame([(d, t, "x", "y", 1) for d, t in docs], SCHEMA).repartition(3)
    rows = near_dup.near_duplicates(frame, size, 80).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows} == brute(docs, size, 80)


def test_odd_rows(spark):
    docs = [(1, None, "", "", 1), (2, None, "", "", 1), (None, "a b c d e f", "", "", 1), (None, "a b c d e f", "", "", 1), (5, "a b c d e f", "", "", 1), (5, "a b c d e f", "", "", 1), (7, "A b c d e f", None, None, None)]
    rows = near_dup.near_duplicates(spark.createDataFrame(docs, SCHEMA), 4, 80).collect()
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(map(tuple, rows), key=key) == sorted([(1, 0, 1, True), (2, 0, 2, True), (None, 3, None, False), (None, 3, None, False), (5, 3, 5, True), (5, 3, 5, True), (7, 3, 5, False)], key=key)
    assert near_dup.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_signatures_meet_within_their_distance():
    """Whatever DISTANCE values differ, the pair has a key in common."""
    rng = np.random.default_rng(3)
    for _ in range(200):
        x = rng.integers(0, 1 << 16, near_dup.VALUES).astype(np.uint16)
        y = x.copy()
        y[rng.choice(near_dup.VALUES, near_dup.DISTANCE, replace=False)] ^= 1
        batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array([x.tobytes(), y.tobytes()])], names=["id", "signature"])
        keys = next(near_dup._keys(iter([batch])))
        mine = [set(keys.column(0).to_numpy()[keys.column(1).to_numpy() == k].tolist()) for k in (1, 2)]
        assert mine[0] & mine[1] and len(mine[0]) == near_dup.VALUES


def test_components(spark):
    rng = random.Random(5)
    edges = [(a, a + 1) for a in range(0, 60)] + [(200, b) for b in range(201, 260)] + [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        return x if parent[x] == x else root(parent[x])

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    got = {r.id: r.component for r in connected(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {x: root(x) for x in parent if root(x) != x}
