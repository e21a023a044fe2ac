"""The matcher against all parts of every text."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from methylspark.functions import approximate, dna


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def all_places(text, pattern, most, grouped=False):
    found = [(edits(text[a:z], pattern), a, z) for a in range(len(text)) for z in range(max(a + 1, a + len(pattern) - most), min(len(text), a + len(pattern) + most) + 1)]
    best = min((d for d, *_ in found), default=most + 1)
    if best > most or best >= len(pattern):
        return -1
    spans = sorted((a, z) for d, a, z in found if d == best)
    if not grouped:
        first = max(spans, key=lambda s: (-s[0], s[1]))
        return -1 if any(a >= first[1] for a, _ in spans) else first[0]
    reach = 0
    for k, (a, z) in enumerate(spans):
        if k and a >= reach:
            return -1
        reach = max(reach, z)
    return min(spans, key=lambda s: (s[0] - s[1], s[0]))[0]


def spoiled(rng, pattern, n):
    out = list(pattern)
    for _ in range(n):
        k = rng.randrange(len(out))
        out[k : k + 1] = rng.choice([[], [rng.choice("ACGT")], [out[k], rng.choice("ACGT")]])
    return "".join(out)


def some(rng, pattern, n):
    dna_of = lambda k: "".join(rng.choice("ACGTN") for _ in range(k))
    out = ["", pattern, pattern[1:], pattern * 2, "A" * 30]
    for _ in range(n):
        parts = [dna_of(rng.randrange(12))]
        for _ in range(rng.choice([0, 1, 1, 1, 2])):
            parts += [spoiled(rng, pattern, rng.randrange(4)), dna_of(rng.choice([0, 0, 1, 8]))]
        out.append("".join(parts))
    return out


@pytest.mark.parametrize("pattern", ["ACGTTGCA", "AAAAAA", "ACACACACA", "GTGGCCGATGTTTCG"])
@pytest.mark.parametrize("most", [0, 1, 2, 3])
def test_places_are_those_of_all_parts(pattern, most):
    texts = some(random.Random(most), pattern, 250)
    for grouped in (False, True):
        want = [all_places(t, pattern, most, grouped) for t in texts]
        assert approximate.places(texts, pattern, most, grouped).tolist() == want
        assert sum(w >= 0 for w in want) > 20


def test_end_distances():
    rng = random.Random(5)
    for m in (1, 7, 63, 64):
        pattern = "".join(rng.choice("ACGT") for _ in range(m))
        texts = ["".join(rng.choice("ACGT") for _ in range(40)) for _ in range(6)]
        got = approximate.end_distances(np.array([list(t.encode()) for t in texts], np.uint8), pattern.encode())
        for t, row in zip(texts, got.tolist(), strict=True):
            assert row == [min(edits(t[a : j + 1], pattern) for a in range(j + 2)) for j in range(40)]
    with pytest.raises(ValueError, match="64"):
        approximate.places(["A"], "A" * 65, 2)


def test_column_of_places(spark):
    rng = random.Random(6)
    pattern = "GTGGCCGATGTTTCG"
    rows = [(k, t) for k, t in enumerate(some(rng, pattern, 60))] + [(900, None), (901, "Ω" + pattern[:-1]), (902, f"{pattern}AC{pattern}")]
    df = spark.createDataFrame(rows, "id int, text string")
    got = {r.id: r.at for r in df.select("id", dna.near_position(F.col("text"), pattern, 3).alias("at")).collect()}
    for k, t in rows:
        exact = [i for i in range(len(t or "")) if t.startswith(pattern, i)]
        want = None if t is None or len(exact) > 1 else exact[0] if exact else all_places(t, pattern, 3)
        assert got[k] == (None if want == -1 else want), t
