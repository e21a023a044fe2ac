"""First rows, numbers and seeded draws against plain loops."""

import random

import pytest

from methylspark.functions.chemistry import PAIRED_FLAGS
from methylspark.operators import mbias, prefix

SCHEMA = "file string, ordinal bigint, number string"


def rows_of(seed, n):
    rng = random.Random(seed)
    rows = {(rng.choice(["a", "b", "c", None]), rng.choice([rng.randrange(50), rng.randrange(10**6), rng.randrange(10**15)])) for _ in range(n)}
    return [(f, o, f"x{k}") for k, (f, o) in enumerate(rows)]


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1]))


@pytest.mark.parametrize("bins", [4, 4096])
def test_first_rows(spark, monkeypatch, bins):
    monkeypatch.setattr(prefix, "BINS", bins)
    rows = rows_of(1, 400)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for most in (1, 2, 137, len(rows) - 1, len(rows), len(rows) + 1):
        got = [tuple(r) for r in prefix.first_rows(df, most, "file", "ordinal").collect()]
        assert in_order(got) == in_order(rows)[:most], most
    alone = spark.createDataFrame([(None, k * 7, "") for k in range(300)], SCHEMA)
    assert {r.ordinal for r in prefix.first_rows(alone, 11, "ordinal").collect()} == {k * 7 for k in range(11)}
    assert prefix.first_rows(df.limit(0), 3, "file", "ordinal").count() == 0
    assert "Sort" not in prefix.first_rows(df, 100, "file", "ordinal")._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("bins", [3, 4096])
def test_numbers(spark, monkeypatch, bins):
    monkeypatch.setattr(prefix, "BINS", bins)
    rows = rows_of(2, 300)
    found = prefix.numbered(spark.createDataFrame(rows, SCHEMA).repartition(4), "file", "ordinal", name="place").collect()
    assert [tuple(r)[:3] for r in sorted(found, key=lambda r: r.place)] == in_order(rows)
    assert sorted(r.place for r in found) == list(range(len(rows)))


@pytest.mark.parametrize("apart", [7, 1 << 18])
@pytest.mark.parametrize("seed", [0, 42, 2**40 + 5])
def test_draws_are_those_of_a_loop(spark, monkeypatch, apart, seed):
    monkeypatch.setattr(prefix, "APART", apart)
    rows = rows_of(3, 500)
    rng = random.Random(seed)
    want = [r for r in in_order(rows) if rng.random() < 0.3]
    got = [tuple(r) for r in prefix.seeded_sample(spark.createDataFrame(rows, SCHEMA).repartition(6), 0.3, seed, "file", "ordinal").collect()]
    assert in_order(got) == want


def test_bias_of_a_replayed_sample(spark, sf_dir):
    """One record after another: eligible ones are drawn, those without bases don't count towards the cap."""
    from methylspark.derived import tables

    reads, blocks = tables(spark, sf_dir, "reads", "ref_blocks")
    reads = reads.selectExpr("*").withColumn("seq", mbias.F.when(mbias.F.col("ordinal") % 31 == 0, "").otherwise(mbias.F.col("seq"))).cache()
    config = mbias.BiasConfig(r1_length=30, max_cycle=30, fraction=0.4, seed=9, max_records=100, replay=True)
    rng, chosen = random.Random(9), []
    for r in sorted(reads.collect(), key=lambda r: r.ordinal):
        if r.flag not in PAIRED_FLAGS or r.mapq < 10 or rng.random() >= 0.4:
            continue
        if len(chosen) >= 100:
            break
        if r.seq:
            chosen.append(r.ordinal)
    assert len(chosen) == 100
    plain = mbias.BiasConfig(r1_length=30, max_cycle=30)
    want = mbias.cycles(reads.where(mbias.F.col("ordinal").isin(chosen)), blocks, plain).collect()
    assert sorted(mbias.cycles(reads, blocks, config).collect()) == sorted(want)
