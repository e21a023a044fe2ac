"""Mixing sources to target weights by iterative proportional fitting, with DataFrame functions alone.

Documents are summed to cells of (source, lang, topic). The cells' token weights are raked to the targets of one marginal after the
other, ROUNDS times at most. A cell's weight over its tokens is its factor; a document's probability is min(1, c * factor), where c makes the expected
tokens a given share of all, with cells that reach 1 taken whole. A document is kept where a uniform number made from a hash of its doc_id is below its
probability, so equal runs keep equal documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from methylspark.llm.store import discard, written

ROUNDS, ROUNDS_A_PLAN, NEAR = 12, 3, 1e-12
#: Targets are shares of tokens to this power, made to sum to 1: 1 keeps the shares as they are, 0 makes all equal.
SOURCE_POWER, LANG_POWER, TOPIC_POWER, KEPT_SHARE = 0.5, 0.7, 0.7, 0.5
AXES = ("source", "lang", "topic")
SIGNS, CAPITALS = "*#%&$@<>{}", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WORD = r"[^\x20\x09-\x0D]+"
#: Hex digits of the md5 that make the uniform number.
DIGITS = 12


def topic_of(text: Column) -> Column:
    """What a text mainly is, by its form, since documents carry no topic: table, markup, shouting, brief, long or prose."""
    n = F.greatest(F.length(text), F.lit(1))

    def share(letters: str) -> Column:
        return F.regexp_count(text, F.lit(f"[{letters}]")) / n

    return (
        F.when(share("|") > 0.02, "table")
        .when(share(SIGNS) > 0.08, "markup")
        .when(share("A-Z") > 0.3, "shouting")
        .when(F.length(text) < 400, "brief")
        .when(F.length(text) > 12000, "long")
        .otherwise("prose")
    )


def cells_of(docs: DataFrame, topic: str | None = None) -> DataFrame:
    """(doc, source, lang, topic, tokens): documents as structs, with their cell and words. topic: the column that tells it; the text's form by default."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    # a struct of its own keeps the table's columns apart, whatever their names
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"), text.alias("text"), *(F.coalesce(F.col(a).cast("string"), F.lit("")).alias(a) for a in ("source", "lang")), *([F.coalesce(F.col(topic).cast("string"), F.lit("")).alias("topic")] if topic else []))
    return rows.select("doc", "source", "lang", F.col("topic") if topic else topic_of(F.col("text")).alias("topic"), F.regexp_count("text", F.lit(WORD)).cast("bigint").alias("tokens"))


def raked(cells: DataFrame, powers: dict[str, float], rounds: int = ROUNDS, targets: dict[str, dict[str, float]] | None = None) -> DataFrame:
    """Cells (axes, tokens) with their weight after fitting; weights sum to 1. Cells without a token keep weight 0.

    An axis's targets are its values' shares of tokens to a power, or the weights that `targets` gives (0 for values it doesn't name), made to sum to 1.
    Fitting ends after `rounds`, or before where every marginal is within NEAR of its target.
    """
    whole = cells.agg(F.sum("tokens").cast("double").alias("whole"))
    now = cells.crossJoin(F.broadcast(whole)).withColumn("weight", F.coalesce(F.col("tokens") / F.nullif("whole", F.lit(0.0)), F.lit(0.0)))
    for axis in AXES:
        held = F.sum("weight").over(Window.partitionBy(axis))
        given = (targets or {}).get(axis)
        if given is None:
            raw = F.pow(held, F.lit(powers[axis]))
        else:
            asked = F.coalesce(F.create_map(*(F.lit(x) for v, w in sorted(given.items()) for x in (v, float(w))))[F.col(axis)], F.lit(0.0)) if given else F.lit(0.0)
            raw = F.when(held > 0, asked).otherwise(0.0)
        now = now.withColumn(f"{axis}_raw", raw)
    for axis in AXES:
        # sums over the distinct values of an axis: each cell brings its share of its value's cells
        parts = now.groupBy(axis).agg(F.first(f"{axis}_raw").alias("raw")).agg(F.sum("raw").alias(f"{axis}_all"))
        now = now.crossJoin(F.broadcast(parts)).withColumn(f"{axis}_target", F.coalesce(F.col(f"{axis}_raw") / F.nullif(f"{axis}_all", F.lit(0.0)), F.lit(0.0)))
    now = written(now.select(*AXES, "tokens", "weight", *(f"{a}_target" for a in AXES)), "cells")
    for r in range(rounds):
        for axis in AXES:
            held = F.sum("weight").over(Window.partitionBy(axis))
            now = now.withColumn("weight", F.when(held > 0, F.col("weight") * F.col(f"{axis}_target") / held).otherwise(0.0))
        if (r + 1) % ROUNDS_A_PLAN == 0:
            now = written(now, "cells")
            if r + 1 < rounds and max(x or 0.0 for x in _deviations(now)) <= NEAR:
                break
    return now


def _deviations(cells: DataFrame) -> list[float]:
    """How far each marginal is off its target at most."""
    of = {a: F.abs(F.sum("weight").over(Window.partitionBy(a)) - F.col(f"{a}_target")) for a in AXES}
    return list(cells.select(*(x.alias(a) for a, x in of.items())).agg(*(F.max(a) for a in AXES)).first())


def probabilities(cells: DataFrame, share: float) -> DataFrame:
    """Cells with their documents' probability min(1, c * factor). c is such that the expected tokens are `share` of all; it grows from what it would be without the
    bound of 1 by cells found beyond that bound, each step one sum over cells, until none is added."""
    with_factor = cells.where("tokens > 0").withColumn("factor", F.col("weight") / F.col("tokens"))
    c, bound = 0.0, -1
    while True:
        over = F.lit(c) * F.col("factor") > 1
        sums = with_factor.agg(F.count_if(over).alias("n"), F.sum("tokens").alias("whole"), F.sum(F.when(over, F.col("tokens")).otherwise(0)).alias("taken"), F.sum(F.when(~over, F.col("weight")).otherwise(0.0)).alias("left")).first()
        if sums.n == bound or not sums.left:
            break
        c, bound = (share * sums.whole - sums.taken) / sums.left, sums.n
    return with_factor.select(*AXES, F.least(F.lit(1.0), F.lit(c) * F.col("factor")).alias("probability"))


def uniform(doc_id: Column) -> Column:
    """A number in [0, 1) made from the md5 of the id's decimal text (of nothing for a null id)."""
    return F.conv(F.substr(F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(1), F.lit(DIGITS)), 16, 10).cast("double") / float(16**DIGITS)


def mix(docs: DataFrame, powers: dict[str, float] | None = None, share: float = KEPT_SHARE, rounds: int = ROUNDS, targets: dict[str, dict[str, float]] | None = None, topic: str | None = None) -> DataFrame:
    """All columns of `docs` with topic, tokens, probability and kept.

    `docs` has doc_id, text, source and lang; `topic` names the column of a document's topic, where there is one. `targets` gives weights of an axis's values
    (source, lang or topic), as in {"lang": {"en": 0.7, "de": 0.3}}: documents of other values are not kept, named values without a document count for nothing. Axes
    without such weights have their shares to a power. A null source, lang or topic is a value of its own (""); null and empty texts
    have no token, take no part in the fitting and have probability 1. Rows with equal doc_ids are kept or left together. Columns of `docs`
    named like one of the added four are replaced; others stay, whatever their names. An empty table gives an empty one.
    """
    powers = powers or {"source": SOURCE_POWER, "lang": LANG_POWER, "topic": TOPIC_POWER}
    placed = cells_of(docs, topic)
    sums = written(placed.groupBy(*AXES).agg(F.sum("tokens").alias("tokens")), "cell-sums")
    found = written(probabilities(raked(sums, powers, rounds, targets), share), "cell-probabilities")
    discard(sums)
    by_cell = found.select(*(F.col(a).alias(f"of_{a}") for a in AXES), F.col("probability").alias("chance"))
    joined = placed.join(by_cell, [F.col(a) == F.col(f"of_{a}") for a in AXES], "left")
    probability = F.when(F.col("tokens") > 0, F.coalesce("chance", F.lit(1.0))).otherwise(1.0)
    own = [F.col("doc")[c].alias(c) for c in docs.columns if c.lower() not in ("topic", "tokens", "probability", "kept")]
    return joined.select(*own, "topic", "tokens", probability.alias("probability"), (uniform(F.col("doc")["doc_id"]) < probability).alias("kept"))


def oracle_sql(powers: dict[str, float] | None = None, share: float = KEPT_SHARE, rounds: int = ROUNDS) -> str:
    """The same in DuckDB's SQL, over the table documents."""
    powers = powers or {"source": SOURCE_POWER, "lang": LANG_POWER, "topic": TOPIC_POWER}

    def part(letters: str) -> str:
        return f"(n - length(translate(t, '{letters}', ''))) / n"

    steps = []
    for r in range(rounds):
        for k, a in enumerate(AXES):
            last = f"w{r * len(AXES) + k}"
            steps.append(f"w{r * len(AXES) + k + 1} AS (SELECT * REPLACE (CASE WHEN sum(weight) OVER (PARTITION BY {a}) > 0 THEN weight * {a}_target / sum(weight) OVER (PARTITION BY {a}) ELSE 0.0 END AS weight) FROM {last})")
    targets = ", ".join(f"(SELECT power(sum(c.tokens)::DOUBLE / (SELECT sum(tokens) FROM cells), {powers[a]}) FROM cells c WHERE c.{a} = cells.{a}) / (SELECT sum(p) FROM (SELECT power(sum(tokens)::DOUBLE / (SELECT sum(tokens) FROM cells), {powers[a]}) AS p FROM cells GROUP BY {a})) AS {a}_target" for a in AXES)
    return f"""
WITH texts AS (SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang, coalesce(text, '') AS t, greatest(length(coalesce(text, '')), 1) AS n FROM documents),
placed AS (SELECT doc_id, source, lang, CAST(len(regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS tokens,
  CASE WHEN {part("|")} > 0.02 THEN 'table' WHEN {part(SIGNS)} > 0.08 THEN 'markup' WHEN {part(CAPITALS)} > 0.3 THEN 'shouting'
    WHEN length(t) < 400 THEN 'brief' WHEN length(t) > 12000 THEN 'long' ELSE 'prose' END AS topic FROM texts),
cells AS (SELECT source, lang, topic, sum(tokens) AS tokens FROM placed GROUP BY ALL),
w0 AS (SELECT source, lang, topic, tokens, tokens::DOUBLE / (SELECT sum(tokens) FROM cells) AS weight, {targets} FROM cells),
{", ".join(steps)},
factors AS (SELECT *, weight / tokens AS factor FROM w{rounds * len(AXES)} WHERE tokens > 0),
levels AS (SELECT factor, coalesce(sum(tokens) OVER (ORDER BY factor DESC, source, lang, topic ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS taken,
  sum(weight) OVER (ORDER BY factor DESC, source, lang, topic ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest, sum(tokens) OVER () AS whole FROM factors),
scale AS (SELECT max(c) AS c FROM (SELECT factor, ({share} * whole - taken) / nullif(rest, 0) AS c FROM levels) WHERE c >= 0 AND c * factor <= 1),
chances AS (SELECT source, lang, topic, least(1.0, coalesce((SELECT c FROM scale) * factor, 1.0)) AS p FROM factors),
final AS (SELECT doc_id, source, lang, topic, placed.tokens AS tokens, CASE WHEN placed.tokens > 0 THEN coalesce(p, 1.0) ELSE 1.0 END AS p FROM placed LEFT JOIN chances USING (source, lang, topic))
SELECT doc_id, source, lang, topic, tokens, round_even(p, 6) AS probability,
  CAST(('0x' || substr(md5(CAST(coalesce(doc_id::VARCHAR, '') AS VARCHAR)), 1, {DIGITS})) AS BIGINT)::DOUBLE / {16**DIGITS}.0 < p AS kept FROM final
"""
