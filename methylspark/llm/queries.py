"""One query for each operator of this subpackage, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from methylspark.llm import collocations, divergence, fingerprint, langid, maxent, mixing, near_dup, packing, quality, records, token_counts, topk, toxicity
from methylspark.llm.store import new_path

BYTE_BPE, WORD_BPE = "byte_bpe_50k.json", "word_bpe_49k.json"
#: Tokens that a document may have.
TOKEN_LIMIT = 2048
#: Scores from which a document counts as of quality, and as toxic.
QUALITY_LIMIT, TOXIC_LIMIT = 0.5, 0.7


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = langid.crc_class("doc_id", 7) == 2
    found = maxent.score(table(spark, sf_dir, "documents"), held_out)
    return found.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), size=4, percent=80)


#: In ASCII letters alone, as the queries fold case; words lie between spaces and 0x09-0x0D.
SQL_WORDS = r"list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '')"

OP2_SQL = f"""
WITH RECURSIVE words AS (SELECT doc_id, {SQL_WORDS} AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i+3], ' '))) END AS s
  FROM words),
flat AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y FROM flat a JOIN flat b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach AS (SELECT doc_id AS x, doc_id AS y FROM sets UNION SELECT r.x, p.y FROM reach r JOIN pairs p ON r.y = p.x),
least AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN least ON x = doc_id
"""


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.harmonic_pack(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE), 1024, 0)
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "class")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(langid.crc_class("doc_id", 3) == 1, F.lit(False))
    model = quality.learn(docs, table(spark, sf_dir, "labels").where(~held_out))
    found = quality.assess(docs, model)
    return found.select("doc_id", held_out.alias("held_out"), "text_score", "meta_score", "score", (F.col("score") >= QUALITY_LIMIT).alias("kept"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(langid.crc_class("doc_id", 3) == 1, F.lit(False))
    machine = toxicity.learn(docs, table(spark, sf_dir, "labels").where(~held_out))
    found = toxicity.detect(docs, machine)
    return found.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= TOXIC_LIMIT).cast("int").alias("predicted"))


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fingerprint.fingerprint_neighbours(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def op7_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), every=100, k=10, scale=1024)


OP7_SQL = """
WITH rows AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS w FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY embedding) = 1),
scored AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(range(1, len(c.w) + 1), lambda i: q.w[i] * c.w[i])) AS BIGINT) AS score
  FROM rows q JOIN rows c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""


def op8_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(langid.crc_class("doc_id", 3) == 1, F.lit(False))
    found = langid.identify(docs, docs.where(~held_out).select("text", "lang"))
    return found.select("doc_id", held_out.alias("held_out"), F.coalesce("language", F.lit("und")).alias("lang_pred"), "score", "margin", "accepted")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    axes = (F.coalesce(a, F.lit("")).alias(a) for a in ("source", "lang"))
    return mixed.select("doc_id", *axes, "topic", "tokens", F.bround("probability", 6).alias("probability"), "kept")


def op10_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = records.write_records(table(spark, sf_dir, "documents"), new_path(spark, "token-records"), public_tokenizers.path(BYTE_BPE), 2)
    read = records.read_records(spark, files)
    return read.select("doc_id", "start", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"), least=100, top=2000)


OP12_SQL = r"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p FROM documents),
lists AS (SELECT lang, list_filter(regexp_split_to_array(p, '[\x20\x09]+'), lambda w: w <> '') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w)) AS n FROM lists GROUP BY lang),
grams AS (SELECT lang, unnest(list_transform(range(1, len(w) - k + 2), lambda i: w[i:i + k - 1])) AS g FROM lists, (SELECT unnest(range(1, 6)) AS k) WHERE len(w) >= k),
counts AS (SELECT lang, g, len(g) AS words, CAST(count(*) AS HUGEINT) AS f FROM grams GROUP BY lang, g HAVING count(*) >= 100),
cuts AS (SELECT c.lang, c.g, c.f AS a, k, l.f AS l, r.f AS r, CAST(t.n AS HUGEINT) AS n, (1000 * c.f * CAST(t.n AS HUGEINT)) // (l.f * r.f) AS score
  FROM (SELECT *, unnest(range(1, words)) AS k FROM counts) c JOIN totals t ON t.lang = c.lang JOIN counts l ON l.lang = c.lang AND l.g = c.g[1:k] JOIN counts r ON r.lang = c.lang AND r.g = c.g[k + 1:c.words]),
firsts AS (SELECT *, row_number() OVER (PARTITION BY lang, g ORDER BY score, k) AS place FROM cuts),
within AS (SELECT DISTINCT lang, g[i:i + k - 1] AS g, f FROM (SELECT lang, g, f, words, k, unnest(range(1, words - k + 2)) AS i FROM (SELECT *, unnest(range(2, words)) AS k FROM counts))),
kept AS (SELECT * FROM firsts c WHERE place = 1 AND NOT EXISTS (SELECT 1 FROM within w WHERE w.lang = c.lang AND w.g = c.g AND w.f >= c.a)),
ranked AS (SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, n, score, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(array_to_string(g, ' '))) AS rank FROM kept)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 2000
"""


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"), least=3, top=200)


OP13_SQL = r"""
WITH docs AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
flat AS (SELECT id, lang, source, unnest(w) AS term FROM docs),
kept AS (SELECT lang, term, CAST(count(*) AS HUGEINT) AS n FROM flat GROUP BY lang, term HAVING count(DISTINCT id) >= 3),
langs AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
cells AS (SELECT lang, source, term, count(*) AS n FROM flat JOIN kept USING (lang, term) GROUP BY lang, source, term),
sizes AS (SELECT lang, source, sum(n) AS total FROM cells GROUP BY lang, source),
groups AS (SELECT DISTINCT lang, source FROM docs),
dense AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000 * CAST(coalesce(c.n, 0) + 1 AS HUGEINT)) // (coalesce(s.total, 0) + v) AS p, 1 + (1000000000 * (k.n + 1)) // (langs.total + v) AS q
  FROM groups g JOIN kept k USING (lang) JOIN langs USING (lang) LEFT JOIN sizes s ON s.lang = g.lang AND s.source = g.source LEFT JOIN cells c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
sums AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value FROM dense a JOIN dense b ON a.lang = b.lang AND a.term = b.term GROUP BY a.lang, a.source, b.source),
parts AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL SELECT lang, source, 'term', term, CAST(((p - q) * (p - q)) // q AS BIGINT) FROM dense WHERE n > 0 AND p > q),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INTEGER) AS rank FROM parts)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_lm_scores, op2_near_duplicates, op3_packing, op4_quality, op5_toxicity, op6_fingerprints, op7_top_k, op8_languages, op9_mixing, op10_token_records, op11_token_counts, op12_collocations, op13_source_divergence)
}
ORACLE_SQL: dict[str, str] = {"op2_near_duplicates": OP2_SQL, "op7_top_k": OP7_SQL, "op9_mixing": mixing.oracle_sql(), "op12_collocations": OP12_SQL, "op13_source_divergence": OP13_SQL}
