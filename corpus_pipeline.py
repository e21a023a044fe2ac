"""A training corpus from raw documents: toxic and poor documents go, one of each group of near duplicates stays, sources are mixed
to target weights, and what is kept is packed into token sequences.

Each stage works on all that the one before it kept, and its decisions take effect in what it returns. Classifiers learn from the labelled rows among
the documents that reach them, and judge each row by itself.

All stages take null and empty texts (no words), null doc_ids, sources and languages, repeated rows, which are judged alike, and further columns, which they leave out. An empty table gives an
empty one, and without labels of both kinds a classifier's stage keeps all.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from methylspark.llm import mixing, near_dup, packing, quality, queries, toxicity
from methylspark.llm.store import written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that are likely toxic. Texts that are null or have no letter or digit stay."""
    machine = toxicity.learn(docs, queries.table(spark, sf_dir, "labels"))
    return toxicity.detect(docs, machine, COLUMNS).where(F.col("score") < queries.TOXIC_LIMIT).select(*COLUMNS)


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents of likely poor quality. A null text is judged as an empty one."""
    model = quality.learn(docs, queries.table(spark, sf_dir, "labels"))
    return quality.assess(docs, model, COLUMNS).where(F.col("score") >= queries.QUALITY_LIMIT).select(*COLUMNS)


def different(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the least doc_id; those without a doc_id are in no group and stay. Of rows that repeat a doc_id the first by text stays."""
    found = near_dup.near_duplicates(docs, size=5, percent=80)
    kept = found.where("kept").select("doc_id")
    rank = F.row_number().over(Window.partitionBy("doc_id").orderBy("text"))
    first = docs.select(*COLUMNS).join(kept, "doc_id", "left_semi").withColumn("_rank", rank).where("_rank = 1")
    return first.select(*COLUMNS).unionByName(docs.where("doc_id is null").select(*COLUMNS))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose sources, languages and forms have their target weights. Texts without a word, which weigh nothing, stay; rows of one doc_id stay or go together, those without a doc_id too."""
    return mixing.mix(docs).where("kept").select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, with digests of their ids. A text without a word is its end id alone."""
    pieces = packing.harmonic_pack(docs, public_tokenizers.path(queries.BYTE_BPE), 1024, 0)
    return pieces.withColumn("ids_crc32", F.crc32("ids"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxic),
    ("quality", good),
    ("near duplicates", different),
    ("mixing", mixed),
    ("packing", packed),
]
#: Learned classifiers and token ids can't be told in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written as Parquet and read again."""
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
