"""Sequencing inputs made from the driver's tables by SQL that Spark and DuckDB both run.

The tables hold no sequencing data. Reads are keyed on events.event_id, two of them mates that overlap, barcodes on nation, and the reference genome's bases come
from md5 digests, so both engines see the same rows. `views(dialect)` gives the common table expressions; every query and its SQL twin start from them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from methylspark.operators.barcodes import INSERT_LEFT, LINKER

LETTERS = "'0123456789abcdef', 'ACGTACGTACGTACGT'"
#: Bases of each contig, of a reference block, and of a read.
CONTIG, BLOCK, READ = 512, 32, 25
#: (name, role): autosomes, the mitochondrion and a spike-in.
CONTIGS = (("chr1", "host"), ("chr2", "host"), ("chr3", "host"), ("chrM", "mito"), ("lambda", "spike"))
#: Flags of first and second mates.
FLAGS = ((99, 83, 99, 83, 99, 83, 99, 83, 1123, 65), (147, 163, 147, 163, 147, 163, 147, 163, 1171, 129))
TABLES = ("nation", "events")

#: How many parts a folder's events are stored as, by session.
_stored: dict[tuple[str, str], int] = {}
_SPARK = {"div": "div", "qual": "transform(sequence(0, 24), i -> CAST(25 + (event_id * 7 + i * 3) % 17 AS INT))", "int": "INT", "string": "STRING", "range": "explode(sequence(0, {n}))"}
_DUCK = {"div": "//", "qual": "list_transform(range(25), lambda i: CAST(25 + (event_id * 7 + i * 3) % 17 AS INTEGER))", "int": "INTEGER", "string": "VARCHAR", "range": "unnest(range(0, {n} + 1))"}


#: Spoiled linkers and insert-lefts by the kind of a pair: a letter missing, replaced, put in, two replaced, C read as T; in the seed's part and before it, and far off its place.
LINKERS = {4: LINKER[:12] + LINKER[13:], 5: LINKER[1:], 6: LINKER[:9] + "A" + LINKER[10:], 7: LINKER + LINKER[:8] + LINKER, 8: LINKER[:20] + "T" + LINKER[20:], 10: "GG" + LINKER[2:], 11: LINKER.replace("C", "T")}
INSERTS = {1: "T" + INSERT_LEFT[1:], 2: INSERT_LEFT[:25] + "C" + INSERT_LEFT[26:], 3: INSERT_LEFT[:30] + INSERT_LEFT[31:], 4: INSERT_LEFT.replace("C", "T"), 5: "ACGT" * 6 + INSERT_LEFT, 6: INSERT_LEFT[:3] + "T" + INSERT_LEFT[4:22] + "A" + INSERT_LEFT[23:]}


def _case(key: str, values, other: str = "NULL") -> str:
    return f"CASE {key} " + " ".join(f"WHEN {k} THEN {v!r}" for k, v in (values.items() if isinstance(values, dict) else enumerate(values))) + f" ELSE {other} END"


def views(dialect: str) -> str:
    """The WITH list: whitelist, contigs, ref_blocks, reads, pairs and what they are made of."""
    d = _SPARK if dialect == "spark" else _DUCK
    n = len(CONTIGS)
    contig = _case(f"pair % {n}", [c for c, _ in CONTIGS])
    blocks = CONTIG // BLOCK - 1
    return f"""
whitelist AS (SELECT n_nationkey AS ord, lpad(CAST(n_nationkey AS {d["string"]}), 2, '0') AS barcode_index,
  translate(substr(md5(concat('barcode', CAST(n_nationkey AS {d["string"]}))), 1, 8), {LETTERS}) AS seq FROM nation),
contigs AS (SELECT n_nationkey AS c_ord, {_case("n_nationkey", [c for c, _ in CONTIGS])} AS contig, {_case("n_nationkey", [r for _, r in CONTIGS])} AS role FROM nation WHERE n_nationkey < {n}),
ref_blocks AS (SELECT contig, role, b * {BLOCK} AS block_start, translate(md5(concat(contig, ':', CAST(b AS {d["string"]}))), {LETTERS}) AS seq
  FROM (SELECT contig, role, {d["range"].format(n=blocks)} AS b FROM contigs)),
keyed AS (SELECT event_id, value, pair, pair % 7 AS i1, (pair {d["div"]} 7) % 5 AS i2 FROM (SELECT *, event_id {d["div"]} 2 AS pair FROM events)),
reads AS (SELECT event_id AS ordinal, concat('r', CAST(pair AS {d["string"]})) AS qname,
  CAST(CASE WHEN event_id % 2 = 0 THEN {_case("pair % 10", FLAGS[0])} ELSE {_case("pair % 10", FLAGS[1])} END AS {d["int"]}) AS flag, {contig} AS rname,
  CAST((pair * 37) % {CONTIG - 50} + event_id % 2 * (pair % 9) AS {d["int"]}) AS pos, CAST((event_id * 13) % 61 AS {d["int"]}) AS mapq,
  CASE event_id % 9 WHEN 7 THEN '5S20M' WHEN 8 THEN '10M2D15M' WHEN 6 THEN '12M3I10M' ELSE '25M' END AS cigar,
  translate(substr(md5(concat('read', CAST(event_id AS {d["string"]}))), 1, {READ}), {LETTERS}) AS seq, {d["qual"]} AS qual,
  CASE WHEN pair % 11 = 0 THEN NULL WHEN pair % 13 = 0 THEN concat(a.seq, b.seq) WHEN pair % 17 = 0 THEN 'NNNNNNNN+NNNNNNNN' ELSE concat(a.seq, '+', b.seq) END AS cb,
  CASE WHEN event_id % 19 = 0 THEN '2' WHEN event_id % 23 = 0 THEN 'x' WHEN event_id % 3 = 0 THEN '1' END AS nh
  FROM keyed JOIN whitelist a ON a.ord = i1 JOIN whitelist b ON b.ord = i2),
made AS (SELECT event_id AS ordinal, concat('@p', CAST(event_id AS {d["string"]}), ' 1:N') AS h1,
  concat(CASE WHEN event_id % 12 = 1 THEN concat('A', substr(b.seq, 2)) WHEN event_id % 12 = 11 THEN translate(b.seq, 'C', 'T') ELSE b.seq END, {_case("event_id % 12", LINKERS, f"'{LINKER}'")},
    CASE event_id % 12 WHEN 3 THEN concat(substr(a.seq, 1, 7), 'G') WHEN 2 THEN 'NNNNNNNN' WHEN 11 THEN translate(a.seq, 'C', 'T') ELSE a.seq END, {_case(f"(event_id {d['div']} 12) % 7", INSERTS, f"'{INSERT_LEFT}'")},
    translate(substr(md5(concat('insert', CAST(event_id AS {d["string"]}))), 1, 30), {LETTERS})) AS whole
  FROM keyed JOIN whitelist a ON a.ord = i1 JOIN whitelist b ON b.ord = i2),
pairs AS (SELECT ordinal, h1, CASE WHEN ordinal % 12 = 9 THEN substr(whole, 1, 70) ELSE whole END AS s1, rpad('', CAST(CASE WHEN ordinal % 12 = 9 THEN 70 ELSE length(whole) END AS {d["int"]}), 'I') AS q1 FROM made)
"""


def tables(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    """These derived views as DataFrames. A table that is stored as fewer parts than the session has cores for is dealt to all of them before reads are made of it."""
    for t in TABLES:
        table = spark.read.parquet(f"{sf_dir}/{t}.parquet")
        cores = spark.sparkContext.defaultParallelism
        if t == "events":
            key = spark.sparkContext.applicationId, sf_dir
            if key not in _stored:
                _stored[key] = table.rdd.getNumPartitions()
            table = table.select("event_id", "value").repartition(cores) if _stored[key] < cores else table
        table.createOrReplaceTempView(t)
    return [spark.sql(f"WITH {views('spark')} SELECT * FROM {name}") for name in names]


def oracle(query: str) -> str:
    """DuckDB SQL over the derived views. A query may open with further views and a comma."""
    return f"WITH {views('duckdb')}, {query}" if query.lstrip().split(" ", 1)[0].lower() != "select" else f"WITH {views('duckdb')} {query}"
