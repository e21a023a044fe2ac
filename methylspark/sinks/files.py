"""Writers of coverage, tables and statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from methylspark.functions import formats

CG_FIELDS = ("rname", "start", "end", "pct", "meth", "unmeth")
CH_FIELDS = (*CG_FIELDS, "context", "strand")


def coverage_lines(calls: DataFrame, *keys: str) -> DataFrame:
    """Tab-separated lines of calls, 0-based with start = end, percents with two places; context and strand where the calls have them."""
    fields = CH_FIELDS if "context" in calls.columns else CG_FIELDS
    shown = calls.withColumns({"start": F.col("pos"), "end": F.col("pos"), "pct": formats.fixed(F.col("pct"), 2)})
    return shown.select(*keys, "rname", "pos", F.concat_ws("\t", *(F.col(f).cast("string") for f in fields)).alias("value"))


def write_coverage(calls: DataFrame, manifest: DataFrame, path: str) -> None:
    """One folder of coverage lines for each context, x and spot that has a row, sorted by contig and position. Spots are dealt to tasks by hash; a spot is never split."""
    placed = calls.join(manifest.select("spot_id", "x"), "spot_id")
    context = F.col("context") if "context" in calls.columns else F.lit("CG")
    kinds = placed.withColumn("kind", context)
    lines = coverage_lines(kinds, "kind", "x", "spot_id")
    lines.repartition("kind", "spot_id").sortWithinPartitions("kind", "x", "spot_id", "rname", "pos").select("kind", "x", "spot_id", "value").write.partitionBy("kind", "x", "spot_id").text(path)


def write_tsv(table: DataFrame, path: str, *order: str) -> None:
    """A small table as one tab-separated file with a header, NA for null."""
    table.orderBy(*order).coalesce(1).write.csv(path, sep="\t", header=True, nullValue="NA")


MANIFEST_FIELDS = ("spot_id", "barcode1_index", "barcode2_index", "barcode1", "barcode2", "raw_cb")


def write_manifest(manifest: DataFrame, path: str) -> None:
    """All spots of `calls.spot_keys` as one tab-separated file with a header, in order of the whitelist's first and then second barcode. A manifest is the square of a whitelist: some thousand rows."""
    manifest.orderBy("x", "y").select(*MANIFEST_FIELDS).coalesce(1).write.csv(path, sep="\t", header=True)


def write_stats(row: DataFrame, path: str) -> None:
    """One row of counters as a line of JSON."""
    row.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")).coalesce(1).write.text(path)


def write_fastq(found: DataFrame, path: str) -> None:
    """Kept pairs with annotated headers and their insert, rejected pairs as they were, as gzip text by status and mate, in order of their ordinals within a task."""
    kept = F.size("reasons") == 0
    start = F.coalesce("insert_start", F.lit(0)) + 1
    tag = F.concat(F.lit("@"), F.col("barcode1"), F.lit("+"), F.col("barcode2"), F.lit(":"))
    cut = lambda c: F.when(kept, F.substr(c, start)).otherwise(F.col(c))
    header = lambda c: F.when(kept, F.concat(tag, F.substr(c, F.lit(2)))).otherwise(F.col(c))
    mates = [F.struct(F.lit(m).alias("mate"), F.concat_ws("\n", header(f"h{k}"), cut("s1") if k == 1 else F.col("s2"), F.lit("+"), cut("q1") if k == 1 else F.col("q2")).alias("value")) for k, m in ((1, "R1"), (2, "R2"))]
    rows = found.select("ordinal", F.when(kept, "kept").otherwise("rejected").alias("status"), F.explode(F.array(*mates)).alias("r")).select("ordinal", "status", "r.mate", "r.value")
    rows.sortWithinPartitions("status", "mate", "ordinal").select("status", "mate", "value").write.partitionBy("status", "mate").option("compression", "gzip").text(path)
