"""Barcodes of paired reads: where they stand, which they are, and why a pair is rejected."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from methylspark.functions import dna
from methylspark.functions.chemistry import Assay

#: The construct's fixed parts (fixed values).
LINKER = "ATCCACGTGCTTGAGAGGCCAGAGCATTCG"
INSERT_LEFT = "CATCGGCGTACGACTAGATGTGTATAAGAGACAG"
ALPHABET = "ACGTN"
#: Assays whose unmethylated C are read as T, in barcodes and linkers too.
CONVERTED = (Assay.EMSEQ, Assay.CABERNET)


#: Variants of a whitelist that are sent to every task, at most; more are joined by a shuffle.
SENT_VARIANTS = 2_000_000


@dataclass(frozen=True)
class Layout:
    """[barcode2][linker][barcode1][insert-left][insert], and how far each part may be off.

    The linker is looked for in the first bases, up to `slack` beyond its place. Taps reads have the insert-left found by its last `seed` bases, within `span` bases of
    where they belong; both are found within `linker_edits` edits. Other assays have the insert-left found C/T-aware within `insert_mismatches`, and where the assay converts
    unmethylated bases the linker too, and barcodes are compared with C read as T.
    """

    assay: Assay = Assay.TAPS
    linker: str = LINKER
    insert_left: str = INSERT_LEFT
    barcode: int = 8
    slack: int = 62
    seed: int = 15
    span: int = 40
    linker_edits: int = 1
    insert_mismatches: int = 1
    barcode_distance: int = 1

    @property
    def shortest(self) -> int:
        return 2 * self.barcode + len(self.linker) + len(self.insert_left)


def neighbours(seq: Column) -> Column:
    """A text and all texts that differ from it at one place."""
    changed = F.flatten(F.transform(F.sequence(F.lit(1), F.length(seq)), lambda i: F.transform(F.array(*map(F.lit, ALPHABET)), lambda b: F.concat(F.substr(seq, F.lit(1), i - 1), b, F.substr(seq, i + 1)))))
    return F.array_distinct(F.concat(F.array(seq), changed))


def corrections(whitelist: DataFrame, most: int = 1, converted: bool = False) -> DataFrame:
    """(observed, barcode, distance) for every text within `most` places of a barcode that one barcode alone is nearest to; a barcode is itself. With `converted` C is read as T in barcodes."""
    seq = dna.converted(F.upper("seq")) if converted else F.upper("seq")
    # of equal barcodes, as conversion may make them, one stands for all
    near = whitelist.select(seq.alias("barcode")).distinct().select(F.col("barcode").alias("observed"), "barcode", F.lit(0).alias("distance"))
    for d in range(1, most + 1):
        wider = near.select(F.explode(neighbours(F.col("observed"))).alias("observed"), "barcode").withColumn("distance", F.lit(d))
        near = near.unionByName(wider).groupBy("observed", "barcode").agg(F.min("distance").alias("distance"))
    found = near.groupBy("observed").agg(F.array_sort(F.collect_list(F.struct("distance", "barcode"))).alias("all"))
    first, second = F.get("all", F.lit(0)), F.get("all", F.lit(1))
    alone = (first["distance"] == 0) | second.isNull() | (first["distance"] < second["distance"])
    return found.where(alone).select("observed", first["barcode"].alias("barcode"), first["distance"].alias("distance"))


def known(whitelist: DataFrame, layout: Layout) -> DataFrame:
    """`corrections` for a layout, sent to all tasks where the whitelist's size bounds them."""
    found = corrections(whitelist, layout.barcode_distance, layout.assay in CONVERTED)
    each = sum(math.comb(layout.barcode, d) * (len(ALPHABET) - 1) ** d for d in range(layout.barcode_distance + 1))
    return F.broadcast(found) if whitelist.count() * each <= SENT_VARIANTS else found


def nearest(observed: DataFrame, whitelist: DataFrame, column: str = "observed", most: int = 1) -> DataFrame:
    """(observed, barcode, distance) of distinct observed barcodes: itself where the whitelist has it, else the only nearest one within `most` places, else null.

    The whitelist's variants are joined by equality, so no observed barcode is compared with all.
    """
    # a count drops nulls, since a filter would be pushed below what finds the barcodes, which is then made for it again
    seen = observed.groupBy(column).agg(F.count(column).alias("n")).where("n > 0").select(column)
    return seen.join(known(whitelist, Layout(barcode_distance=most)).withColumnRenamed("observed", column), column, "left")


def placed(pairs: DataFrame, layout: Layout, column: str = "s1") -> DataFrame:
    """Pairs with the places of linker and insert-left and both observed barcodes."""
    n, size, m = len(layout.linker), layout.barcode, len(layout.insert_left)
    seq, window = F.col("_seq"), F.col("_window")
    # each step is a column of its own, so that none is computed again within the next
    out = pairs.withColumn("_seq", F.upper(column)).withColumn("_window", F.left("_seq", F.lit(size + n + layout.slack)))
    out = out.withColumn("linker_at", dna.c_t_position(window, layout.linker, layout.linker_edits) if layout.assay in CONVERTED else dna.near_position(window, layout.linker, layout.linker_edits))
    after = F.col("linker_at") + n + size
    out = out.withColumn("_after", F.when((F.col("linker_at") >= size) & (after <= F.length(seq)), after))
    if layout.assay == Assay.TAPS:
        seed = layout.insert_left[-layout.seed :]
        out = out.withColumn("_window", F.substr(seq, F.col("_after") + (m - len(seed)) + 1, F.lit(layout.span)))
        out = out.withColumn("_at", dna.near_position(window, seed, layout.linker_edits))
    else:
        out = out.withColumn("_window", F.substr(seq, F.col("_after") + 1, F.lit(m + layout.span)))
        out = out.withColumn("_at", dna.c_t_position(window, layout.insert_left, layout.insert_mismatches))
    at = F.col("_after") + F.col("_at")
    out = out.withColumn("insert_at", F.when(at + m <= F.length(seq), at))
    return out.withColumns({"observed2": F.substr(seq, F.col("_after") - (n + 2 * size) + 1, F.lit(size)), "observed1": F.substr(seq, F.col("_after") - size + 1, F.lit(size))}).drop("_seq", "_window", "_after", "_at")


def rejections(pairs: DataFrame, whitelist: DataFrame, layout: Layout, column: str = "s1", quality: str = "q1", second: DataFrame | None = None) -> DataFrame:
    """`placed` pairs with barcode1, barcode2, reasons (empty: kept) and insert_start, where the insert begins. Barcodes of the second place may have a whitelist of their own.

    Both barcodes are looked up in tables that every task has, so pairs aren't shuffled.
    """
    found = placed(pairs, layout, column)
    for k, names in (("1", whitelist), ("2", whitelist if second is None else second)):
        table = known(names, layout).select(F.col("observed").alias(f"observed{k}"), F.col("barcode").alias(f"barcode{k}"))
        found = found.join(table, f"observed{k}", "left")
    short = (F.length(column) < layout.shortest) | (F.length(quality) < layout.shortest)
    reasons = (
        F.when(short, F.array(F.lit("short_r1")))
        .when(F.col("linker_at").isNull(), F.array(F.lit("structure_mismatch"), F.lit("linker2_not_found")))
        .when(F.col("observed1").isNull(), F.array(F.lit("structure_mismatch")))
        .when(F.col("insert_at").isNull(), F.array(F.lit("structure_mismatch"), F.lit("tn5_not_found")))
        .when(F.col("barcode1").isNull(), F.array(F.lit("barcode1_not_in_whitelist")))
        .when(F.col("barcode2").isNull(), F.array(F.lit("barcode2_not_in_whitelist")))
        .otherwise(F.array().cast("array<string>"))
    )
    return found.withColumns({"reasons": reasons, "insert_start": F.col("insert_at") + len(layout.insert_left)})


def found_inserts(found: DataFrame, layout: Layout, column: str = "s1") -> DataFrame:
    """Pairs of `rejections` with `insert`, the bases that were taken for the insert-left, or null for those that aren't kept. (A filter would be pushed below the search, which is then made for it again.)"""
    return found.withColumn("insert", F.when(F.size("reasons") == 0, F.substr(F.upper(column), F.col("insert_at") + 1, F.lit(len(layout.insert_left)))))


REASONS = ("short_r1", "structure_mismatch", "linker2_not_found", "tn5_not_found", "barcode1_not_in_whitelist", "barcode2_not_in_whitelist")


def reject_counts(found: DataFrame) -> DataFrame:
    """One row: total, kept and each reason's number; a pair counts in each of its reasons."""
    return found.agg(F.count("*").alias("total_reads"), F.count_if(F.size("reasons") == 0).alias("kept_reads"), *(F.count_if(F.array_contains("reasons", r)).alias(r) for r in REASONS))


def insert_conversion(inserts: DataFrame, positions: list[int], column: str = "insert") -> tuple[DataFrame, DataFrame]:
    """Of inserts whose C at these positions are methylated: T, C and other bases by position; and one row with the mean of the reads' conversion rates, and the share of reads that are T throughout. Null inserts count for nothing."""
    scored = inserts.select(F.when(F.col(column).isNotNull(), dna.conversion(F.upper(column), positions)).alias("bases"))
    at = [F.get("bases", F.lit(k)) for k in range(len(positions))]
    kinds = {"t_count": lambda b: b == "T", "c_count": lambda b: b == "C", "other_count": lambda b: ~b.isin("T", "C")}
    counted = scored.agg(*(F.count_if(is_it(b)).alias(f"{name}_{k}") for k, b in enumerate(at) for name, is_it in kinds.items()))
    by_position = counted.select(F.explode(F.array(*(F.struct(F.lit(p).alias("position"), *(F.col(f"{name}_{k}").alias(name) for name in kinds)) for k, p in enumerate(positions)))).alias("row")).select("row.*")
    number = lambda letter: F.size(F.filter("bases", lambda b: b == letter))
    rates = scored.select("bases", F.when(F.col("bases").isNotNull(), number("T") / F.nullif(number("T") + number("C"), F.lit(0))).alias("rate"), F.forall("bases", lambda b: b == "T").alias("full"))
    whole = rates.agg(F.count("bases").alias("reads"), F.count("rate").alias("informative"), F.bround(F.avg("rate"), 6).alias("mean_rate"), F.count_if("full").alias("fully_converted"))
    return by_position, whole
