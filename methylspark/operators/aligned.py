"""Aligned bases: one row for each base of a record that stands on a reference position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from methylspark.functions import chemistry, dna

#: How far each CIGAR operation moves in the read and in the reference.
_IN_READ, _IN_REFERENCE, _ALIGNED = ("M", "I", "S", "=", "X"), ("M", "D", "N", "=", "X"), ("M", "=", "X")


def aligned_blocks(cigar: Column, pos: Column) -> Column:
    """array<struct<q, r, n>>: runs of n bases from read place q on reference place r; a CIGAR is text as in SAM."""
    lengths = F.transform(F.regexp_extract_all(cigar, F.lit(r"(\d+)[MIDNSHP=X]"), F.lit(1)), lambda x: x.cast("int"))
    kinds = F.regexp_extract_all(cigar, F.lit(r"\d+([MIDNSHP=X])"), F.lit(1))
    empty = F.array().cast("array<struct<q:int,r:int,n:int>>")

    def step(state: Column, op: Column) -> Column:
        kind, n = op["kinds"], op["lengths"]
        block = F.array(F.struct(state["q"].alias("q"), state["r"].alias("r"), n.alias("n")))
        return F.struct(
            (state["q"] + F.when(kind.isin(*_IN_READ), n).otherwise(0)).alias("q"),
            (state["r"] + F.when(kind.isin(*_IN_REFERENCE), n).otherwise(0)).alias("r"),
            F.when(kind.isin(*_ALIGNED), F.concat(state["blocks"], block)).otherwise(state["blocks"]).alias("blocks"),
        )

    start = F.struct(F.lit(0).alias("q"), pos.cast("int").alias("r"), empty.alias("blocks"))
    return F.aggregate(F.arrays_zip(kinds.alias("kinds"), lengths.alias("lengths")), start, step, lambda s: s["blocks"])


def bases(records: DataFrame, *carried: str) -> DataFrame:
    """Aligned bases with the columns `carried` of their record: qpos, pos, length (of the whole query, soft clips included), base, next_base,
    qual, next_qual. Deletions, skips, insertions and clips make no row. The next base is the next of the query, also across an indel."""
    runs = records.select(*carried, "seq", "qual", F.length("seq").alias("length"), F.explode(aligned_blocks(F.col("cigar"), F.col("pos"))).alias("run"))
    places = runs.select("*", F.explode(F.sequence(F.lit(0), F.col("run.n") - 1)).alias("i")).withColumns({"qpos": F.col("run.q") + F.col("i"), "pos": F.col("run.r") + F.col("i")})
    letter = lambda k: F.nullif(F.upper(F.substr("seq", F.col("qpos") + k, F.lit(1))), F.lit(""))
    return places.select(*carried, "length", "qpos", "pos", letter(1).alias("base"), letter(2).alias("next_base"), F.get("qual", F.col("qpos")).alias("qual"), F.get("qual", F.col("qpos") + 1).alias("next_qual"))


def overlaps_resolved(aligned: DataFrame, name: str = "qname", contig: str = "rname", base: str = "base", by: tuple[str, ...] = ()) -> DataFrame:
    """Aligned bases with what mates both cover counted once: where they agree one keeps the sum of both qualities (at most 200) and the other 0;
    where they differ the better keeps four fifths of its quality and the other 0. Ties keep the record that comes first. `base` is read along the reference.
    Records without a name (null or *) have no mate; mates are alike in the columns `by`."""
    both = Window.partitionBy(name, contig, "pos", *by)
    first = F.row_number().over(both.orderBy(F.desc("qual"), "ordinal")) == 1
    agree = F.min(base).over(both) == F.max(base).over(both)
    total = F.least(F.sum("qual").over(both), F.lit(200))
    kept = F.when(agree, total).otherwise(F.floor(F.col("qual") * 0.8)).cast("int")
    return aligned.withColumn("qual", F.when((F.col(name) != "*") & (F.count("*").over(both) == 2), F.when(first, kept).otherwise(0)).otherwise(F.col("qual")).cast("int"))


#: Reference positions that depth is bounded for together.
DEPTH_BIN = 1024


def deep_bins(records: DataFrame, most: int) -> DataFrame:
    """(contig, bin) of DEPTH_BIN positions that more than `most` records reach. No position of any other bin is covered more often. Records, not bases, are counted, and partly before the shuffle."""
    longest = F.aggregate(F.regexp_extract_all("cigar", F.lit(r"(\d+)"), F.lit(1)), F.lit(0), lambda n, x: n + x.cast("int"))
    bins = F.sequence(F.floor(F.col("pos") / DEPTH_BIN), F.floor((F.col("pos") + longest) / DEPTH_BIN))
    return records.select(F.col("rname").alias("contig"), F.explode(bins).alias("bin")).groupBy("contig", "bin").agg(F.count("*").alias("n")).where(F.col("n") > most).select("contig", "bin")


#: Ranges that a deep position's bases are ranked in before they are ranked together.
DEPTH_SALTS = 64


def depth_capped(aligned: DataFrame, most: int, records: DataFrame, contig: str = "rname") -> DataFrame:
    """At most so many bases of each reference position, the first in order of their records' ordinals.

    Whether any bin of positions is deep enough is asked at once, by a count of records alone; as a rule none is, and the bases are left as they are, in one pass. Else only bases in deep bins
    are ranked, first in DEPTH_SALTS parts of each position, so that no task gets more than so many times `most` of one."""
    deep = deep_bins(records, most)
    if deep.isEmpty():
        return aligned
    here = [F.col(contig) == F.col("contig"), F.floor(F.col("pos") / DEPTH_BIN) == F.col("bin")]
    found = aligned.join(deep, here, "left_semi").withColumn("salt", F.pmod(F.xxhash64("ordinal"), F.lit(DEPTH_SALTS)))
    for keys in ((contig, "pos", "salt"), (contig, "pos")):
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy("ordinal", "qpos"))
        found = found.withColumn("rank", rank).where(F.col("rank") <= most).drop("rank")
    return aligned.join(deep, here, "left_anti").unionByName(found.drop("salt"))


def reference_sites(blocks: DataFrame) -> DataFrame:
    """(contig, pos, context, strand) of all CpG and CH sites. Blocks (contig, block_start, seq) find their neighbours by an equi-join, so no contig is sorted whole."""
    seq = F.upper("seq")
    blocks = blocks.select("contig", "block_start", seq.alias("seq"))
    ends = blocks.select("contig", (F.col("block_start") + F.length("seq")).alias("block_start"), F.right("seq", F.lit(1)).alias("before"))
    starts = blocks.select("contig", F.col("block_start").alias("next_start"), F.left("seq", F.lit(1)).alias("after"))
    wide = blocks.withColumn("next_start", F.col("block_start") + F.length("seq")).join(ends, ["contig", "block_start"], "left").join(starts, ["contig", "next_start"], "left")
    padded = F.concat(F.coalesce("before", F.lit(".")), F.col("seq"), F.coalesce("after", F.lit(".")))
    at = wide.select("contig", "block_start", padded.alias("padded"), F.explode(F.sequence(F.lit(0), F.length("seq") - 1)).alias("i"))
    base = lambda k: F.substr("padded", F.col("i") + k, F.lit(1))
    found = at.select("contig", (F.col("block_start") + F.col("i")).cast("int").alias("pos"), chemistry.site(base(1), base(2), base(3)).alias("site"))
    return found.where("site is not null").select("contig", "pos", "site.context", "site.strand")


def as_sequenced(records: DataFrame, *carried: str) -> DataFrame:
    """Aligned bases as the machine read them: base and next_base in sequencing direction, placed_base and placed_next along the reference."""
    reverse = chemistry.is_reverse(F.col("flag"))
    placed = bases(records.withColumn("fwd", dna.sequenced(F.upper("seq"), reverse)), *carried, "flag", "fwd")
    at = F.when(reverse, F.col("length") - F.col("qpos") - 1).otherwise(F.col("qpos"))
    letter = lambda k: F.nullif(F.substr("fwd", at + k, F.lit(1)), F.lit(""))
    return placed.withColumns({"placed_base": F.col("base"), "placed_next": F.col("next_base"), "base": letter(1), "next_base": letter(2)}).drop("fwd")
