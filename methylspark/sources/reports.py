"""Readers of what earlier steps report, and of lists that name contigs and files. All are small files; each gives one row or a few."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

READS = ("R1", "R2")


def find_pair(spark: SparkSession, folder: str) -> tuple[str, str]:
    """The two FASTQ files of a folder, R1 first: names with R1 or R2 between other signs than letters and digits, ending in .fastq or .fq, with .gz or not. Any other number of files, or of either mate, is an error."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.{fastq,fq,FASTQ,FQ,Fastq,Fq}{,.gz,.GZ,.Gz}").load(folder).select("path")
    paths = sorted(r.path for r in files.collect())
    if len(paths) != 2:
        raise ValueError(f"{folder}: {len(paths)} FASTQ files, not two")
    mates = [[p for p in paths if re.search(rf"(^|[^0-9A-Za-z])[Rr]{k}([^0-9A-Za-z]|$)", p.rsplit("/", 1)[-1])] for k in (1, 2)]
    if any(len(m) != 1 for m in mates) or mates[0] == mates[1]:
        raise ValueError(f"{folder}: one R1 and one R2 are needed")
    return mates[0][0], mates[1][0]


def read_bias(spark: SparkSession, path: str) -> DataFrame:
    """(read, cycle, coverage, methylation_rate) of a table of cycles; rows without a rate and of other reads are left out, a missing column is an error."""
    rows = spark.read.csv(path, sep="\t", header=True)
    if missing := {"read", "cycle", "coverage", "methylation_rate"} - set(rows.columns):
        raise ValueError(f"{path} has no column {', '.join(sorted(missing))}")
    kept = rows.where(F.col("read").isin(*READS) & (F.col("methylation_rate") != "NA"))
    return kept.select("read", F.col("cycle").cast("int"), F.col("coverage").cast("bigint"), F.col("methylation_rate").cast("double"))


def read_trims(spark: SparkSession, path: str) -> dict[str, tuple[int, int]]:
    """Left and right trims of both reads, the seventh and eighth column of their last rows; other text than digits, or a read without a row, is an error."""
    rows = spark.read.text(path, wholetext=True).first()
    found: dict[str, list[str]] = {}
    for line in (rows.value if rows else "").splitlines()[1:]:
        fields = line.split("\t")
        if fields[0] in READS:
            found[fields[0]] = fields[6:8]
    if any(len(found.get(r, ())) != 2 or not all(x.isdecimal() and x.isascii() for x in found[r]) for r in READS):
        raise ValueError(f"{path} has no trims of both reads")
    return {r: (int(found[r][0]), int(found[r][1])) for r in READS}


def _json(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, wholetext=True)


def _number(*names: str) -> list[Column]:
    """Whole numbers at these places of a JSON text, fractions cut off; null for anything else."""
    return [F.get_json_object("value", f"$.{n}").try_cast("double").try_cast("bigint") for n in names]


def read_raw_reads(spark: SparkSession, path: str) -> DataFrame:
    """One row: reads before trimming, by the first of three places of the trimmer's report that has a number."""
    return _json(spark, path).select(F.coalesce(*_number("summary.before_filtering.total_reads", "summary.total_reads", "total_reads")).alias("raw_reads"))


def read_gbp(spark: SparkSession, path: str) -> DataFrame:
    """One row: billions of bases after trimming, else before; null without a positive number."""
    bases = [F.when(n > 0, n) for n in _number("summary.after_filtering.total_bases", "summary.before_filtering.total_bases")]
    return _json(spark, path).select((F.coalesce(*bases) / 1e9).alias("gbp"))


def read_barcoded_reads(spark: SparkSession, path: str) -> DataFrame:
    """One row: reads with barcodes, two for each pair that extraction kept."""
    return _json(spark, path).select((_number("kept_reads")[0] * 2).alias("barcoded_reads"))


def read_saturation_rate(spark: SparkSession, path: str) -> str | None:
    """The rate in the first row of a saturation table, as it is written; None where there is none."""
    row = spark.read.text(path, wholetext=True).first()
    lines = row.value.splitlines() if row else []
    cells = dict(zip(lines[0].split("\t"), lines[1].split("\t"), strict=False)) if len(lines) > 1 else {}
    return cells.get("saturation_rate", "").strip() or None


def contig_list(text: str) -> list[str]:
    """Contigs of a list such as "chr1, chr2"."""
    return [c for c in (part.strip() for part in text.split(",")) if c]


def checked_contigs(names: list[str], blocks: DataFrame) -> list[str]:
    """The same names; one that no reference block has is an error."""
    asked = blocks.sparkSession.createDataFrame([(n,) for n in names], "contig string")
    missing = [r.contig for r in asked.join(blocks.select("contig"), "contig", "left_anti").orderBy("contig").collect()]
    if missing:
        raise ValueError(f"not in the reference: {', '.join(missing)}")
    return names


def spike_names(spark: SparkSession, folder: str, contexts: tuple[str, ...]) -> list[str]:
    """Names of the targets that have coverage files <name>.<context>.cov in a folder, but the host's mitochondrion."""
    from pyarrow import fs

    system, root = fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)
    # listed by hand, since Spark's readers pass over empty files
    names = [f.base_name.removesuffix(".cov").rpartition(".") for f in system.get_file_info(fs.FileSelector(root)) if f.type == fs.FileType.File and f.base_name.endswith(".cov")]
    return sorted({name for name, _, context in names if context in contexts and name not in ("host_mito", "")})


MANIFEST = ("spot_id", "barcode1_index", "barcode2_index", "raw_cb")


def read_manifest(spark: SparkSession, path: str, *, indexed: bool = True) -> DataFrame:
    """(spot_id, x, y, raw_cb) of a table of spots, as `write_manifest` makes it: rows without a spot, a CB or, with `indexed`, whole numbers as indices are left out. Of rows that
    repeat a spot or CB the last counts. A missing column, or no usable row, is an error."""
    needed = MANIFEST if indexed else ("spot_id", "raw_cb")
    lines = spark.read.text(path, wholetext=True).first()
    rows = [line.split("\t") for line in (lines.value if lines else "").splitlines() if line]  # one row a spot: some thousand
    if not rows or (missing := set(needed) - set(rows[0])):
        raise ValueError(f"{path} has no column {', '.join(sorted(missing)) if rows else 'at all'}")
    at = {name: rows[0].index(name) for name in needed}
    found: dict[str, tuple] = {}
    for row in rows[1:]:
        cells = {name: (row[k].strip() if k < len(row) else "") for name, k in at.items()}
        numbers = [cells.get(c, "") for c in ("barcode1_index", "barcode2_index")]
        whole = [int(n) if n.lstrip("+-").isdecimal() else None for n in numbers]
        if cells["spot_id"] and cells["raw_cb"] and not (indexed and None in whole):
            found[cells["raw_cb"].upper()] = (cells["spot_id"], *whole)
    if not found:
        raise ValueError(f"{path} has no usable row")
    return spark.createDataFrame([(spot, x, y, cb) for cb, (spot, x, y) in found.items()], "spot_id string, x int, y int, raw_cb string")
