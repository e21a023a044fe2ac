"""Readers of sequencing files. Each is a Spark data source that reads through Arrow's file systems (local paths, hdfs://, s3://, ...)."""

from __future__ import annotations

import gzip
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.window import Window

from methylspark.sources import fastq
from methylspark.sources.bam import BamSource

BATCH = 4096
FASTQ = "file string, ordinal bigint, header string, seq string, plus string, qual string"
#: Parts of FASTQ files up to which their counts are sent to all tasks; more are joined by a shuffle.
MOST_PARTS = 100_000
FASTA = "contig string, block_start int, seq string"


def _open(path: str):
    from pyarrow import fs

    system, name = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
    return system.open_input_stream(name, compression=None)


def _text(path: str) -> io.TextIOBase:
    raw = _open(path)
    stream = gzip.GzipFile(fileobj=raw) if path.endswith(".gz") else raw
    return io.TextIOWrapper(io.BufferedReader(stream) if not isinstance(stream, gzip.GzipFile) else stream, encoding="ascii")


class _File(InputPartition):
    def __init__(self, path: str):
        super().__init__(path)
        self.path = path


class _Files(DataSourceReader):
    """One partition a file: these formats are compressed as a whole or have records that no place in the file shows."""

    rows: staticmethod
    types: pa.Schema

    def __init__(self, options: dict[str, str]):
        self.paths = [p for p in options["path"].split(",") if p]
        self.options = options

    def partitions(self) -> list[InputPartition]:
        return [_File(p) for p in self.paths]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        block: list[tuple] = []
        for row in self.rows(partition.path, self.options):
            block.append(row)
            if len(block) == BATCH:
                yield self._batch(block)
                block = []
        if block:
            yield self._batch(block)

    def _batch(self, block: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*block, strict=True), self.types.types, strict=True)], schema=self.types)


def fasta_rows(path: str, options: dict[str, str]) -> Iterator[tuple]:
    """Blocks of each contig's bases, in upper case."""
    size = int(options.get("block", 10_000))
    with _text(path) as lines:
        name, start, held = None, 0, ""
        for line in lines:
            if line.startswith(">"):
                if held:
                    yield name, start, held
                name, start, held = line[1:].split()[0], 0, ""
            else:
                held += line.strip().upper()
                while len(held) >= size:
                    yield name, start, held[:size]
                    start, held = start + size, held[size:]
        if held:
            yield name, start, held


def _source(kind: str, columns: str, read, types: list[tuple[str, pa.DataType]]) -> type[DataSource]:
    reader = type(f"{kind}Reader", (_Files,), {"rows": staticmethod(read), "types": pa.schema(types)})
    return type(f"{kind}Source", (DataSource,), {"name": classmethod(lambda cls: kind), "schema": lambda self: columns, "reader": lambda self, schema: reader(dict(self.options))})


_S, _L, _I = pa.string(), pa.int64(), pa.int32()
SOURCES = {
    "fasta": _source("fasta", FASTA, fasta_rows, [("contig", _S), ("block_start", _I), ("seq", _S)]),
    "bam": BamSource,
}


def read(spark: SparkSession, kind: str, *paths: str, **options: str) -> DataFrame:
    """A DataFrame of these files: kind is fastq, fasta or bam."""
    if kind == "fastq":
        return _read_fastq(spark, list(paths), options)
    spark.dataSource.register(SOURCES[kind])
    return spark.read.format(kind).options(**options).option("path", ",".join(paths)).load()


def _read_fastq(spark: SparkSession, paths: list[str], options: dict[str, str]) -> DataFrame:
    """(file, ordinal, header, seq, plus, qual): ordinal is a record's number in its file, from a count of each part's records."""
    for source in (fastq.FastqSource, fastq.CountsSource):
        spark.dataSource.register(source)
    parts, counts = (spark.read.format(kind).options(**options).option("path", ",".join(paths)).load() for kind in ("fastq_parts", "fastq_counts"))
    split = int(options.get("split", fastq.SPLIT))
    number = [len(fastq.parts_of(p, split)) for p in paths]
    if max(number, default=1) == 1:
        found = parts.withColumnRenamed("place", "ordinal")
    else:
        before = Window.partitionBy("file").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        offsets = counts.select("file", "part", F.coalesce(F.sum("records").over(before), F.lit(0)).alias("before"))
        offsets = F.broadcast(offsets) if sum(number) <= MOST_PARTS else offsets
        found = parts.join(offsets, ["file", "part"]).withColumn("ordinal", F.col("before") + F.col("place"))
    return found.select("file", "ordinal", "header", "seq", "plus", "qual")


def read_regions(spark: SparkSession, regions: list[tuple[str, int, int]], *paths: str, **options: str) -> DataFrame:
    """Records of BAM files that reach into one of these (contig, first position, position after the last), each once; with an index beside a file little else of it is read."""
    spans = ";".join(f"{contig}:{lo + 1}-{hi}" for contig, lo, hi in regions)
    return read(spark, "bam", *paths, regions=spans, **options)


def read_pairs(spark: SparkSession, first: str, second: str, **options: str) -> DataFrame:
    """Read pairs by their place in both files; files of different length are an error."""
    r1, r2 = (read(spark, "fastq", p, **options).select("ordinal", *(F.col(c).alias(f"{a}{k}") for c, a in (("header", "h"), ("seq", "s"), ("plus", "p"), ("qual", "q")))) for k, p in ((1, first), (2, second)))
    both = r1.join(r2, "ordinal", "full")
    whole = F.when(F.col("h1").isNull() | F.col("h2").isNull(), F.raise_error(F.lit("the files of a pair differ in length"))).otherwise(F.col("h1"))
    return both.withColumn("h1", whole)


def with_cb(records: DataFrame) -> DataFrame:
    """Records with cb (the CB tag, or else what stands before the first colon of the name) and nh."""
    prefix = F.nullif(F.regexp_extract("qname", r"^([^:]*):", 1), F.lit(""))
    return records.withColumns({"cb": F.coalesce(F.col("tags")["CB"], prefix), "nh": F.col("tags")["NH"]})


def read_whitelist(spark: SparkSession, path: str) -> DataFrame:
    """(ord, barcode_index, seq): lines of `index sequence` or `sequence`, # begins a comment. Sequences are of A, C, G, T and N, of one length and, like indices, unique; else it is an error."""
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", "\r?\n")).alias("line", "text"))
    cleaned = lines.withColumn("text", F.trim(F.regexp_replace("text", "#.*", ""))).where("text <> ''")
    rows = [(r.text.split(), r.line) for r in cleaned.orderBy("line").collect()]  # a whitelist is a configuration: some hundred lines
    width = max(2, len(str(max(0, len(rows) - 1))))
    out = [(k, parts[0] if len(parts) == 2 else str(k).zfill(width), parts[-1].upper()) for k, (parts, _) in enumerate(rows)]
    seqs, names = [s for *_, s in out], [n for _, n, _ in out]
    if any(len(p) > 2 for p, _ in rows) or any(set(s) - set("ACGTN") for s in seqs) or len({len(s) for s in seqs}) > 1 or len(set(seqs)) < len(seqs) or len(set(names)) < len(names) or any(not n.replace("-", "").replace("_", "").replace(".", "").isalnum() for n in names):
        raise ValueError(f"{path}: not a whitelist")
    return spark.createDataFrame(out, "ord int, barcode_index string, seq string")


def read_coverage(spark: SparkSession, path: str, context: str) -> DataFrame:
    """Rows of *.<context>.cov files below a folder, with their spot; rows that don't parse are left out."""
    names = ["rname", "start", "end", "pct", "meth", "unmeth", "context", "strand"]
    raw = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", f"*.{context}.cov").text(path)
    parts = F.split("value", "\t")
    kinds = dict(zip(names, ("string", "int", "int", "double", "bigint", "bigint", "string", "string"), strict=True))
    rows = raw.select(F.regexp_extract(F.input_file_name(), rf"([^/]+)\.{context}\.cov$", 1).alias("spot_id"), *(F.get(parts, F.lit(k)).try_cast(kinds[n]).alias(n) for k, n in enumerate(names)))
    return rows.where("meth is not null and unmeth is not null and start is not null")
