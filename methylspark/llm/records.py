"""Token ids in files of length-delimited binary records, with an offset index beside each file.

A file is a run of records, each: payload length (8 bytes, little-endian), masked checksum of these 8 bytes (4), the payload,
masked checksum of the payload (4). The checksum is CRC-32, masked as rotate-right(crc, 15) + 0xA282EAD8 modulo 2**32, so that a
checksum stored within checked data does no harm. A payload is: doc_id (8, signed), bytes per id (1), then the ids
little-endian. `<file>.idx` holds for each record its offset in the file and the ids in the records before it (8 bytes each), for reads in any order
and for reading a file in parts.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from methylspark.llm.encoding import encoder
from methylspark.llm.store import written

#: Added to a rotated checksum (fixed value of the record format).
MASK_DELTA = 0xA282EAD8
FILES = "file int, path string, docs bigint, tokens bigint, bytes bigint"
#: Bytes of records that a task reads (about; a record is never split).
PART_BYTES = 16 << 20
#: Stored for a null doc_id.
NULL_ID = -(1 << 63)


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    head = struct.pack("<Q", len(payload))
    return b"".join((head, struct.pack("<I", masked(head)), payload, struct.pack("<I", masked(payload))))


def unframe(data: bytes | memoryview, at: int) -> tuple[memoryview, int]:
    """The payload of the record at this offset, and the next record's offset. A broken record raises."""
    view = memoryview(data)
    head = view[at : at + 8]
    if len(head) < 8 or masked(head) != struct.unpack_from("<I", view, at + 8)[0]:
        raise ValueError(f"broken record length at {at}")
    n = struct.unpack("<Q", head)[0]
    payload = view[at + 12 : at + 12 + n]
    if len(payload) < n or masked(payload) != struct.unpack_from("<I", view, at + 12 + n)[0]:
        raise ValueError(f"broken record at {at}")
    return payload, at + 16 + n


def parse(payload: memoryview) -> tuple[int | None, np.ndarray]:
    doc, width = struct.unpack_from("<qB", payload)
    return None if doc == NULL_ID else doc, np.frombuffer(payload[9:], f"<u{width}")


def _opened(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def _write(batches: Iterator[pa.RecordBatch], folder: str, tokenizer: str, end_id: int) -> Iterator[pa.RecordBatch]:
    """One file of a partition's documents. It gets its name when whole, so a task that is run again replaces it."""
    encode = encoder(tokenizer)
    end = np.array([end_id], encode.dtype).tobytes()
    k = TaskContext.get().partitionId()
    fs, top = _opened(folder)
    fs.create_dir(top, recursive=True)
    name, mark = f"{top}/part-{k:06d}.rec", uuid.uuid4().hex
    docs = tokens = at = 0
    offsets = []
    with fs.open_output_stream(f"{top}/_{mark}") as out:
        for b in batches:
            names = iter(b.column(0).to_pylist())
            for found in encode.column(b.column(1)):
                block = []
                for ids, doc in zip(found, names, strict=False):
                    ids = ids.tobytes() + end
                    record = frame(struct.pack("<qB", NULL_ID if doc is None else doc, encode.dtype.itemsize) + ids)
                    offsets += (at, tokens)
                    at += len(record)
                    tokens += len(ids) // encode.dtype.itemsize
                    docs += 1
                    block.append(record)
                out.write(b"".join(block))
    if not docs:
        fs.delete_file(f"{top}/_{mark}")
        return
    with fs.open_output_stream(f"{top}/_{mark}.idx") as out:
        out.write(np.array(offsets, "<u8").tobytes())
    fs.move(f"{top}/_{mark}.idx", f"{name}.idx")
    fs.move(f"{top}/_{mark}", name)
    uri = f"{folder.rstrip('/')}/part-{k:06d}.rec"
    yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([uri]), *(pa.array([v], pa.int64()) for v in (docs, tokens, at))], names=["file", "path", "docs", "tokens", "bytes"])


def write_records(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Writes each document's ids (its text's, then `end_id`) in ascending doc_id order to record files in `folder`.

    Documents are dealt by ranges of doc_id, one file a partition, sorted within; Spark chooses the partitions'
    number by size. Returns one row a file: file (ascending with doc_id), path, docs, tokens, bytes, first_token
    (ids in the files before it). Null doc_ids come first, equal ones in order of their texts; null texts are
    empty; further columns are ignored; an empty table gives no file.
    """
    ordered = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    files = written(ordered.mapInArrow(lambda it: _write(it, folder, tokenizer, end_id), FILES), "record-files")
    before = F.sum("tokens").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1))
    return files.withColumn("first_token", F.coalesce(before, F.lit(0)))


def _index(fs, name: str, first: int, last: int) -> np.ndarray:
    """Offsets and ids before them of the records first to last - 1, and where the last one ends."""
    with fs.open_input_file(f"{name}.idx") as f:
        whole = f.size() // 16
        rows = np.frombuffer(f.read_at(16 * (min(last + 1, whole) - first), 16 * first), "<u8").reshape(-1, 2)
    return rows if last < whole else np.concatenate((rows, [[fs.get_file_info(name).size, 0]])).astype(np.uint64)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The records of parts of files: path, first and last position, ids before the file."""
    for b in batches:
        for path, first, last, before in zip(*(b.column(k).to_pylist() for k in range(4)), strict=True):
            fs, name = _opened(path)
            index = _index(fs, name, first, last).astype(np.int64)
            with fs.open_input_file(name) as f:
                lo = 0
                while lo < last - first:
                    # about 4 MB of records, at least one
                    hi = max(lo + 1, int(np.searchsorted(index[:, 0], index[lo, 0] + (1 << 22), side="right")) - 1)
                    data, at = f.read_at(index[hi, 0] - index[lo, 0], index[lo, 0]), 0
                    docs, ids, n = [], [], before + int(index[lo, 1])
                    starts = []
                    for _ in range(lo, hi):
                        payload, at = unframe(data, at)
                        doc, found = parse(payload)
                        docs.append(doc)
                        starts.append(n)
                        ids.append(found.astype("<u4").tobytes())
                        n += len(found)
                    yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(starts, pa.int64()), pa.array(ids, pa.binary())], names=["doc_id", "start", "ids"])
                    lo = hi


def read_records(spark: SparkSession, files: DataFrame) -> DataFrame:
    """All records of these files (rows of `write_records`), checksums tested: doc_id, start (ids of all documents before it), ids (little-endian uint32).

    Files are read in parts of about PART_BYTES, found by their indices, each by a task of its own.
    """
    parts = F.greatest(F.lit(1), F.least(F.col("docs"), F.ceil(F.col("bytes") / PART_BYTES)))
    edge = lambda k: F.floor(F.col("docs") * k / F.col("parts")).cast("bigint")
    dealt = files.withColumn("parts", parts).select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("part"))
    dealt = dealt.select("path", edge(F.col("part")).alias("first"), edge(F.col("part") + 1).alias("last"), "first_token").where("last > first")
    n = files.agg(F.sum(parts).alias("n")).first().n or 1
    return dealt.repartition(n).mapInArrow(_read, "doc_id bigint, start bigint, ids binary")


def read_at(path: str, positions: list[int]) -> list[tuple[int | None, np.ndarray]]:
    """The records at these positions of one file, in the order asked for, by its offset index."""
    fs, name = _opened(path)
    out = []
    with fs.open_input_file(name) as f:
        for p in positions:
            lo, hi = _index(fs, name, p, p + 1)[:, 0].tolist()
            payload, _ = unframe(f.read_at(hi - lo, lo), 0)
            out.append(parse(payload))
    return out
