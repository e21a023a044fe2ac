"""FASTQ files, each read by many tasks where it is plain text or gzip in blocks.

A part of a file has the lines whose line break before them lies in its bytes (or blocks); the first part also has the first line. In a record of four lines only a
header begins with @ and has a + at the beginning of the line after the next, so a task finds its first record by that and reads to the end
of its last. `place` numbers a part's records; `fastq_counts` tells how many each part has, which makes places numbers within the file.
"""

from __future__ import annotations

import gzip
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from methylspark.sources.bgzf import MAGIC, Blocks, first_block, open_file

FASTQ = "file string, part int, place bigint, header string, seq string, plus string, qual string"
COUNTS = "file string, part int, records bigint"
#: Bytes of a part, as they stand in the file, and bytes that are read together.
SPLIT, TOGETHER = 64 << 20, 4 << 20


class Part(InputPartition):
    def __init__(self, path: str, part: int, start: int, end: int, kind: str):
        super().__init__((path, part))
        self.path, self.part, self.start, self.end, self.kind = path, part, start, end, kind


def parts_of(path: str, split: int) -> list[Part]:
    file = open_file(path)
    size, head = file.size(), file.read_at(min(18, file.size()), 0)
    kind = "blocks" if head[:4] == MAGIC and head[12:14] == b"BC" else "gzip" if head[:2] == MAGIC[:2] else "plain"
    if kind == "gzip":
        return [Part(path, 0, 0, size, kind)]
    return [Part(path, k, at, min(at + split, size), kind) for k, at in enumerate(range(0, max(1, size), split))]


def _chunks(part: Part) -> Iterator[tuple[bytes, bool]]:
    """Data from the part's beginning to the file's end, and whether it is the part's own."""
    file = open_file(part.path)
    if part.kind == "plain":
        for a, z, own in ((part.start, part.end, True), (part.end, file.size(), False)):
            for at in range(a, z, TOGETHER):
                yield file.read_at(min(TOGETHER, z - at), at), own
    elif part.kind == "gzip":
        file.seek(0)
        stream = gzip.GzipFile(fileobj=file)
        while data := stream.read(TOGETHER):
            yield data, True
    else:
        at = first_block(file, part.start, part.end)
        if at is not None:
            for place, data in Blocks(file, at):
                yield data, place < part.end


def records(part: Part) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Records of a part: data, where their lines begin, and where these end; four lines a record."""
    chunks = _chunks(part)
    data, own, ended = b"", 0, False

    def more() -> bool:
        nonlocal data, own, ended
        held = []
        size = 0
        while not ended and size < TOGETHER:
            chunk, mine = next(chunks, (None, False))
            if chunk is None:
                ended = True
                break
            if mine:
                own = len(data) + size + len(chunk)
            held.append(chunk)
            size += len(chunk)
        data = data + b"".join(held)
        if ended and data and not data.endswith(b"\n"):
            data += b"\n"
        return size > 0

    def lines(at: int) -> tuple[np.ndarray, np.ndarray]:
        ends = np.flatnonzero(np.frombuffer(data, np.uint8)[at:] == 10) + at
        return np.concatenate(([at], ends + 1))[: len(ends)], ends

    more()
    at = 0
    if part.start:
        while (at := data.find(b"\n") + 1) == 0 and own == len(data) and more():
            pass
        if not 0 < at <= own:
            return
        while True:
            starts, _ = lines(at)
            if len(starts) >= 7 or not more():
                break
        marks = [data[s : s + 1] for s in starts[:7].tolist()]
        first = next((k for k in range(min(4, len(marks) - 2)) if marks[k] == b"@" and marks[k + 2] == b"+"), None)
        if first is None:
            if len(starts) < 7:
                return
            raise ValueError(f"{part.path}: broken record after byte {part.start}")
        at = int(starts[first])
    while at <= own:
        starts, ends = lines(at)
        n = len(ends) // 4 * 4
        mine = int(np.searchsorted(starts[:n:4], own, side="right")) * 4
        if mine:
            s, e = starts[:mine], ends[:mine]
            body = np.frombuffer(data, np.uint8)
            if (body[s[::4]] != 64).any() or (body[s[2::4]] != 43).any():
                raise ValueError(f"{part.path}: broken record")
            yield body, s, e - (body[np.maximum(e - 1, 0)] == 13) * (e > s)
            at = int(ends[mine - 1]) + 1
        if mine < n or (ended and at == len(data)):
            return
        if ended:
            if at <= own:
                raise ValueError(f"{part.path}: broken record at its end")
            return
        data, own, at = data[at:], own - at, 0
        more()


def _lines(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    sizes = ends - starts
    until = np.cumsum(sizes)
    body = data[np.repeat(starts - (until - sizes), sizes) + np.arange(until[-1])]
    places = np.append(0, until).astype(np.int32)
    return pa.Array.from_buffers(pa.string(), len(sizes), [None, pa.py_buffer(places.tobytes()), pa.py_buffer(body.tobytes())])


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.paths, self.split = [p for p in options["path"].split(",") if p], int(options.get("split", SPLIT))

    def partitions(self) -> list[InputPartition]:
        return [p for path in self.paths for p in parts_of(path, self.split)]


class FastqReader(_Reader):
    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        place = 0
        for data, starts, ends in records(partition):
            n = len(starts) // 4
            columns = [_lines(data, starts[k::4], ends[k::4]) for k in range(4)]
            yield pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(partition.path), n), pa.array(np.full(n, partition.part, np.int32)), pa.array(np.arange(place, place + n)), *columns], names=["file", "part", "place", "header", "seq", "plus", "qual"])
            place += n


class CountsReader(_Reader):
    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        n = sum(len(starts) // 4 for _, starts, _ in records(partition))
        yield pa.RecordBatch.from_arrays([pa.array([partition.path]), pa.array([partition.part], pa.int32()), pa.array([n], pa.int64())], names=["file", "part", "records"])


def _source(kind: str, columns: str, reader: type[_Reader]) -> type[DataSource]:
    return type(kind, (DataSource,), {"name": classmethod(lambda cls: kind), "schema": lambda self: columns, "reader": lambda self, schema: reader(dict(self.options))})


FastqSource, CountsSource = _source("fastq_parts", FASTQ, FastqReader), _source("fastq_counts", COUNTS, CountsReader)
