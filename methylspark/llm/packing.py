"""Harmonic packing of documents into fixed-length token sequences.

What a document has beyond whole sequences, its rest, is of class k where k of its length fit in a sequence and k + 1 don't; a bin of class k takes k rests. What
a full bin leaves free, less than 1 / (k + 1) of it, is filled with tokens cut from a rest that is given up for this, the filler, so that nothing is padded.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from methylspark.llm.encoding import encoder

PIECES = "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint, class int"


#: Full bins that wait for filling, at most, before a rest of any class becomes the filler; until then one of class 1 does.
WAITING = 8


@dataclass
class Item:
    """Tokens of a document from `start` on, 4 bytes each, and how many the document has."""

    doc: int | None
    start: int
    data: bytes
    total: int

    def __len__(self) -> int:
        return len(self.data) // 4

    def cut(self, n: int) -> Item:
        """The first n tokens, which are taken away."""
        head = Item(self.doc, self.start, self.data[: 4 * n], self.total)
        self.start, self.data = self.start + n, self.data[4 * n :]
        return head


class Bins:
    """One worker's open bins, and the pieces that have a place: (item, sequence, offset, class; 0 for what was cut to fill)."""

    def __init__(self, capacity: int, first_sequence: int):
        self.capacity, self.next = capacity, first_sequence
        self.open: dict[int, list[Item]] = {}
        self.waiting: list[tuple[int, list[Item]]] = []
        self.filler: Item | None = None
        self.done: list[tuple[Item, int, int, int]] = []

    def _sequence(self, items: list[tuple[Item, int]]) -> None:
        at = 0
        for item, kind in items:
            self.done.append((item, self.next, at, kind))
            at += len(item)
        self.next += 1

    def add(self, item: Item) -> None:
        for at in range(0, len(item) - self.capacity + 1, self.capacity):
            self._sequence([(Item(item.doc, item.start + at, item.data[4 * at : 4 * (at + self.capacity)], item.total), 1)])
        item.cut(len(item) // self.capacity * self.capacity)
        if not len(item):
            return
        kind = self.capacity // len(item)
        if self.filler is None and self.waiting and (kind == 1 or len(self.waiting) > WAITING):
            self.filler = item
            self._fill()
            return
        held = self.open.setdefault(kind, [])
        held.append(item)
        if len(held) == kind:
            del self.open[kind]
            self.waiting.append((kind, held))
            self._fill()

    def _fill(self) -> None:
        """Closes waiting bins while there is something to fill them with."""
        while self.waiting:
            kind, items = self.waiting[-1]
            free = self.capacity - sum(map(len, items))
            if free and self.filler is None:
                return
            part: list[tuple[Item, int]] = []
            if free:
                if len(self.filler) < free:
                    # what is left of the filler joins the bin, which waits on
                    items.append(self.filler)
                    self.filler = None
                    continue
                part = [(self.filler.cut(free), 0)]
                if not len(self.filler):
                    self.filler = None
            self.waiting.pop()
            self._sequence([*((x, kind if k < kind else 0) for k, x in enumerate(items)), *part])

    def close(self) -> None:
        """Deals what is left to whole sequences, and its end to sequences of a power of two tokens, which aren't padded."""
        left = [x for _, items in self.waiting for x in items] + [x for _, items in sorted(self.open.items()) for x in items] + ([self.filler] if self.filler else [])
        self.open, self.waiting, self.filler = {}, [], None
        rest = sum(map(len, left))
        at = 0
        while rest:
            size = self.capacity if rest >= self.capacity else 1 << (rest.bit_length() - 1)
            rest -= size
            row = []
            while size:
                n = min(size, len(left[at]))
                row.append((left[at].cut(n), 0))
                size -= n
                at += not len(left[at])
            self._sequence(row)


def _packed(batches: Iterator[pa.RecordBatch], path: str, capacity: int, end_id: int) -> Iterator[pa.RecordBatch]:
    encode = encoder(path)
    bins = Bins(capacity, TaskContext.get().partitionId() << 33)

    def placed() -> Iterator[pa.RecordBatch]:
        if bins.done:
            items, sequence, offset, kind = map(list, zip(*bins.done, strict=True))
            bins.done = []
            kinds = [([x.doc for x in items], pa.int64()), ([x.start for x in items], pa.int64()), ([len(x) for x in items], pa.int64()), ([x.data for x in items], pa.binary()), ([x.total for x in items], pa.int64()), (sequence, pa.int64()), (offset, pa.int64()), (kind, pa.int32())]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in kinds], names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "class"])

    for b in batches:
        docs = iter(b.column(0).to_pylist())
        for block in encode.column(b.column(1)):
            for ids, doc in zip(block, docs, strict=False):
                bins.add(Item(doc, 0, np.append(ids, end_id).astype("<u4").tobytes(), len(ids) + 1))
            yield from placed()
    bins.close()
    yield from placed()


def harmonic_pack(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 0) -> DataFrame:
    """Pieces of documents with their places in sequences of at most `capacity` tokens (a power of two).

    A document's ids are its text's by the tokenizer file, then `end_id`. Whole sequences are cut off first; the rest, n tokens, is a piece of
    class capacity // n. Bins of class k take k rests, and are filled with pieces of class 0, cut from some rests. Each worker fills its own bins and holds less than one bin
    of each class, of which there are less than twice the root of `capacity`, and some that wait to be filled; nothing is shuffled. At its end a worker
    deals what is left to whole sequences and some of a power of two tokens, as pieces of class 0.

    Columns: doc_id, start, length, ids (little-endian uint32), doc_tokens, sequence_id, offset, class.
    Null and empty texts have the end id alone; a null doc_id stays null; equal rows are packed one by one; further
    columns of `docs` are ignored; an empty table gives an empty one.
    """
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(lambda it: _packed(it, tokenizer, capacity, end_id), PIECES)


def digest(ids: bytes) -> int:
    """What F.crc32 gives for a piece's ids."""
    return zlib.crc32(ids)
