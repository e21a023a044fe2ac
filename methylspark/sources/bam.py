"""BAM files, each read by many tasks, or only where an index says that a region's records are.

A file is cut by bytes. A task finds the first block that begins in its part, and in its data the first record: a place from which a chain of records
follows, each with fields that this file allows. It reads all records that begin in blocks of its part, the last one to its end. `ordinal` is a record's virtual place
in its file (block << 16 | place within its data), so ordinals ascend in file order whatever the parts are.

With `regions` and an index beside the file (.bai or .csi), only the chunks are read that can hold records which reach into the regions; without an index, the file is
read whole and the same records are given. Regions are an option and no pushed-down filter: Spark 4.1 keeps the filters that a Python source was
given first for all later uses of the same DataFrame.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from methylspark.sources.bgzf import Blocks, Stream, exists, first_block, open_file

BAM = "file string, ordinal bigint, qname string, flag int, rname string, pos int, mapq int, cigar string, rnext string, pnext int, tlen int, seq string, qual array<int>, tags map<string,string>"
TYPES = pa.schema(
    [("file", pa.string()), ("ordinal", pa.int64()), ("qname", pa.string()), ("flag", pa.int32()), ("rname", pa.string()), ("pos", pa.int32()), ("mapq", pa.int32()), ("cigar", pa.string()), ("rnext", pa.string()), ("pnext", pa.int32()), ("tlen", pa.int32()), ("seq", pa.string()), ("qual", pa.list_(pa.int32())), ("tags", pa.map_(pa.string(), pa.string()))]
)
#: Codes of bases and of CIGAR operations in a record (fixed values of the format), and which operations move in the reference.
BASES, OPERATIONS = "=ACMGRSVTWYHKDBN", "MIDNSHP=X"
IN_REFERENCE = np.array([op in "MDN=X" for op in OPERATIONS] + [False] * 7)
#: A record's fields of fixed size.
HEAD = np.dtype([("size", "<i4"), ("ref", "<i4"), ("pos", "<i4"), ("name", "u1"), ("mapq", "u1"), ("bin", "<u2"), ("cigar", "<u2"), ("flag", "<u2"), ("seq", "<i4"), ("next_ref", "<i4"), ("next_pos", "<i4"), ("tlen", "<i4")])
#: Compressed bytes of a part, data that is decoded together, records that must follow one another, and the most bytes of one.
SPLIT, TOGETHER, CHAIN, LONGEST = 32 << 20, 2 << 20, 8, 1 << 28
_SIZES = {"A": "c", "c": "b", "C": "B", "s": "h", "S": "H", "i": "i", "I": "I", "f": "f"}
_PAIRS = np.frombuffer("".join(BASES[b >> 4] + BASES[b & 15] for b in range(256)).encode(), np.uint8).reshape(256, 2)


@dataclass
class Header:
    """Names and lengths of a file's contigs, and the virtual place of its first record."""

    names: list[str]
    lengths: np.ndarray
    first: int


def header(file, path: str) -> Header:
    stream = Stream(Blocks(file, 0, ahead=1 << 16))
    at = 0

    def take(n: int) -> bytes:
        nonlocal at
        if not stream.ensure(at + n):
            raise ValueError(f"{path}: the header is cut off")
        at += n
        return bytes(stream.data[at - n : at])

    def number() -> int:
        return struct.unpack("<i", take(4))[0]

    if take(4) != b"BAM\x01":
        raise ValueError(f"{path}: not a BAM file")
    take(number())
    names, lengths = [], []
    for _ in range(number()):
        names.append(take(number())[:-1].decode())
        lengths.append(number())
    while at == len(stream.data) and stream.more():
        pass
    stream.drop(at)
    return Header(names, np.array(lengths, np.int64), stream.places[-1] if stream.data else file.size() << 16)


def _plausible(data: np.ndarray, head: Header) -> np.ndarray:
    """Places at which a record may begin, by its fields of fixed size and the end of its name."""
    n = len(data) - HEAD.itemsize
    if n <= 0:
        return np.zeros(0, np.int64)

    def field(name: str) -> np.ndarray:
        kind, at = HEAD.fields[name]
        # four (two) interleaved views, so that nothing is copied byte by byte
        out = np.empty(n, np.int64)
        for k in range(kind.itemsize):
            part = data[at + k : at + k + (n - k + kind.itemsize - 1) // kind.itemsize * kind.itemsize]
            out[k::kind.itemsize] = np.frombuffer(part.tobytes(), kind)[: len(out[k::kind.itemsize])]
        return out

    size, ref, next_ref = field("size"), field("ref"), field("next_ref")
    contigs = len(head.names)
    ok = (size >= 32) & (size <= LONGEST) & (ref >= -1) & (ref < contigs) & (next_ref >= -1) & (next_ref < contigs) & (data[12 : 12 + n] > 0)
    at = np.flatnonzero(ok)
    if not len(at):
        return at
    limit = np.append(head.lengths, np.iinfo(np.int32).max)
    fields = data[at[:, None] + np.arange(HEAD.itemsize)].copy().view(HEAD)[:, 0]
    wide = {k: fields[k].astype(np.int64) for k in ("size", "name", "cigar", "seq", "pos", "next_pos", "ref", "next_ref")}
    ok = (wide["seq"] >= 0) & (32 + wide["name"] + 4 * wide["cigar"] + (wide["seq"] + 1) // 2 + wide["seq"] <= wide["size"])
    for pos, ref in (("pos", "ref"), ("next_pos", "next_ref")):
        ok &= (wide[pos] >= -1) & (wide[pos] <= limit[wide[ref]])
    last = at + HEAD.itemsize + wide["name"] - 1
    ok &= (last >= len(data)) | (data[np.minimum(last, len(data) - 1)] == 0)
    return at[ok]


def first_record(stream: Stream, head: Header, end: int) -> int | None:
    """The place in the stream's data of the first record that begins in a block before `end`; None where none does."""
    want = 1 << 17
    while True:
        whole = not stream.ensure(want)
        data = np.frombuffer(bytes(stream.data), np.uint8)
        good = set(_plausible(data, head).tolist())
        limit = next((s for s, p in zip(stream.starts, stream.places, strict=True) if p >> 16 >= end), None)
        short = False
        for at in sorted(good):
            if limit is not None and at >= limit:
                return None
            k, links = at, 0
            while links < CHAIN and k in good:
                k += 4 + int(struct.unpack_from("<i", stream.data, k)[0])
                links += 1
            if links == CHAIN or (whole and k == len(data)):
                return at
            if not whole and k + HEAD.itemsize >= len(data):
                short = True  # its chain goes on beyond what is here
                break
        if whole or (limit is not None and not short):
            return None
        want = 2 * len(data)


def _gathered(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """These parts of the data, one after the other."""
    until = np.cumsum(sizes)
    return data[np.repeat(starts - (until - sizes), sizes) + np.arange(until[-1] if len(until) else 0)]


def _strings(body: np.ndarray, sizes: np.ndarray) -> pa.Array:
    places = np.append(0, np.cumsum(sizes)).astype(np.int32)
    return pa.Array.from_buffers(pa.string(), len(sizes), [None, pa.py_buffer(places.tobytes()), pa.py_buffer(body.tobytes())])


def tags_of(data: bytes, wanted: frozenset[str] | None = None) -> list[tuple[str, str]]:
    """A record's tags as text, those wanted (None: all)."""
    out, at = [], 0
    while at < len(data):
        name, kind = data[at : at + 2].decode(), chr(data[at + 2])
        keep = wanted is None or name in wanted
        at += 3
        if kind in "ZH":
            end = data.index(0, at)
            value, at = data[at:end], end + 1
            if keep:
                out.append((name, value.decode()))
        elif kind == "B":
            n = struct.unpack_from("<I", data, at + 1)[0]
            form = f"<{n}{_SIZES[chr(data[at])]}"
            if keep:
                out.append((name, ",".join(map(str, struct.unpack_from(form, data, at + 5)))))
            at += 5 + struct.calcsize(form)
        else:
            value = struct.unpack_from(f"<{_SIZES[kind]}", data, at)[0]
            at += struct.calcsize(_SIZES[kind])
            if keep:
                out.append((name, value.decode() if kind == "A" else str(value)))
    return out


def _cigars(data: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> tuple[list[str | None], np.ndarray]:
    """CIGARs as text, and how far each reaches in the reference."""
    body = _gathered(data, starts, 4 * counts)
    ops = body.view("<u4")
    moved = np.where(IN_REFERENCE[ops & 15], ops >> 4, 0).astype(np.int64)
    until = np.append(0, np.cumsum(moved))
    at = np.append(0, np.cumsum(counts))
    known: dict[bytes, str | None] = {b"": None}
    raw, out = body.tobytes(), []
    for a, z in zip((4 * at[:-1]).tolist(), (4 * at[1:]).tolist(), strict=True):
        ops = raw[a:z]
        if ops not in known:
            known[ops] = "".join([f"{c >> 4}{OPERATIONS[c & 15]}" for c in struct.unpack(f"<{len(ops) // 4}I", ops)])
        out.append(known[ops])
    return out, until[at[1:]] - until[at[:-1]]


def decoded(path: str, data: np.ndarray, at: np.ndarray, places: np.ndarray, head: Header, wanted: frozenset[str] | None, regions: list[tuple[str, int, int]] | None = None) -> pa.RecordBatch:
    """Rows of the records that begin at these places of the data; with `regions` those that reach into one of them."""
    fields = data[at[:, None] + np.arange(HEAD.itemsize)].copy().view(HEAD)[:, 0] if len(at) else np.zeros(0, HEAD)
    name, count, letters = (fields[k].astype(np.int64) for k in ("name", "cigar", "seq"))
    names_at = at + HEAD.itemsize
    cigar, reach = _cigars(data, names_at + name, count)
    if regions is not None:
        begin = fields["pos"].astype(np.int64)
        keep = np.zeros(len(at), bool)
        for contig, lo, hi in regions:
            if contig in head.names:
                keep |= (fields["ref"] == head.names.index(contig)) & (begin < hi) & (begin + np.maximum(reach, 1) > lo)
        keep = np.flatnonzero(keep)
        if len(keep) < len(at):
            return decoded(path, data, at[keep], places[keep], head, wanted)
    seq_at = names_at + name + 4 * count
    packed = (letters + 1) // 2
    both = _PAIRS[_gathered(data, seq_at, packed)].ravel()
    odd = letters % 2 == 1
    seq = np.delete(both, np.cumsum(2 * packed)[odd] - 1) if odd.any() else both
    qual_at = seq_at + packed
    missing = (letters > 0) & (data[np.minimum(qual_at, len(data) - 1)] == 255)
    shown = np.where(missing, 0, letters)
    qual = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(shown)).astype(np.int32)), pa.array(_gathered(data, qual_at, shown).astype(np.int32)), mask=pa.array(missing))
    tags_at, ends = qual_at + letters, at + 4 + fields["size"]
    raw = data.tobytes() if wanted is None or wanted else b""
    tags = [tags_of(raw[a:z], wanted) if raw else [] for a, z in zip(tags_at.tolist(), ends.tolist(), strict=True)]
    contigs = pa.array([*head.names, None], pa.string())
    ints = {k: pa.array(fields[k].astype(np.int32)) for k in ("flag", "pos", "mapq", "next_pos", "tlen")}
    contig, other = (contigs.take(pa.array(np.where(fields[k] < 0, len(head.names), fields[k]).astype(np.int64))) for k in ("ref", "next_ref"))
    columns = [pa.repeat(pa.scalar(path), len(at)), pa.array(places), _strings(_gathered(data, names_at, name - 1), name - 1), ints["flag"], contig, ints["pos"], ints["mapq"], pa.array(cigar, pa.string()), other, ints["next_pos"], ints["tlen"], _strings(seq, letters), qual, pa.array(tags, TYPES.field("tags").type)]
    return pa.RecordBatch.from_arrays(columns, schema=TYPES)


@dataclass
class Index:
    """Chunks of virtual places by contig and bin, and the least place that a record in each stretch of 2**shift positions can have."""

    shift: int
    depth: int
    bins: list[dict[int, list[tuple[int, int]]]]
    least: list[dict[int, int]]
    linear: list[np.ndarray] | None

    def chunks(self, contig: int, lo: int, hi: int) -> list[tuple[int, int]]:
        """Ranges of virtual places that hold all records of a contig that reach into positions lo to hi - 1."""
        if contig >= len(self.bins):
            return []
        top = 1 << (self.shift + 3 * self.depth)
        lo, hi = max(0, lo), min(hi, top)
        if lo >= hi:
            return []
        found, first, floor = [], 0, 0
        if self.linear is not None and len(self.linear[contig]):
            table = self.linear[contig]
            floor = int(table[min(lo >> self.shift, len(table) - 1)])
        for level in range(self.depth + 1):
            span = self.shift + 3 * (self.depth - level)
            own = self.bins[contig]
            a, z = first + (lo >> span), first + ((hi - 1) >> span)
            for b in range(a, z + 1) if z - a < len(own) else (b for b in own if a <= b <= z):
                found += own.get(b, [])
                if b == a and self.linear is None:
                    floor = max(floor, self.least[contig].get(b, 0))
            first += 1 << (3 * level)
        out: list[tuple[int, int]] = []
        for a, z in sorted((max(a, floor), z) for a, z in found if z > floor):
            if out and a >> 16 <= out[-1][1] >> 16:
                out[-1] = out[-1][0], max(z, out[-1][1])
            else:
                out.append((a, z))
        return out


def read_index(path: str) -> Index:
    """A .bai or a .csi file."""
    file = open_file(path)
    data = file.read_at(file.size(), 0)
    if data[:2] == b"\x1f\x8b":
        stream = Stream(Blocks(file, 0))
        while stream.more():
            pass
        data = bytes(stream.data)
    kind = data[:4]
    if kind not in (b"BAI\x01", b"CSI\x01"):
        raise ValueError(f"{path}: not an index")
    at = 4

    def take(form: str) -> tuple:
        nonlocal at
        out = struct.unpack_from(f"<{form}", data, at)
        at += struct.calcsize(f"<{form}")
        return out

    shift, depth = 14, 5
    if kind == b"CSI\x01":
        shift, depth, extra = take("iii")
        at += extra
    bins, least, linear = [], [], []
    # the bin after the last holds counts, no chunks
    counts = ((1 << 3 * (depth + 1)) - 1) // 7 + 1
    for _ in range(take("i")[0]):
        own, floors = {}, {}
        for _ in range(take("i")[0]):
            number = take("I")[0]
            floor = take("Q")[0] if kind == b"CSI\x01" else 0
            chunks = [take("QQ") for _ in range(take("i")[0])]
            if number != counts:
                own[number], floors[number] = chunks, floor
        bins.append(own)
        least.append(floors)
        if kind == b"BAI\x01":
            n = take("i")[0]
            linear.append(np.frombuffer(data, "<u8", n, at))
            at += 8 * n
    return Index(shift, depth, bins, least, linear if kind == b"BAI\x01" else None)


def region(text: str) -> tuple[str, int, int]:
    """`contig`, or `contig:first-last` with places from 1 on, as positions (0-based, end excluded)."""
    name, _, span = text.rpartition(":")
    first, dash, last = span.replace(",", "").partition("-")
    if name and first.isdigit() and (last.isdigit() or not last):
        return name, int(first) - 1, int(last) if last else (1 << 60 if dash else int(first))
    return text, 0, 1 << 60


class Part(InputPartition):
    """Blocks that begin in a range of a file's bytes; or ranges of virtual places, and whether a record begins at each."""

    def __init__(self, path: str, start: int, end: int, chunks: list[tuple[int, int, bool]] | None = None):
        super().__init__((path, start, end, chunks))
        self.path, self.start, self.end, self.chunks = path, start, end, chunks


class BamReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.paths = [p for p in options["path"].split(",") if p]
        self.split = int(options.get("split", SPLIT))
        self.tags = frozenset(t for t in options["tags"].split(",") if t) if "tags" in options else None
        self.regions = [region(r) for r in options["regions"].split(";") if r] if "regions" in options else None
        #: Blocks that this reader has read.
        self.blocks = 0

    def partitions(self) -> list[InputPartition]:
        parts: list[InputPartition] = []
        for path in self.paths:
            file = open_file(path)
            size = file.size()
            index = next((p for p in (f"{path}.bai", f"{path}.csi") if self.regions is not None and exists(p)), None)
            if index is None:
                parts += [Part(path, at, min(at + self.split, size)) for at in range(0, max(size, 1), self.split)]
                continue
            head, index = header(file, path), read_index(index)
            chunks = sorted(c for name, lo, hi in self.regions if name in head.names for c in index.chunks(head.names.index(name), lo, hi))
            merged: list[list[int]] = []
            for a, z in chunks:
                if merged and a <= merged[-1][1]:
                    merged[-1][1] = max(z, merged[-1][1])
                else:
                    merged.append([a, z])
            held, weight = [], 0
            for a, z in merged:
                # a long chunk is cut by bytes; which record begins a later piece is found there
                edges = [a, *(at << 16 for at in range((a >> 16) + self.split, z >> 16, self.split)), z]
                for lo, hi in zip(edges, edges[1:], strict=False):
                    held.append((lo, hi, lo == a))
                    weight += (hi >> 16) - (lo >> 16)
                    if weight >= self.split:
                        parts.append(Part(path, 0, size, held))
                        held, weight = [], 0
            if held:
                parts.append(Part(path, 0, size, held))
        return parts or [Part(self.paths[0], 0, 0, [])]

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        file = open_file(partition.path)
        head = header(file, partition.path)
        try:
            if partition.chunks is None:
                yield from self._range(file, partition.path, head, partition.start << 16, partition.end << 16, False)
            else:
                for a, z, known in partition.chunks:
                    yield from self._range(file, partition.path, head, a, z, known)
        except ValueError as broken:
            raise ValueError(f"{partition.path}: {broken}") from None

    def _range(self, file, path: str, head: Header, begin: int, end: int, known: bool) -> Iterator[pa.RecordBatch]:
        """Records that begin at virtual places from `begin` to `end`; `known`: one begins at `begin`."""
        if end <= head.first:
            return
        if begin <= head.first or known:
            begin = max(begin, head.first)
            stream = Stream(Blocks(file, begin >> 16), begin & 0xFFFF)
        else:
            at = first_block(file, begin >> 16, -(-end >> 16))
            if at is None:
                return
            stream = Stream(Blocks(file, at))
            found = first_record(stream, head, -(-end >> 16))
            if found is None:
                self.blocks += stream.blocks.read
                return
            stream.drop(found)
        try:
            yield from self._records(stream, path, head, end)
        finally:
            self.blocks += stream.blocks.read

    def _records(self, stream: Stream, path: str, head: Header, end: int) -> Iterator[pa.RecordBatch]:
        at, done = 0, False
        while not done:
            starts: list[int] = []
            while at < TOGETHER:
                if not stream.ensure(at + 4):
                    if len(stream.data) != at:
                        raise ValueError("the file ends within a record")
                    done = True
                    break
                # data that begins at a block's first byte is of that block
                if len(starts) % 64 == 0 or at >= stream.starts[-1]:
                    k = len(stream.starts) - 1
                    while stream.starts[k] > at:
                        k -= 1
                    if stream.places[k] + (at - stream.starts[k]) >= end:
                        done = True
                        break
                size = struct.unpack_from("<i", stream.data, at)[0]
                if not 32 <= size <= LONGEST:
                    raise ValueError("a broken record")
                if not stream.ensure(at + 4 + size):
                    raise ValueError("the file ends within a record")
                starts.append(at)
                at += 4 + size
            if starts:
                data = np.frombuffer(bytes(stream.data[:at]), np.uint8)
                offsets, edges, places = np.array(starts, np.int64), np.array(stream.starts, np.int64), np.array(stream.places, np.int64)
                k = np.searchsorted(edges, offsets, side="right") - 1
                virtual = places[k] + offsets - edges[k]
                keep = virtual < end
                if not keep.all():
                    done = True
                if keep.any():
                    yield decoded(path, data, offsets[keep], virtual[keep], head, self.tags, self.regions)
            stream.drop(at)
            at = 0


class BamSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "bam"

    def schema(self) -> str:
        return BAM

    def reader(self, schema) -> BamReader:
        return BamReader(dict(self.options))
