"""BAM files read in many parts and by region, against a plain reading of what was written."""

import bisect
import random
import struct

import pytest

from methylspark.sources import bam, files
from methylspark.sources.bgzf import Blocks, first_block, open_file
from tests.test_files import block, record

CONTIGS = [("chr1", 600_000), ("chr2", 90_000), ("lambda", 5_000)]
EMPTY = block(b"")


def reach(cigar):
    return sum(n for n, op in cigar if op in "MDN=X")


def some_records(seed, n):
    """Sorted records, some without qualities or bases, and unplaced ones at the end."""
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        ref = rng.choice([0, 0, 0, 1, 2])
        cigar = rng.choice([[(20, "M")], [(3, "S"), (17, "M")], [(10, "M"), (rng.choice([2, 40_000]), "N"), (10, "M")], [(8, "M"), (2, "I"), (10, "M")]])
        size = sum(m for m, op in cigar if op in "MIS=X")
        pos = rng.randrange(max(1, CONTIGS[ref][1] - reach(cigar)))
        qual = [255] * size if k % 17 == 0 else [rng.randrange(40) for _ in range(size)]
        tags = b"CBZ" + rng.choice([b"AACC+GGTT", b"TT+AA"]) + b"\0" + (b"NHC\x02" if k % 3 else b"XBBS" + struct.pack("<IHH", 2, 7, 8))
        rows.append((ref, pos, f"read{k}:{rng.randrange(10**6)}", rng.choice([99, 147, 1123]), rng.randrange(61), cigar, "".join(rng.choice("ACGTN") for _ in range(size)), qual, tags))
    rows.sort(key=lambda r: r[:2])
    return rows + [(-1, -1, f"lost{k}", 77, 0, [], "ACG", [1, 2, 3], b"") for k in range(20)] + [(-1, -1, "bare", 77, 0, [], "", [], b"")]


def written(path, rows, size):
    """The file, and each record's first and last virtual place."""
    head = b"BAM\x01" + struct.pack("<i", 6) + b"@HD\tVN" + struct.pack("<i", len(CONTIGS)) + b"".join(struct.pack("<i", len(n) + 1) + n.encode() + b"\0" + struct.pack("<i", m) for n, m in CONTIGS)
    data, edges = bytearray(head), []
    for ref, pos, name, flag, mapq, cigar, seq, qual, tags in rows:
        edges.append(len(data))
        data += record(name, flag, ref, pos, mapq, cigar, seq, qual, tags)
    edges.append(len(data))
    out, places, starts = bytearray(), [], []
    for k in range(0, len(data), size):
        starts.append(k)
        places.append(len(out))
        out += block(bytes(data[k : k + size]))
    end = len(out)
    path.write_bytes(bytes(out) + EMPTY)

    def virtual(at):
        if at == len(data):
            return end << 16
        k = bisect.bisect_right(starts, at) - 1
        return places[k] << 16 | at - starts[k]

    return [(virtual(a), virtual(z)) for a, z in zip(edges, edges[1:], strict=False)]


def bin_of(lo, hi, shift, depth):
    hi -= 1
    for level in range(depth, -1, -1):
        span = shift + 3 * (depth - level)
        if lo >> span == hi >> span:
            return ((1 << 3 * level) - 1) // 7 + (lo >> span)
    return 0


def indexed(path, rows, places, shift=14, depth=5, csi=False):
    bins, overlapping = [{} for _ in CONTIGS], [{} for _ in CONTIGS]
    linear = [{} for _ in CONTIGS]
    for (ref, pos, _, _, _, cigar, *_), (a, z) in zip(rows, places, strict=True):
        if ref >= 0:
            end = pos + max(1, reach(cigar))
            chunks = bins[ref].setdefault(bin_of(pos, end, shift, depth), [])
            if chunks and chunks[-1][1] == a:
                chunks[-1] = chunks[-1][0], z
            else:
                chunks.append((a, z))
            for level in range(depth + 1):
                span = shift + 3 * (depth - level)
                for k in range(pos >> span, (end - 1 >> span) + 1):
                    overlapping[ref].setdefault(((1 << 3 * level) - 1) // 7 + k, a)
            for k in range(pos >> shift, (end - 1 >> shift) + 1):
                linear[ref].setdefault(k, a)
    out = (b"CSI\x01" + struct.pack("<iii", shift, depth, 0) if csi else b"BAI\x01") + struct.pack("<i", len(CONTIGS))
    for own, stretch, first in zip(bins, linear, overlapping, strict=True):
        out += struct.pack("<i", len(own) + 1)
        for number, chunks in [*own.items(), (((1 << 3 * (depth + 1)) - 1) // 7 + 1, [(0, 1), (2, 3)])]:
            out += struct.pack("<I", number) + (struct.pack("<Q", first.get(number, 0)) if csi else b"") + struct.pack("<i", len(chunks)) + b"".join(struct.pack("<QQ", *c) for c in chunks)
        if not csi:
            n, last = max(stretch, default=-1) + 1, 0
            out += struct.pack("<i", n)
            for k in range(n):
                last = stretch.get(k, last)
                out += struct.pack("<Q", last)
    path.write_bytes(block(out) + EMPTY if csi else out)


def told(rows):
    text = {op: op for op in bam.OPERATIONS}
    return [(n, f, CONTIGS[ref][0] if ref >= 0 else None, pos, mapq, "".join(f"{m}{text[op]}" for m, op in c) or None, s, None if q[:1] == [255] else q) for ref, pos, n, f, mapq, c, s, q, _ in rows]


def rows_of(reader):
    out = []
    for part in reader.partitions():
        for b in reader.read(part):
            out += [(r["qname"], r["flag"], r["rname"], r["pos"], r["mapq"], r["cigar"], r["seq"], r["qual"], r["ordinal"]) for r in b.to_pylist()]
    return out


@pytest.mark.parametrize(("size", "split"), [(97, 150), (700, 1000), (700, 5), (5000, 3000), (60_000, 20_000), (60_000, 1 << 20)])
def test_parts_give_the_rows_of_the_whole(tmp_path, size, split):
    """Also where records reach over several blocks, and where parts are smaller than blocks."""
    path, rows = tmp_path / "x.bam", some_records(size, 300 if split == 5 else 1500)
    places = written(path, rows, size)
    reader = bam.BamReader({"path": str(path), "split": str(split)})
    got = rows_of(reader)
    assert [r[:-1] for r in got] == told(rows)
    assert [r[-1] for r in got] == [a for a, _ in places]


def test_block_starts(tmp_path):
    """Data that looks like a block's first bytes is none."""
    path = tmp_path / "x.bgzf"
    rng = random.Random(1)
    parts = [rng.randbytes(rng.randrange(1, 3000)) for _ in range(40)]
    stored = [b"\x1f\x8b\x08\x04" + b"\0" * 6 + b"\x06\0BC\x02\0\x20\0" + p for p in parts]
    blocks = [block(p) for p in stored]
    path.write_bytes(b"".join(blocks) + EMPTY)
    file, starts = open_file(str(path)), [sum(map(len, blocks[:k])) for k in range(len(blocks) + 1)]
    for at in range(0, starts[-1], 37):
        want = next(s for s in starts if s >= at)
        assert first_block(file, at, file.size()) == want
    assert [d for _, d in Blocks(file, starts[3])] == [*stored[3:], b""]


@pytest.mark.parametrize("kind", ["bai", "csi"])
def test_regions_by_index(tmp_path, kind):
    path, rows = tmp_path / "x.bam", some_records(5, 4000)
    places = written(path, rows, 900)
    indexed(tmp_path / f"x.bam.{kind}", rows, places, csi=kind == "csi", **({"shift": 12, "depth": 4} if kind == "csi" else {}))
    whole = bam.BamReader({"path": str(path)})
    rows_of(whole)
    rng = random.Random(6)
    spans = [(1, 100_000, 120_000), (1, 1, 600_000), (2, 89_000, 90_000), (3, 1, 5_000), (1, 599_990, 599_995)] + [(1, a := rng.randrange(1, 590_000), a + rng.randrange(9000)) for _ in range(20)]
    for split in (500, 1 << 20):
        for ref, a, z in spans:
            reader = bam.BamReader({"path": str(path), "split": str(split), "regions": f"{CONTIGS[ref - 1][0]}:{a:,}-{z}"})
            want = [t for t, r in zip(told(rows), rows, strict=True) if r[0] == ref - 1 and r[1] < z and r[1] + max(1, reach(r[5])) > a - 1]
            assert sorted(r[:-1] for r in rows_of(reader)) == sorted(want), (ref, a, z)
            if z - a < 10_000 and split > 500:
                assert reader.blocks < whole.blocks / 4
    both = bam.BamReader({"path": str(path), "regions": "lambda;chr2:100"})
    assert {r[2] for r in rows_of(both)} <= {"lambda", "chr2"}


def test_regions_in_spark(spark, tmp_path):
    path, rows = tmp_path / "x.bam", some_records(7, 1500)
    indexed(tmp_path / "x.bam.bai", rows, written(path, rows, 2000))
    read = files.read(spark, "bam", str(path), split="4000", tags="CB")
    regions = [("chr2", 1000, 50_000), ("chr2", 40_000, 60_000), ("lambda", 0, 5000)]
    found = files.read_regions(spark, regions, str(path), split="4000")
    want = sorted(t[0] for t, r in zip(told(rows), rows, strict=True) if any(t[2] == c and t[3] < hi and t[3] + max(1, reach(r[5])) > lo for c, lo, hi in regions))
    assert sorted(r.qname for r in found.collect()) == want and read.count() == len(rows)
    assert found.rdd.getNumPartitions() < read.rdd.getNumPartitions()
    assert {tuple(sorted(r.tags)) for r in read.select("tags").collect()} == {("CB",), ()}
    (tmp_path / "x.bam.bai").unlink()
    assert sorted(r.qname for r in files.read_regions(spark, regions, str(path)).collect()) == want


def test_broken_files(tmp_path):
    path, rows = tmp_path / "x.bam", some_records(8, 300)
    written(path, rows, 700)
    whole = path.read_bytes()
    for name, data in {"cut off at its end": whole[: -len(EMPTY)], "cut within a block": whole[:-60], "a changed byte": whole[:3000] + bytes([whole[3000] ^ 1]) + whole[3001:], "no BAM": block(b"text") + EMPTY}.items():
        path.write_bytes(data)
        for split in ("800", "1000000"):
            with pytest.raises(Exception, match="x.bam|broken|block|error"):
                rows_of(bam.BamReader({"path": str(path), "split": split}))
                raise AssertionError(name)
    path.write_bytes(block(b"BAM\x01" + struct.pack("<ii", 0, 0)) + EMPTY)
    assert rows_of(bam.BamReader({"path": str(path)})) == []
