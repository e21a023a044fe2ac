"""FASTQ files read in many parts against a plain reading."""

import gzip
import random

import pytest

from methylspark.sources import fastq, files
from tests.test_files import block


def text_of(seed, n, ends="\n"):
    """Records whose qualities may begin with @ or +, some without bases."""
    rng = random.Random(seed)
    out = []
    for k in range(n):
        size = rng.choice([0, 1, 5, 30, 200])
        out.append((f"@r{k} {'@' * rng.randrange(3)}+", "".join(rng.choice("ACGTN") for _ in range(size)), rng.choice(["+", f"+r{k}", "+@"]), "".join(rng.choice("@+I!#5") for _ in range(size))))
    return out, "".join(ends.join(r) + ends for r in out).encode()


def stored(path, data, kind, size=500):
    path.write_bytes({"plain": lambda: data, "gzip": lambda: gzip.compress(data), "blocks": lambda: b"".join(block(data[k : k + size]) for k in range(0, len(data), size)) + block(b"")}[kind]())
    return path


def rows_of(path, split):
    reader, counts = (r({"path": str(path), "split": str(split)}) for r in (fastq.FastqReader, fastq.CountsReader))
    out = []
    for part, other in zip(reader.partitions(), counts.partitions(), strict=True):
        mine = [(r["place"], (r["header"], r["seq"], r["plus"], r["qual"])) for b in reader.read(part) for r in b.to_pylist()]
        assert [p for p, _ in mine] == list(range(len(mine)))
        assert [r for b in counts.read(other) for r in b.column("records").to_pylist()] == [len(mine)]
        out += [r for _, r in mine]
    return out


@pytest.mark.parametrize("kind", ["plain", "blocks", "gzip"])
@pytest.mark.parametrize("together", [64, 4 << 20])
def test_parts_give_the_records_of_the_whole(tmp_path, monkeypatch, kind, together):
    monkeypatch.setattr(fastq, "TOGETHER", together)
    for seed, split in enumerate([1, 7, 50, 333, 2000, 1 << 20]):
        rows, data = text_of(seed, 60 if split < 10 else 200, "\r\n" if seed == 3 else "\n")
        assert rows_of(stored(tmp_path / "x", data, kind), split) == rows
        assert rows_of(stored(tmp_path / "x", data.rstrip(b"\r\n") if rows[-1][3] else data, kind), split) == rows
    assert rows_of(stored(tmp_path / "x", b"", kind), 10) == []


def test_every_cut_of_a_small_file(tmp_path):
    rows, data = text_of(9, 12)
    path = stored(tmp_path / "x", data, "plain")
    for cut in range(1, len(data) + 2):
        assert rows_of(path, cut) == rows


def test_ordinals_and_pairs(spark, tmp_path):
    first, one = text_of(1, 300)
    second, two = text_of(2, 300)
    paths = [str(stored(tmp_path / "r1.fastq", one, "plain")), str(stored(tmp_path / "r2.fastq.gz", two, "blocks"))]
    read = files.read(spark, "fastq", *paths, split="900")
    assert read.rdd.getNumPartitions() > 10
    got = {(r.file, r.ordinal): (r.header, r.seq, r.plus, r.qual) for r in read.collect()}
    assert got == {(p, k): r for p, rows in zip(paths, (first, second), strict=True) for k, r in enumerate(rows)}
    pairs = files.read_pairs(spark, *paths, split="900").orderBy("ordinal").collect()
    assert [(p.h1, p.s1, p.h2, p.q2) for p in pairs] == [(a[0], a[1], b[0], b[3]) for a, b in zip(first, second, strict=True)]


@pytest.mark.parametrize("spoil", [lambda d: d[:-30], lambda d: d.replace(b"\n+", b"\n-", 1), lambda d: d.replace(b"@r50 ", b"#r50 ", 1), lambda d: d + b"\n"])
def test_broken_files(tmp_path, spoil):
    rows, data = text_of(3, 100)
    for split in (200, 1 << 20):
        with pytest.raises(ValueError, match="broken record"):
            rows_of(stored(tmp_path / "x", spoil(data), "plain"), split)
