"""Sequencing files, written by hand and read back."""

import gzip
import struct
import zlib

import pytest

from methylspark.sources import bam, files


def block(data: bytes) -> bytes:
    c = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = c.compress(data) + c.flush()
    return b"\x1f\x8b\x08\x04" + b"\0" * 6 + struct.pack("<H", 6) + b"BC" + struct.pack("<HH", 2, len(body) + 25) + body + struct.pack("<II", zlib.crc32(data), len(data))


def record(name, flag, ref, pos, mapq, cigar, seq, qual, tags=b""):
    ops = b"".join(struct.pack("<I", n << 4 | bam.OPERATIONS.index(op)) for n, op in cigar)
    codes = [bam.BASES.index(b) for b in seq] + [0] * (len(seq) % 2)
    packed = bytes(codes[k] << 4 | codes[k + 1] for k in range(0, len(codes), 2))
    body = struct.pack("<iiBBHHHiiii", ref, pos, len(name) + 1, mapq, 0, len(cigar), flag, len(seq), -1, -1, 0) + name.encode() + b"\0" + ops + packed + bytes(qual) + tags
    return struct.pack("<i", len(body)) + body


def test_bam(spark, tmp_path):
    head = b"BAM\x01" + struct.pack("<i", 3) + b"@HD" + struct.pack("<i", 1) + struct.pack("<i", 5) + b"chr1\0" + struct.pack("<i", 1000)
    data = head + record("a:1", 99, 0, 10, 60, [(2, "S"), (3, "M")], "ACGTN", [30, 31, 32, 33, 34], b"CBZAA+CC\0NHC\x01") + record("b", 4, -1, -1, 0, [], "AC", [255, 255], b"XAAq" + b"XBBS" + struct.pack("<IHH", 2, 7, 8))
    path = tmp_path / "x.bam"
    path.write_bytes(b"".join(block(data[k : k + 40]) for k in range(0, len(data), 40)) + block(b""))
    rows = files.with_cb(files.read(spark, "bam", str(path))).orderBy("ordinal").collect()
    assert [(r.qname, r.flag, r.rname, r.pos, r.mapq, r.cigar, r.seq, r.qual, r.cb, r.nh) for r in rows] == [("a:1", 99, "chr1", 10, 60, "2S3M", "ACGTN", [30, 31, 32, 33, 34], "AA+CC", "1"), ("b", 4, None, -1, 0, None, "AC", None, None, None)]
    assert rows[1].tags == {"XA": "q", "XB": "7,8"}
    path.write_bytes(block(data))
    with pytest.raises(Exception, match="last block"):
        files.read(spark, "bam", str(path)).collect()


def test_fastq(spark, tmp_path):
    one, two = tmp_path / "r1.fastq", tmp_path / "r2.fastq.gz"
    one.write_text("@a 1\nACGT\n+\n@@@@\n@b\nAC\n+\nII\n")
    two.write_bytes(gzip.compress(b"@a 2\nTT\n+\nII\n@b\nGG\n+\nII\n"))
    rows = files.read_pairs(spark, str(one), str(two)).orderBy("ordinal").collect()
    assert [(r.h1, r.s1, r.q1, r.s2) for r in rows] == [("@a 1", "ACGT", "@@@@", "TT"), ("@b", "AC", "II", "GG")]
    two.write_bytes(gzip.compress(b"@a 2\nTT\n+\nII\n"))
    with pytest.raises(Exception, match="length"):
        files.read_pairs(spark, str(one), str(two)).collect()
    one.write_text("@a\nAC\n+\n")
    with pytest.raises(Exception, match="broken record"):
        files.read(spark, "fastq", str(one)).collect()


def test_fasta(spark, tmp_path):
    path = tmp_path / "x.fa"
    path.write_text(">a note\nacg\nTTT\n>b\nGG\n")
    assert sorted(map(tuple, files.read(spark, "fasta", str(path), block="4").collect())) == [("a", 0, "ACGT"), ("a", 4, "TT"), ("b", 0, "GG")]


def test_whitelist(spark, tmp_path):
    path = tmp_path / "w.tsv"
    path.write_text("# barcodes\nx1 ACGT\ny2\tTTTT # last\n")
    assert files.read_whitelist(spark, str(path)).collect() == [(0, "x1", "ACGT"), (1, "y2", "TTTT")]
    path.write_text("acgt\nTTTT\n")
    assert files.read_whitelist(spark, str(path)).collect() == [(0, "00", "ACGT"), (1, "01", "TTTT")]
    for text in ("ACGT\nACG\n", "ACGT\nACGT\n", "AC-T\n", "a b c\n"):
        path.write_text(text)
        with pytest.raises(ValueError):
            files.read_whitelist(spark, str(path))


def test_coverage(spark, tmp_path):
    folder = tmp_path / "host" / "0"
    folder.mkdir(parents=True)
    (folder / "00_01.CG.cov").write_text("chr1\t5\t5\t50.00\t1\t1\nchr1\tx\t5\t0\t1\t1\nshort\t1\n")
    (folder / "00_01.CA.cov").write_text("chr1\t5\t5\t50.00\t1\t1\tCA\t+\n")
    rows = files.read_coverage(spark, str(tmp_path), "CG").collect()
    assert [(r.spot_id, r.rname, r.start, r.meth, r.unmeth) for r in rows] == [("00_01", "chr1", 5, 1, 1)]
    assert files.read_coverage(spark, str(tmp_path), "CA").first().strand == "+"
