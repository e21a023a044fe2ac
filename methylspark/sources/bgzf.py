"""Files of gzip blocks that name their own size: read from any place, by one task or by many."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

#: A block's first bytes, and the most bytes that it and its data may have (fixed values of the format).
MAGIC, MOST = b"\x1f\x8b\x08\x04", 1 << 16
#: Blocks that must follow one another for a place to count as a block's beginning.
CHAIN = 3


def open_file(path: str):
    """A file of any of Arrow's file systems, for reads at any place."""
    from pyarrow import fs

    system, name = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
    return system.open_input_file(name)


def exists(path: str) -> bool:
    from pyarrow import fs

    system, name = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
    return system.get_file_info(name).type == fs.FileType.File


def _sizes(data: bytes, at: int) -> tuple[int, int] | None:
    """Bytes of the block that begins at this place of `data`, and of its header; None where none begins."""
    if data[at : at + 4] != MAGIC or at + 12 > len(data):
        return None
    extra = struct.unpack_from("<H", data, at + 10)[0]
    k, end = at + 12, at + 12 + extra
    while k + 4 <= min(end, len(data)):
        size = struct.unpack_from("<H", data, k + 2)[0]
        if data[k : k + 2] == b"BC" and size == 2 and k + 6 <= len(data):
            return struct.unpack_from("<H", data, k + 4)[0] + 1, 12 + extra
        k += 4 + size
    return None


def first_block(file, start: int, end: int) -> int | None:
    """The first place from `start` on and before `end` where a block begins: CHAIN blocks follow one another from it, or fewer up to the file's end."""
    total, at = file.size(), start
    while at < end:
        data = file.read_at(min(2 * MOST, total - at), at)
        k = data.find(MAGIC)
        while 0 <= k < len(data) and at + k < end:
            if _follows(file, at + k, total):
                return at + k
            k = data.find(MAGIC, k + 1)
        at += max(1, len(data) - len(MAGIC) + 1)
    return None


def _follows(file, at: int, total: int) -> bool:
    for _ in range(CHAIN):
        if at == total:
            return True
        sizes = _sizes(file.read_at(min(1 << 10, total - at), at), 0)
        if sizes is None or at + sizes[0] > total:
            return False
        at += sizes[0]
    return True


class Blocks:
    """The blocks of a file from one on: (place, data), None after the last. A file whose last block isn't empty was cut off, as was one that ends within a block."""

    def __init__(self, file, at: int, ahead: int = 1 << 20):
        self.file, self.at, self.total, self.ahead = file, at, file.size(), ahead
        self.held, self.base, self.read = b"", at, 0
        self.empty = False

    def _have(self, n: int) -> bool:
        k = self.at - self.base
        if len(self.held) - k < n:
            self.held = self.file.read_at(min(max(n, self.ahead), self.total - self.at), self.at)
            self.base = self.at
        return len(self.held) - (self.at - self.base) >= n

    def next(self) -> tuple[int, bytes] | None:
        if self.at >= self.total:
            if not self.empty:
                raise ValueError("the file ends before its last block")
            return None
        self._have(min(1 << 10, self.total - self.at))
        k = self.at - self.base
        sizes = _sizes(self.held, k)
        if sizes is None:
            raise ValueError(f"no block of a BGZF file at {self.at}")
        if not self._have(sizes[0]):
            raise ValueError("the file ends before its last block")
        k = self.at - self.base
        data = zlib.decompress(self.held[k + sizes[1] : k + sizes[0] - 8], -15)
        crc, size = struct.unpack_from("<II", self.held, k + sizes[0] - 8)
        if size != len(data) or crc != zlib.crc32(data):
            raise ValueError(f"a broken block at {self.at}")
        place = self.at
        self.at += sizes[0]
        self.empty = not data
        self.read += 1
        return place, data

    def __iter__(self) -> Iterator[tuple[int, bytes]]:
        while (block := self.next()) is not None:
            yield block


class Stream:
    """Data from a place within a block on, with the virtual place (block << 16 | place within it) of each of its bytes.

    Data that `drop` passed over is forgotten."""

    def __init__(self, blocks: Blocks, within: int = 0):
        self.blocks, self.data, self.skip = blocks, bytearray(), within
        #: Where blocks begin in `data`, and their virtual places there.
        self.starts: list[int] = []
        self.places: list[int] = []

    def more(self) -> bool:
        """One block more; False at the file's end."""
        block = self.blocks.next()
        if block is None:
            return False
        place, data = block
        if self.skip:
            if self.skip > len(data):
                raise ValueError(f"no place {self.skip} in the block at {place}")
            data, place, self.skip = data[self.skip :], place << 16 | self.skip, 0
        else:
            place <<= 16
        if self.starts and self.starts[-1] == len(self.data):  # an empty block: its place is the next one's
            self.starts.pop()
            self.places.pop()
        self.starts.append(len(self.data))
        self.places.append(place)
        self.data += data
        return True

    def ensure(self, n: int) -> bool:
        while len(self.data) < n:
            if not self.more():
                return False
        return True

    def drop(self, n: int) -> None:
        k = 0
        while k + 1 < len(self.starts) and self.starts[k + 1] <= n:
            k += 1
        if self.starts:
            self.places[k] += max(0, n - self.starts[k])
            self.starts, self.places = [max(0, s - n) for s in self.starts[k:]], self.places[k:]
        del self.data[:n]
