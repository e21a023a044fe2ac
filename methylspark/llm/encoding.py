"""Token ids of text columns by a public tokenizer file, with each piece of text encoded once.

A byte-level BPE splits a text before it merges: before a space that a non-space follows, around a line break between two
words, and between a letter and a sign. So ids of a text are the ids of the pieces between such places, one after the other. Pieces are
found by 64-bit hashes for many texts at once, and compared byte by byte with the piece that they are taken for; the tokenizer encodes those that are new, and ids are put together by array operations.
Texts that hold an added token's string, or a piece that only shares another's hash, are encoded whole. So are all texts where the file's tokenizer splits in another way: where it has a normaliser,
another pre-tokenizer, a prefix space, or a model other than a plain BPE.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

from methylspark.llm.wordhash import buffers, mix, polynomial, slices

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Pieces that a worker process remembers, and ids and bytes of them. More are encoded again; ids don't depend on it.
MEMORY_PIECES, MEMORY_SIZE = 500_000, 4_000_000
#: Bytes of text that are encoded together.
CHUNK_BYTES = 2 << 20

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
#: ASCII signs; an apostrophe may belong to the letters after it.
_SIGN = np.zeros(256, bool)
_SIGN[[b for b in range(33, 127) if not chr(b).isalnum() and b != 39]] = True
_PRINT = np.zeros(256, bool)
_PRINT[33:127] = True
#: Bytes with which no white space begins (of those beyond ASCII, all first bytes that some have are left out).
_SOLID = np.ones(256, bool)
_SOLID[[*range(0x09, 0x0E), *range(0x1C, 0x21), 0x7F, 0xC2, 0xE1, 0xE2, 0xE3, 0xEF]] = False


def cuts(text: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Where pieces begin. at: the rows' offsets."""
    n = len(text)
    cut = np.zeros(n + 1, bool)
    cut[at] = True
    last = cut[1:].copy()  # of its row
    after = np.empty(n, bool)
    after[:-1] = _SOLID[text[1:]]
    after[-1:] = False
    after &= ~last
    cut[:n] |= (text == 0x20) & after
    if n > 1:
        letter, sign = _LETTER[text], _SIGN[text]
        cut[1:n] |= (letter[:-1] & sign[1:]) | (sign[:-1] & letter[1:])
        line = np.flatnonzero((text[1:] == 0x0A) & _PRINT[text[:-1]] & after[1:] & ~last[:-1]) + 1
        cut[line] = cut[line + 1] = True
    return np.flatnonzero(cut[:n])


def splits_at_cuts(tokenizer: str) -> bool:
    """Whether a tokenizer's JSON splits texts at `cuts` before it merges."""
    told = json.loads(tokenizer)
    first, model = told.get("pre_tokenizer") or {}, told.get("model") or {}
    splits = first.get("type") == "ByteLevel" and not first.get("add_prefix_space", True) and first.get("use_regex", True)
    return splits and told.get("normalizer") is None and told.get("truncation") is None and model.get("type") == "BPE" and not model.get("dropout")


class Encoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.plain = splits_at_cuts(self.tokenizer.to_str())
        vocab = self.tokenizer.get_vocab()
        self.dtype = np.dtype("<u2" if max(vocab.values()) < 1 << 16 else "<u4")
        self.opens = np.zeros(max(vocab.values()) + 1, bool)
        self.opens[[i for token, i in vocab.items() if token.startswith("Ġ")]] = True
        self.added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        # of each piece: its hash, where its ids begin and how many they are, where its bytes begin and how many they are
        self.names, self.begin, self.size, self.at, self.wide = (np.zeros(0, t) for t in (np.uint64, np.int64, np.int64, np.int64, np.int64))
        self.ids, self.bytes = np.zeros(0, self.dtype), np.zeros(0, np.uint8)

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, self.dtype) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encoded(self, pieces: list[str]) -> list[np.ndarray]:
        """Ids of pieces. Those that begin with their only space are encoded in one call: their first tokens hold the space."""
        spaced = [k for k, p in enumerate(pieces) if p[0] == " " and " " not in p[1:] and len(p) > 1]
        out: list[np.ndarray | None] = [None] * len(pieces)
        if spaced:
            ids = self.whole(["".join([pieces[k] for k in spaced])])[0]
            at = np.append(np.flatnonzero(self.opens[ids]), len(ids)).tolist()
            if len(at) == len(spaced) + 1:
                for k, a, z in zip(spaced, at, at[1:], strict=False):
                    out[k] = ids[a:z]
        rest = [k for k, x in enumerate(out) if x is None]
        for k, x in zip(rest, self.whole([pieces[k] for k in rest]), strict=True):
            out[k] = x
        return out

    def _known(self, names: np.ndarray) -> np.ndarray:
        if not len(self.names):
            return np.full(len(names), -1)
        at = np.minimum(np.searchsorted(self.names, names), len(self.names) - 1)
        return np.where(self.names[at] == names, at, -1)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all these rows, and each row's range among them."""
        base = int(offsets[0])
        text, at = data[base : int(offsets[-1])], offsets - base
        if not len(text):
            return np.zeros(0, self.dtype), np.zeros(len(at), np.int64)
        starts = cuts(text, at)
        ends = np.append(starts[1:], len(text))
        total, inverse = polynomial(text)
        hashes = mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
        del total, inverse
        names, first, kind = np.unique(hashes, return_index=True, return_inverse=True)
        place = self._known(names)
        new, old = np.flatnonzero(place < 0), np.flatnonzero(place >= 0)
        raw = text.tobytes()
        found = self._encoded([raw[a:z].decode() for a, z in zip(starts[first[new]].tolist(), ends[first[new]].tolist(), strict=True)])
        size, begin, known_at, wide = (np.zeros(len(names), np.int64) for _ in range(4))
        for mine, kept in ((size, self.size), (begin, self.begin), (known_at, self.at), (wide, self.wide)):
            mine[old] = kept[place[old]]
        size[new] = [len(x) for x in found]
        begin[new] = len(self.ids) + np.cumsum(size[new]) - size[new]
        known_at[new], wide[new] = len(self.bytes) + starts[first[new]], (ends - starts)[first[new]]
        arena = np.concatenate([self.ids, *found]) if found else self.ids
        lengths = size[kind]
        until = np.cumsum(lengths)
        out = arena[np.repeat(begin[kind] - (until - lengths), lengths) + np.arange(until[-1])]
        rows = np.append(0, until)[np.searchsorted(starts, at)]
        mistaken = self._mistaken(text, starts, ends, known_at[kind], wide[kind])
        if len(new) and len(self.names) + len(new) <= MEMORY_PIECES and max(len(arena), len(self.bytes) + int(wide[new].sum())) <= MEMORY_SIZE:
            known_at[new] = len(self.bytes) + np.cumsum(wide[new]) - wide[new]
            body = np.repeat(starts[first[new]] - (known_at[new] - len(self.bytes)), wide[new]) + np.arange(int(wide[new].sum()))
            every = np.concatenate((self.names, names[new]))
            order = np.argsort(every, kind="stable")
            self.names, self.ids, self.bytes = every[order], arena, np.concatenate((self.bytes, text[body]))
            self.begin, self.size, self.at, self.wide = (np.concatenate((a, b[new]))[order] for a, b in ((self.begin, begin), (self.size, size), (self.at, known_at), (self.wide, wide)))
        return self._with_whole(raw, at, out, rows, np.searchsorted(at, starts[mistaken], side="right") - 1)

    def _mistaken(self, text: np.ndarray, starts: np.ndarray, ends: np.ndarray, known_at: np.ndarray, wide: np.ndarray) -> np.ndarray:
        """Numbers of the pieces whose bytes aren't those that they are taken for; these stand among the remembered bytes, or beyond them in this text."""
        fits = wide == ends - starts
        part = np.flatnonzero(fits)
        size = wide[part]
        until = np.cumsum(size)
        step = np.arange(until[-1] if len(until) else 0)
        shift = until - size
        here = text if len(part) == len(starts) else text[np.repeat(starts[part] - shift, size) + step]
        same = np.concatenate((self.bytes, text))[np.repeat(known_at[part] - shift, size) + step] == here
        if same.all() and fits.all():
            return np.zeros(0, np.int64)
        return np.union1d(np.flatnonzero(~fits), part[np.searchsorted(until, np.flatnonzero(~same), side="right")])

    def _with_whole(self, raw: bytes, at: np.ndarray, ids: np.ndarray, rows: np.ndarray, odd: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same, with the texts `odd` and those that hold an added token's string encoded whole."""
        odd = set(odd.tolist())
        for token in self.added:
            k = raw.find(token)
            while k >= 0:
                odd.add(int(np.searchsorted(at, k, side="right")) - 1)
                k = raw.find(token, k + 1)
        if not odd:
            return ids, rows
        parts = [self.whole([raw[at[r] : at[r + 1]].decode()])[0] if r in odd else ids[rows[r] : rows[r + 1]] for r in range(len(at) - 1)]
        return np.concatenate(parts), np.append(0, np.cumsum([len(p) for p in parts]))

    def column(self, column: pa.Array) -> Iterator[list[np.ndarray]]:
        """Ids of a text column's rows, some rows at a time; a null is an empty text."""
        data, offsets = buffers(column)
        for lo, hi in slices(offsets, CHUNK_BYTES):
            if not self.plain:
                yield self.whole([bytes(data[a:z]).decode() for a, z in zip(offsets[lo:hi], offsets[lo + 1 : hi + 1], strict=True)])
                continue
            ids, rows = self.encode(data, offsets[lo : hi + 1])
            yield np.split(ids, rows[1:-1])


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    return Encoder(path)
