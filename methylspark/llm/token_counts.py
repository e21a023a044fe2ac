"""Token counts without token ids: byte-pair merging on a heap and a linked list.

A word begins as one symbol a byte. Its adjacent pairs that the tokenizer can merge stand in a heap by rank, then place; the pair of the
lowest rank is popped, merged within a linked list of the symbols that are left, and the pairs that the merge makes are
pushed. A popped pair that no longer stands is passed over. A word's count is its bytes minus its merges: no id is written down.

Normalising and splitting follow the tokenizer's file. Where a file drops white space, texts are cut at ASCII white space first, and
each different chunk of a text is counted once; what a worker process remembers of chunks and words is bounded and changes no count.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import pairwise

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

#: Chunks and words that a worker process remembers, and the longest of them in bytes.
MEMORY, LONGEST = 700_000, 64
#: Bits of a place within a word, and of a symbol.
_PLACE, _SYMBOL = 32, 20
#: Bytes of a text that are cut into chunks together.
PART_BYTES = 4 << 20
_SPACE = re.compile(rb"[\t-\r ]")
#: The splitting rule that never holds white space, and what it is on lower-case letters and printable ASCII; these letters are composed already.
_DROPS_SPACE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_EASY_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")
_EASY = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")


def byte_letters() -> str:
    """The letter that stands for each byte in byte-level vocabularies: printable Latin-1 for itself, other bytes for those from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return "".join(chr(b if b in shown else next(rest)) for b in range(256))


class MergeCounter:
    """Counts of the tokens that a byte-level BPE file of the tokenizers library gives."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        told = json.loads(self.tokenizer.to_str())
        model, first = told["model"], told.get("pre_tokenizer") or {}
        steps = first.get("pretokenizers", [first])
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "fuse_unk", "ignore_merges") if model.get(k)]
        added = told.get("added_tokens", [])
        if model.get("type") != "BPE" or odd or steps[-1].get("type") != "ByteLevel" or any(t["lstrip"] or t["rstrip"] or t["single_word"] or (t["normalized"] and told.get("normalizer")) for t in added):
            raise ValueError(f"{path}: not a plain byte-level BPE")
        letters, end, vocab = byte_letters(), model.get("end_of_word_suffix") or "", model["vocab"]
        try:
            self.inner = [vocab[c] for c in letters]
            self.last = [vocab[c + end] for c in letters]
        except KeyError as missing:
            raise ValueError(f"{path}: no symbol for {missing}") from None
        self.byte = {c: b for b, c in enumerate(letters)}
        #: Of each pair that merges, as one number: its rank and the symbol it makes, as one number too.
        self.pairs: dict[int, int] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.pairs[vocab[a] << _SYMBOL | vocab[b]] = rank << _SYMBOL | vocab[a + b]
        self.special = re.compile("|".join(re.escape(t["content"]) for t in sorted(added, key=lambda t: -len(t["content"]))).encode()) if added else None
        # white space never reaches a word, so that texts can be cut at it
        normal = told.get("normalizer") or {}
        kinds = [x["type"] for x in normal.get("normalizers", [normal] if normal else [])]
        self.cut = steps[0].get("type") == "Split" and steps[0].get("pattern") == {"Regex": _DROPS_SPACE} and steps[0].get("invert") is True and steps[0].get("behavior") == "Removed"
        self.cut = self.cut and set(kinds) <= {"NFC", "Replace", "Lowercase"} and not any(_SPACE.search(t["content"].encode()) for t in added)
        self.lower = self.cut and kinds[-1:] == ["Lowercase"]
        self.chunks: dict[bytes, int] = {}
        self.words: dict[bytes, int] = {}

    def merges(self, symbols: list[int]) -> int:
        """How many merges these symbols take."""
        pairs, place, symbol, n = self.pairs.get, (1 << _PLACE) - 1, (1 << _SYMBOL) - 1, len(symbols)
        now = [pairs(a << _SYMBOL | b, -1) for a, b in pairwise(symbols)]  # what the pair that begins at each place would give; -1: nothing
        now.append(-1)
        heap = [found << _PLACE | k for k, found in enumerate(now) if found >= 0]
        heapify(heap)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        done = 0
        while heap:
            top = heappop(heap)
            k = top & place
            found = top >> _PLACE
            if now[k] != found:  # one of the pair has merged with another
                continue
            made = symbols[k] = found & symbol
            done += 1
            i, j = before[k], after[k]
            now[j] = -1
            j = after[k] = after[j]
            if j >= 0:
                before[j] = k
                found = now[k] = pairs(made << _SYMBOL | symbols[j], -1)
                if found >= 0:
                    heappush(heap, found << _PLACE | k)
            else:
                now[k] = -1
            if i >= 0:
                found = now[i] = pairs(symbols[i] << _SYMBOL | made, -1)
                if found >= 0:
                    heappush(heap, found << _PLACE | i)
        return done

    def word(self, word: bytes) -> int:
        n = self.words.get(word)
        if n is None:
            inner = self.inner
            n = len(word) - self.merges([*[inner[b] for b in word[:-1]], self.last[word[-1]]])
            if len(word) <= LONGEST:
                if len(self.words) >= MEMORY:
                    self.words.clear()
                self.words[word] = n
        return n

    def _plain(self, chunk: bytes) -> int:
        """Tokens of text without a special string."""
        text = chunk.decode()
        if self.lower and _EASY.fullmatch(text):
            return sum([self.word(w.encode()) for w in _EASY_WORDS.findall(text.lower())])
        if self.tokenizer.normalizer:
            text = self.tokenizer.normalizer.normalize_str(text)
        return sum(self.word(bytes([self.byte[c] for c in w])) for w, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(text) if w)

    def chunk(self, chunk: bytes) -> int:
        """Tokens of text that white space doesn't cut: each special string is one."""
        if self.special is None or not (found := self.special.findall(chunk)):
            return self._plain(chunk)
        return len(found) + sum(self._plain(p) for p in self.special.split(chunk) if p)

    def count(self, text: bytes) -> int:
        """Tokens of a whole text (UTF-8)."""
        if not self.cut:
            return self.chunk(text) if text else 0
        known, total = self.chunks, 0
        for part in _parts(text):
            for chunk, times in Counter(part.split()).items():
                n = known.get(chunk)
                if n is None:
                    n = self.chunk(chunk)
                    if len(chunk) <= LONGEST:
                        if len(known) >= MEMORY:
                            known.clear()
                        known[chunk] = n
                total += n * times
        return total


def _parts(text: bytes) -> Iterator[bytes]:
    """The text in parts of about PART_BYTES that end at white space."""
    lo = 0
    while len(text) - lo > PART_BYTES:
        space = _SPACE.search(text, lo + PART_BYTES)
        if space is None:
            break
        yield text[lo : space.start()]
        lo = space.start()
    yield text[lo:] if lo else text


@lru_cache(maxsize=4)
def counter(path: str) -> MergeCounter:
    return MergeCounter(path)


def _counted(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """n_bytes and n_tokens of the last column, beside the others."""
    count = counter(path).count
    for b in batches:
        texts = [x or b"" for x in b.column(b.num_columns - 1).cast(pa.binary()).to_pylist()]
        columns = [*b.columns[:-1], pa.array([len(x) for x in texts], pa.int64()), pa.array([count(x) for x in texts], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=[*b.schema.names[:-1], "n_bytes", "n_tokens"])


def count_tokens(docs: DataFrame, tokenizer: str, carried: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns `carried`, n_bytes (of UTF-8) and n_tokens of each whole text, as the file `tokenizer` has them without added special tokens.

    Special strings within a text are one token each, as by the library's default. Null and empty texts have no token; equal rows are
    counted one by one; null ids stay; further columns are left out; an empty table gives an empty one. Rows stay where they are: nothing is shuffled.
    """
    counter(tokenizer)  # a file of another kind is an error here, not in tasks
    rows = docs.select(*(F.col(c) for c in carried), F.col("text").cast("string").alias("_counted_text"))
    fields = [StructField("n_bytes", LongType()), StructField("n_tokens", LongType())]
    return rows.mapInArrow(lambda it: _counted(it, tokenizer), StructType([*rows.schema.fields[:-1], *fields]))
