"""Language identification by compression: the language whose raw-content dictionary makes the text smallest.

A language's dictionary is a bounded sample of its labelled texts: groups of SNIPPET words from all over them, since longer runs
would find the passages that documents share rather than the language. Of a text, all its different words go in pieces of PIECE bytes
through zstandard with each dictionary, lower-cased and without signs and digits; so what a text repeats
of itself costs nothing in any language. Sizes are summed over the whole text. Where the margin between the
smallest and the next is narrow, the operator rejects its own answer.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from methylspark.llm.store import discard, written

PIECE, LEVEL = 4096, 6
#: Of each language: labelled documents that are drawn from (about), and bytes of its dictionary.
SAMPLE_DOCS, DICTIONARY_BYTES = 400, 110_000
#: Words of a dictionary's snippet, and from one snippet's beginning to the next.
SNIPPET, STRIDE = 3, 7
#: Relative margin at which an answer is as likely right as not, for ONE_PIECE bytes of words.
MARGIN, ONE_PIECE = 0.02, 400
#: ASCII that is neither a letter nor white space.
_SIGNS = bytes(b for b in range(128) if not chr(b).isalpha() and not chr(b).isspace())
RESULT = "doc_id bigint, language string, margin double, score double, accepted boolean"


def crc_class(column: str, classes: int):
    """crc32 of a number's decimal text modulo `classes`; null for null."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(classes))


def different_words(text: str) -> list[bytes]:
    """A text's different words in the order they first come, lower-cased, without signs and digits."""
    return list(dict.fromkeys(text.lower().encode().translate(None, _SIGNS).split()))


def _snippets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, snippet): each text's different words, SNIPPET together, a snippet every STRIDE."""
    for b in batches:
        for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            words = different_words(text)
            found = list(dict.fromkeys(b" ".join(words[k : k + SNIPPET]) for k in range(0, len(words), STRIDE)))
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(found), pa.string()), pa.array(found, pa.binary())], names=["lang", "snippet"])


def dictionaries(labelled: DataFrame) -> dict[str, bytes]:
    """Raw content for each language of (text, lang) rows, the most frequent first: snippets of about SAMPLE_DOCS different whole texts drawn by a hash of the text, whatever the table's size and the texts'
    copies. The text of the least hash is always drawn, so each language has one. Of more snippets than DICTIONARY_BYTES hold, those of the highest checksums are taken, from all texts alike."""
    rows = labelled.where("lang is not null and text is not null and length(trim(text)) > 0").select("lang", "text", F.xxhash64("text").alias("h"))
    # texts are told apart by their hashes, so that none is shuffled
    seen = rows.groupBy("lang", "h").agg(F.count("*").alias("n")).groupBy("lang").agg(F.sum("n").alias("n"), F.count("*").alias("texts"), F.min("h").alias("least")).collect()
    counts = {r.lang: r.n for r in seen}
    if not counts:
        return {}
    steps = F.create_map(*(F.lit(x) for r in sorted(seen) for x in (r.lang, max(1, r.texts // SAMPLE_DOCS))))
    least = F.create_map(*(F.lit(x) for r in sorted(seen) for x in (r.lang, r.least)))
    drawn = rows.where((F.pmod("h", steps[F.col("lang")]) == 0) | (F.col("h") == least[F.col("lang")])).select("lang", "text")
    snippets = written(drawn.mapInArrow(_snippets, "lang string, snippet binary").distinct().withColumn("crc", F.crc32("snippet")), "snippets")
    size = {r.lang: r.n for r in snippets.groupBy("lang").agg(F.sum(F.octet_length("snippet") + 1).alias("n")).collect()}
    if not size:
        discard(snippets)
        return {}
    # the highest checksums that hold twice what a dictionary takes, so that no more than this comes to the driver
    limits = F.create_map(*(F.lit(x) for lang, n in sorted(size.items()) for x in (lang, int((1 - min(1.0, 2 * DICTIONARY_BYTES / n)) * 2**32))))
    found = snippets.where(F.col("crc") >= limits[F.col("lang")]).orderBy("lang", "crc", "snippet").collect()
    discard(snippets)
    out: dict[str, bytes] = {}
    for lang in sorted(size, key=lambda x: (-counts[x], x)):
        content = b" ".join(bytes(r.snippet) for r in found if r.lang == lang)
        while content and len(content) < 8:
            content += b" " + content
        if content:
            out[lang] = content[-DICTIONARY_BYTES:]
    return out


@lru_cache(maxsize=8)
def _compressors(contents: tuple[tuple[str, bytes], ...], level: int) -> list:
    import zstandard

    out = []
    for _, content in contents:
        raw = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        raw.precompute_compress(level=level)
        out.append(zstandard.ZstdCompressor(dict_data=raw, write_content_size=False, write_checksum=False, write_dict_id=False))
    return out


def sizes(text: str, compressors: list) -> list[int]:
    """Bytes of the whole text with each dictionary."""
    words = b" ".join(different_words(text))
    pieces = [words[k : k + PIECE] for k in range(0, len(words), PIECE)] or [b""]
    return [sum(len(c.compress(p)) for p in pieces) for c in compressors]


def _identified(batches: Iterator[pa.RecordBatch], sent: Broadcast) -> Iterator[pa.RecordBatch]:
    contents = sent.value
    compressors = _compressors(contents, LEVEL)
    names = [lang for lang, _ in contents]
    for b in batches:
        rows = []
        for text in b.column(1).to_pylist():
            if not text or not any(map(str.isalpha, text)):
                rows.append((None, 0.0, 0.0, False))
                continue
            found = sizes(text, compressors)
            order = sorted(range(len(found)), key=found.__getitem__)
            least = found[order[0]]
            margin = (found[order[1]] - least) / least if len(order) > 1 else 1.0
            sharp = math.sqrt(max(least, 1) / ONE_PIECE) * 4 / MARGIN
            odds = sum(math.exp(-min(700.0, sharp * (x - least) / least)) for x in found)
            rows.append((names[order[0]], margin, 1 / odds, margin >= MARGIN / 2))
        language, margin, score, accepted = zip(*rows, strict=True) if rows else ((), (), (), ())
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(language, pa.string()), pa.array(margin, pa.float64()), pa.array(score, pa.float64()), pa.array(accepted, pa.bool_())], names=["doc_id", "language", "margin", "score", "accepted"])


def identify(docs: DataFrame, labelled: DataFrame) -> DataFrame:
    """The language of each document by what (text, lang) rows teach: doc_id, language, margin, score, accepted.

    margin is by how much the next language's size is larger, relative to the smallest; score is a probability made of the sizes;
    accepted is false where the margin is under half of MARGIN (a rejection). language is null, and accepted false, for null texts and texts without a
    letter. Ties go to the language with more labelled texts. Equal rows are answered one by one; further columns are ignored; an empty table
    gives an empty one. Without a labelled text every language is null.
    """
    contents = tuple(dictionaries(labelled).items())
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    if not contents:
        return rows.select("doc_id", F.lit(None).cast("string").alias("language"), F.lit(0.0).alias("margin"), F.lit(0.0).alias("score"), F.lit(False).alias("accepted"))
    sent = docs.sparkSession.sparkContext.broadcast(contents)
    return rows.mapInArrow(lambda it: _identified(it, sent), RESULT)
