"""A document quality classifier by co-training.

Two views of a document are classified apart: its text content (hashed words and pairs of words, shares of kinds of letters, of repeated words and lines, and the worst of its
lines) and its page metadata (source, language, length). Over ROUNDS rounds each view's logistic regression labels the
documents it is surest of among all that aren't in the labelled sample, in the classes' proportion, and hands them to the other view. Afterwards each view is
calibrated on labelled documents that trained neither, and the calibrated views are combined there. All documents are scored by both.

Features of all documents are made once and written. A round counts the pool's documents by how sure a view is of them, which gives the level from which
the surest are taken, then takes these: both are passes of tasks over the pool, and only the documents handed over come to the driver.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from methylspark.llm.store import discard, written
from methylspark.llm.toxicity import platt
from methylspark.llm.wordhash import buffers, mix, slices, word_hashes

#: Labelled documents that are learned from (about; drawn by a hash of doc_id).
LABELLED = 12_000
#: Rounds; documents that a view hands over in each (about), and how sure it is of them at least. Levels of sureness to a unit of the logit.
ROUNDS, EXCHANGED, SURE, LEVELS = 5, 400, 0.9, 64
#: Slots of hashed words and pairs of words.
SLOTS = 512
#: A metadata value has a feature of its own where the labelled sample has it so often; others share one. Values of a field, at most.
SEEN, VALUES = 5, 512
#: Rows that are looked at together.
ROWS = 1024
METADATA = ("source", "lang")
SCORES = ("text_score", "meta_score", "score")

_KIND = np.zeros(256, np.uint8)
_KIND[97:123] = 1
_KIND[65:91] = 2
_KIND[48:58] = 3
_KIND[[0x20, *range(0x09, 0x0E)]] = 4
_KIND[128:] = 5
_KIND[list(b".,;:!?'\"()-")] = 6
_KIND[list(b"|")] = 7
_KINDS = 8  # 0: other ASCII signs


def _shares(text: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Shares of the kinds of bytes in each range."""
    kinds = _KIND[text]
    out = np.empty((len(at) - 1, _KINDS))
    for k in range(_KINDS):
        total = np.append(0, np.cumsum(kinds == k))
        out[:, k] = total[at[1:]] - total[at[:-1]]
    return out / np.maximum(np.diff(at), 1)[:, None]


def text_view(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Content features of these texts, one row each."""
    base, rows = int(offsets[0]), len(offsets) - 1
    text, at = data[base : int(offsets[-1])], offsets - base
    words, of = word_hashes(data, offsets)
    n_words = np.diff(of)
    doc = np.repeat(np.arange(rows), n_words)
    share = _shares(text, at)
    # lines: the breaks, and each text's end
    stops = np.unique(np.concatenate((np.flatnonzero(text == 10) + 1, at[1:])))
    starts = np.append(0, stops[:-1])
    full = stops > starts
    starts, stops = starts[full], stops[full]
    line_doc = np.searchsorted(at, starts, side="right") - 1
    lines = _shares(text, np.append(starts, len(text))) if len(starts) else np.zeros((0, _KINDS))
    size = stops - starts
    odd = lines[:, [0, 2, 7]]

    def by_doc(values: np.ndarray, group: np.ndarray, start: float = 0.0) -> np.ndarray:
        out = np.full(rows, start)
        np.maximum.at(out, group, values)
        return out

    worst = [by_doc(np.where(size >= 20, odd[:, k], 0), line_doc) for k in range(3)]
    spread = [np.bincount(line_doc, size * (odd[:, k] > limit), rows) / np.maximum(np.diff(at), 1) for k, limit in enumerate((0.1, 0.4, 0.03))]
    again = np.zeros(len(words), bool)
    again[1:] = (words[1:] == words[:-1]) & (doc[1:] == doc[:-1])
    order = np.lexsort((words, doc))
    first = np.ones(len(words), bool)
    first[1:] = (words[order][1:] != words[order][:-1]) | (doc[order][1:] != doc[order][:-1])
    begin = np.flatnonzero(first)
    times = np.diff(np.append(begin, len(words)))
    kinds = np.bincount(doc[order][begin], minlength=rows)
    # as many different words as a text of its length has by Heaps's law, roughly
    richness = kinds / np.maximum(n_words, 1) ** 0.85
    most = by_doc(times, doc[order][begin]) / np.maximum(n_words, 1)
    length = np.diff(at) / np.maximum(n_words, 1)
    per_word = [share[:, k] * np.diff(at) / np.maximum(n_words, 1) for k in (0, 6, 7)]
    columns = [*share.T, *worst, *spread, np.bincount(doc, again, rows) / np.maximum(n_words, 1), np.minimum(richness, 3), most, np.minimum(length, 40) / 10, *(np.minimum(x, 5) for x in per_word), np.bincount(line_doc, minlength=rows) / np.maximum(n_words, 1)]
    return np.column_stack(columns)


def ngram_view(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How often words and pairs of words of each text fall in each of SLOTS slots, at most 255."""
    words, of = word_hashes(data, offsets)
    rows = len(offsets) - 1
    doc = np.repeat(np.arange(rows), np.diff(of))
    pair = doc[1:] == doc[:-1]
    pairs = mix(words[:-1][pair] * np.uint64(3) + words[1:][pair])
    shift = np.uint64(64 - (SLOTS.bit_length() - 1))
    slot = np.concatenate((mix(words) >> shift, pairs >> shift)).astype(np.int64)
    counts = np.bincount(np.concatenate((doc, doc[1:][pair])) * SLOTS + slot, minlength=rows * SLOTS)
    return np.minimum(counts, 255).astype(np.uint8).reshape(rows, SLOTS)


def packed(shares: np.ndarray, ngrams: np.ndarray) -> list[bytes]:
    """Each row's content features as bytes."""
    return [a.tobytes() + b.tobytes() for a, b in zip(shares.astype("<f4"), ngrams, strict=True)]


def content(rows: list[bytes]) -> np.ndarray:
    """Content features from bytes: shares as they are, slots by the logarithm of their counts, made to length 1."""
    if not rows:
        return np.zeros((0, 1))
    flat = np.frombuffer(b"".join(rows), np.uint8).reshape(len(rows), -1)
    slots = np.log1p(flat[:, -SLOTS:].astype(np.float32))
    slots /= np.maximum(np.sqrt((slots**2).sum(axis=1, keepdims=True)), 1e-6)
    return np.column_stack((np.ascontiguousarray(flat[:, :-SLOTS]).view("<f4"), slots))


def vocabulary(fields: list[list[str | None]]) -> list[dict[str | None, int]]:
    """The number of each value that has a feature of its own, by field; 0 is for all others."""
    out = []
    for values in fields:
        often = [v for v, n in sorted(Counter(values).items(), key=lambda x: (-x[1], x[0] or "")) if n >= SEEN][:VALUES]
        out.append({v: k + 1 for k, v in enumerate(often)})
    return out


def meta_view(fields: list[list[str | None]], chars: np.ndarray, known: list[dict[str | None, int]]) -> np.ndarray:
    """Metadata features: each field's value, and the length by its logarithm."""
    parts = []
    for values, number in zip(fields, known, strict=True):
        one = np.zeros((len(chars), len(number) + 1))
        one[np.arange(len(chars)), [number.get(v, 0) for v in values]] = 1
        parts.append(one)
    size = np.log1p(np.maximum(chars, 0)) / 10
    return np.column_stack((*parts, size, size**2))


@dataclass
class View:
    """A logistic regression on standardised features, then a calibration."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    slope: float = 1.0
    shift: float = 0.0

    def value(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return z @ self.weights[:-1] + self.weights[-1]

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self.slope * self.value(x) + self.shift, -15, 15)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, start: View | None = None) -> View:
    """By Newton steps, from the weights of `start` and in its units where there is one."""
    mean, scale = (start.mean, start.scale) if start else (x.mean(axis=0), x.std(axis=0) + 1e-3)
    z = np.column_stack((np.clip((x - mean) / scale, -8, 8), np.ones(len(x)))).astype(np.float32)
    w, eye = start.weights.copy() if start else np.zeros(z.shape[1]), ridge * np.eye(z.shape[1])
    eye[-1, -1] = 1e-6
    for _ in range(40):
        p = sigmoid(z @ w)
        half = z * np.sqrt(p * (1 - p) + 1e-6).astype(np.float32)[:, None]
        step = np.linalg.solve(half.T @ half + eye, z.T @ (y - p) - eye @ w)
        w += step * min(1.0, 5 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-3:
            break
    return View(mean, scale, w)


@dataclass
class Model:
    known: list[dict[str | None, int]]
    text: View
    meta: View
    mix: np.ndarray

    def score(self, text: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        a, b = self.text.logit(text), self.meta.logit(meta)
        return sigmoid(a), sigmoid(b), sigmoid(self.mix[0] * a + self.mix[1] * b + self.mix[2])


def _slices(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    for lo, hi in slices(offsets):
        for k in range(lo, hi, ROWS):
            yield k, min(hi, k + ROWS)


def _viewed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Batches of `_rows` with their content features."""
    for b in batches:
        data, offsets = buffers(b.column("text"))
        for lo, hi in _slices(offsets):
            at = offsets[lo : hi + 1]
            yield b.slice(lo, hi - lo), packed(text_view(data, at), ngram_view(data, at))


def _metadata(part: pa.RecordBatch) -> tuple[list[list[str | None]], np.ndarray]:
    """Metadata and length, a batch's last columns."""
    n = len(METADATA) + 1
    fields = [part.column(part.num_columns - n + k).to_pylist() for k in range(len(METADATA))]
    return fields, part.column(part.num_columns - 1).fill_null(0).to_numpy(zero_copy_only=False)


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, rows in _viewed(batches):
        n = len(METADATA) + 1
        yield pa.RecordBatch.from_arrays([part.column(0), pa.array(rows, pa.binary()), *part.columns[-n:]], names=["doc_id", "content", *METADATA, "chars"])


def _scored(batches: Iterator[pa.RecordBatch], sent: Broadcast, kept: int) -> Iterator[pa.RecordBatch]:
    model = sent.value
    for part, rows in _viewed(batches):
        yield pa.RecordBatch.from_arrays([*part.columns[:kept], *map(pa.array, model.score(content(rows), meta_view(*_metadata(part), model.known)))], names=[*part.schema.names[:kept], *SCORES])


def _sure(b: pa.RecordBatch, views: tuple[View, View], known: list, gone: np.ndarray) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
    """By view and class: the rows that the view is sure of and that weren't handed over before, and the level of that."""
    xs = content(b.column(1).to_pylist()), meta_view(*_metadata(b), known)
    left = ~np.isin(b.column(0).to_numpy(zero_copy_only=False), gone)
    least = np.log(SURE / (1 - SURE))
    out = []
    for k, (view, x) in enumerate(zip(views, xs, strict=True)):
        value = np.clip(view.value(x), -30, 30)
        for y in (0, 1):
            sure = value if y else -value
            rows = np.flatnonzero(left & (sure >= least))
            out.append((k, y, rows, np.floor(sure[rows] * LEVELS).astype(np.int64)))
    return out


def _levels(batches: Iterator[pa.RecordBatch], sent: Broadcast) -> Iterator[pa.RecordBatch]:
    """(view, class, level, number) of a task's documents."""
    held: Counter = Counter()
    for b in batches:
        for k in range(0, b.num_rows, ROWS):
            for view, y, _, level in _sure(b.slice(k, ROWS), *sent.value[:3]):
                for at, n in zip(*np.unique(level, return_counts=True), strict=True):
                    held[view, y, int(at)] += int(n)
    rows = [(*key, n) for key, n in held.items()]
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else ((), (), (), ()), (pa.int32(), pa.int32(), pa.int64(), pa.int64()), strict=True)], names=["view", "class", "level", "n"])


def _surest(batches: Iterator[pa.RecordBatch], sent: Broadcast) -> Iterator[pa.RecordBatch]:
    """Documents above each view's and class's limit, and of those at the limit a share by a hash of doc_id."""
    limits = sent.value[3]
    for b in batches:
        for lo in range(0, b.num_rows, ROWS):
            part = b.slice(lo, ROWS)
            draw = (mix(part.column(0).to_numpy(zero_copy_only=False).astype(np.uint64)) >> np.uint64(11)) * 2.0**-53
            for view, y, rows, level in _sure(part, *sent.value[:3]):
                limit, share = limits[view, y]
                taken = rows[(level > limit) | ((level == limit) & (draw[rows] < share))]
                if len(taken):
                    n = len(taken)
                    yield pa.RecordBatch.from_arrays([pa.array([view] * n, pa.int32()), pa.array([y] * n, pa.int32()), *(c.take(pa.array(taken)) for c in part.columns)], names=["view", "class", *part.schema.names])


def _limits(counts: list, share: float) -> dict[tuple[int, int], tuple[int, float]]:
    """By view and class: the level above which documents are taken, and the share of those at it that make EXCHANGED in the classes' proportion."""
    out = {}
    for view in (0, 1):
        for y in (0, 1):
            room = int(EXCHANGED * share) if y else EXCHANGED - int(EXCHANGED * share)
            out[view, y] = (-1, 1.0)
            for level, n in sorted(((r["level"], r["n"]) for r in counts if (r["view"], r["class"]) == (view, y)), reverse=True):
                if n >= room:
                    out[view, y] = (level, room / n)
                    break
                room -= n
    return out


FEATURES = "doc_id bigint, content binary, source string, lang string, chars bigint"


def cotrain(labelled: pa.Table, pool: DataFrame) -> Model | None:
    """labelled: doc_id, content, metadata, chars, quality (0 or 1); pool: the same without quality. None where a class is missing."""
    label = labelled["quality"].to_numpy()
    if len(label) < 4 or label.min() == label.max():
        return None
    fields, chars = [labelled[c].to_pylist() for c in METADATA], labelled["chars"].fill_null(0).to_numpy()
    known = vocabulary(fields)
    xs = [content(labelled["content"].to_pylist()), meta_view(fields, chars, known).astype(np.float32)]
    aside = np.arange(len(label)) % 4 == 0
    if len(set(label[aside])) < 2 or len(set(label[~aside])) < 2:
        aside = np.zeros(len(label), bool)
    fit = ~aside
    share = label[fit].mean()
    extra = [[(x[:0], np.zeros(0))] for x in xs]
    models: list[View | None] = [None, None]

    def trained(k: int) -> View:
        rows, y = zip(*extra[k], strict=True)
        return logistic(np.concatenate((xs[k][fit], *rows)), np.concatenate((label[fit], *y)), start=models[k])

    gone = np.zeros(0, np.int64)
    for _ in range(ROUNDS):
        models = [trained(0), trained(1)]
        context = pool.sparkSession.sparkContext
        sent = context.broadcast((tuple(models), known, gone))
        counts = pool.mapInArrow(lambda it, sent=sent: _levels(it, sent), "view int, class int, level bigint, n bigint").groupBy("view", "class", "level").agg(F.sum("n").alias("n")).collect()
        sent.destroy()
        if not counts:
            break
        sent = context.broadcast((tuple(models), known, gone, _limits(counts, share)))
        found = pool.mapInArrow(lambda it, sent=sent: _surest(it, sent), f"view int, class int, {FEATURES}").toArrow().sort_by([("view", "ascending"), ("class", "ascending"), ("doc_id", "ascending")])
        sent.destroy()
        view, y = found["view"].to_numpy(), found["class"].to_numpy()
        rows = content(found["content"].to_pylist()), meta_view([found[c].to_pylist() for c in METADATA], found["chars"].fill_null(0).to_numpy(), known)
        for k in (0, 1):
            extra[1 - k].append((rows[1 - k][view == k], y[view == k].astype(float)))
        gone = np.union1d(gone, found["doc_id"].to_numpy())
    models = [trained(0), trained(1)]
    check = aside if aside.any() else fit
    for model, x in zip(models, xs, strict=True):
        model.slope, model.shift = platt(model.value(x[check]), label[check])
    both = np.column_stack([model.logit(x[check]) for model, x in zip(models, xs, strict=True)])
    joint = logistic(both, label[check])
    w = joint.weights[:-1] / joint.scale
    return Model(known, models[0], models[1], np.array([w[0], w[1], joint.weights[-1] - (w * joint.mean).sum()]))


def _rows(docs: DataFrame, carried: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the columns `carried`, text (unless it is one of them), then metadata and length."""
    names = ["doc_id", *(c for c in carried if c != "doc_id")]
    kinds = {"doc_id": "bigint", "text": "string"}
    shown = [F.col(c).cast(kinds[c]).alias(c) if c in kinds else F.col(c) for c in [*names, *(["text"] if "text" not in names else [])]]
    return docs.select(*shown, *(F.col(c).cast("string").alias(f"_viewed_{c}") for c in METADATA), F.length(F.col("text").cast("string")).cast("bigint").alias("_viewed_chars"))


def learn(docs: DataFrame, labels: DataFrame) -> Model | None:
    """A model from about LABELLED rows of `labels` (doc_id, quality 0 or 1), drawn by a hash of doc_id, and all other documents of `docs`, of which equal ones count once."""
    known = labels.where("doc_id is not null and quality in (0, 1)").groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max("quality").cast("int").alias("quality"))
    n_known = known.count()
    sample = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < min(1.0, LABELLED / max(1, n_known)) * 1_000_000)
    features = written(_rows(docs).where("doc_id is not null").mapInArrow(_featured, FEATURES), "features")
    # at most the sample's size is sent
    labelled = features.join(F.broadcast(sample), "doc_id").toArrow().sort_by([("doc_id", "ascending"), ("content", "ascending")])
    others = features.join(F.broadcast(sample), "doc_id", "left_anti")
    pool = written(others.groupBy("content", *METADATA, "chars").agg(F.min("doc_id").alias("doc_id")).select("doc_id", "content", *METADATA, "chars"), "pool")
    model = cotrain(labelled, pool)
    discard(features)
    discard(pool)
    return model


def assess(docs: DataFrame, model: Model | None, carried: tuple[str, ...] = ()) -> DataFrame:
    """The quality of each document: doc_id, the columns `carried`, text_score, meta_score, score (each a probability of quality 1).

    Null and empty texts have the features of an empty text, null metadata fields a value of their own. Equal rows are scored one by one; further
    columns are ignored; an empty table gives an empty one. Without a model (no labels of either class) every score is 1.
    """
    rows = _rows(docs, carried)
    kept = 1 + len([c for c in carried if c != "doc_id"])
    shown = rows.schema.fields[:kept]
    if model is None:
        return rows.select(*(f.name for f in shown), *(F.lit(1.0).alias(c) for c in SCORES))
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return rows.mapInArrow(lambda it: _scored(it, sent, kept), StructType([*shown, *(StructField(c, DoubleType()) for c in SCORES)]))
