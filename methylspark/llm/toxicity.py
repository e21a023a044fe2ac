"""Toxicity by a subsequence string-kernel support vector machine with Nyström landmarks.

Instances are the tokens of labelled sentences. The kernel counts common subsequences of ORDER letters that span at most SPAN
letters, each occurrence weighing DECAY to the power of its span, so that gaps and inserted letters cost little; it is normalised by each token's
kernel with itself. Punctuation within a token is passed over and lone letters in a row are one token, as in "i.d.i.o.t" or "i d i o t".
With landmarks L, a token's Nyström features are K(L, L)^(-1/2) K(L, token), on which a linear machine with squared hinge loss is
trained by Newton steps. Labels are of documents: a clean document's tokens are all negative, a toxic document's tokens are positive where they are far likelier in
toxic documents, and in later rounds where they resemble these. The machine is a sum over landmarks of subsequence weights, so scoring is one table lookup for each
subsequence. A document scores as its worst token, made a probability by Platt's method.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from methylspark.llm.store import discard, written
from methylspark.llm.wordhash import buffers, mix, slices

ORDER, SPAN, DECAY = 3, 6, 0.75
#: Letters of a token that are looked at together; longer tokens are cut into windows of this length, half of it apart.
WIDTH = 24
LANDMARKS, ROUNDS, PENALTY, INSERTED = 384, 3, 4.0, 0.3
#: Labelled documents of either class that the machine learns from (about; drawn by a hash), and negative tokens.
TOXIC_DOCS, CLEAN_DOCS, NEGATIVES, POSITIVES = 2500, 4000, 12_000, 4000
#: Lower bounds of a token's log odds: from the one it is an insult, from the other it may be one.
LIKELY, POSSIBLE = 2.6, 1.0
#: Where labelled texts are so few that hardly any token reaches LIKELY: how far below the likeliest one insults may lie, and the least that they need.
BELOW, LEAST = 0.4, 2.0
#: One labelled text in so many is kept for calibration, if these are so many of each class.
APART, FEW = 4, 4

_SKIP, _GAP, _EDGE = 0, 1, 2
#: Letter classes: 0 passed over, 1 ends a token, 2 a token's edges, then digits, letters, and bytes over 127 by their low bits.
CLASSES = np.zeros(256, np.uint8)
CLASSES[[0x20, *range(0x09, 0x0E)]] = _GAP
CLASSES[48:58] = 3
CLASSES[97:123] = np.arange(4, 30)
CLASSES[65:91] = np.arange(4, 30)
CLASSES[128:] = 30 + np.arange(128) % 34
_STEPS = [(a, b) for a in range(1, SPAN) for b in range(1, SPAN - a)]


def windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Letter classes of every token's windows (a row each: edge, letters, edge, zeros), and the text each is of."""
    base = int(offsets[0])
    letters = CLASSES[data[base : int(offsets[-1])]]
    keep = letters != _SKIP
    at = np.append(0, np.cumsum(keep))[offsets - base]
    letters = letters[keep]
    n = len(letters)
    if n == 0:
        return np.zeros((0, WIDTH + 2), np.uint8), np.zeros(0, np.int64)
    solid = letters != _GAP
    edge = np.zeros(n + 1, bool)
    edge[at] = True

    def spans(solid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        begin, stop = solid.copy(), solid.copy()
        begin[1:] &= ~solid[:-1] | edge[1:n]
        stop[:-1] &= ~solid[1:] | edge[1:n]
        return np.flatnonzero(begin), np.flatnonzero(stop) + 1

    starts, ends = spans(solid)
    lone = ends - starts == 1
    joined = lone[1:] & lone[:-1] & (starts[1:] - ends[:-1] == 1) & ~edge[starts[1:]] & ~edge[ends[:-1]] if len(starts) else np.zeros(0, bool)
    if joined.any():
        drop = np.zeros(n, bool)
        drop[ends[:-1][joined]] = True
        at = np.append(0, np.cumsum(~drop))[at]
        letters = letters[~drop]
        n = len(letters)
        edge = np.zeros(n + 1, bool)
        edge[at] = True
        starts, ends = spans(letters != _GAP)
    long = ends - starts > WIDTH
    if long.any():
        more = [(s, min(s + WIDTH, e)) for a, e in zip(starts[long].tolist(), ends[long].tolist(), strict=True) for s in range(a, max(a + 1, e - WIDTH // 2), WIDTH // 2)]
        starts, ends = np.concatenate((starts[~long], [s for s, _ in more])), np.concatenate((ends[~long], [e for _, e in more]))
        order = np.argsort(starts, kind="stable")
        starts, ends = starts[order], ends[order]
    size = ends - starts
    padded = np.append(letters, np.zeros(WIDTH, np.uint8))
    rows = padded[starts[:, None] + np.arange(WIDTH)]
    rows[np.arange(WIDTH) >= size[:, None]] = 0
    out = np.zeros((len(starts), WIDTH + 2), np.uint8)
    out[:, 0] = _EDGE
    out[:, 1:-1] = rows
    out[np.arange(len(starts)), size + 1] = _EDGE
    return out, np.searchsorted(at, starts, side="right") - 1


def distinct(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows, and each row's number among them."""
    packed = np.zeros((len(rows), -(-rows.shape[1] // 8) * 8), np.uint8)
    packed[:, : rows.shape[1]] = rows
    words = packed.view(np.uint64)
    h = np.zeros(len(rows), np.uint64)
    for k in range(words.shape[1]):
        h = mix(h + words[:, k] + np.uint64(k + 1))
    _, first, inverse = np.unique(h, return_index=True, return_inverse=True)
    return rows[first], inverse


def subsequences(rows: np.ndarray) -> Iterator[tuple[np.ndarray, float]]:
    """Keys (18 bits) and weight of the subsequences of every step; a key with a zero in it is none."""
    wide = rows.astype(np.int32)
    for a, b in _STEPS:
        s = a + b
        if s < rows.shape[1]:
            x, y, z = wide[:, :-s], wide[:, a : rows.shape[1] - b], wide[:, s:]
            keys = (x << 12) | (y << 6) | z
            keys[(x == 0) | (z == 0)] = 0
            yield keys, DECAY ** (s + 1)


def energy(rows: np.ndarray) -> np.ndarray:
    """The root of each token's kernel with itself: of the sum over its distinct subsequences of their squared weights. Without a letter
    that comes twice no subsequence does, and the length tells it."""
    size = np.count_nonzero(rows, axis=1)
    table = np.array([np.sqrt(sum(max(0, n - a - b) * DECAY ** (2 * (a + b + 1)) for a, b in _STEPS)) for n in range(rows.shape[1] + 1)])
    out = table[size]
    letters = np.sort(rows, axis=1)
    again = np.flatnonzero(((letters[:, 1:] == letters[:, :-1]) & (letters[:, 1:] > _EDGE)).any(axis=1))
    short = size[again] <= 11
    for part, width in ((again[short], 11), (again[~short], rows.shape[1])):
        for lo in range(0, len(part), 8192):
            x = rows[part[lo : lo + 8192], :width]
            # a key and, in its low bits, its span
            keys = np.sort(np.concatenate([np.where(k == 0, 0, k << 3 | round(np.log(w) / np.log(DECAY))) for k, w in subsequences(x)], axis=1), axis=1)
            weight = np.where(keys == 0, 0.0, DECAY ** (keys & 7))
            new = np.ones(keys.shape, bool)
            new[:, 1:] = keys[:, 1:] >> 3 != keys[:, :-1] >> 3
            begin = np.flatnonzero(new)
            square = np.add.reduceat(weight.ravel(), begin) ** 2
            out[part[lo : lo + 8192]] = np.sqrt(np.bincount(begin // keys.shape[1], square, len(x)))
    return np.maximum(out, DECAY**3)


def decision(rows: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The machine's values without its bias; short tokens apart, which most are."""
    out = np.zeros(len(rows))
    short = rows[:, 11] == 0
    for part, width in ((np.flatnonzero(short), 11), (np.flatnonzero(~short), rows.shape[1])):
        x = rows[part, :width]
        total = np.zeros(len(part), np.float32)
        for keys, weight in subsequences(x):
            total += weight * table[keys].sum(axis=1)
        out[part] = total / energy(x)
    return out


def gram(rows: np.ndarray, landmarks: np.ndarray) -> np.ndarray:
    """Normalised kernel values of tokens with landmarks."""
    used = np.unique(np.concatenate([k.ravel() for k, _ in subsequences(landmarks)]))
    place = np.zeros(1 << 18, np.int32)
    place[used] = np.arange(1, len(used) + 1)
    of = np.zeros((len(used) + 1, len(landmarks)), np.float32)
    for keys, weight in subsequences(landmarks):
        np.add.at(of, (place[keys], np.arange(len(landmarks))[:, None]), weight)
    of[0] = of[place[0]] = 0
    of /= energy(landmarks)
    out = np.zeros((len(rows), len(landmarks)), np.float32)
    for lo in range(0, len(rows), 2048):
        x = rows[lo : lo + 2048]
        for keys, weight in subsequences(x):
            p = place[keys]
            i, j = np.nonzero(p)
            if len(i):
                begin = np.flatnonzero(np.append(True, i[1:] != i[:-1]))
                out[lo + i[begin]] += weight * np.add.reduceat(of[p[i, j]], begin, axis=0)
        out[lo : lo + 2048] /= energy(x)[:, None]
    return out


def squared_hinge(z: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float) -> tuple[np.ndarray, float]:
    """A linear machine's weights and bias, by Newton steps on the rows within the margin."""
    x = np.column_stack((z, np.ones(len(z)))).astype(np.float64)
    ridge = np.eye(x.shape[1]) / penalty
    ridge[-1, -1] = 1e-6
    w = np.zeros(x.shape[1])
    inside = np.ones(len(x), bool)
    for _ in range(30):
        a = x[inside] * weight[inside, None]
        w = np.linalg.solve(a.T @ x[inside] + ridge, a.T @ y[inside])
        now = y * (x @ w) < 1
        if np.array_equal(now, inside):
            break
        inside = now
    return w[:-1], float(w[-1])


def platt(values: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """a, b of P(label = 1) = 1 / (1 + exp(-(a * value + b))), with smoothed targets."""
    n1, n0 = label.sum(), len(label) - label.sum()
    t = np.where(label == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.column_stack((values, np.ones(len(values))))
    w = np.array([1.0, 0.0])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + 1e-6 * np.eye(2), x.T @ (t - p) - 1e-6 * w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(max(w[0], 1e-3)), float(w[1])


@dataclass
class Machine:
    """Subsequence weights, and what makes the worst token's value a probability."""

    table: np.ndarray
    bias: float
    slope: float
    shift: float

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Probabilities that these texts are toxic; a text without a token counts as one with value -1."""
        rows, text = windows(data, offsets)
        worst = np.full(len(offsets) - 1, -1.0)
        if len(rows):
            kinds, inverse = distinct(rows)
            value = (decision(kinds, self.table) + self.bias)[inverse]
            begin = np.flatnonzero(np.append(True, text[1:] != text[:-1]))
            worst[text[begin]] = np.maximum.reduceat(value, begin)
        return 1 / (1 + np.exp(-np.clip(self.slope * worst + self.shift, -30, 30)))


def with_insertions(rows: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """These windows with a letter inserted at each place between two of theirs, and the row each is of."""
    out, of = [], []
    for k, row in enumerate(rows):
        letters = row[1 : np.count_nonzero(row) - 1]
        for at in range(1, len(letters) if len(letters) < WIDTH else 0):
            new = np.zeros(WIDTH + 2, np.uint8)
            new[: len(letters) + 3] = [_EDGE, *letters[:at], rng.integers(4, 30), *letters[at:], _EDGE]
            out.append(new)
            of.append(k)
    return np.array(out, np.uint8).reshape(-1, WIDTH + 2), np.array(of, np.int64)


def _machine(positive: np.ndarray, times: np.ndarray, negative: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, float]:
    """Table and bias of a machine from positive windows, how often each was chosen, and negative windows, the hardest first."""
    top = np.argsort(-times, kind="stable")[: LANDMARKS // 2]
    hard = min(len(negative), LANDMARKS // 4)
    some = hard + rng.choice(len(negative) - hard, min(len(negative) - hard, LANDMARKS - len(top) - hard), replace=False)
    landmarks = np.concatenate((positive[top], negative[:hard], negative[some]))
    near = gram(landmarks, landmarks).astype(np.float64)
    scale, basis = np.linalg.eigh((near + near.T) / 2)
    root = (basis / np.sqrt(np.maximum(scale, 1e-3))) @ basis.T
    # the insults found most often also count with a letter inserted, all its places together INSERTED times as much
    inserted, of = with_insertions(positive[top], rng)
    times = np.minimum(times, 20)
    y = np.append(np.ones(len(positive) + len(inserted)), -np.ones(len(negative)))
    weight = np.concatenate((times, INSERTED * times[top][of] / np.bincount(of)[of] if len(of) else [], np.ones(len(negative))))
    weight[y > 0] *= 0.25 * max(1, len(negative)) / weight[y > 0].sum()
    w, bias = squared_hinge(gram(np.concatenate((positive, inserted, negative)), landmarks) @ root, y, weight, PENALTY)
    beta = (root @ w) / energy(landmarks)
    table = np.zeros(1 << 18, np.float32)
    for keys, factor in subsequences(landmarks):
        np.add.at(table, keys, (factor * beta[:, None]).astype(np.float32))
    key = np.arange(1 << 18)
    table[(key < 1 << 12) | (key & 63 == 0) | ((key >> 6) & 63 == 0)] = 0
    return table, bias


def _windowed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, toxic, window): each text's distinct windows. Columns: toxic, text."""
    part, row = TaskContext.get().partitionId() << 33, 0
    for b in batches:
        data, offsets = buffers(b.column(1))
        toxic = b.column(0).to_numpy(zero_copy_only=False)
        for lo, hi in slices(offsets):
            found, text = windows(data, offsets[lo : hi + 1])
            pair = np.unique(np.column_stack((text, distinct(found)[1])), axis=0, return_index=True)[1] if len(found) else np.zeros(0, np.int64)
            text = text[pair]
            body = pa.py_buffer(np.ascontiguousarray(found[pair]).tobytes())
            shape = pa.py_buffer((np.arange(len(pair) + 1) * (WIDTH + 2)).astype(np.int32).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(part + row + text), pa.array(toxic[lo + text].astype(np.int32)), pa.Array.from_buffers(pa.binary(), len(pair), [None, shape, body])], names=["row", "toxic", "window"])
            row += hi - lo


def _unpacked(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, WIDTH + 2)


def _valued(batches: Iterator[pa.RecordBatch], sent: Broadcast) -> Iterator[pa.RecordBatch]:
    """The machine's value of the last column's windows, beside all columns."""
    table, bias = sent.value
    for b in batches:
        if b.num_rows:
            kinds, inverse = distinct(_unpacked(b.column(b.num_columns - 1)))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array((decision(kinds, table) + bias)[inverse])], names=[*b.schema.names, "value"])


def _with_value(rows: DataFrame, machine: tuple[np.ndarray, float] | None, odds: Column) -> DataFrame:
    """Rows whose last column is a window, with its value: by the machine, or by `odds` while there is none."""
    if machine is None:
        return rows.withColumn("value", odds)
    sent = rows.sparkSession.sparkContext.broadcast(machine)
    return rows.mapInArrow(lambda it: _valued(it, sent), StructType([*rows.schema.fields, StructField("value", DoubleType())]))


def fit(texts: DataFrame) -> Machine | None:
    """A machine from whole labelled texts (toxic 0 or 1, text); None where a class has none, or no token is likely an insult.

    Positive are the tokens whose log odds of a toxic text are above LIKELY at the lower end of what their counts allow; in later rounds also, of each toxic text without
    one, the worst token, if the machine takes it for one and clean texts hardly hold it. Toxic texts without either teach nothing. One text in APART (by a hash)
    isn't learned from, and values are made probabilities on these; where they have fewer than FEW of a class, on all.

    Texts become their distinct windows in tasks, and windows are counted, valued and chosen there; to the driver come at most POSITIVES + NEGATIVES windows and one number a text.
    """
    known = texts.select(F.col("toxic").cast("int"), "text").where("toxic in (0, 1)")
    kind = F.col("toxic") + F.when(F.pmod(F.xxhash64("text"), F.lit(APART)) == 0, 2).otherwise(0)
    found = written(known.select(kind.alias("toxic"), "text").mapInArrow(_windowed, "row bigint, toxic int, window binary"), "windows")
    number = {r.toxic: r.n for r in found.groupBy("toxic").agg(F.count_distinct("row").alias("n")).collect()}
    apart = min(number.get(2, 0), number.get(3, 0)) >= FEW
    taught = found.where("toxic < 2") if apart else found.withColumn("toxic", F.col("toxic") % 2)
    n1, n0 = (number.get(x, 0) + (0 if apart else number.get(x + 2, 0)) for x in (1, 0))
    if not n1 or not n0:
        discard(found)
        return None
    kinds = written(taught.groupBy("window").agg(F.count_if(F.col("toxic") == 1).alias("df1"), F.count_if(F.col("toxic") == 0).alias("df0")).select("df1", "df0", "window"), "kinds")
    # how much likelier a window is in toxic texts, at the lower end of what its few counts allow
    a, c = F.col("df1") + 0.5, F.col("df0") + 0.5
    odds = F.log(a / (n1 + 1)) - F.log(c / (n0 + 1)) - F.sqrt(1 / a + 1 / c)
    bad = written(taught.where("toxic = 1").join(kinds.where(odds > POSSIBLE), "window").select("row", odds.alias("odds"), "window"), "bad")
    clean = kinds.where("df0 > 0")

    def picked(rows: DataFrame, *order: Column, n: int) -> list[bytes]:
        return [bytes(r.window) for r in rows.orderBy(*order, "window").limit(n).select("window").collect()]

    usual = [*picked(clean, F.desc("df0"), n=NEGATIVES // 4), *picked(clean, F.xxhash64("window"), n=NEGATIVES // 2)]
    sure = bad.groupBy("window").agg(F.max("odds").alias("odds"), F.count("*").alias("times")).where(F.col("odds") > LEAST)
    top = sure.agg(F.max("odds")).first()[0]
    likely = min(LIKELY, max(LEAST, top - BELOW)) if top is not None else LIKELY
    sure = sure.where(F.col("odds") > likely)
    chosen = {bytes(r.window): r.times for r in sure.orderBy(F.desc("odds"), "window").limit(POSITIVES).collect()}
    rest = bad.join(bad.where(F.col("odds") > likely).select("row").distinct(), "row", "left_anti").select("row", "window")
    rng = np.random.default_rng(0)
    machine = None
    for _ in range(ROUNDS if chosen else 0):
        if machine is not None:
            worst = _with_value(rest, machine, odds).groupBy("row").agg(F.max(F.struct("value", "window")).alias("w")).where("w.value > 0")
            more = worst.groupBy("w.window").agg(F.count("*").alias("times")).orderBy(F.desc("times"), "window").limit(POSITIVES).collect()
            chosen = {bytes(r.window): r.times for r in more} | chosen
        hard = picked(_with_value(clean, machine, odds), F.desc("value"), n=NEGATIVES // 4)
        positive = sorted(chosen)
        negative = [w for w in dict.fromkeys((*hard, *usual)) if w not in chosen]
        if not negative:
            machine = None
            break
        rows = [np.frombuffer(b"".join(x), np.uint8).reshape(-1, WIDTH + 2) for x in (positive, negative)]
        machine = _machine(rows[0], np.array([chosen[w] for w in positive], float), rows[1], rng)
    out = None
    if machine is not None:
        judged = found.where("toxic > 1") if apart else found
        most = _with_value(judged, machine, odds).groupBy("row").agg((F.max("toxic") % 2).alias("toxic"), F.max("value").alias("value")).orderBy("row").toArrow()
        value, toxic = most["value"].to_numpy(), most["toxic"].to_numpy()
        # toxic texts in which the machine sees nothing would flatten what they say nothing of
        seen = (toxic == 0) | (value > 0)
        out = Machine(*machine, *platt(value[seen], toxic[seen]))
    for table in (found, kinds, bad):
        discard(table)
    return out


def _scored(batches: Iterator[pa.RecordBatch], sent: Broadcast, text: int, kept: int) -> Iterator[pa.RecordBatch]:
    """Scores of the column `text` beside the first `kept` columns."""
    machine = sent.value
    for b in batches:
        data, offsets = buffers(b.column(text))
        for lo, hi in slices(offsets):
            columns = [c.slice(lo, hi - lo) for c in b.columns[:kept]]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(machine.score(data, offsets[lo : hi + 1]))], names=[*b.schema.names[:kept], "score"])


def learn(docs: DataFrame, labels: DataFrame) -> Machine | None:
    """A machine from a sample of labelled documents: about TOXIC_DOCS and CLEAN_DOCS, drawn by a hash of doc_id at rates that the labels' numbers set."""
    known = labels.where("doc_id is not null and toxic in (0, 1)").select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    counts = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    share = F.create_map(*(F.lit(x) for t, most in ((0, CLEAN_DOCS), (1, TOXIC_DOCS)) for x in (t, min(1.0, most / max(1, counts.get(t, 1))))))
    drawn = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < share[F.col("toxic")] * 1_000_000).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    # at most the sample's size is sent, and one text of each of its ids is learned from
    return fit(texts.join(F.broadcast(drawn), "doc_id").groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("text").alias("text")).select("toxic", "text"))


def detect(docs: DataFrame, machine: Machine | None, carried: tuple[str, ...] = ()) -> DataFrame:
    """The toxicity of each document: doc_id, the columns `carried`, score (0 to 1).

    Null texts and those without a letter or digit score as a token far on the clean side. Equal rows are scored one by one; further columns are
    ignored; an empty table gives an empty one. Without a machine (no labels of either class) every score is 0.
    """
    names = ["doc_id", *(c for c in carried if c != "doc_id")]
    shown = [F.col("doc_id").cast("bigint").alias("doc_id"), *(F.col(c).cast("string").alias(c) if c == "text" else F.col(c) for c in names[1:])]
    if machine is None:
        return docs.select(*shown, F.lit(0.0).alias("score"))
    rows = docs.select(*shown) if "text" in names else docs.select(*shown, F.col("text").cast("string").alias("_scored_text"))
    text, kept = names.index("text") if "text" in names else len(names), len(names)
    sent = docs.sparkSession.sparkContext.broadcast(machine)
    return rows.mapInArrow(lambda it: _scored(it, sent, text, kept), StructType([*rows.schema.fields[:kept], StructField("score", DoubleType())]))
