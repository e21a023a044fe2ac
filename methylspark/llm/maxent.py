"""Language-model scores from a hashed maximum-entropy model with a class-factored softmax.

P(word | history) = P(class | history) * P(word | class, history). Classes part the words by frequency into bins of equal mass; the
last class holds all words outside the HEAD most frequent, and the unknown word. Within a class of the head, a tree of as many branches as there are classes leads
to each word alone: words by rank, so a class of n words takes log n levels. Words outside the head are parted by bits of their hashes, more levels the more they
are; those of one leaf share it by count + 1, and the unknown word has one count of its class. Each node of these trees is a softmax as the classes' is, over sums of weight
rows, one for each active feature: the last word, the one before it, the one before that (skips), the last two words (an n-gram) and the classes of the last three,
each hashed with its node to one of so many rows as the number of different words asks for, up to a bound. Logarithms of branches' counts are the bias, so untrained weights give unigrams,
and all probabilities sum to 1.

Counting: each task counts its words, Spark adds them up; every word's count enters, however many there are. Training: in each of ROUNDS
rounds, tasks run AdaGrad over their share of that round's documents, dealt by a hash of doc_id, in sparse numpy batches, from the common weights, and send the rows they
changed; the changes of a row are averaged by how often it was active. Scoring: one pass makes the trees' part; words outside the head are counted per document and
joined with their counts by Spark.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache, cached_property

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from methylspark.llm.store import written
from methylspark.llm.wordhash import buffers, mix, slices, word_hashes

#: Words whose class and count every task knows (at most); classes, and branches of a node; weight rows at least and at most; rows for each word with features of its own.
HEAD, CLASSES, ROWS, MOST_ROWS, NAMED_ROWS = 1 << 17, 32, 1 << 16, 1 << 18, 4
#: Levels of the tree of words outside the head, at most; 5 bits of the hash each.
OUTER_LEVELS, OUTER_BITS = 2, 5
ROUNDS, BATCH, RATE, CHUNK_ROWS = 2, 4096, 0.4, 512
#: Distinct words that a task counts before it sends them on.
HELD_WORDS = 1 << 20
#: Training tokens that a task has (about) for each ROWS weight rows; of a corpus of more than MANY_TOKENS, as many times more as the root of how often it is larger,
#: so that what tasks send becomes small beside the corpus. So many tasks' changes, or fewer, are summed at once.
TASK_TOKENS, MANY_TOKENS, SUMMED_TASKS = 2_400_000, 1 << 30, 64
#: Rows of a group that are added one after the other.
RANKS = 5
END = np.uint64(0x9D5C_0FFE_E1E5_7A27)


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of these rows, each row closed by END, and the rows' ranges."""
    words, at = word_hashes(data, offsets)
    rows = len(offsets) - 1
    out = np.empty(len(words) + rows, np.uint64)
    close = at[1:] + np.arange(rows)
    is_end = np.zeros(len(out), bool)
    is_end[close] = True
    out[is_end], out[~is_end] = END, words
    return out, np.append(0, close + 1)


def tallied(words: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    if counts is None:
        return np.unique(words, return_counts=True)
    order = np.argsort(words, kind="stable")
    words, counts = words[order], counts[order]
    first = np.flatnonzero(np.append(True, words[1:] != words[:-1])) if len(words) else np.zeros(0, np.int64)
    return words[first], np.add.reduceat(counts, first) if len(first) else counts


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0

    def flushed(keep: int) -> Iterator[pa.RecordBatch]:
        nonlocal held, size
        words, counts = tallied(np.concatenate([w for w, _ in held]), np.concatenate([c for _, c in held]))
        held, size = [(words, counts)], len(words)
        if size > keep:
            held, size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(counts.astype(np.int64))], names=["word", "n"])

    for b in batches:
        data, offsets = buffers(b.column(0))
        for lo, hi in slices(offsets):
            held.append(tallied(tokens(data, offsets[lo : hi + 1])[0]))
            size += len(held[-1][0])
            if size > 2 * HELD_WORDS:
                yield from flushed(HELD_WORDS)
    if held:
        yield from flushed(-1)


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, c) for all words of a text column, END among them once a row."""
    parts = texts.mapInArrow(_counted, "word bigint, n bigint")
    return written(parts.groupBy("word").agg(F.sum("n").alias("c")), "word-counts")


@dataclass
class Vocabulary:
    """The head's words, ascending by hash, with their class, their feature name (a rank), count, and node and branch at each level of their class's tree (-1: ended before);
    each class's log10 sum of count + 1. Each node's bias; the nodes of the outer tree come last, from `outer` on. log10 of the sums of its leaves; weight rows."""

    words: np.ndarray
    classes: np.ndarray
    names: np.ndarray
    log_counts: np.ndarray
    log_sums: np.ndarray
    total: int
    distinct: int
    nodes: np.ndarray
    branches: np.ndarray
    bias: np.ndarray
    outer: int
    outer_levels: int
    leaf_sums: np.ndarray
    rows: int

    @property
    def named(self) -> int:
        return self.rows // NAMED_ROWS

    @cached_property
    def starts(self) -> np.ndarray:
        """Where the words with each value of the leading bits begin: few have one, since words are hashes."""
        bits = len(self.words).bit_length() + 2
        return np.searchsorted(self.words, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)).astype(np.int32)

    def find(self, words: np.ndarray) -> np.ndarray:
        """Each word's place in the head, or -1."""
        out = np.full(len(words), -1)
        begin = self.starts
        lead = (words >> np.uint64(65 - len(begin).bit_length())).astype(np.int64)
        at, end = begin[lead], np.append(begin[1:], np.int32(len(self.words)))[lead]
        left = np.flatnonzero(at < end)
        while len(left):
            hit = self.words[at[left]] == words[left]
            out[left[hit]] = at[left[hit]]
            left = left[~hit]
            at[left] += 1
            left = left[at[left] < end[left]]
        return out


def _log(mass: np.ndarray) -> np.ndarray:
    """A node's bias; branches without a word are out of reach."""
    return np.where(mass > 0, np.log(np.maximum(mass, 1e-9)), -1e4).astype(np.float32)


def tree(of: np.ndarray, c: np.ndarray, classes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nodes and branches, a row a level, of words by rank with class `of`; and the nodes' bias."""
    size = np.bincount(of, minlength=classes)
    start = np.cumsum(size) - size
    place, size = np.arange(len(of)) - start[of], size[of]
    depth = np.zeros(len(of), np.int64)
    while (deeper := classes**depth < size).any():
        depth += deeper
    levels = int(depth.max(initial=0))
    nodes, branches, bias = np.full((levels, len(of)), -1, np.int32), np.full((levels, len(of)), -1, np.int16), [np.zeros((0, classes), np.float32)]
    n = 0
    for k in range(levels):
        here = np.flatnonzero(depth > k)
        below = classes ** (depth[here] - k - 1)
        _, node = np.unique(of[here] * (len(of) + 1) + place[here] // (below * classes), return_inverse=True)
        branch = place[here] // below % classes
        m = int(node.max()) + 1
        nodes[k, here], branches[k, here] = node + n, branch
        bias.append(_log(np.bincount(node * classes + branch, c[here] + 1.0, m * classes).reshape(m, classes)))
        n += m
    return nodes, branches, np.concatenate(bias)


def outer_tree(outside: DataFrame, distinct: int, classes: int, most: int) -> tuple[int, np.ndarray, np.ndarray]:
    """Levels (at most `most`), nodes' bias and leaves' sums of count + 1, for so many words outside the head."""
    branches = 1 << OUTER_BITS
    levels = 0
    while levels < most and branches**levels < distinct:
        levels += 1
    leaves = branches**levels
    sums = np.zeros(leaves)
    if distinct:
        for r in outside.groupBy(F.col("word").bitwiseAND(F.lit(leaves - 1)).alias("leaf")).agg(F.sum(F.col("c") + 1).alias("s")).collect():
            sums[r.leaf] = r.s
    bias = [np.zeros((0, classes), np.float32)]
    for k in range(levels):  # the first level takes the lowest bits
        nodes = branches**k
        mass = sums.reshape(-1, branches, nodes).sum(axis=0).T
        bias.append(np.pad(_log(mass), ((0, 0), (0, classes - branches)), constant_values=-1e4))
    return levels, np.concatenate(bias), sums


def vocabulary(counts: DataFrame, head: int, classes: int) -> Vocabulary:
    """The head are the `head` most frequent words, about: of those at the least level of counts that has room for some only, a share by a hash."""
    level = F.floor(F.log2("c") * 64)
    levels = sorted(((r.level, r.n, r.c) for r in counts.groupBy(level.alias("level")).agg(F.count("*").alias("n"), F.sum("c").alias("c")).collect()), reverse=True)
    total, distinct = sum(c for _, _, c in levels), sum(n for _, n, _ in levels)
    taken, least, share = 0, -1, 1.0
    for name, n, _ in levels:
        if taken + n > head:
            least, share = name, (head - taken) / n
            break
        taken += n
    draw = F.pmod(F.xxhash64("word"), F.lit(1 << 30))
    inside = (level > least) | ((level == least) & (draw < int(share * (1 << 30))))
    rows = counts.where(inside).toArrow()
    words, c = rows["word"].to_numpy().view(np.uint64), rows["c"].to_numpy()
    rank = np.lexsort((words, -c))
    words, c = words[rank], c[rank]
    mass = np.cumsum(c) - c / 2
    of = np.minimum((mass / max(1, c.sum()) * (classes - 1)).astype(np.int64), classes - 2)
    sums = np.bincount(of, c + 1, classes)
    sums[classes - 1] = (total + distinct + 1) - (c + 1).sum()
    order = np.argsort(words)
    with np.errstate(divide="ignore"):
        logs = np.log10(sums)
    nodes, branches, bias = tree(of, c, classes)
    outer_levels, outer_bias, leaves = outer_tree(counts.where(~inside), distinct - len(words), classes, OUTER_LEVELS)
    with np.errstate(divide="ignore"):
        leaf_sums = np.log10(leaves)
    rows = ROWS
    while rows < min(MOST_ROWS, 2 * distinct):
        rows *= 2
    return Vocabulary(words[order], of[order].astype(np.int16), order.astype(np.int64), np.log10(c[order] + 1.0), logs, total, distinct, nodes[:, order], branches[:, order], np.concatenate((bias, outer_bias)), len(bias), outer_levels, leaf_sums, rows)


def _hashed(*parts: np.ndarray, rows: int) -> np.ndarray:
    h = np.zeros(len(parts[0]), np.uint64)
    for k, p in enumerate(parts):
        h = (h + p.astype(np.uint64) + np.uint64(k + 1)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return (mix(h) & np.uint64(rows - 1)).astype(np.int64)


def features(classes: np.ndarray, names: np.ndarray, first: np.ndarray, rows: int) -> np.ndarray:
    """Active weight rows of every token, one column for each kind of features. first: where each token's text begins; before it stands END."""
    n = len(classes)
    at = np.arange(n)

    def back(values: np.ndarray, k: int, empty: int) -> np.ndarray:
        out = np.empty_like(values)
        out[k:] = values[: n - k]
        out[:k] = empty
        out[at - first < k] = empty
        return out

    w1, w2, w3 = (back(names, k, -2) + 2 for k in (1, 2, 3))
    c1, c2, c3 = (back(classes, k, CLASSES) for k in (1, 2, 3))
    none = np.zeros(n, np.int64)
    parts = [(none + 1, w1), (none + 2, w2), (none + 3, w3), (none + 5, c1, c2, c3), (none + 4, w1, w2)]
    # each kind's rows lie together
    return np.stack([_hashed(*p, rows=rows) for p in parts]).T


@cache
def _item(size: int) -> np.dtype:
    return np.dtype((np.void, size))


def _whole(weights: np.ndarray) -> np.ndarray:
    """Weight rows as single items, which numpy copies whole."""
    return weights.view(_item(weights.itemsize * weights.shape[1]))[:, 0]


class Scratch:
    """Arrays of rows that are written again and again: fresh ones of this size cost more than what is done with them."""

    def __init__(self) -> None:
        self.held: dict[str, np.ndarray] = {}

    def rows(self, name: str, n: int, classes: int) -> np.ndarray:
        held = self.held.get(name)
        if held is None or len(held) < n or held.shape[1] != classes:
            held = self.held[name] = np.empty((n, classes), np.float32)
        return held[:n]

    def take(self, name: str, weights: np.ndarray, at: np.ndarray) -> np.ndarray:
        out = self.rows(name, len(at), weights.shape[1])
        np.take(_whole(weights), at, out=_whole(out), mode="clip")
        return out


def _logits(rows: list[np.ndarray], bias: np.ndarray, scratch: Scratch) -> np.ndarray:
    """The branches' sums of weights, a kind of feature each, and bias."""
    logits = np.add(rows[0], bias, out=scratch.rows("logits", *rows[0].shape))
    for x in rows[1:]:
        logits += x
    return logits


def _exponentials(logits: np.ndarray, scratch: Scratch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Exponentials of what logits have above a number, the rows' sums of them, and the number: the batch's largest logit, and for rows that are too small then for exact floats their own."""
    top = logits.max()
    out = np.subtract(logits, top, out=scratch.rows("exponentials", *logits.shape))
    np.exp(out, out=out)
    sums, tops = np.einsum("ij->i", out), np.full(len(logits), top)
    low = np.flatnonzero(~(sums > 1e-20))
    if len(low):
        tops[low] = logits[low].max(axis=1)
        out[low] = np.exp(logits[low] - tops[low, None])
        sums[low] = out[low].sum(axis=1)
    return out, sums, tops


def _gathered(weights: np.ndarray, active: np.ndarray, scratch: Scratch) -> list[np.ndarray]:
    n, kinds = active.shape
    rows = scratch.take("rows", weights, active.T.ravel())
    return [rows[k * n : (k + 1) * n] for k in range(kinds)]


def softmax(weights: np.ndarray, active: np.ndarray, bias: np.ndarray) -> np.ndarray:
    scratch = Scratch()
    out, sums, _ = _exponentials(_logits(_gathered(weights, active, scratch), bias, scratch), scratch)
    return out / sums[:, None]


def log10_softmax(weights: np.ndarray, active: np.ndarray, bias: np.ndarray, branch: np.ndarray, scratch: Scratch) -> np.ndarray:
    """Of each row the branch that is taken."""
    logits = _logits(_gathered(weights, active, scratch), bias, scratch)
    _, sums, tops = _exponentials(logits, scratch)
    taken = logits[np.arange(len(branch)), branch].astype(np.float64)
    return (taken - tops - np.log(sums)) / np.log(10)


def _group_sums(p: np.ndarray, at: np.ndarray, begin: np.ndarray, times: np.ndarray, scratch: Scratch) -> np.ndarray:
    """Sums of the rows p[at] by groups of two or more that begin at `begin`, largest first. The first rows of all are added rank by rank; what is left of groups of like size is
    summed at once, filled up by the last row of p, which is zero."""
    out = scratch.take("sums", p, at[begin])
    for rank in range(1, RANKS):
        n = int(np.searchsorted(-times, -rank))
        out[:n] += scratch.take("group", p, at[begin[:n] + rank])
    hi = int(np.searchsorted(-times, -RANKS))
    while hi:
        # those with more than half of what the smallest could be filled up to
        w = 1 << int(times[hi - 1] - RANKS - 1).bit_length()
        lo = int(np.searchsorted(-times[:hi], -(w + RANKS), side="left"))
        place = np.arange(RANKS, RANKS + w)
        found = np.where(place < times[lo:hi, None], at[np.minimum(begin[lo:hi, None] + place, len(at) - 1)], len(p) - 1)
        out[lo:hi] += np.einsum("ijk->ik", scratch.take("group", p, found.ravel()).reshape(hi - lo, w, -1))
        hi = lo
    return out


class Local:
    """One task's AdaGrad from common weights."""

    def __init__(self, weights: np.ndarray):
        self.start, self.weights = weights, weights.copy()
        self.square = np.full(len(weights), 1e-2, np.float32)
        self.active = np.zeros(len(weights), np.float32)
        self.scratch = Scratch()

    def step(self, active: np.ndarray, target: np.ndarray, bias: np.ndarray) -> None:
        """Moves the active rows along the gradient of these decisions. A row that is active once, as most are, moves by its decision's; only for others the decisions' are added up."""
        n, kinds = active.shape
        scratch, classes = self.scratch, self.weights.shape[1]
        rows = _gathered(self.weights, active, scratch)
        e, sums, _ = _exponentials(_logits(rows, bias, scratch), scratch)
        ended = scratch.rows("gradient", n + 1, classes)
        p = np.divide(e, sums[:, None], out=ended[:n])
        p.reshape(-1)[np.arange(0, n * classes, classes) + target] -= 1
        ended[n] = 0
        # an entry is a kind of feature and a decision, its lower bits
        low = (n - 1).bit_length()
        bits = low + kinds.bit_length()
        key = np.sort((active.T << bits | np.arange(kinds)[:, None] << low | np.arange(n)).ravel())
        row, at = key >> bits, key & ((1 << bits) - 1)
        begin = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
        row, first, times = row[begin], at[begin], np.diff(np.append(begin, n * kinds))
        at &= (1 << low) - 1
        many = np.flatnonzero(times > 1)
        many = many[np.argsort(-times[many], kind="stable")]
        g = _group_sums(ended, at, begin[many], times[many], scratch)
        times = times.astype(np.float32)
        self.active[row] += times
        square = np.einsum("ij,ij->i", p, p)[first & ((1 << low) - 1)]
        square[many] = np.einsum("ij,ij->i", g, g) / times[many]
        square += self.square[row]
        self.square[row] = square
        rate = RATE / np.sqrt(square * times)
        moved = scratch.take("moved", self.weights, row[many])
        g *= rate[many, None]
        moved -= g
        own = np.zeros((kinds, 1 << low), np.float32)
        own.ravel()[first] = rate
        for x, share, of in zip(rows, own, active.T, strict=True):
            x -= np.multiply(p, share[:n, None], out=e)
            _whole(self.weights)[of] = _whole(x)
        # rows active more than once have been written by one decision, or another
        _whole(self.weights)[row[many]] = _whole(moved)

    def changes(self) -> Iterator[tuple[int, bytes]]:
        """By chunk of rows: the rows that were active, how often, and their change."""
        for k in range(0, len(self.weights), CHUNK_ROWS):
            row = np.flatnonzero(self.active[k : k + CHUNK_ROWS])
            if len(row):
                moved = self.weights[k + row] - self.start[k + row]
                yield k // CHUNK_ROWS, np.uint32(len(row)).tobytes() + row.astype(np.uint32).tobytes() + self.active[k + row].tobytes() + moved.astype(np.float16).tobytes()


def _encoded(words: np.ndarray, at: np.ndarray, v: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Places in the head, classes, feature names (-1: none of its own) and text beginnings of tokens."""
    place = v.find(words)
    known = place >= 0
    safe = np.where(known, place, 0)
    classes = np.where(known, v.classes[safe], CLASSES - 1).astype(np.int64) if len(v.words) else np.full(len(words), CLASSES - 1)
    names = np.where(known, v.names[safe], -1) if len(v.words) else np.full(len(words), -1)
    names = np.where((names >= 0) & (names < v.named), names, v.named + classes)
    return place, classes, names, np.repeat(at[:-1], np.diff(at))


def _levels(words: np.ndarray, at: np.ndarray, v: Vocabulary, rows: int) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray | None]]]:
    """Places in the head, and for the classes and each level of the trees: the tokens that decide there, their active weight rows, the branch taken, and the node (None: the classes')."""
    place, classes, names, first = _encoded(words, at, v)
    wide = features(classes, names, first, 1 << 62)
    out = [(np.arange(len(words)), wide & (rows - 1), classes, None)]

    def level(tokens: np.ndarray, node: np.ndarray, branch: np.ndarray) -> None:
        key = (node.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        active = (mix(np.take(wide.T, tokens, axis=1).view(np.uint64) + key) & np.uint64(rows - 1)).view(np.int64)
        out.append((tokens, active.T, branch.astype(np.int64), node))

    head = np.flatnonzero(place >= 0)
    word = place[head]
    for nodes, branches in zip(v.nodes, v.branches, strict=True):
        node = nodes[word]
        deeper = np.flatnonzero(node >= 0)
        head, word, node = head[deeper], word[deeper], node[deeper]
        if len(head):
            level(head, node, branches[word])
    away = np.flatnonzero(place < 0)
    # a word that no leaf can hold is unknown, and ends at its class
    away = away[np.isfinite(v.leaf_sums[_leaf(words[away], v)])]
    start = v.outer
    for k in range(v.outer_levels if len(away) else 0):
        of = (words[away] & np.uint64((1 << OUTER_BITS * k) - 1)).astype(np.int64)
        branch = (words[away] >> np.uint64(OUTER_BITS * k)) & np.uint64((1 << OUTER_BITS) - 1)
        level(away, start + of, branch)
        start += 1 << OUTER_BITS * k
    return place, out


def decisions(words: np.ndarray, at: np.ndarray, v: Vocabulary, rows: int, bias: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]]:
    """Places in the head, and for the classes and each level of the trees: the tokens that decide there, their active weight rows, the branch taken, and a bias for all or each."""
    place, levels = _levels(words, at, v, rows)
    return place, [(of, active, branch, bias[None, :] if node is None else v.bias[node]) for of, active, branch, node in levels]


def batched(levels: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray | None]], v: Vocabulary, bias: np.ndarray, scratch: Scratch) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Decisions in batches, with their level; biases only as long as the batch is worked on."""
    for depth, (of, active, branch, node) in enumerate(levels):
        for k in range(0, len(of), BATCH):
            own = bias[None, :] if node is None else scratch.take("bias", v.bias, node[k : k + BATCH])
            yield depth, of[k : k + BATCH], active[k : k + BATCH], branch[k : k + BATCH], own


def _leaf(words: np.ndarray, v: Vocabulary) -> np.ndarray:
    return (words & np.uint64(len(v.leaf_sums) - 1)).astype(np.int64)


def _trained(batches: Iterator[pa.RecordBatch], sent: Broadcast) -> Iterator[pa.RecordBatch]:
    v, weights, bias = sent.value
    local = None
    for b in batches:
        data, offsets = buffers(b.column(0))
        for lo, hi in slices(offsets, 1 << 18):
            words, at = tokens(data, offsets[lo : hi + 1])
            local = local or Local(weights)
            for _, _, active, branch, own in batched(_levels(words, at, v, len(weights))[1], v, bias, local.scratch):
                local.step(active, branch, own)
    if local:
        out = list(local.changes())
        task = pa.array([TaskContext.get().partitionId()] * len(out), pa.int32())
        yield pa.RecordBatch.from_arrays([task, pa.array([k for k, _ in out], pa.int32()), pa.array([x for _, x in out], pa.binary())], names=["task", "chunk", "body"])


def _summed(classes: int, first: bool, last: bool):
    """Sums a chunk's rows over tasks: how often each was active, and their changes by that (as sums, but from tasks themselves: `first`); at the end (`last`) their means, of all rows."""

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        times, moved = np.zeros(CHUNK_ROWS, np.float32), np.zeros((CHUNK_ROWS, classes), np.float32)
        for b in batches:
            for body in b.column("body"):
                data = body.as_buffer()
                n = int(np.frombuffer(data, np.uint32, 1)[0])
                row, active = np.frombuffer(data, np.uint32, n, 4), np.frombuffer(data, np.float32, n, 4 + 4 * n)
                change = np.frombuffer(data, np.float16 if first else np.float32, n * classes, 4 + 8 * n).reshape(n, classes)
                times[row] += active
                moved[row] += active[:, None] * change if first else change
        if last:
            out = (moved / np.maximum(times, 1)[:, None]).tobytes()
        else:
            row = np.flatnonzero(times)
            out = np.uint32(len(row)).tobytes() + row.astype(np.uint32).tobytes() + times[row].tobytes() + moved[row].tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([out], pa.binary())], names=["chunk", "body"])

    return run


def averaged(parts: DataFrame, tasks: int, classes: int) -> DataFrame:
    """(chunk, body) of tasks' changes (task, chunk, body) as means. Many tasks' are summed in two steps, so that no group holds more than about the root of their number."""
    groups = 1 if tasks <= SUMMED_TASKS else int(tasks**0.5)
    kind = "chunk int, body binary"
    if groups > 1:
        parts = parts.groupBy("chunk", F.pmod("task", F.lit(groups)).alias("group")).applyInArrow(_summed(classes, True, False), kind)
    return parts.groupBy("chunk").applyInArrow(_summed(classes, groups == 1, True), kind)


def train(texts: Callable[[int], DataFrame], tasks: int, v: Vocabulary, classes: int, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and class bias. texts(r): the text column of round r's documents, in so many partitions."""
    mass = 10.0**v.log_sums
    bias = np.log(np.maximum(mass, 1e-9) / max(mass.sum(), 1e-9)).astype(np.float32)
    weights = np.zeros((rows, classes), np.float32)
    for r in range(ROUNDS):
        docs = texts(r)
        sent = docs.sparkSession.sparkContext.broadcast((v, weights, bias))
        parts = docs.mapInArrow(lambda it, sent=sent: _trained(it, sent), "task int, chunk int, body binary")
        weights = weights.copy()
        for row in averaged(parts, tasks, classes).toArrow().to_pylist():
            at = row["chunk"] * CHUNK_ROWS
            x = np.frombuffer(row["body"], np.float32).reshape(CHUNK_ROWS, classes)[: rows - at]
            weights[at : at + len(x)] += x
        sent.destroy()
    return weights, bias


def _scored(batches: Iterator[pa.RecordBatch], sent: Broadcast) -> Iterator[pa.RecordBatch]:
    """Of each row: its tokens, those in the head, their sum of log10 (count + 1), what the model's score has above this for tokens of the head and unknown ones; then a row
    for each distinct word outside the head with how often it stands there, and what its score has above an unknown one's and log10 (count + 1) if it is known."""
    v, weights, bias = sent.value
    names_out = ["row", "doc_id", "n_tokens", "n_head", "head_score", "class_score", "word", "n", "tree_score"]
    part, row, scratch = TaskContext.get().partitionId() << 33, 0, Scratch()
    for b in batches:
        data, offsets = buffers(b.column(1))
        for lo, hi in slices(offsets, 1 << 18):
            words, at = tokens(data, offsets[lo : hi + 1])
            place, levels = _levels(words, at, v, len(weights))
            head = place >= 0
            scores, within = np.zeros(len(words)), np.zeros(len(words))
            for depth, of, active, branch, own in batched(levels, v, bias, scratch):
                (within if depth else scores)[of] += log10_softmax(weights, active, own, branch, scratch)
            known = np.where(head, v.log_counts[np.where(head, place, 0)], 0.0) if len(v.words) else np.zeros(len(words))
            scores += np.where(head, within - known, -v.log_sums[-1])
            # of the last class's sum one is the unknown word's
            within += np.log10(max(10.0 ** v.log_sums[-1] - 1, 1e-9)) - v.leaf_sums[_leaf(words, v)]
            rows = np.arange(hi - lo)
            ids = part + row + rows
            n_tokens, n_head = np.diff(at), np.add.reduceat(head.astype(np.int64), at[:-1])
            of = np.repeat(rows, n_tokens)
            away, away_of, away_score = words[~head], of[~head], within[~head]
            order = np.lexsort((away, away_of))
            away, away_of, away_score = away[order], away_of[order], away_score[order]
            begin = np.flatnonzero(np.append(True, (away[1:] != away[:-1]) | (away_of[1:] != away_of[:-1]))) if len(away) else np.zeros(0, np.int64)
            times = np.diff(np.append(begin, len(away)))
            docs = b.column(0).slice(lo, hi - lo)
            m = len(begin)
            zero, nothing = pa.nulls(m, pa.int64()), pa.nulls(m, pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(ids), docs, pa.array(n_tokens), pa.array(n_head), pa.array(np.add.reduceat(known, at[:-1])), pa.array(np.add.reduceat(scores, at[:-1])), pa.nulls(hi - lo, pa.int64()), pa.nulls(hi - lo, pa.int64()), pa.nulls(hi - lo, pa.float64())], names=names_out)
            if m:
                yield pa.RecordBatch.from_arrays([pa.array(ids[away_of[begin]]), zero, zero, zero, nothing, nothing, pa.array(away[begin].view(np.int64)), pa.array(times), pa.array(np.add.reduceat(away_score, begin))], names=names_out)
            row += hi - lo


def score(docs: DataFrame, held_out) -> DataFrame:
    """Scores of every document by a model of those where the column `held_out` is false.

    Returns doc_id, held_out, n_tokens, n_known (tokens whose word is in training texts), train_tokens, base_score (unigrams, one added to each count)
    and score (log10 probability of the text, END included, by the model). Null texts are empty: END alone. A null held_out
    counts as false. Equal rows are scored one by one; further columns are ignored; an empty table gives an empty one. With no
    training text all words are unknown and both scores are 0.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col("text").cast("string").alias("text"))
    train_rows = rows.where("not held_out")
    counts = word_counts(train_rows.select("text"))
    v = vocabulary(counts, HEAD, CLASSES)
    tasks = max(1, round(v.total / (TASK_TOKENS * v.rows / ROWS * max(1.0, (v.total / MANY_TOKENS) ** 0.5))))
    # a hash of its doc_id (its text without one) deals each document to a round and a task, and orders a task's, so that scores don't depend on how the table is stored
    drawn = train_rows.select(F.xxhash64(F.coalesce("doc_id", F.xxhash64("text"))).alias("draw"), "text")

    def texts(r: int) -> DataFrame:
        mine = drawn.where(F.pmod("draw", F.lit(ROUNDS)) == r)
        return mine.repartitionById(tasks, F.pmod(F.xxhash64("draw"), F.lit(tasks)).cast("int")).sortWithinPartitions("draw", F.octet_length("text")).select("text")

    weights, bias = train(texts, tasks, v, CLASSES, v.rows)
    sent = docs.sparkSession.sparkContext.broadcast((v, weights, bias))
    found = written(rows.select("doc_id", "text").mapInArrow(lambda it: _scored(it, sent), "row bigint, doc_id bigint, n_tokens bigint, n_head bigint, head_score double, class_score double, word bigint, n bigint, tree_score double"), "scored")
    away = found.where("word is not null").select("row", "word", "n", "tree_score").join(counts, "word")
    away = away.groupBy("row").agg(F.sum("n").alias("n_away"), F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("away_score"), F.sum("tree_score").alias("tree_score"))
    count_score = F.col("head_score") + F.coalesce("away_score", F.lit(0.0))
    all_words = F.lit(float(np.log10(v.total + v.distinct + 1)))
    whole = found.where("word is null").drop("tree_score").join(away, "row", "left").select("doc_id", "n_tokens", (F.col("n_head") + F.coalesce("n_away", F.lit(0))).alias("n_known"), F.lit(v.total).cast("bigint").alias("train_tokens"), (count_score - F.col("n_tokens") * all_words).alias("base_score"), (count_score + F.col("class_score") + F.coalesce(away["tree_score"], F.lit(0.0))).alias("score"))
    return whole

