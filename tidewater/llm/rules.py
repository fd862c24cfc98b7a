"""Quality rules: an isolation forest on rule statistics.

Base rules fail a text with fewer than MIN_WORDS words or with more than MAX_REPEAT percent of
its words in repeated windows. The others are judged by a forest: trees split random
statistics at random values until a document stands alone; documents that a few splits
isolate are anomalous. The anomaly score is 2 ** (-mean path length / expected path length).

The forest has TREES trees, and every document that passes the base rules takes part: it is
dealt to one tree by hash, to more where a tree would get fewer than TREE_ROWS rows. Trees grow
level by level, all at once: a Spark job brings the count, least and largest statistics of each
open node, and the driver draws the next splits from those. The threshold is calibrated from the
scores of all labelled rows, counted in BINS bins: it is the upper end of the bin that best
parts label 0 from label 1 (highest share of good ones kept minus share of bad ones kept), but
never one that rejects more than MAX_LOST of the good ones. Without labels of both kinds only
scores beyond all documents' are anomalous.

Statistics of all documents cover their whole texts. Null and empty texts have no words and
fail the base rules. Ids with several labels count once, with the smallest.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MIN_WORDS, MAX_REPEAT, WINDOW = 20, 30, 8
TREES, TREE_ROWS, SEED = 128, 256, 11
BINS, MAX_LOST = 1 << 16, 0.002

SYMBOLS, MARKS = b"#*$%&|<>", b"!?"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
VERDICT = ", ".join(f"{c} bigint" for c in COUNTS) + ", base_failed boolean, kept boolean, anomaly double"


# --- statistics -------------------------------------------------------------------------

def statistics(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The counts of the rules, and the features of the forest, for each text."""
    words, n = C.Words(texts), len(texts)
    first = words.first[:n + 1]
    count = np.diff(first)
    raw = np.frombuffer(words.data, np.uint8)
    lead = (raw & 0xC0) != 0x80  # bytes that begin a code point
    points = np.concatenate([[0], np.cumsum(lead)])
    word_points = points[words.end] - points[words.start]
    chars = C.group_sums(word_points, first)
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS)] = True
    found = symbol[raw]
    symbols = C.group_sums(found, words.at)
    repeat = C.group_sums(_repeated(words, first), first)
    dup = _dup_lines(words, raw, n)
    counts = np.stack([count, chars, symbols, dup, repeat], 1).astype(np.int64)

    # What the base rules leave to the forest: word length, symbols, distinct words, marks and
    # words of one character. Repeats and length would isolate harmless extremes.
    per = 1 / np.maximum(count, 1)
    owner = np.repeat(np.arange(n), count)
    key = np.sort((owner.astype(np.uint64) << C.U(40)) | (words.name[:owner.size] >> C.U(24)))
    new = np.ones(key.size, bool)
    new[1:] = key[1:] != key[:-1]
    distinct = np.bincount((key[new] >> C.U(40)).astype(np.int64), minlength=n)
    mark = np.zeros(256, bool)
    mark[list(MARKS)] = True
    features = np.stack([
        chars * per, symbols / np.maximum(chars, 1), C.group_sums(mark[raw], words.at) / np.maximum(chars, 1),
        np.log1p(distinct) / np.maximum(np.log1p(count), 1e-9), np.bincount(owner, word_points <= 1, n) * per], 1)
    return counts, features


def _repeated(words: C.Words, first: np.ndarray) -> np.ndarray:
    """Which words lie in a window that occurs twice or more in their text."""
    total = int(first[-1])
    gram = C.grams(words.name[:total], WINDOW)
    at = np.flatnonzero(C.within(first, WINDOW, total))
    if not at.size:
        return np.zeros(total, bool)
    owner = np.searchsorted(first, at, "right").astype(np.uint64)
    key = C.joined_name(gram[at], owner * C.GOLD)
    order = np.argsort(key, kind="stable")
    key = key[order]
    twin = np.zeros(key.size, bool)
    twin[1:] = key[1:] == key[:-1]
    twin[:-1] |= twin[1:]
    return C.covered(at[order[twin]], WINDOW, total)


def _dup_lines(words: C.Words, raw: np.ndarray, n: int) -> np.ndarray:
    """Lines with a word that are equal to an earlier line of their text."""
    end = np.flatnonzero(raw[:words.at[n]] == 10)
    # Line ends: a line feed, or the blank behind a text.
    stop = np.union1d(end, words.at[1:n + 1] - 1)
    start = np.concatenate([[0], stop[:-1] + 1])
    text = np.searchsorted(words.at[:n + 1], start, "right") - 1
    if not stop.size:
        return np.zeros(n, np.int64)
    solid = np.searchsorted(words.start, stop) > np.searchsorted(words.start, start)
    start, stop, text = start[solid], stop[solid], text[solid]
    whole: set[bytes] = set()
    dup = np.zeros(n, np.int64)
    data = words.data
    last = -1
    for t, a, b in zip(text.tolist(), start.tolist(), stop.tolist()):
        if t != last:
            whole, last = set(), t
        line = data[a:b]
        if line in whole:
            dup[t] += 1
        else:
            whole.add(line)
    return dup


def base_failed(counts: np.ndarray) -> np.ndarray:
    return (counts[:, 0] < MIN_WORDS) | (100 * counts[:, 4] > MAX_REPEAT * counts[:, 0])


# --- forest -----------------------------------------------------------------------------

def expected_path(n) -> np.ndarray:
    """Mean path length of an unsuccessful search in a random tree of n rows."""
    n = np.asarray(n, float)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649) - 2 * (n - 1) / np.maximum(n, 1),
                    np.where(n == 2, 1.0, 0.0))


class Forest:
    """Trees as arrays: feature or -1, value of the split, left child (right is next), and
    the path length that a leaf stands for."""

    def __init__(self, rows: np.ndarray, threshold: float = 1.0):
        rng = np.random.default_rng(SEED)
        self.trees, self.threshold = [], threshold
        self.size = min(TREE_ROWS, len(rows))
        depth = math.ceil(math.log2(max(2, self.size)))
        for _ in range(TREES if len(rows) > 1 else 0):
            self.trees.append(self._grow(rows[rng.choice(len(rows), self.size, replace=False)], depth, rng))

    @staticmethod
    def _grow(rows, depth, rng):
        feature, value, left, path = [-1], [0.0], [0], [0.0]
        todo = [(0, rows, 0)]
        while todo:
            node, part, level = todo.pop()
            low, high = part.min(0), part.max(0)
            wide = np.flatnonzero(high > low)
            if level >= depth or len(part) <= 1 or not wide.size:
                path[node] = level + float(expected_path(len(part)))
                continue
            f = int(rng.choice(wide))
            v = float(rng.uniform(low[f], high[f]))
            feature[node], value[node], left[node] = f, v, len(feature)
            for child in (part[part[:, f] < v], part[part[:, f] >= v]):
                todo.append((len(feature), child, level + 1))
                feature.append(-1), value.append(0.0), left.append(0), path.append(0.0)
                if not len(child):
                    path[-1] = level + 1.0
                    todo.pop()
        return np.array(feature), np.array(value), np.array(left), np.array(path)

    @staticmethod
    def leaf(tree, rows: np.ndarray) -> np.ndarray:
        """The leaf of a tree that each row comes to."""
        feature, value, left, _ = tree
        node, every = np.zeros(len(rows), np.int64), np.arange(len(rows))
        while True:
            f = feature[node]
            inner = f >= 0
            if not inner.any():
                return node
            right = rows[every, np.maximum(f, 0)] >= value[node]
            node = np.where(inner, left[node] + right, node)

    def scores(self, rows: np.ndarray) -> np.ndarray:
        if not self.trees or not len(rows):
            return np.zeros(len(rows))
        total = np.zeros(len(rows))
        for tree in self.trees:
            total += tree[3][self.leaf(tree, rows)]
        return 2.0 ** (-total / len(self.trees) / max(float(expected_path(self.size)), 1e-9))


def _bin(score: np.ndarray) -> np.ndarray:
    """Bins of scores; the upper end belongs to a bin."""
    return np.clip(np.ceil(np.asarray(score, float) * BINS).astype(np.int64) - 1, 0, BINS - 1)


def parted(good: np.ndarray, bad: np.ndarray, every: np.ndarray) -> float:
    """The largest score that is still kept, from counts of scores by bin."""
    if not good.any() or not bad.any():
        return float(np.flatnonzero(every).max(initial=BINS - 1 if not every.any() else 0) + 1) / BINS
    kept, lost = np.cumsum(good) / good.sum(), np.cumsum(bad) / bad.sum()
    cuts = np.flatnonzero((good > 0) & (kept >= 1 - MAX_LOST))
    return float(cuts[int(np.argmax((kept - lost)[cuts]))] + 1) / BINS


def calibrated(good: np.ndarray, bad: np.ndarray, every: np.ndarray) -> float:
    """The same from the scores themselves."""
    return parted(*[np.bincount(_bin(np.ravel(s)), minlength=BINS) for s in (good, bad, every)])


WIDTH = statistics([b""])[1].shape[1]


def _joined(batches, limit: int = 1 << 16):
    """Record batches joined to about `limit` rows."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= limit:
            yield pa.Table.from_batches(held).combine_chunks()
            held, n = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _rows(batch) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("f").to_pylist()), np.float64).reshape(-1, WIDTH)


def _features(docs: DataFrame) -> DataFrame:
    """doc_id and features of the texts that pass the base rules."""
    def work(batches):
        for batch, texts in C.slices(batches):
            counts, features = statistics(texts)
            keep = ~base_failed(counts)
            yield from C.to_batches({"doc_id": batch.column("doc_id").filter(pa.array(keep)),
                                     "f": pa.array([x.tobytes() for x in features[keep]], pa.binary())})
    return C.map_batches(docs.select(F.col("doc_id").cast("bigint"), "text"), work, "doc_id bigint, f binary")


def _grown(rows: DataFrame) -> Forest:
    """A forest of all rows (f and _tree, the first of the trees that a row is dealt to)."""
    forest, total = Forest(np.zeros((0, WIDTH))), rows.count()
    if total <= 1:
        return forest
    shares = min(TREES, -(-TREES * TREE_ROWS // total))
    forest.size = max(2, round(total * shares / TREES))
    depth = math.ceil(math.log2(max(2, min(forest.size, TREE_ROWS))))
    trees = [([-1], [0.0], [0], [0.0]) for _ in range(TREES)]
    opened = [[0] for _ in range(TREES)]
    ends = [f"{end}{i}" for end in ("low", "high") for i in range(WIDTH)]
    for level in range(depth + 1):
        found = _nodes(rows, [tuple(np.array(a) for a in t) for t in trees], opened, shares).groupBy("tree", "node").agg(
            F.sum("n").alias("n"), *[(F.min if e.startswith("low") else F.max)(e).alias(e) for e in ends]).collect()
        opened = [[] for _ in range(TREES)]
        for r in sorted(found, key=lambda r: (r.tree, r.node)):
            feature, value, left, path = trees[r.tree]
            low, high = np.array(r[3:3 + WIDTH]), np.array(r[3 + WIDTH:])
            wide = np.flatnonzero(high > low)
            if level >= depth or r.n <= 1 or not wide.size:
                path[r.node] = level + float(expected_path(r.n))
                continue
            rng = np.random.default_rng([SEED, r.tree, r.node])
            f = int(rng.choice(wide))
            feature[r.node], value[r.node], left[r.node] = f, float(rng.uniform(low[f], high[f])), len(feature)
            for _ in range(2):  # a child that no row comes to stays a leaf of this path
                opened[r.tree].append(len(feature))
                feature.append(-1), value.append(0.0), left.append(0), path.append(level + 1.0)
        if not any(opened):
            break
    forest.trees = [tuple(np.array(a) for a in t) for t in trees]
    return forest


def _nodes(rows: DataFrame, trees: list, opened: list, shares: int) -> DataFrame:
    """Count, least and largest features of the rows in each open node, as each task finds them."""
    sent = rows.sparkSession.sparkContext.broadcast((trees, opened))

    def work(batches):
        trees, opened = sent.value
        for batch in _joined(batches):
            x, first = _rows(batch), batch.column("_tree").to_numpy()
            out = {"tree": [], "node": [], "n": [], "low": [], "high": []}
            for t in range(TREES):
                mine = x[(t - first) % TREES < shares]
                if not opened[t] or not len(mine):
                    continue
                node = Forest.leaf(trees[t], mine)
                inside = np.isin(node, opened[t])
                mine, node = mine[inside], node[inside]
                order = np.argsort(node, kind="stable")
                mine, (at, start, n) = mine[order], np.unique(node[order], return_index=True, return_counts=True)
                if at.size:
                    out["tree"].append(np.full(at.size, t)), out["node"].append(at), out["n"].append(n)
                    out["low"].append(np.minimum.reduceat(mine, start)), out["high"].append(np.maximum.reduceat(mine, start))
            if out["tree"]:
                got = {k: np.concatenate(v) for k, v in out.items()}
                yield from C.to_batches({**{k: got[k].astype(np.int64) for k in ("tree", "node", "n")},
                                         **{f"{e}{i}": got[e][:, i] for e in ("low", "high") for i in range(WIDTH)}})

    ends = ", ".join(f"{e}{i} double" for e in ("low", "high") for i in range(WIDTH))
    return C.map_batches(rows, work, f"tree bigint, node bigint, n bigint, {ends}")


def _counted(rows: DataFrame, forest: Forest) -> DataFrame:
    """Scores of rows (f, _label) counted by label and bin."""
    sent = rows.sparkSession.sparkContext.broadcast(forest)

    def work(batches):
        for batch in _joined(batches):
            score = _bin(sent.value.scores(_rows(batch)))
            label = batch.column("_label").fill_null(-1).to_numpy().astype(np.int64)
            key, n = np.unique((label + 1) * BINS + score, return_counts=True)
            yield from C.to_batches({"label": key // BINS - 1, "bin": key % BINS, "n": n.astype(np.int64)})

    return C.map_batches(rows.select("f", "_label"), work, "label bigint, bin bigint, n bigint").groupBy(
        "label", "bin").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, labels: DataFrame) -> Forest:
    """A forest with its threshold; labels: doc_id and quality 0 or 1."""
    rows = C.stored(_features(docs).withColumn(
        "_tree", F.pmod(F.xxhash64("doc_id", "f"), F.lit(TREES)).cast("bigint")))
    forest = _grown(rows)
    known = (labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
             .groupBy("doc_id").agg(F.min(F.col("quality").cast("int")).alias("_label")))
    counts = {q: np.zeros(BINS, np.int64) for q in (-1, 0, 1)}
    for r in _counted(rows.join(known, "doc_id", "left"), forest).collect():
        counts[r.label if r.label in (0, 1) else -1][r.bin] += r.n
    forest.threshold = parted(counts[1], counts[0], sum(counts.values()))
    return forest


def judged(docs: DataFrame, forest: Forest) -> DataFrame:
    """doc_id, the counts, base_failed, kept and the anomaly score."""
    sent = docs.sparkSession.sparkContext.broadcast(forest)

    def work(batches):
        forest = sent.value
        for rows, texts in C.slices(batches):
            counts, features = statistics(texts)
            failed, score = base_failed(counts), forest.scores(features)
            yield from C.to_batches({"doc_id": rows.column("doc_id"),
                                     **{c: counts[:, i] for i, c in enumerate(COUNTS)},
                                     "base_failed": failed, "kept": ~failed & (score <= forest.threshold), "anomaly": score})

    return C.map_batches(docs.select(F.col("doc_id").cast("bigint"), "text"), work, f"doc_id bigint, {VERDICT}")
