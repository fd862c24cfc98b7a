"""Quality classifier: multiple-instance learning with gated attention.

A document is a bag of passages of PASSAGE words, the whole text, the last one shorter. Every
passage becomes a vector of counts and shares (FEATURES) and of hashed words (HASHED), which a
tanh layer encodes. A gate, tanh(V h) * sigmoid(U h), gives each passage a weight, softmax over
the document; the weighted sum of the encoded passages gives the score. Encoder, gate and
output are learned together from document labels, so no passage needs a label of its own.

The model is fitted on the driver on a bounded sample: at most SAMPLE_PER_CLASS labelled
documents of each class, those with the smallest hashes of their ids, and at most
SAMPLE_PASSAGES passages of each, evenly spread. Classes are weighted to their shares among
all labelled rows given, so scores are probabilities. Scoring reads all passages of all texts.

Null and empty texts are one empty passage. Ids with several labels count once, with the
smallest; null labels are left out. With labels of one class only, or none, the score is the
smoothed share of label 1 (1 of no labels). Repeated rows are scored each.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PASSAGE = 64
SAMPLE_PER_CLASS = 3000
SAMPLE_PASSAGES = 48
HIDDEN, GATE, STEPS, SEED = 24, 16, 200, 7
#: Characters are counted by kind; the kinds are sets of bytes.
KINDS = [b"#*$%&|<>", b"!?", b".,;:'\"()-", b"0123456789", bytes(range(65, 91)), b"\n",
         bytes(range(97, 123)), b"@/\\_=+[]{}~^`"]
FEATURES = len(KINDS) + 8
HASHED = 32
SCORED = "score double"


def passages(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The vectors of all passages, and for each text the index of its first one (and the
    end). Every text has one at least."""
    words = C.Words(texts)
    count = words.counts()[:len(texts)]
    number = np.maximum(1, -(-count // PASSAGE))
    first = np.concatenate([[0], np.cumsum(number)])
    total = int(first[-1])
    doc = np.repeat(np.arange(len(texts)), number)
    nth = np.arange(total) - first[doc]
    lo = words.first[doc] + nth * PASSAGE
    hi = np.minimum(lo + PASSAGE, words.first[doc + 1])
    n = hi - lo
    share = 1 / np.maximum(n, 1)
    if not words.name.size:
        return np.zeros((total, FEATURES + HASHED), np.float32), first
    owner = np.repeat(np.arange(total), n)
    out = np.zeros((total, FEATURES + HASHED), np.float64)
    # Bytes of the passage, from its first word to the first word of the next one.
    stop = np.append(words.start, len(words.data))
    a = stop[np.minimum(lo, words.name.size)]
    b = np.where(hi < words.first[doc + 1], stop[np.minimum(hi, words.name.size)],
                 words.at[doc] + np.diff(words.at)[doc] - 1)
    b = np.where(n > 0, np.maximum(b, a), a)
    raw = np.frombuffer(words.data, np.uint8)
    per_byte = 1 / np.maximum(b - a, 1)
    for k, kind in enumerate(KINDS):
        hit = np.zeros(256, bool)
        hit[list(kind)] = True
        places = np.flatnonzero(hit[raw])
        out[:, k] = (np.searchsorted(places, b) - np.searchsorted(places, a)) * per_byte
    size = (words.end - words.start).astype(np.float64)
    k = len(KINDS)
    mean = np.bincount(owner, size, total) * share
    spread = np.sqrt(np.maximum(np.bincount(owner, size * size, total) * share - mean * mean, 0))
    key = np.sort((owner.astype(np.uint64) << C.U(40)) | (words.name >> C.U(24)))
    new = np.ones(key.size, bool)
    new[1:] = key[1:] != key[:-1]
    distinct = np.bincount((key[new] >> C.U(40)).astype(np.int64), minlength=total)
    same = np.zeros(words.name.size, bool)
    same[1:] = (words.name[1:] == words.name[:-1]) & (owner[1:] == owner[:-1])
    out[:, k] = np.minimum(mean, 40) / 10
    out[:, k + 1] = np.minimum(spread, 40) / 10
    out[:, k + 2] = distinct * share
    out[:, k + 3] = np.bincount(owner, same, total) * share
    out[:, k + 4] = n / PASSAGE
    out[:, k + 5] = np.bincount(owner, size <= 1, total) * share
    out[:, k + 6] = np.log1p(count[doc]) / 8
    out[:, k + 7] = nth == 0
    sign = np.where(words.name & C.U(1 << 60), 1.0, -1.0)
    cell = owner * HASHED + (words.name & C.U(HASHED - 1)).astype(np.int64)
    out[:, FEATURES:] = np.bincount(cell, sign, total * HASHED).reshape(total, HASHED) * share[:, None]
    return out.astype(np.float32), first


class Model:
    """The network, as plain arrays."""

    def __init__(self, share: float):
        self.share, self.weights = share, None

    def _forward(self, x, first):
        w = self.weights
        h = np.tanh(x @ w["W"] + w["b"])
        t, s = np.tanh(h @ w["V"]), 1 / (1 + np.exp(-(h @ w["U"])))
        raw = (t * s) @ w["w"]
        doc = np.repeat(np.arange(first.size - 1), np.diff(first))
        top = np.maximum.reduceat(raw, first[:-1])
        e = np.exp(raw - top[doc])
        a = e / np.add.reduceat(e, first[:-1])[doc]
        z = np.add.reduceat(a[:, None] * h, first[:-1])
        return h, t, s, doc, a, z, z @ w["c"] + w["d"]

    def scores(self, x, first) -> np.ndarray:
        if self.weights is None:
            return np.full(first.size - 1, self.share)
        x = (x - self.mean) / self.scale
        logit = self._forward(np.clip(x, -8, 8), first)[-1]
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))

    def fit(self, x, first, label, weight):
        rng = np.random.default_rng(SEED)
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-3
        x = np.clip((x - self.mean) / self.scale, -8, 8)
        n = x.shape[1]
        self.weights = w = {
            "W": rng.normal(0, n ** -0.5, (n, HIDDEN)), "b": np.zeros(HIDDEN),
            "V": rng.normal(0, HIDDEN ** -0.5, (HIDDEN, GATE)),
            "U": rng.normal(0, HIDDEN ** -0.5, (HIDDEN, GATE)),
            "w": rng.normal(0, GATE ** -0.5, GATE), "c": rng.normal(0, HIDDEN ** -0.5, HIDDEN),
            "d": np.zeros(())}
        m = {k: np.zeros_like(v) for k, v in w.items()}
        v2 = {k: np.zeros_like(v) for k, v in w.items()}
        weight = weight / weight.sum()
        for step in range(1, STEPS + 1):
            h, t, s, doc, a, z, logit = self._forward(x, first)
            g = weight * (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - label)
            dz = g[:, None] * w["c"]
            dh = a[:, None] * dz[doc]
            da = (dz[doc] * h).sum(1)
            draw = a * (da - np.add.reduceat(a * da, first[:-1])[doc])
            dts = draw[:, None] * w["w"]
            dt, ds = dts * s * (1 - t * t), dts * t * s * (1 - s)
            dh += dt @ w["V"].T + ds @ w["U"].T
            dx = dh * (1 - h * h)
            grad = {"W": x.T @ dx, "b": dx.sum(0), "V": h.T @ dt, "U": h.T @ ds,
                    "w": (t * s).T @ draw, "c": z.T @ g, "d": g.sum()}
            for k in w:
                if k not in "bd":
                    grad[k] = grad[k] + 1e-4 * w[k]
                m[k] = 0.9 * m[k] + 0.1 * grad[k]
                v2[k] = 0.999 * v2[k] + 0.001 * grad[k] ** 2
                w[k] = w[k] - 0.02 * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v2[k] / (1 - 0.999 ** step)) + 1e-8)
        return self


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from labelled documents; labels: doc_id and quality 0 or 1."""
    known = (labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
             .groupBy("doc_id").agg(F.min(F.col("quality").cast("int")).alias("quality")))
    there = {int(r["quality"]): r["count"] for r in known.groupBy("quality").count().collect()}
    total = sum(there.values())
    model = Model((there.get(1, 0) + 1) / (total + 1))
    if min(there.get(0, 0), there.get(1, 0)) == 0:
        return model
    rank = F.xxhash64("doc_id")
    chosen = [known.filter(F.col("quality") == q).orderBy(rank, "doc_id").limit(SAMPLE_PER_CLASS) for q in (0, 1)]
    # At most 2 * SAMPLE_PER_CLASS rows of two numbers.
    sample = F.broadcast(chosen[0].unionByName(chosen[1]).withColumnRenamed("quality", "_label"))
    bags = docs.select("doc_id", "text").join(sample, "doc_id").select("text", "_label")

    def work(batches):
        for rows, texts in C.slices(batches):
            x, first = passages(texts)
            kept = []
            for a, b in zip(first[:-1], first[1:]):
                n = int(min(b - a, SAMPLE_PASSAGES))
                kept.append(x[np.linspace(a, b - 1, n).round().astype(np.int64)].tobytes())
            yield from C.to_batches({"label": rows.column("_label").cast(pa.int32()), "x": pa.array(kept, pa.binary())})

    got = C.map_batches(bags, work, "label int, x binary").collect()
    if not got or len({r["label"] for r in got}) < 2:
        return model
    got.sort(key=lambda r: (r["label"], bytes(r["x"])))
    x = [np.frombuffer(r["x"], np.float32).reshape(-1, FEATURES + HASHED) for r in got]
    label = np.array([r["label"] for r in got], np.float64)
    share = np.array([there.get(0, 0), there.get(1, 0)]) / total
    number = np.array([np.sum(label == 0), np.sum(label == 1)])
    weight = (share / number)[label.astype(np.int64)]
    first = np.concatenate([[0], np.cumsum([len(v) for v in x])])
    return model.fit(np.concatenate(x).astype(np.float64), first, label, weight)


def scored(docs: DataFrame, model: Model, with_text: bool = True) -> DataFrame:
    """The documents with score; an input column of that name is replaced."""
    docs = docs.drop("score")
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches):
        model = sent.value
        for rows, texts in C.slices(batches):
            score = model.scores(*passages(texts))
            rows = rows if with_text else rows.drop_columns(["text"])
            yield from rows.append_column("score", pa.array(score, pa.float64())).to_batches()

    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if with_text or f.name != "text")
    return C.map_batches(docs, work, f"{names}, {SCORED}")


def held_out() -> Column:
    return F.coalesce(C.crc_mod("doc_id", 5) == 0, F.lit(False))


THRESHOLD = 0.3


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents whose score reaches the threshold, with their columns. The model learns
    from the labels outside the held-out fold."""
    model = fit(docs, labels.filter(~held_out()))
    return C.shielded(docs, lambda d: scored(d, model).filter(F.col("score") >= threshold), "score")
