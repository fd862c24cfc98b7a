"""Periodic runs of words, by uniting suffix classes in the order of decreasing common prefixes.

A run is a stretch of words with smallest period q, at least max(LEAST, 2 q) words long, that no
neighbouring word extends. Words of a run after its first q are repeats and can be dropped.

Method, inside one text: sort its suffixes (prefix doubling; groups that are single are left
alone) and take the common prefix of neighbours in this order. Neighbours are united by
decreasing common prefix l, Kruskal's way, with union-find over ordered sets of positions,
the smaller set inserted into the larger. Two positions i < j that a union makes neighbours have a common
prefix of exactly l; if j - i <= l, the words from i on have period j - i for j - i + l words and
no longer. That seed is a run unless the word before i goes on with the period, and then
position i - 1 has the same run as seed. A smaller period g would have put i + g between i and j
before, so j - i is the smallest, and every run is found once.

What bounds the work: a run of LEAST words or two periods has a common prefix of at least
LEAST / 2, so only positions whose first LEAST / 2 words occur again in the same text are
sorted, and of those only the ones that have such a neighbour no farther than their longest
common prefix are united. Both rules leave out positions that can be in no seed.

Words are compared by 64-bit names inside one text. Rows are independent: no shuffle, no group.
A text is held whole in one task, with about four bytes for each word and doubling. Null and
empty texts have no words and no runs. Repeated rows give repeated results; ids may be null.
"""

from __future__ import annotations

import hashlib
import sys
import zlib
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame

from . import common as C

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Words of the shortest run.
LEAST = 12

RUNS = "doc_id bigint, start bigint, length bigint, period bigint"
REPORT = ("doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
          "runs_sha256 string, collapsed_sha256 string, n_words bigint, n_removed bigint")


# --- suffixes ---------------------------------------------------------------------------

def suffix_levels(ids: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The order of the suffixes of ids, as far as they share a prefix with a neighbour, and for
    each k the ranks of all blocks of 2**k values: equal blocks have equal ranks."""
    order = np.argsort(ids, kind="stable")
    sorted_ids = ids[order]
    start = np.ones(ids.size, bool)
    start[1:] = sorted_ids[1:] != sorted_ids[:-1]
    rank = np.empty(ids.size, np.int32)
    group = np.maximum.accumulate(np.where(start, np.arange(ids.size), 0))
    rank[order] = group
    levels, size = [rank], 1
    while True:
        # Places of the order whose group has more than one member.
        single = start.copy()
        single[:-1] &= start[1:]
        place = np.flatnonzero(~single)
        if not place.size:
            return order, levels
        who = order[place]
        follower = levels[-1][who + size]
        by = np.lexsort((follower, group[place]))
        who, follower = who[by], follower[by]
        order[place] = who
        first = start[place]
        first[1:] |= follower[1:] != follower[:-1]
        start[place] = first
        group = np.maximum.accumulate(np.where(start, np.arange(ids.size), 0))
        rank = levels[-1].copy()
        rank[who] = group[place]
        levels.append(rank)
        size *= 2


def common_prefixes(order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """The common prefix of each place of the order with the one before it; 0 for the first."""
    out = np.zeros(order.size, np.int64)
    place = np.flatnonzero(levels[0][order[1:]] == levels[0][order[:-1]]) + 1
    a, b, got = order[place - 1].copy(), order[place].copy(), np.zeros(place.size, np.int64)
    for k in range(len(levels) - 1, -1, -1):
        same = levels[k][a] == levels[k][b]
        step = same.astype(np.int64) << k
        a, b, got = a + step, b + step, got + step
    out[place] = got
    return out


def candidates(order: np.ndarray, prefix: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The positions that a seed may have, in suffix order, and the common prefix of each with
    the one before it (0 where a class of common prefixes of `least` begins)."""
    linked = prefix >= least
    inside = linked.copy()
    inside[:-1] |= linked[1:]
    place = np.flatnonzero(inside)
    if not place.size:
        return place, place
    position, before = order[place], np.where(linked[place], prefix[place], 0)
    longest = before.copy()
    longest[:-1] = np.maximum(longest[:-1], before[1:])
    group = np.cumsum(before == 0)
    by = np.lexsort((position, group))
    step = np.diff(position[by])
    step[np.diff(group[by]) > 0] = order.size
    gap = np.full(place.size, order.size, np.int64)
    gap[by[1:]] = step
    gap[by[:-1]] = np.minimum(gap[by[:-1]], step)
    keep = np.flatnonzero(gap <= longest)
    if not keep.size:
        return keep, keep
    # What lies between two kept places bounds their common prefix.
    between = np.minimum.reduceat(before[:keep[-1] + 1], np.concatenate([[0], keep[:-1] + 1]))
    between[0] = 0
    return position[keep], between


def seeds(position: list[int], before: np.ndarray):
    """(i, j, l): positions i < j made neighbours by the union of classes with common prefix l,
    where j - i <= l."""
    edges = np.argsort(-before, kind="stable")
    edges = edges[before[edges] > 0]
    lengths = before[edges].tolist()
    root = list(range(len(position)))
    member = [[p] for p in position]
    found = []
    for r, l in zip(edges.tolist(), lengths):
        a, b = r - 1, r
        while root[a] != a:
            root[a] = a = root[root[a]]
        while root[b] != b:
            root[b] = b = root[root[b]]
        if len(member[a]) < len(member[b]):
            a, b = b, a
        large, small = member[a], member[b]
        root[b], member[b] = a, None
        last, at = -1, 0
        for n, x in enumerate(small):
            at = bisect_left(large, x, at)
            if at and x - large[at - 1] <= l and large[at - 1] != last:
                found.append((large[at - 1], x, l))
            if at < len(large):
                after = large[at]
                if after - x <= l and not (n + 1 < len(small) and small[n + 1] < after):
                    found.append((x, after, l))
            large.insert(at, x)
            last = x
    return found


def find(ids: np.ndarray, least: int = LEAST) -> np.ndarray:
    """Rows (start, length, period) of all runs in ids, ordered by start, then period. Values
    that occur once separate texts: no run reaches across one."""
    none = np.zeros((0, 3), np.int64)
    if ids.size < least:
        return none
    # The last value is followed by one that nothing equals.
    ids = np.append(ids, ids.max() + 1)
    order, levels = suffix_levels(ids)
    position, before = candidates(order, common_prefixes(order, levels), least // 2)
    if not position.size:
        return none
    found = seeds(position.tolist(), before)
    if not found:
        return none
    i, j, l = np.array(found, np.int64).T
    keep = (j - i + l >= least) & ((i == 0) | (ids[i - 1] != ids[j - 1]))
    i, j, l = i[keep], j[keep], l[keep]
    out = np.stack([i, j - i + l, j - i], 1)
    return out[np.lexsort((out[:, 2], out[:, 0]))]


# --- texts ------------------------------------------------------------------------------

def runs_of(texts: list[bytes], least: int = LEAST) -> list[np.ndarray]:
    """The runs of each text, rows (start, length, period)."""
    words, half = C.Words(texts), least // 2
    out = [np.zeros((0, 3), np.int64)] * len(texts)
    name, first = words.name, words.first[:len(texts) + 1]
    gram = C.grams(name, half)
    if not gram.size:
        return out
    inside = C.within(first, half, name.size)
    group = np.repeat(np.arange(len(texts)), np.diff(first))[:gram.size][inside]
    key = np.sort(C.joined_name(gram[inside], group.astype(np.uint64)))
    if not (key[1:] == key[:-1]).any():
        return out
    key = key[1:][key[1:] == key[:-1]]
    mine = C.joined_name(gram[inside], group.astype(np.uint64))
    again = np.unique(group[key[np.minimum(np.searchsorted(key, mine), key.size - 1)] == mine])
    # Texts with words of their own numbers, one after the other, each closed by a value of its own.
    sizes = np.diff(first)[again]
    at = np.concatenate([[0], np.cumsum(sizes + 1)])
    ids = np.empty(at[-1], np.int64)
    _, number = np.unique(name, return_inverse=True)
    unlike = int(number.max()) + 1
    for k, t in enumerate(again.tolist()):
        ids[at[k]:at[k + 1] - 1] = number[first[t]:first[t + 1]] + k * (unlike + 1)
        ids[at[k + 1] - 1] = unlike + k * (unlike + 1)
    found = find(ids, least)
    cut = np.searchsorted(found[:, 0], at)
    for k, t in enumerate(again.tolist()):
        rows = found[cut[k]:cut[k + 1]].copy()
        rows[:, 0] -= at[k]
        out[t] = rows
    return out


def kept_words(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """The words that no run holds after its first period."""
    if not runs.size:
        return words
    gone = C.covered(runs[:, 0] + runs[:, 2], runs[:, 1] - runs[:, 2], len(words))
    return [w for w, g in zip(words, gone.tolist()) if not g]


def woven(doc_id, text: bytes) -> bytes:
    """The text with the periodic tail that the query's contract gives to a tenth of the ids."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10:
        return text
    words, g = text.split(), h // 10
    if not words:
        return text
    a = g % len(words)
    p = 1 + (len(words) - a) // (3 + g % 8)
    block = words[a:a + p]
    more = -(-(len(words) - a) // p)
    return b" ".join(words[:a] + (block * more)[:len(words) - a])


def _mapped(docs: DataFrame, schema: str, work, weave: bool) -> DataFrame:
    """work(ids, texts, runs) for slices of the documents."""
    def run(batches):
        for rows, texts in C.slices(batches):
            ids = rows.column("doc_id").to_pylist()
            if weave:
                texts = [woven(i, t) for i, t in zip(ids, texts)]
            yield from C.to_batches(work(ids, texts, runs_of(texts)))
    rows = docs.selectExpr("cast(doc_id as bigint) as doc_id", "text")
    return C.map_batches(rows, run, schema)


def found(docs: DataFrame, weave: bool = False) -> DataFrame:
    """doc_id, start, length, period: one row for each run, in words counted from 0."""
    def work(ids, texts, runs):
        rows = np.concatenate([*runs, np.zeros((0, 3), np.int64)])
        who = [i for i, r in zip(ids, runs) for _ in range(len(r))]
        return {"doc_id": pa.array(who, pa.int64()), "start": rows[:, 0], "length": rows[:, 1], "period": rows[:, 2]}
    return _mapped(docs, RUNS, work, weave)


def collapsed(docs: DataFrame) -> DataFrame:
    """doc_id and text, its words joined by one space without the repeats of its runs."""
    def work(ids, texts, runs):
        out = [b" ".join(kept_words(t.split(), r)).decode("utf-8", "surrogatepass") for t, r in zip(texts, runs)]
        return {"doc_id": pa.array(ids, pa.int64()), "text": pa.array(out, pa.string())}
    return _mapped(docs, "doc_id bigint, text string", work, False)


def report(docs: DataFrame, weave: bool = False) -> DataFrame:
    """For each document the number of runs, the longest one (ties: smallest start, then
    period; nulls without one), and digests of all runs and of the words kept."""
    def work(ids, texts, runs):
        top, listed, kept, total = [], [], [], []
        for text, rows in zip(texts, runs):
            words = text.split()
            stay = kept_words(words, rows)
            best = None
            if len(rows):
                s, n, q = rows[np.lexsort((rows[:, 2], rows[:, 0], -rows[:, 1]))[0]].tolist()
                best = (s, n, q, 1000 * n // q)
            top.append(best or (None,) * 4)
            lines = "".join(f"{s},{n},{q}\n" for s, n, q in rows.tolist())
            listed.append(hashlib.sha256(lines.encode()).hexdigest())
            kept.append(hashlib.sha256(b" ".join(stay)).hexdigest())
            total.append((len(words), len(words) - len(stay)))
        columns = list(zip(*top)) or [()] * 4
        return {"doc_id": pa.array(ids, pa.int64()), "n_runs": pa.array([len(r) for r in runs], pa.int64()),
                **{k: pa.array(v, pa.int64()) for k, v in zip(("start", "length", "period", "exponent_milli"), columns)},
                "runs_sha256": pa.array(listed, pa.string()), "collapsed_sha256": pa.array(kept, pa.string()),
                "n_words": pa.array([n for n, _ in total], pa.int64()), "n_removed": pa.array([n for _, n in total], pa.int64())}
    return _mapped(docs, REPORT, work, weave)
