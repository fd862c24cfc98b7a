"""Benchmark decontamination with suffix arrays of the training text.

A task takes a shard of documents and sorts the word suffixes that can begin a match into
a suffix array. Every suffix of the benchmark items (the queries) is then searched in it by
bisection: the interval of equal prefixes gives all places, the neighbours give the longest
verbatim match. Suffixes that cannot match, because the benchmark has no text with the same
first words, are left out of the array; this drops no match.

The benchmark is the stated set of queries. It is read in blocks of at most BLOCK_WORDS
words; each block is broadcast (at most about 120 bytes a word) and makes one pass over the
documents, so a benchmark of any size is searched whole.

Words are runs of ASCII letters and digits and of characters beyond ASCII, A-Z lower-cased.
A window is `window` consecutive words of an item; an item with fewer, but not none, is one
window. Null and empty texts have no words, so n_hit is 0 and contaminated is false; items
without words match nothing. Equal ids and repeated rows are separate rows of the result.
"""

from __future__ import annotations

import hashlib
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import common as C

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOW = 13
#: Words of benchmark text in a broadcast block.
BLOCK_WORDS = 200_000
#: Bytes of training text in one suffix array.
SHARD_BYTES = 2 << 20

VERDICT = ("n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, "
           "contaminated boolean")
FOUND = "spans array<struct<start:bigint,size:bigint>>, items array<string>, n_words bigint"
MATCHES = ("item_id string, item_pos bigint, length bigint, doc_id bigint, doc_pos bigint")


class Block:
    """The windows of some items as sorted keys.

    key: rows of `window` big-endian word names as bytes, short windows padded with zeros;
    size: words of each window; owner, owner_first: the items of each window."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        words = C.Words([t for _, t in items], C.NOT_ALNUM, lower=True)
        self.window, rows, sizes, owners, places, ats, stops = window, [], [], [], [], [], []
        for i, (item_id, _) in enumerate(items):
            name = words.name[words.first[i]:words.first[i + 1]]
            size = min(window, name.size)
            for p in range(name.size - size + 1 if size else 0):
                row = np.zeros(window, ">u8")
                row[:size] = name[p:p + size]
                rows.append(row.tobytes())
                sizes.append(size)
                owners.append(item_id)
                places.append(p)
                ats.append(words.first[i] + p)
                stops.append(words.first[i + 1])
        key = np.array(rows, f"S{8 * window}") if rows else np.zeros(0, f"S{8 * window}")
        order = np.lexsort((np.array(sizes), key)) if rows else np.zeros(0, np.int64)
        self.owner = [owners[i] for i in order]
        self.place = np.array(places, np.int64)[order]
        # Where each window lies in the words of all items, and where its item ends.
        self.name, self.at = words.name, np.array(ats, np.int64)[order]
        self.stop = np.array(stops, np.int64)[order]
        every, size = key[order], np.array(sizes, np.int64)[order]
        new = np.ones(every.size, bool)
        new[1:] = (every[1:] != every[:-1]) | (size[1:] != size[:-1])
        self.owner_first = np.append(np.flatnonzero(new), every.size)
        self.key, self.size = every[new], size[new]
        # First words of all windows, as many as the shortest has, three at most.
        self.lead = int(min([3, *self.size])) if self.size.size else 0
        if self.lead:
            heads = np.frombuffer(self.key.astype(f"S{8 * window}").tobytes(), ">u8")
            heads = heads.reshape(-1, window)[:, :self.lead].astype(np.uint64)
            name = heads[:, 0].copy()
            for j in range(1, self.lead):
                name = C.joined_name(name, heads[:, j])
            self.heads = np.unique(name)
            self.seen = np.zeros(1 << 20, bool)
            self.seen[(self.heads & C.U((1 << 20) - 1)).astype(np.int64)] = True

    def suffixes(self, words: C.Words):
        """The suffix array of a shard: positions in order, and their first words as keys."""
        name, last = words.name, words.first[1:]
        if not self.lead or not name.size:
            return np.zeros(0, np.int64), np.zeros(0, self.key.dtype)
        head = name[:name.size - self.lead + 1].copy()
        for j in range(1, self.lead):
            head = C.joined_name(head, name[j:name.size - self.lead + 1 + j])
        at = np.flatnonzero(self.seen[(head & C.U((1 << 20) - 1)).astype(np.int64)])
        at = at[np.isin(head[at], self.heads)]
        stop = last[np.searchsorted(last, at, side="right")]
        rows = np.zeros((at.size, self.window), ">u8")
        for j in range(self.window):
            inside = at + j < stop
            rows[inside, j] = name[at[inside] + j]
        key = np.frombuffer(rows.tobytes(), f"S{8 * self.window}")
        order = np.argsort(key, kind="stable")
        return at[order], key[order]

    def search(self, words: C.Words):
        """For every window the interval of the suffix array that begins with it."""
        at, key = self.suffixes(words)
        pad = np.zeros((self.size.size, self.window), ">u8")
        pad[np.arange(self.window)[None, :] >= self.size[:, None]] = np.iinfo(np.uint64).max
        low = np.searchsorted(key, self.key, "left")
        top = np.frombuffer((np.frombuffer(self.key.tobytes(), ">u8").reshape(pad.shape) | pad)
                            .astype(">u8").tobytes(), self.key.dtype)
        return at, key, low, np.searchsorted(key, top, "right")


def blocks(benchmark: DataFrame, window: int) -> list[Block]:
    """The benchmark in bounded blocks, read one partition after the other."""
    out, held, words = [], [], 0
    for row in benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").toLocalIterator():
        text = (row["text"] or "").encode()
        held.append((row["item_id"] or "", text))
        words += len(text) // 5
        if words >= BLOCK_WORDS:
            out.append(Block(held, window))
            held, words = [], 0
    if held or not out:
        out.append(Block(held, window))
    return out


def _digest(items) -> str:
    return hashlib.sha256(",".join(sorted(set(items))).encode()).hexdigest()


def _located(block: Block, words: C.Words):
    """Pairs of window number and word position, for all occurrences."""
    at, _, low, high = block.search(words)
    size = high - low
    window = np.repeat(np.arange(size.size), size)
    step = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    return window, at[np.repeat(low, size) + step]


def _items(block: Block, words: C.Words, window, place) -> dict[int, list[str]]:
    """The items found in each document of the shard."""
    doc = np.searchsorted(words.first, place, "right") - 1
    out: dict[int, set] = {}
    for d, w in set(zip(doc.tolist(), window.tolist())):
        out.setdefault(d, set()).update(block.owner[block.owner_first[w]:block.owner_first[w + 1]])
    return {d: sorted(x) for d, x in out.items()}


def hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
         with_text: bool = True) -> DataFrame:
    """The documents (without their text, if so asked) with n_words, n_hit (words inside an occurrence of a window), n_items
    (items with occurring windows), items_sha256 and contaminated (n_hit is at least a
    twentieth of the words). Columns of these names in the input are replaced."""
    docs = docs.drop(*StructType.fromDDL(VERDICT).names)
    found = blocks(benchmark, window)
    if len(found) == 1:
        return _one_pass(docs, found[0], with_text)
    out = _many_passes(docs, found)
    return out if with_text else out.drop("text")


def _verdict(words: C.Words, place, size, items: dict, n: int) -> dict:
    hit = C.group_sums(C.covered(place, size, words.name.size), words.first[:n + 1])
    count = np.diff(words.first[:n + 1])
    return {"n_words": pa.array(count, pa.int64()), "n_hit": pa.array(hit, pa.int64()),
            "n_items": pa.array([len(items.get(i, ())) for i in range(n)], pa.int64()),
            "items_sha256": pa.array([_digest(items.get(i, ())) for i in range(n)], pa.string()),
            "contaminated": pa.array((hit > 0) & (20 * hit >= count))}


def _one_pass(docs: DataFrame, block: Block, with_text: bool) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(block)

    def work(batches):
        block = sent.value
        for rows, texts in C.slices(batches, limit=SHARD_BYTES):
            words = C.Words(texts, C.NOT_ALNUM, lower=True)
            window, place = _located(block, words)
            items = _items(block, words, window, place)
            rows = rows if with_text else rows.drop_columns(["text"])
            for name, values in _verdict(words, place, block.size[window], items, len(texts)).items():
                rows = rows.append_column(name, values)
            yield from rows.to_batches()

    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema
                      if with_text or f.name != "text")
    return C.map_batches(docs, work, f"{names}, {VERDICT}")


def _many_passes(docs: DataFrame, found: list[Block]) -> DataFrame:
    """One pass for each block; the spans and items of a row meet under its row number."""
    docs = C.stored(docs.withColumn("_row", F.monotonically_increasing_id()))
    parts = None
    for block in found:
        sent = docs.sparkSession.sparkContext.broadcast(block)

        def work(batches, sent=sent):
            block = sent.value
            for rows, texts in C.slices(batches, limit=SHARD_BYTES):
                words = C.Words(texts, C.NOT_ALNUM, lower=True)
                window, place = _located(block, words)
                items = _items(block, words, window, place)
                doc = np.searchsorted(words.first, place, "right") - 1
                spans: dict[int, list] = {}
                for d, p, n in sorted(set(zip(doc.tolist(), place.tolist(), block.size[window].tolist()))):
                    spans.setdefault(d, []).append({"start": p - int(words.first[d]), "size": n})
                n = len(texts)
                out = pa.table({
                    "_row": rows.column("_row"),
                    "spans": pa.array([spans.get(i, []) for i in range(n)],
                                      pa.list_(pa.struct([("start", pa.int64()), ("size", pa.int64())]))),
                    "items": pa.array([items.get(i, []) for i in range(n)], pa.list_(pa.string())),
                    "n_words": pa.array(np.diff(words.first[:n + 1]), pa.int64())})
                yield from out.combine_chunks().to_batches()

        part = C.map_batches(docs.select("_row", "text"), work, f"_row bigint, {FOUND}")
        parts = part if parts is None else parts.unionByName(part)
    merged = parts.groupBy("_row").agg(F.flatten(F.collect_list("spans")).alias("spans"),
                                       F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
                                       F.max("n_words").alias("n_words"))

    def finish(batches):
        for batch in batches:
            hit, digest = [], []
            for spans, items in zip(batch.column("spans").to_pylist(), batch.column("items").to_pylist()):
                end = max([s["start"] + s["size"] for s in spans], default=0)
                mark = C.covered(np.array([s["start"] for s in spans], np.int64),
                                 np.array([s["size"] for s in spans], np.int64), end)
                hit.append(int(mark.sum()))
                digest.append(_digest(items))
            n = np.array(batch.column("n_words").to_pylist(), np.int64)
            h = np.array(hit, np.int64)
            yield from C.to_batches({"_row": batch.column("_row"), "n_words": n, "n_hit": h,
                                     "n_items": pa.array([len(x) for x in batch.column("items").to_pylist()], pa.int64()),
                                     "items_sha256": pa.array(digest, pa.string()),
                                     "contaminated": pa.array((h > 0) & (20 * h >= n))})

    return docs.join(merged.mapInArrow(finish, f"_row bigint, {VERDICT}"), "_row").drop("_row")


def longest(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """For every window of the benchmark that occurs, the longest verbatim match that
    begins there, over all shards, with its place: the smallest (doc_id, doc_pos) among
    equally long ones. Matches shorter than a window are left out."""
    parts = None
    for block in blocks(benchmark, window):
        sent = docs.sparkSession.sparkContext.broadcast(block)

        def work(batches, sent=sent):
            block = sent.value
            for rows, texts in C.slices(batches, limit=SHARD_BYTES):
                words = C.Words(texts, C.NOT_ALNUM, lower=True)
                found, place = _located(block, words)
                times = np.diff(block.owner_first)[found]
                owner = np.repeat(block.owner_first[found], times)
                owner = owner + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                place, length = np.repeat(place, times), np.repeat(block.size[found], times)
                doc = np.searchsorted(words.first, place, "right") - 1
                more = np.arange(place.size)
                while more.size:
                    a, b = place[more] + length[more], block.at[owner[more]] + length[more]
                    inside = (a < words.first[doc[more] + 1]) & (b < block.stop[owner[more]])
                    more, a, b = more[inside], a[inside], b[inside]
                    more = more[words.name[a] == block.name[b]]
                    length[more] += 1
                yield from C.to_batches({
                    "item_id": pa.array([block.owner[i] for i in owner], pa.string()),
                    "item_pos": block.place[owner], "length": length,
                    "doc_id": rows.column("doc_id").take(pa.array(doc)),
                    "doc_pos": place - words.first[doc]})

        part = C.map_batches(docs.select(F.col("doc_id").cast("bigint"), "text"), work, MATCHES)
        parts = part if parts is None else parts.unionByName(part)
    best = F.min(F.struct((-F.col("length")).alias("n"), "doc_id", "doc_pos"))
    return (parts.groupBy("item_id", "item_pos").agg(best.alias("at"))
            .select("item_id", "item_pos", (-F.col("at.n")).alias("length"), "at.doc_id", "at.doc_pos"))


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents that are not contaminated, with their columns."""
    return C.shielded(docs, lambda d: hits(d, benchmark, window).filter(~F.col("contaminated")),
                      "_row", *StructType.fromDDL(VERDICT).names)
