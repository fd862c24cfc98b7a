"""N-gram Jaccard join in the metric space of shingle sets.

1 - Jaccard is a metric d; two documents link when d is at most 1 - THRESHOLD. The space is
cut into regions around pivots, with copies of boundary documents wherever the triangle
inequality leaves a link possible, and regions are joined recursively and exactly.

First level: documents that share nothing are all at distance 1, where no pivot can tell them
apart. So the first pivots come from an index: two documents that link share a shingle among
the first n - ceil(0.75 n) + 1 of either (rare shingles first, prefix filter); the smallest
document that holds a shingle in this prefix is the pivot of all that do, and a document is
copied to the region of each of its pivots, unless the region lies in another one. Parity sketches, whose Hamming distance never
exceeds the symmetric difference, drop the copies that can have no partner in a region, or
none that they do not also meet in an earlier region; sizes alone drop some before that.

Next levels, inside a region: several pivots, distances to them, Voronoi regions by the
nearest one; a document also goes to region q if d(x, q) <= d(x, nearest) + 2 * 0.25. Regions
of a few documents are joined pair by pair, leaving out pairs that the distances to a pivot
rule out and pairs that are connected already. Regions of more than REGION documents are
dealt over many tasks: against some pivots first, then what is not yet connected to the
largest component against everything, in blocks: by sketches, then the sets that these leave.

Copies: equal sets are one vertex. Links inside a region are returned as a spanning forest, so
no group is expanded into pairs. Null and empty texts, and those of white space, have no
shingles and link with nothing. Ids that occur more than once are results of their own, and
count as one document where they have the same set. Null ids get the component of their set.
"""

from __future__ import annotations

import hashlib
import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from . import common as C
from . import graph as G
from . import repeats as R

cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(G)
cloudpickle.register_pickle_by_value(R)

SHINGLE = 5
#: Links need 100 * intersection >= PERCENT * union; MARGIN is the largest distance of a link.
PERCENT, MARGIN = 75, 0.25
#: Shingles counted as frequent: how many at most, and from how many occurrences on. They come
#: last in the order of the prefix, which changes the work but not the result.
FREQUENT, FREQUENT_FROM = 1 << 17, 64
#: Shingles that a task counts at a time.
COUNTED = 1 << 19
#: Documents of a region that one task joins.
REGION = 512
PIVOTS, LEAF, STAR_ROUNDS = 4, 24, 2
#: Regions of a document, the first ones by pivot, that its rows tell of. A pair is joined in the
#: first region that it has in common; one that these do not show is joined more than once.
TOLD = 8

SETS = "doc_id bigint, n bigint, set_name bigint, prefix binary, sketch binary"

#: Shingles are indexed by so many bits of their names. Two that share them make a region larger
#: than it need be; links are judged on whole names.
INDEX_BITS, LOW_BITS = 40, 28
#: Index entries that a task packs at a time, and the largest difference of their nodes.
PACKED, SPAN = 1 << 21, 1 << 16
PACKS = "bucket int, base bigint, size int, data binary"


# --- sets -------------------------------------------------------------------------------

def shingle_sets(texts: list[bytes], size: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingle names of each text."""
    words = C.Words(texts, lower=True)
    name = C.grams(words.name, size)
    out = []
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        if b - a >= size:
            part = np.sort(name[a:b - size + 1])
            new = np.ones(part.size, bool)
            new[1:] = part[1:] != part[:-1]
            out.append(part[new])
        elif b > a:
            out.append(C.grams(words.name[a:b], b - a))
        else:
            out.append(name[:0])
    return out[:len(texts)]


def set_name(x: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(x.tobytes(), digest_size=8).digest(), "little", signed=True)


def sketch(x: np.ndarray, bits: int) -> np.ndarray:
    """Parities of the numbers of shingles in `bits` cells, as bytes."""
    return np.packbits(np.bincount((x & C.U(bits - 1)).astype(np.int64), minlength=bits).astype(np.uint8) & 1)


def sketch_bits(n: int) -> int:
    return max(64, 1 << (n - 1).bit_length()) if n else 64


def halved(rows: np.ndarray) -> np.ndarray:
    """Sketches of half as many cells: the cell number loses its top bit."""
    half = rows.shape[1] // 2
    return rows[:, :half] ^ rows[:, half:]


def planes(x: np.ndarray, width: int) -> bytes:
    """Whole numbers as `width` bytes each, all first bytes first, which compresses better."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def from_planes(data, size: int, width: int) -> np.ndarray:
    out = np.zeros((size, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8, size * width).reshape(width, size).T
    return out.view("<u8").reshape(size)


def frequent(docs: DataFrame) -> np.ndarray:
    """The shingles found in most documents, sorted. Every task counts its documents, forgets
    the rarest ones when its table is full, and hands over those that it met twice."""

    def work(batches):
        held, counts, fresh, size = np.zeros(0, np.uint64), np.zeros(0, np.int64), [], 0

        def merged():
            every = np.concatenate([held, *fresh])
            times = np.ones(every.size, np.int64)
            times[:held.size] = counts
            order = np.argsort(every, kind="stable")
            every = every[order]
            new = np.ones(every.size, bool)
            new[1:] = every[1:] != every[:-1]
            starts = np.flatnonzero(new)
            return every[starts], np.add.reduceat(times[order], starts) if starts.size else counts

        for _, texts in C.slices(batches):
            fresh += shingle_sets(texts)
            size += sum(map(len, texts))
            if size > 4 * C.SLICE_BYTES:
                held, counts = merged()
                fresh, size = [], 0
                while held.size > COUNTED:
                    keep = counts > counts.min()
                    held, counts = held[keep], counts[keep]
        held, counts = merged()
        keep = counts > 1
        yield from C.to_batches({"s": held[keep].view(np.int64), "c": counts[keep]})

    rows = (C.map_batches(docs.select("text"), work, "s bigint, c bigint")
            .groupBy("s").agg(F.sum("c").alias("c")).filter(F.col("c") >= FREQUENT_FROM)
            .orderBy(F.desc("c"), "s").limit(FREQUENT).select("s").toArrow())
    return np.sort(rows.column("s").to_numpy().view(np.uint64))


def described(docs: DataFrame) -> DataFrame:
    """Number, name, prefix and sketch of the set of every document, and a number of the row. The
    prefix holds the index bits of its shingles."""
    sent = docs.sparkSession.sparkContext.broadcast(frequent(docs))

    def work(batches):
        common = sent.value
        for rows, texts in C.slices(batches):
            sets = shingle_sets(texts)
            size = np.fromiter(map(len, sets), np.int64, len(sets))
            every = np.concatenate(sets) if sets else common[:0]
            often = np.zeros(every.size, bool)
            if common.size:
                often = common[np.minimum(np.searchsorted(common, every), common.size - 1)] == every
            at = np.concatenate([[0], np.cumsum(size)])
            prefix, low = [], C.U((1 << INDEX_BITS) - 1)
            for x, a, b in zip(sets, at[:-1].tolist(), at[1:].tolist()):
                n = b - a
                keep = n - -(-PERCENT * n // 100) + 1 if n else 0
                rare = x[~often[a:b]]
                if rare.size < keep:
                    rare = np.concatenate([rare, x[often[a:b]]])
                prefix.append(planes(np.diff(np.unique(rare[:keep] & low), prepend=C.U(0)), INDEX_BITS // 8))
            yield from C.to_batches({
                "doc_id": rows.column("doc_id"), "n": size,
                "set_name": pa.array([set_name(x) for x in sets], pa.int64()),
                "prefix": pa.array(prefix, pa.binary()),
                "sketch": pa.array([sketch(x, sketch_bits(x.size)).tobytes() for x in sets], pa.binary())})

    # Nodes are numbered, since small numbers take less room in a shuffle than names do.
    return C.stored(C.map_batches(docs.select("doc_id", "text"), work, SETS)
                    .withColumn("node", F.monotonically_increasing_id()))


# --- regions ----------------------------------------------------------------------------

def packs(node: np.ndarray, s: np.ndarray):
    """Index entries (shingle, node) by the high bits of the shingle. In a pack the shingles are
    sorted; their differences and the nodes, less the smallest one, are written as bytes."""
    base = int(node.min())
    order = np.argsort(s)
    s, node = s[order], (node[order] - base).astype(np.uint64)
    high = (s >> C.U(LOW_BITS)).astype(np.int64)
    edge = np.ones(s.size, bool)
    edge[1:] = high[1:] != high[:-1]
    start = np.flatnonzero(edge)
    low = s & C.U((1 << LOW_BITS) - 1)
    step = np.diff(low, prepend=C.U(0))
    step[start] = low[start]
    data = [planes(step[a:b], 4) + planes(node[a:b], 2) for a, b in zip(start.tolist(), np.append(start[1:], s.size).tolist())]
    yield from C.to_batches({"bucket": pa.array(high[start], pa.int32()), "base": np.full(start.size, base),
                             "size": pa.array(np.diff(np.append(start, s.size)), pa.int32()),
                             "data": pa.array(data, pa.binary())})


def regions(table: pa.Table):
    """(pivot, node) from the packs of one bucket: the nodes of each shingle that several have."""
    low, node = [], []
    for base, size, data in zip(*(table.column(c).to_pylist() for c in ("base", "size", "data"))):
        low.append(np.cumsum(from_planes(data, size, 4)))
        node.append(from_planes(memoryview(data)[4 * size:], size, 2).astype(np.int64) + base)
    low, node = np.concatenate(low), np.concatenate(node)
    order = np.lexsort((node, low))
    low, node = low[order], node[order]
    edge = np.ones(low.size, bool)
    edge[1:] = low[1:] != low[:-1]
    start = np.flatnonzero(edge)
    size = np.diff(np.append(start, low.size))
    pivot, shared = np.repeat(node[start], size), np.repeat(node[start] < node[np.append(start[1:], low.size) - 1], size)
    pair = np.unique(np.stack([pivot[shared], node[shared]], 1), axis=0)
    yield from C.to_batches({"pivot": pair[:, 0], "node": pair[:, 1]})


def memberships(every: DataFrame, sets: DataFrame) -> DataFrame:
    """(pivot, node): the first-level regions. every: node and prefix of all rows; sets: those that
    stand for the distinct sets. A bounded filter finds them; what it lets pass besides are copies
    of theirs, in the same regions, and have no part in what follows.

    The index moves in packs of some bytes an entry, and a bucket of shingles is read once."""
    sent = sets.sparkSession.sparkContext.broadcast(G.id_filter(sets, "node"))

    def entries(batches):
        bits, held, count, first = sent.value, [], 0, 0

        def flushed():
            node = np.repeat(np.concatenate([n for n, _, _ in held]), np.concatenate([k for _, k, _ in held]))
            yield from packs(node, np.concatenate([s for _, _, s in held]))

        for batch in batches:
            batch = batch.filter(pa.array(G.passes(bits, batch.column("place").to_numpy())))
            if not batch.num_rows:
                continue
            node = batch.column("node").to_numpy()
            data = batch.column("prefix").to_pylist()
            width = INDEX_BITS // 8
            size = np.fromiter((len(x) // width for x in data), np.int64, len(data))
            # Rows of several files may be far apart in number.
            cuts = [0, *(np.flatnonzero(np.abs(np.diff(node)) >= SPAN) + 1).tolist(), node.size]
            for a, b in zip(cuts[:-1], cuts[1:]):
                low, high = int(node[a:b].min()), int(node[a:b].max())
                if held and (count > PACKED or max(high, first[1]) - min(low, first[0]) >= SPAN):
                    yield from flushed()
                    held, count = [], 0
                first = (low, high) if not held else (min(low, first[0]), max(high, first[1]))
                s = [np.cumsum(from_planes(x, k, width)) for x, k in zip(data[a:b], size[a:b].tolist())]
                held.append((node[a:b], size[a:b], np.concatenate(s)))
                count += held[-1][2].size
        if held:
            yield from flushed()

    placed = every.filter(F.col("n") > 0).select("node", "prefix", G.place_in_filter("node").alias("place"))
    member = _by_key(C.map_batches(placed, entries, PACKS), "bucket", regions, "pivot bigint, node bigint")
    return C.stored(_needed(C.stored(member.distinct())))


def _needed(member: DataFrame) -> DataFrame:
    """The regions without those that lie in another one: where all documents of a region have
    the same smallest pivot, they all are in the region of that one."""
    top = member.groupBy("node").agg(F.min("pivot").alias("top"))
    spans = (member.join(top, "node").groupBy("pivot").agg(F.min("top").alias("low"), F.max("top").alias("high"))
             .filter((F.col("low") < F.col("high")) | (F.col("low") == F.col("pivot"))))
    return member.join(spans.select("pivot"), "pivot", "left_semi")


def _first_regions(member: DataFrame) -> DataFrame:
    """(node, told): the first regions of every document."""
    order = Window.partitionBy("node").orderBy("pivot")
    return (member.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= TOLD)
            .groupBy("node").agg(F.collect_list("pivot").alias("told")))


def _sized(member: DataFrame, sets: DataFrame) -> DataFrame:
    """(pivot, node, n) of small regions, without the documents that no other one of the region
    comes near in size. The next smaller and the next larger one tell, and only sizes move."""
    near = Window.partitionBy("pivot").orderBy("n", "node")
    less, more = F.lag("n").over(near), F.lead("n").over(near)
    near_less, near_more = 100 * less >= PERCENT * F.col("n"), 100 * F.col("n") >= PERCENT * more
    return C.stored(member.join(sets.select("node", "n"), "node")
                    .withColumn("near", F.coalesce(near_less, F.lit(False)) | F.coalesce(near_more, F.lit(False)))
                    .filter("near").select("pivot", "node", "n"))


def partnered(n: np.ndarray, sketches: list[bytes], before: list[set] | None = None, head: np.ndarray | None = None,
              node: np.ndarray | None = None) -> np.ndarray:
    """Which documents of a region may link with another one there, as far as sizes and
    sketches tell. before: earlier regions of each document; pairs that share one are met there.
    head: one of a pair is a head row; the rows of one node are no pair."""
    bits = np.array([8 * len(s) for s in sketches])
    out = np.zeros(n.size, bool)
    for level in np.unique(bits):
        same, twice = np.flatnonzero(bits == level), np.flatnonzero(bits == 2 * level)
        rows = np.frombuffer(b"".join(sketches[i] for i in same), np.uint8).reshape(same.size, -1)
        if twice.size:
            more = np.frombuffer(b"".join(sketches[i] for i in twice), np.uint8).reshape(twice.size, -1)
            rows = np.concatenate([rows, halved(more)])
        who = np.concatenate([same, twice])
        rows, size = np.ascontiguousarray(rows).view(np.uint64), n[who]
        for i in range(same.size):
            far = np.bitwise_count(rows[i + 1:] ^ rows[i]).sum(1, dtype=np.int64)
            total = size[i + 1:] + size[i]
            near = (7 * far <= total) & (4 * np.minimum(size[i + 1:], size[i]) >= 3 * np.maximum(size[i + 1:], size[i]))
            if head is not None:
                near &= (head[who[i + 1:]] | head[who[i]]) & (node[who[i + 1:]] != node[who[i]])
            met = who[i + 1:][near]
            if before is not None and before[who[i]]:
                mine = before[who[i]]
                met = met[[not (out[who[i]] and out[j]) and mine.isdisjoint(before[j]) for j in met.tolist()]]
            if met.size:
                out[who[i]] = True
                out[met] = True
    return out


class Region:
    """Exact join of some sets: a spanning forest of their links."""

    def __init__(self, sets: list[np.ndarray]):
        self.sets, self.n = sets, np.fromiter(map(len, sets), np.int64, len(sets))
        self.parent, self.edges = list(range(len(sets))), []
        bits = sketch_bits(int(self.n.max(initial=1)))
        self.rows = np.array([sketch(x, bits) for x in sets]).view(np.uint64).reshape(len(sets), -1)

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = i = self.parent[self.parent[i]]
        return i

    def common(self, i: int, j: int) -> int:
        a, b = (i, j) if self.n[i] <= self.n[j] else (j, i)
        x, y = self.sets[a], self.sets[b]
        if not x.size:
            return 0
        return int((y[np.minimum(np.searchsorted(y, x), y.size - 1)] == x).sum())

    def link(self, i: int, j: int, common: int):
        union = int(self.n[i] + self.n[j]) - common
        if union and 100 * common >= PERCENT * union and self.root(i) != self.root(j):
            self.parent[self.root(i)] = self.root(j)
            self.edges.append((i, j))

    def star(self, pivot: int, others: np.ndarray) -> np.ndarray:
        """Distances to a pivot, and the links with it."""
        out = np.ones(others.size)
        for k, j in enumerate(others.tolist()):
            if j == pivot:
                out[k] = 0
                continue
            c = self.common(pivot, j)
            out[k] = 1 - c / max(1, int(self.n[pivot] + self.n[j]) - c)
            self.link(pivot, j, c)
        return out

    def join(self, who: np.ndarray):
        """All links among the documents `who`."""
        if who.size <= LEAF:
            self.leaf(who, np.zeros((0, who.size)))
            return
        pivots, far = [0], []
        for _ in range(PIVOTS):
            far.append(self.star(int(who[pivots[-1]]), who))
            pivots.append(int(np.argmax(np.min(far, axis=0))))
        far = np.array(far)
        if len({self.root(i) for i in who.tolist()}) == 1:
            return
        near = far.argmin(0)
        close = far.min(0)
        parts = [np.flatnonzero((far[q] <= close + 2 * MARGIN + 1e-9)) for q in range(len(far))]
        parts = [p for q, p in enumerate(parts) if (near == q).any()]
        if max(p.size for p in parts) > 0.8 * who.size:
            self.leaf(who, far)
        else:
            for p in parts:
                self.join(who[p])

    def leaf(self, who: np.ndarray, far: np.ndarray, first: int | None = None):
        """Pair by pair; of the first ones with all, if a number is given."""
        n, rows = self.n[who], self.rows[who]
        for i in range(who.size if first is None else first):
            rest = slice(i + 1, None)
            total = n[rest] + n[i]
            ok = 4 * np.minimum(n[rest], n[i]) >= 3 * np.maximum(n[rest], n[i])
            if far.size:
                ok &= (np.abs(far[:, rest] - far[:, i:i + 1]) <= MARGIN + 1e-9).all(0)
            ok &= 7 * np.bitwise_count(rows[rest] ^ rows[i]).sum(1, dtype=np.int64) <= total
            for j in (np.flatnonzero(ok) + i + 1).tolist():
                a, b = int(who[i]), int(who[j])
                if self.root(a) != self.root(b):
                    self.link(a, b, self.common(a, b))


def _sets_of(rows: pa.Table | pa.RecordBatch) -> list[np.ndarray]:
    return [np.frombuffer(x, np.uint64) for x in rows.column("set").cast(pa.large_binary()).to_pylist()]


def _by_key(df: DataFrame, key: str, work, schema: str) -> DataFrame:
    """work(table) for the rows of each key; groups are small, a task has many."""
    def run(batches):
        for rows in R.grouped(batches, key):
            yield from work(rows)
    return C.map_batches(df.repartition(F.col(key)).sortWithinPartitions(key), run, schema)


EDGES = "a bigint, b bigint"


def _edges(node: np.ndarray, region: Region):
    """Links of a region as stars: every linked document with the smallest one connected."""
    if region.edges:
        linked = sorted({i for e in region.edges for i in e})
        root, least = [region.root(i) for i in linked], {}
        for i, r in zip(linked, root):
            least[r] = min(least.get(r, node[i]), node[i])
        yield from C.to_batches({"a": node[linked], "b": np.array([least[r] for r in root], np.int64)})


def near_edges(docs: DataFrame, every: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between different sets, (a, b) by node, enough of them to connect all that are
    connected. every: the described documents; sets: node, set_name, n and doc_id, one row for
    each set."""
    spark = docs.sparkSession
    member = memberships(every, sets)
    sizes = C.stored(member.groupBy("pivot").count().filter(F.col("count") > REGION))
    small = _sized(member.join(sizes, "pivot", "left_anti"), sets)
    large = member.join(sizes, "pivot")

    def may_link(rows):
        here = rows.column("pivot")[0].as_py()
        before = [{p for p in told if p < here} for told in rows.column("told").to_pylist()]
        keep = partnered(rows.column("n").to_numpy(), rows.column("sketch").to_pylist(), before)
        if keep.any():
            yield from rows.select(["pivot", "node"]).filter(pa.array(keep)).combine_chunks().to_batches()

    described_small = small.join(_first_regions(member), "node").join(every.select("node", "sketch"), "node")
    kept = _by_key(described_small.select("pivot", "node", "n", "told", "sketch"), "pivot", may_link, "pivot bigint, node bigint")
    kept = C.stored(kept.withColumn("count", F.lit(0).cast("bigint"))
                    .unionByName(large.select("pivot", "node", "count")))
    # Without the documents that have no partner, more regions lie in others.
    kept = C.stored(_needed(kept).join(sets.select("node", "set_name", "doc_id"), "node"))

    # The whole sets of those documents only, made anew from their texts.
    wanted = kept.select("doc_id").distinct()
    sent = spark.sparkContext.broadcast(G.id_filter(wanted, "doc_id"))

    def whole(batches):
        bits = sent.value
        def chosen():
            for batch in batches:
                yield batch.filter(pa.array(G.passes(bits, batch.column("place").to_numpy())))
        for rows, texts in C.slices(chosen()):
            made = shingle_sets(texts)
            yield from C.to_batches({"set_name": pa.array([set_name(x) for x in made], pa.int64()),
                                     "doc_id": rows.column("doc_id"),
                                     "set": pa.array([x.tobytes() for x in made], pa.binary())})

    placed = docs.filter(F.col("doc_id").isNotNull()).select("doc_id", "text", G.place_in_filter("doc_id").alias("place"))
    made = C.map_batches(placed, whole, "set_name bigint, doc_id bigint, set binary")
    made = made.dropDuplicates(["set_name", "doc_id"])
    rows = C.stored(kept.join(made, ["set_name", "doc_id"]).select("pivot", "node", "set", "count"))

    def join_small(table):
        region = Region(_sets_of(table))
        region.join(np.arange(table.num_rows))
        yield from _edges(table.column("node").to_numpy(), region)

    found = _by_key(rows.filter(F.col("count") == 0).select("pivot", "node", "set"), "pivot", join_small, EDGES)
    hot = rows.filter(F.col("count") > 0)
    if not hot.isEmpty():
        found = found.unionByName(_large(hot))
    return found


def _large(rows: DataFrame) -> DataFrame:
    """Links inside regions of many documents, dealt over tasks of about REGION documents.

    Round by round some pivots of each region meet all its documents. Documents connected to
    the region's largest component need no pairing among themselves; the others meet every
    document of the region, block by block: first the sketches of all, then the sets of those that
    may link. The sets move to the tasks that compare them, and sizes, sketches and numbers to
    the others."""
    parts = F.ceil(F.col("count") / REGION).cast("bigint")
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("node", "pivot"), parts)).select("pivot", "node", "set", "count", "salt")
    found = None

    def small(batches):
        for batch in batches:
            made = _sets_of(batch)
            yield from C.to_batches({**{c: batch.column(c) for c in ("pivot", "node", "count", "salt")},
                                     "n": pa.array([x.size for x in made], pa.int64()),
                                     "sketch": pa.array([sketch(x, sketch_bits(x.size)).tobytes() for x in made], pa.binary())})

    keys = C.stored(C.map_batches(rows.select("pivot", "node", "count", "salt", "set"), small,
                                  "pivot bigint, node bigint, count bigint, salt bigint, n bigint, sketch binary"))

    def heads_first(table):
        head = np.array(table.column("head").to_pylist(), bool)
        return pa.concat_tables([table.filter(pa.array(head)), table.filter(pa.array(~head))]).combine_chunks(), int(head.sum())

    def meet(table):
        """The head rows of a task against all its rows."""
        table, first = heads_first(table)
        node = table.column("node").to_numpy()
        region = Region(_sets_of(table))
        region.leaf(np.arange(node.size), np.zeros((0, node.size)), first)
        yield from _edges(node, region)

    def may_meet(table):
        """The rows of a task that may link with a head row, or the other way round."""
        keep = partnered(table.column("n").to_numpy(), table.column("sketch").to_pylist(),
                         head=np.array(table.column("head").to_pylist(), bool), node=table.column("node").to_numpy())
        if keep.any():
            yield from (table.select(["pivot", "node", "task", "head"]).filter(pa.array(keep)).combine_chunks()
                        .to_batches(max_chunksize=1 << 16))

    every_salt = F.explode(F.sequence(F.lit(0).cast("bigint"), parts - 1))
    open_keys = keys
    for turn in range(STAR_ROUNDS):
        # Pivots: the first ones by hash among the documents outside the largest component.
        order = Window.partitionBy("pivot").orderBy(F.xxhash64("node", F.lit(turn)), "node")
        heads = C.stored(open_keys.select("pivot", "node").withColumn("rank", F.row_number().over(order))
                         .filter(F.col("rank") <= 2 * PIVOTS).select("pivot", "node").distinct())
        both = (rows.join(heads, ["pivot", "node"]).withColumn("salt", every_salt)
                .select("pivot", "salt", "node", "set", F.lit(True).alias("head"))
                .unionByName(rows.join(heads, ["pivot", "node"], "left_anti")
                             .select("pivot", "salt", "node", "set", F.lit(False).alias("head")))
                .withColumn("task", F.xxhash64("pivot", "salt")))
        edges = C.stored(_by_key(both.select("task", "node", "set", "head"), "task", meet, EDGES))
        found = edges if found is None else found.unionByName(edges)
        # What the largest component of each region leaves out.
        roots = G.components(found)
        named = (keys.select("pivot", "node", "count").join(roots, "node", "left")
                 .withColumn("root", F.coalesce("root", "node")))
        top = (named.groupBy("pivot", "root").count().groupBy("pivot")
               .agg(F.max(F.struct("count", "root")).alias("top")).select("pivot", F.col("top.root").alias("top")))
        open_keys = C.stored(named.join(top, "pivot").filter(F.col("root") != F.col("top")).select("pivot", "node", "count"))
        if open_keys.isEmpty():
            return found
    # The rest, in blocks of documents outside the largest component against all.
    number = open_keys.groupBy("pivot").agg(F.count("*").alias("open"))
    half = REGION // 2
    blocks = C.stored(number.withColumn("blocks", F.ceil(F.col("open") / half).cast("bigint")).select("pivot", "blocks"))
    block_of = (keys.join(open_keys.select("pivot", "node"), ["pivot", "node"]).join(blocks, "pivot")
                .withColumn("block", F.pmod(F.xxhash64("node", F.lit(-1)), F.col("blocks"))))
    heads = block_of.withColumn("salt", every_salt)
    rest = keys.join(blocks, "pivot").withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
    cells = ("pivot", "node", "n", "sketch", F.xxhash64("pivot", "block", "salt").alias("task"))
    both = heads.select(*cells, F.lit(True).alias("head")).unionByName(rest.select(*cells, F.lit(False).alias("head")))
    near = C.stored(_by_key(both, "task", may_meet, "pivot bigint, node bigint, task bigint, head boolean"))
    left = near.join(rows.select("pivot", "node", "set"), ["pivot", "node"])
    return found.unionByName(C.stored(_by_key(left.select("task", "node", "set", "head"), "task", meet, EDGES)))


# --- results ----------------------------------------------------------------------------

def components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id, the smallest doc_id reachable by links."""
    every, lead = _leads(docs, F.min("doc_id").alias("least"))
    lead = C.stored(lead.select("set_name", F.coalesce("least", "lead").alias("least")))
    return (every.select("doc_id", F.col("n").alias("n_shingles"), "set_name").join(lead, "set_name", "left")
            .select("doc_id", "n_shingles",
                    F.when(F.col("n_shingles") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id")))


def _leads(docs: DataFrame, least: Column) -> tuple[DataFrame, DataFrame]:
    """The described documents, and for each set its smallest id as lead and the aggregate
    `least` over the sets of its component, null where it links with none."""
    docs = docs.select(F.col("doc_id").cast("bigint"), "text")
    every = described(docs)
    first = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "node")))
    lead = C.stored(every.filter(F.col("n") > 0).groupBy("set_name").agg(first.alias("first"), F.max("n").alias("n"))
                    .select("set_name", "n", F.col("first.doc_id").alias("lead"), "first.node"))
    sets = lead.filter(F.col("lead").isNotNull()).select("node", "set_name", "n", F.col("lead").alias("doc_id"))
    roots = G.components(near_edges(docs, every, sets))
    named = roots.join(sets.select("node", "set_name", "doc_id"), "node")
    found = (named.groupBy("root").agg(least).join(named.select("root", "set_name"), "root").select("set_name", "least"))
    return every, lead.select("set_name", "lead").join(found, "set_name", "left")


def distinct(docs: DataFrame) -> DataFrame:
    """One document of each component, that with the smallest id, with its columns; of several
    sets with this id in a component, that with the smallest name. Rows are told apart by id
    and set: rows of one id that do not link are results of their own, and of rows of one id
    and set one stays. Rows with a null id stay.

    Most documents are alone: a bounded filter on the ids that are not lets them pass without a
    shuffle of their texts. Of those that it finds most are copies that go: a second one, on the
    sets of the rows among them that stay, drops them where they are, and only the others'
    texts are joined with the exact ids and sets."""
    return C.shielded(docs, _distinct, "_place", "_set")


def _distinct(docs: DataFrame) -> DataFrame:
    # A repeated id can lead two components, so the set that stays is named as well.
    every, lead = _leads(docs, F.min(F.struct("doc_id", "set_name")).alias("least"))
    lead = C.stored(lead.select("set_name", F.coalesce("least.doc_id", "lead").alias("least"),
                                F.coalesce("least.set_name", "set_name").alias("kept")))
    stays = (F.col("n") == 0) | ((F.col("doc_id") == F.col("least")) & (F.col("set_name") == F.col("kept")))
    found = C.stored(every.filter(F.col("doc_id").isNotNull()).select("doc_id", "n", "set_name").join(lead, "set_name", "left")
                     .select("doc_id", "set_name", stays.alias("stays")))
    fate = found.groupBy("doc_id").agg(F.count("*").alias("rows"), F.bool_and("stays").alias("stays"))
    fate = C.stored(fate.filter((F.col("rows") > 1) | ~F.col("stays")).select("doc_id"))
    sent = docs.sparkSession.sparkContext.broadcast(G.id_filter(fate, "doc_id"))

    def met(batches):
        bits = sent.value
        for batch in batches:
            yield batch.filter(pa.array(G.passes(bits, batch.column("place").to_numpy()))).select(["set_name"])

    staying = found.filter("stays").select("set_name", G.place_in_filter("doc_id").alias("place"))
    staying = C.map_batches(staying, met, "set_name bigint")
    sent_sets = docs.sparkSession.sparkContext.broadcast(G.id_filter(staying, "set_name", hashed=True))
    placed = docs.withColumn("_place", F.when(F.col("doc_id").isNotNull(), G.place_in_filter("doc_id")))

    def chosen(batches, inside):
        bits = sent.value
        for batch in batches:
            place = batch.column("_place").fill_null(0).to_numpy()
            hit = G.passes(bits, place) & batch.column("_place").is_valid().to_numpy(zero_copy_only=False)
            yield batch.filter(pa.array(hit == inside))

    def alone(batches):
        return chosen(batches, False)

    def others(batches):
        for rows, texts in C.slices(chosen(batches, True)):
            names = pa.array([set_name(x) for x in shingle_sets(texts)], pa.int64())
            keep = G.passes(sent_sets.value, names.to_numpy() & (G.FILTER_BITS - 1))
            yield from rows.append_column("_set", names).filter(pa.array(keep)).to_batches()

    lost = found.filter(~F.col("stays")).select("doc_id", F.col("set_name").alias("_set"))
    named = C.map_batches(placed, others, StructType([*placed.schema.fields, StructField("_set", LongType())]))
    again = named.dropDuplicates(["doc_id", "_set"]).join(lost, ["doc_id", "_set"], "left_anti").select(*docs.columns)
    return C.map_batches(placed, alone, placed.schema).drop("_place").unionByName(again)
