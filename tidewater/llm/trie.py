"""Prefix tries of conversations, as double arrays.

A node is a distinct sequence of first turns (role and text); the root is the empty one. Each
node gets the number of conversations that begin with it, its children, the leaves below it, the
bytes that a store of shared prefixes saves below it, and a digest of the conversations that end
there.

Method: turns have 128-bit names, a conversation is the list of its turns' names, and equal
lists are one row with a count. The lists are range-sorted, so that a shard holds the lists of some
neighbouring prefixes; a hot first turn is spread over as many shards as its lists need. In
each shard a task numbers the turn names densely and packs a double array: the child of state s
by turn t is the slot BASE[s] + t whose CHECK is s. It then traverses the arrays with every list and
adds up counts on the way, and subtree sums from the deepest level to the root.

Only the nodes on a shard's first or last path, as far as a neighbouring shard has them too, are
shared. They leave the shard as partial sums under the name of their path and are merged by
Spark. To make the sums additive, a shard counts a shared node's own text, and the node as
a child, only where the node begins, in the first of its shards.

What is in one task: a shard's lists of names (16 bytes a turn; texts stay behind), the pieces of
a digest one after the other. A conversation's list is one row. A node that ends many
conversations is digested from pieces of their ids that other tasks have put together.

Turns are ordered by turn (null first), then role, then name. A turn given twice is two turns; a
null role or text is empty; rows with a null conv_id belong to no conversation. An empty table
has no nodes. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common as C
from . import repeats as R

cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(R)

#: Turns of a shard, on average.
SHARD_TURNS = 1 << 17
#: Ids put together before they are digested.
PIECE = 4096

EMPTY = hashlib.sha256(b"").hexdigest()
NODES = ("path binary, parent_path binary, least bigint, parent_least bigint, depth bigint, n_convs bigint, "
         "n_children bigint, n_leaves bigint, saved bigint, ends string, shared boolean")


# --- conversations ----------------------------------------------------------------------

def sequences(turns: DataFrame) -> DataFrame:
    """conv_id and its turns in order, as structs of a name and the bytes of the text."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    named = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    row = F.struct(F.col("turn").isNotNull().alias("given"), F.coalesce(F.col("turn").cast("bigint"), F.lit(0)).alias("turn"),
                   role.alias("role"), F.unhex(F.substring(named, 1, 32)).alias("name"),
                   F.octet_length(text).cast("bigint").alias("bytes"))
    return (turns.filter(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("bigint").alias("conv_id"), row.alias("t"))
            .groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
            .select("conv_id", F.transform("turns", lambda t: F.struct(t["name"].alias("name"), t["bytes"].alias("bytes"))).alias("turns")))


def rebuilt(found: DataFrame, block: int = 5, most: int = 9) -> DataFrame:
    """Conversations that share first turns: of conversation c the first h turns come from
    conversation c - c mod block, h = crc32(c) mod `most`; its own follow from place h on."""
    found = C.stored(found)
    heads = (found.filter(F.pmod("conv_id", F.lit(block)) == 0)
             .select(F.col("conv_id").alias("base"), F.slice("turns", 1, most - 1).alias("head")))
    h = C.crc_mod("conv_id", most).cast("int")
    none = F.slice("turns", 1, 0)
    return (found.withColumn("base", F.col("conv_id") - F.pmod("conv_id", F.lit(block))).join(heads, "base", "left")
            .select("conv_id", F.concat(F.slice(F.coalesce("head", none), F.lit(1), h),
                                        F.when(F.size("turns") > h, F.slice("turns", h + 1, F.size("turns"))).otherwise(none))
                    .alias("turns")))


def _ends(convs: DataFrame) -> DataFrame:
    """path and the SHA-256 of the ascending ids of the conversations that end there. convs:
    conv_id, path."""
    def pieces(batches):
        for rows in R.grouped(batches, "path"):
            ids = rows.column("conv_id").to_pylist()
            path = rows.column("path")[0].as_py()
            for k in range(0, len(ids), PIECE):
                part = ids[k:k + PIECE]
                yield from C.to_batches({"path": pa.array([path], pa.binary()), "first": pa.array(part[:1], pa.int64()),
                                         "ids": pa.array([",".join(map(str, part))])})

    def digests(batches):
        path, state = None, None
        for batch in batches:
            paths, ids, done = batch.column("path").to_pylist(), batch.column("ids").to_pylist(), []
            for p, text in zip(paths, ids):
                if p != path:
                    if path is not None:
                        done.append((path, state.hexdigest()))
                    path, state = p, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(text.encode())
            if done:
                yield _digest_rows(done)
        if path is not None:
            yield _digest_rows([(path, state.hexdigest())])

    spread = convs.repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id")
    parts = C.map_batches(spread, pieces, "path binary, first bigint, ids string")
    return C.map_batches(parts.repartition(F.col("path")).sortWithinPartitions("path", "first"), digests, "path binary, ends string")


def _digest_rows(rows) -> pa.RecordBatch:
    return pa.record_batch({"path": pa.array([p for p, _ in rows], pa.binary()), "ends": pa.array([d for _, d in rows])})


# --- double arrays ----------------------------------------------------------------------

class DoubleArray:
    """The trie of some sorted lists of dense turn ids. State 0 is the root; the child of s by t
    is slot base[s] + t where check[slot] = s, and there is none where it is not."""

    def __init__(self, values: np.ndarray, first: np.ndarray, symbols: int):
        """values: the lists one after the other; first: where each begins, and the end."""
        self.size, self.symbols = np.diff(first), symbols
        room = values.size + 2 * symbols + 2
        self.base = np.zeros(room, np.int64)
        self.check = np.full(room, -1, np.int64)
        self.check[0] = 0
        self.free = 1
        rows = np.flatnonzero(self.size > 0)
        state, depth = np.zeros(rows.size, np.int64), 0
        while rows.size:
            turn = values[first[rows] + depth]
            new = np.ones(rows.size, bool)
            new[1:] = (state[1:] != state[:-1]) | (turn[1:] != turn[:-1])
            at = np.flatnonzero(new)
            parents, children = state[at], turn[at]
            cuts = np.flatnonzero(np.append(True, parents[1:] != parents[:-1]))
            ends = np.append(cuts[1:], parents.size)
            for s, a, b in zip(parents[cuts].tolist(), cuts.tolist(), ends.tolist()):
                self._place(s, children[a:b])
            state = self.base[state] + turn
            depth += 1
            stay = self.size[rows] > depth
            rows, state = rows[stay], state[stay]

    def _place(self, s: int, turns: np.ndarray):
        """A base for the children of s: the first one that fits from the first free slot on."""
        low, high = int(turns[0]), int(turns[-1])
        while self.free < self.check.size and self.check[self.free] >= 0:
            self.free += 1
        slot = self.free
        if turns.size > 1:
            tries = 0
            while True:
                self._grow(slot + high - low)
                if not (self.check[slot - low + turns] >= 0).any():
                    break
                # Farther and farther on: from the last used slot on all are free.
                tries += 1
                slot += 1 << max(0, tries - 16)
        else:
            self._grow(slot)
            while self.check[slot] >= 0:
                slot += 1
                self._grow(slot)
        self.base[s] = slot - low
        self.check[self.base[s] + turns] = s

    def _grow(self, slot: int):
        if slot >= self.check.size:
            more = max(slot + 1 - self.check.size, self.check.size)
            self.check = np.concatenate([self.check, np.full(more, -1, np.int64)])
            self.base = np.concatenate([self.base, np.zeros(more, np.int64)])

    def child(self, state: np.ndarray, turn: np.ndarray) -> np.ndarray:
        """The next states, -1 where there is none."""
        slot = self.base[state] + turn
        ok = (slot > 0) & (slot < self.check.size) & (state >= 0)
        return np.where(ok & (self.check[np.where(ok, slot, 0)] == state), slot, -1)

    def walk(self, values: np.ndarray, first: np.ndarray):
        """(depth, rows, states) for the lists, level by level, the root first."""
        rows = np.arange(self.size.size)
        state, depth = np.zeros(rows.size, np.int64), 0
        while rows.size:
            yield depth, rows, state
            stay = self.size[rows] > depth
            rows, state = rows[stay], state[stay]
            state = self.child(state, values[first[rows] + depth])
            depth += 1


def shard_nodes(rows: pa.Table) -> pa.Table:
    """The nodes of one shard. rows: names, bytes, n, least, ends, sorted by names; before and
    after are the numbers of first turns shared with the neighbouring shards, -1 without one."""
    lists = rows.column("names").combine_chunks()
    names = np.array(lists.flatten().to_pylist(), dtype=object)
    first = np.concatenate([[0], np.cumsum(np.diff(lists.offsets.to_numpy()))]).astype(np.int64)
    sizes = rows.column("bytes").combine_chunks().flatten().to_numpy()
    # Dense ids in the order of the names, so that sorted lists stay sorted.
    distinct = sorted(set(names.tolist()))
    number = {x: k for k, x in enumerate(distinct)}
    values = np.fromiter((number[x] for x in names.tolist()), np.int64, names.size)
    n, least = rows.column("n").to_numpy(), rows.column("least").to_numpy()
    ends = np.array(rows.column("ends").to_pylist(), dtype=object)
    before, after = rows.column("before")[0].as_py(), rows.column("after")[0].as_py()

    trie = DoubleArray(values, first, len(distinct))
    room = trie.check.size
    count, low = np.zeros(room, np.int64), np.full(room, np.iinfo(np.int64).max)
    own, depth_of, end = np.zeros(room, np.int64), np.full(room, -1, np.int64), np.full(room, None, dtype=object)
    here, path_low, path_high = np.ones(room, bool), [], []
    levels = []
    for depth, who, state in trie.walk(values, first):
        np.add.at(count, state, n[who])
        np.minimum.at(low, state, least[who])
        depth_of[state] = depth
        if depth:
            own[state] = sizes[first[who] + depth - 1]
        done = trie.size[who] == depth
        end[state[done]] = ends[who[done]]
        levels.append(np.unique(state))
        if who[0] == 0 and depth <= before:
            path_low.append(int(state[0]))
        if who[-1] == trie.size.size - 1 and depth <= after:
            path_high.append(int(state[-1]))
    here[path_low] = False
    passes_on = np.zeros(room, bool)
    passes_on[path_high] = True

    children, leaves = np.zeros(room, np.int64), np.zeros(room, np.int64)
    saved = (count - here) * own
    for states in reversed(levels):
        leaf = states[(children[states] == 0) & ~passes_on[states] & here[states]]
        leaves[leaf] = 1
        if depth_of[states[0]]:
            parent = trie.check[states]
            np.add.at(leaves, parent, leaves[states])
            np.add.at(saved, parent, saved[states])
            np.add.at(children, parent, here[states].astype(np.int64))
    nodes = np.concatenate(levels)
    shared = ~here | passes_on

    # Names of the shared paths.
    path = {}
    for states, row in ((path_low, 0), (path_high, trie.size.size - 1)):
        digest = hashlib.sha256()
        for d, s in enumerate(states):
            if d:
                digest.update(names[first[row] + d - 1])
            path[s] = digest.copy().digest()[:16]
    parent = trie.check[nodes]
    is_shared = shared[nodes]
    parent_shared = shared[parent] & (depth_of[nodes] > 0)
    return pa.table({
        "path": pa.array([path[s] if f else None for s, f in zip(nodes.tolist(), is_shared.tolist())], pa.binary()),
        "parent_path": pa.array([path[s] if f else None for s, f in zip(parent.tolist(), parent_shared.tolist())], pa.binary()),
        "least": low[nodes],
        "parent_least": pa.array(low[parent], mask=parent_shared | (depth_of[nodes] == 0)),
        "depth": depth_of[nodes], "n_convs": count[nodes], "n_children": children[nodes], "n_leaves": leaves[nodes],
        "saved": saved[nodes], "ends": pa.array(end[nodes].tolist(), pa.string()), "shared": is_shared})


# --- nodes ------------------------------------------------------------------------------

def nodes(convs: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row for each node. convs: conv_id and turns, as from `sequences`."""
    names = F.transform("turns", lambda t: t["name"])
    path = F.unhex(F.substring(F.sha2(F.array_join(F.transform(names, F.hex), ""), 256), 1, 32))
    convs = C.stored(convs.select("conv_id", "turns", path.alias("path")))
    ends = _ends(convs.select("path", "conv_id"))
    groups = (convs.groupBy("path").agg(F.count("*").alias("n"), F.min("conv_id").alias("least")).join(ends, "path"))
    # One list for each path, that of its smallest conversation.
    lists = (convs.select(F.col("conv_id").alias("least"), names.alias("names"),
                          F.transform("turns", lambda t: t["bytes"]).alias("bytes"))
             .join(groups.select("n", "least", "ends"), "least"))
    lists = C.stored(lists)
    total = lists.agg(F.sum(F.size("names")), F.min("least")).first()
    if total[1] is None:
        return _result(lists.sparkSession.createDataFrame([], NODES))
    shards = 1 + (total[0] or 0) // shard_turns
    dealt = C.stored(lists.repartitionByRange(shards, "names").withColumn("shard", F.spark_partition_id()))

    # Neighbouring shards: how many first turns the last list of one shares with the first of the next.
    ordered = Window.orderBy("shard")
    edges = dealt.groupBy("shard").agg(F.min("names").alias("low"), F.max("names").alias("high"))
    edges = (edges.withColumn("last", F.lag("high").over(ordered)).withColumn("next", F.lead("low").over(ordered))
             .select("shard", _shared("last", "low").alias("before"), _shared("high", "next").alias("after")))

    def work(batches):
        for rows in R.grouped(batches, "shard"):
            yield from shard_nodes(rows).to_batches(max_chunksize=1 << 14)

    whole = dealt.join(edges, "shard").repartition(shards, "shard").sortWithinPartitions("shard", "names")
    made = C.stored(C.map_batches(whole, work, NODES))
    merged = (made.filter("shared").groupBy("path").agg(
        F.min("parent_path").alias("parent_path"), F.min("least").alias("least"), F.min("parent_least").alias("parent_least"),
        F.min("depth").alias("depth"), *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")),
        F.max("ends").alias("ends"), F.lit(True).alias("shared")))
    merged = C.stored(merged.select(*made.columns))
    every = made.filter(~F.col("shared")).unionByName(merged)
    # The parents of depth 1 are the root, whose smallest member is known.
    known = F.when(F.col("depth") == 1, F.lit(total[1])).otherwise(F.col("parent_least"))
    above = merged.filter(F.col("depth") > 0).select(F.col("path").alias("parent_path"), F.col("least").alias("above"))
    asks = (F.col("depth") > 1) & F.col("parent_path").isNotNull()
    joined = every.filter(asks).join(above, "parent_path").withColumn("parent_least", F.col("above")).drop("above")
    return _result(every.filter(~asks).withColumn("parent_least", known).unionByName(joined.select(*every.columns)))


def _shared(one: str, other: str):
    """How many first values two arrays share; -1 if one is null."""
    size = F.least(F.size(one), F.size(other))
    differs = F.filter(F.sequence(F.lit(0), F.greatest(size - 1, F.lit(0))),
                       lambda i: (i < size) & (F.get(one, i) != F.get(other, i)))
    return F.when(F.col(one).isNull() | F.col(other).isNull(), F.lit(-1)).otherwise(
        F.coalesce(F.get(differs, 0), size)).cast("int")


def _result(found: DataFrame) -> DataFrame:
    return found.select(
        F.col("least").alias("conv_id"), "depth", F.col("parent_least").alias("parent_conv_id"), "n_convs", "n_children",
        "n_leaves", F.col("saved").alias("saved_tokens"), F.coalesce("ends", F.lit(EMPTY)).alias("ends_sha256"))
