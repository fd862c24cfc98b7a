"""Nearest neighbours by inner product, with cross-polytope hashing.

Directions are turned by pseudo-rotations, each three rounds of random signs and a Hadamard
transform; the cell of a vector is the signed axis nearest to it, for `depth` rotations in a row.
TABLES independent tables hold every vector once each. A query probes, in each table, all cells
whose distance score (sum over the rotations of the squared shortfall of the axis from the best
one) is at most a bound. Members of probed cells are ranked by the exact inner product.

Inner products of vectors of different length are no matter of direction alone, so cells are
parted by bands of length, half an octave each, and every band of a cell is probed.

Bound and depth are measured, not set: the nearest vectors of SAMPLE queries are found by brute
force, and the bound is the one within which a share of RECALL of them is reached; of the depths
that the number of vectors allows, the one with the least work at its bound is taken. Every
vector is indexed. Where vectors have no structure the cells probed are about half of all, as no
hash can tell far from near there; the query stays a ranking of queries against blocks of rows.

Work is dealt in units: at most about BLOCK members of a cell against QUERIES of its queries, so a cell
that a third of all vectors fall into is many units. Equal vectors are searched for once, and of more
than KEEP candidates with equal vectors the smallest ids stay, since no others can be in a
result. A query that finds too few (sparse cells) is ranked against all vectors, in blocks.

Vectors that are null, zero or hold null or non-finite components, and rows with a null id, take
no part. Vectors of fewer components count as filled up with zeros. An id that occurs more than
once is one query and one candidate, with the best score of its vectors. Ties go to the smaller
id. Other columns are ignored. No queries or no other candidates: no rows.
"""

from __future__ import annotations

import hashlib
import math
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common as C
from . import repeats as R

cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(R)

TABLES = 2
#: Queries that the bound is measured on, and the share of their neighbours it must reach.
SAMPLE, RECALL = 128, 0.95
#: Members and queries of a unit.
BLOCK, QUERIES = 4096, 512
#: What probing a cell costs, in members ranked.
PROBE_COST = 256
#: Probes of a sampled query beyond which a depth is not considered.
MOST_PROBES = 1 << 14

FOUND = "query bigint, vec_id bigint, score double"


# --- vectors ----------------------------------------------------------------------------

def valid(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """vec_id, v (the components as bytes) and a name of v, for the vectors that take part."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    rows = (df.filter(F.col("vec_id").isNotNull() & F.col(vector).isNotNull()).filter(finite)
            .filter(F.exists(vector, lambda x: x != 0))
            .select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col(vector).alias("x")))
    double = rows.schema["x"].dataType.elementType.typeName() != "float"
    kind = np.float64 if double else np.float32

    def work(batches):
        for batch in batches:
            lists = batch.column("x")
            flat = lists.flatten().cast(pa.float64()).to_numpy().astype(kind) + kind(0)
            at = np.concatenate([[0], np.cumsum(np.diff(lists.offsets.to_numpy()))])
            out = [flat[a:b].tobytes() for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
            yield from C.to_batches({"vec_id": batch.column("vec_id"), "v": pa.array(out, pa.binary()),
                                     "name": pa.array([hashlib.blake2b(x, digest_size=16).digest() for x in out], pa.binary())})

    return C.map_batches(rows, work, "vec_id bigint, v binary, name binary")


class Space:
    """Number format, longest vector, rotations and cells."""

    def __init__(self, kind: str, length: int):
        self.kind, self.length = kind, length
        self.size = max(2, 1 << (length - 1).bit_length())

    def matrix(self, column) -> np.ndarray:
        values = column.to_pylist()
        out = np.zeros((len(values), self.length))
        for i, x in enumerate(values):
            row = np.frombuffer(x, self.kind)
            out[i, :row.size] = row
        return out

    def directions(self, x: np.ndarray) -> np.ndarray:
        x = x / np.abs(x).max(1, keepdims=True)
        out = np.zeros((len(x), self.size))
        out[:, :self.length] = x / np.sqrt((x * x).sum(1, keepdims=True))
        return out

    @staticmethod
    def bands(x: np.ndarray) -> np.ndarray:
        most = np.abs(x).max(1)
        length = np.log2(most) + 0.5 * np.log2(((x / most[:, None]) ** 2).sum(1))
        return np.floor(2 * length + 0.5).astype(np.int64)

    def rotated(self, x: np.ndarray, table: int, level: int) -> np.ndarray:
        """A pseudo-rotation of the rows: three rounds of signs and a Hadamard transform."""
        signs = np.random.default_rng([2, table, level]).choice([-1.0, 1.0], (3, self.size))
        for s in signs:
            x = x * s
            half = 1
            while half < self.size:
                y = x.reshape(len(x), -1, 2, half)
                x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], 2).reshape(len(x), self.size)
                half *= 2
            x = x / math.sqrt(self.size)
        return x

    def vertices(self, directions: np.ndarray, table: int, level: int) -> np.ndarray:
        r = self.rotated(directions, table, level)
        axis = np.abs(r).argmax(1)
        return 2 * axis + (r[np.arange(len(r)), axis] < 0)

    def cells(self, directions: np.ndarray, depth: int) -> np.ndarray:
        """The cell of each row in each table."""
        out = np.zeros((len(directions), TABLES), np.int64)
        for t in range(TABLES):
            for level in range(depth):
                out[:, t] = out[:, t] * 2 * self.size + self.vertices(directions, t, level)
        return out

    def scores(self, directions: np.ndarray, table: int, level: int) -> np.ndarray:
        """For each row the score of every vertex: 0 for the nearest."""
        r = self.rotated(directions, table, level)
        both = np.stack([r, -r], 2).reshape(len(r), 2 * self.size)
        return (both.max(1, keepdims=True) - both) ** 2

    def probes(self, levels: list[np.ndarray], bound: float, most: int | None = None) -> np.ndarray | None:
        """The cells of a table with a score of at most the bound; levels: one query's scores.
        None if there are more than `most`."""
        cell, score = np.zeros(1, np.int64), np.zeros(1)
        for s in levels:
            total = score[:, None] + s
            part, vertex = np.nonzero(total <= bound + 1e-9)
            if most is not None and part.size > most:
                return None
            cell, score = cell[part] * 2 * self.size + vertex, total[part, vertex]
        return cell


def top(query: np.ndarray, vec: np.ndarray, score: np.ndarray, keep: int):
    """The `keep` best of each query, each vector id once."""
    by = np.lexsort((vec, -score, query))
    query, vec, score = query[by], vec[by], score[by]
    again = np.lexsort((np.arange(query.size), vec, query))
    first = np.ones(query.size, bool)
    same = (query[again][1:] == query[again][:-1]) & (vec[again][1:] == vec[again][:-1])
    first[again[1:][same]] = False
    query, vec, score = query[first], vec[first], score[first]
    start = np.ones(query.size, bool)
    start[1:] = query[1:] != query[:-1]
    place = np.arange(query.size) - np.maximum.accumulate(np.where(start, np.arange(query.size), 0))
    ok = place < keep
    return query[ok], vec[ok], score[ok]


def ranked(q: np.ndarray, x: np.ndarray, ids: np.ndarray, keep: int):
    """(row of q, id, score) of the `keep` best rows of x by inner product; the scores are summed
    in an order that depends on the length alone, so equal vectors have equal ones."""
    rough = q @ x.T
    for i in range(len(q)):
        if x.shape[0] > keep:
            least = np.partition(rough[i], -keep)[-keep]
            near = np.flatnonzero(rough[i] >= least - 1e-9 * max(1.0, np.abs(rough[i]).max()))
        else:
            near = np.arange(x.shape[0])
        yield i, ids[near], (x[near] * q[i]).sum(1)


# --- search -----------------------------------------------------------------------------

def _measured(space: Space, vectors: DataFrame, queries: DataFrame, k: int, count: int):
    """Depth and bound, from the true neighbours of a sample of the queries."""
    sample = queries.orderBy(F.xxhash64("lead"), "name").limit(SAMPLE).select("lead", "v").toArrow()
    if not sample.num_rows:
        return None
    own = sample.column("lead").to_numpy()
    q = space.matrix(sample.column("v"))

    def work(batches):
        held = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        found: dict[int, bytes] = {}
        for batch in batches:
            ids = batch.column("vec_id").to_numpy()
            bytes_of = batch.column("v").to_pylist()
            new = [held]
            for i, near, score in ranked(q, space.matrix(batch.column("v")), np.arange(ids.size), k):
                other = ids[near] != own[i]
                found.update((int(ids[j]), bytes_of[j]) for j in near[other].tolist())
                new.append([np.full(other.sum(), i), ids[near[other]], score[other]])
            held = list(top(*(np.concatenate([x[n] for x in new]) for n in range(3)), k))
            found = {v: found[v] for v in set(held[1].tolist())}
        yield from C.to_batches({"query": held[0].astype(np.int64), "vec_id": held[1], "score": held[2],
                                 "v": pa.array([found[v] for v in held[1].tolist()], pa.binary())})

    best = C.map_batches(vectors.select("vec_id", "v"), work, FOUND + ", v binary")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    rows = (best.dropDuplicates(["query", "vec_id"]).withColumn("r", F.row_number().over(order))
            .filter(F.col("r") <= k).select("query", "v").toArrow())
    if not rows.num_rows:
        return 1, math.inf
    who = rows.column("query").to_numpy()
    near, asked = space.directions(space.matrix(rows.column("v"))), space.directions(q)
    best_depth, best_bound, least_cost = 1, math.inf, math.inf
    total, levels = np.zeros((TABLES, who.size)), [[] for _ in range(TABLES)]
    depth = 1
    while depth == 1 or (2 * space.size) ** depth <= count:
        for t in range(TABLES):
            levels[t].append(space.scores(asked, t, depth - 1))
            total[t] += levels[t][-1][who, space.vertices(near, t, depth - 1)]
        bound = float(np.quantile(total.min(0), RECALL, method="higher"))
        made = [space.probes([s[i] for s in levels[t]], bound, MOST_PROBES) for t in range(TABLES) for i in range(len(q))]
        if any(m is None for m in made):
            break
        cost = np.mean([m.size for m in made]) * (PROBE_COST + count / (2 * space.size) ** depth)
        if cost < least_cost:
            best_depth, best_bound, least_cost = depth, bound, cost
        depth += 1
    return best_depth, best_bound


def _rank_units(rows: DataFrame, space: Space, keep: int) -> DataFrame:
    """rows: unit, asks (a query or a member), id, v. The best members of each query, unit by
    unit, and then of what a task has seen."""
    def work(batches):
        held, size = [], 0

        def best():
            return list(top(*(np.concatenate([h[n] for h in held]) for n in range(3)), keep))

        for unit in R.grouped(batches, "unit"):
            asks = unit.column("asks").to_numpy()
            ids, x = unit.column("id").to_numpy(), space.matrix(unit.column("v"))
            own = ids[asks]
            for i, near, score in ranked(x[asks], x[~asks], ids[~asks], keep):
                held.append((np.full(near.size, own[i]), near, score))
                size += near.size
            if size > 1 << 18:
                held = [best()]
                if held[0][0].size > 1 << 17:
                    yield from _found(held.pop())
                size = sum(h[0].size for h in held)
        if held:
            yield from _found(best())

    dealt = rows.repartition(F.col("unit")).sortWithinPartitions("unit")
    return C.map_batches(dealt, work, FOUND)


def _found(best):
    return C.to_batches({"query": best[0], "vec_id": best[1], "score": best[2]})


def _blocks(count: str, size: int) -> Column:
    return F.ceil(F.col(count) / size).cast("bigint")


def _every(n: Column) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("bigint"), n - 1))


def _salt(column: str, n: Column) -> Column:
    return F.pmod(F.xxhash64(column, F.lit(7)), n)


def _in_cells(space: Space, vectors: DataFrame, queries: DataFrame, depth: int, bound: float, keep: int) -> DataFrame:
    def index(batches):
        for batch in batches:
            x = space.matrix(batch.column("v"))
            cells = space.cells(space.directions(x), depth)
            yield from C.to_batches({"vec_id": batch.column("vec_id"), "v": batch.column("v"), "band": space.bands(x),
                                     "cells": pa.ListArray.from_arrays(np.arange(0, cells.size + 1, TABLES, dtype=np.int32), cells.ravel())})

    def probe(batches):
        for batch in batches:
            asked, values = space.directions(space.matrix(batch.column("v"))), batch.column("v").to_pylist()
            ids = batch.column("query").to_pylist()
            for t in range(TABLES):
                levels = [space.scores(asked, t, level) for level in range(depth)]
                for i, v in enumerate(values):
                    cells = space.probes([s[i] for s in levels], bound)
                    yield from C.to_batches({"query": pa.array([ids[i]] * cells.size, pa.int64()), "v": pa.array([v] * cells.size, pa.binary()),
                                             "tab": np.full(cells.size, t, np.int32), "cell": cells})

    queries = queries.select("query", "v")
    held = C.stored(C.map_batches(vectors, index, "vec_id bigint, v binary, band bigint, cells array<bigint>"))
    member = held.select("vec_id", "v", "band", F.posexplode("cells").alias("tab", "cell"))
    asked = C.map_batches(queries, probe, "query bigint, v binary, tab int, cell bigint")
    sizes = member.groupBy("tab", "cell", "band").agg(F.count("*").alias("members"))
    askers = asked.groupBy("tab", "cell").agg(F.count("*").alias("askers"))
    cells = C.stored(sizes.join(askers, ["tab", "cell"]).select(
        "tab", "cell", "band", _blocks("members", BLOCK).alias("m"), _blocks("askers", QUERIES).alias("q")))
    unit = F.xxhash64("tab", "cell", "band", "mb", "qb").alias("unit")
    left = (member.join(cells, ["tab", "cell", "band"]).withColumn("mb", _salt("vec_id", F.col("m"))).withColumn("qb", _every(F.col("q")))
            .select(unit, F.lit(False).alias("asks"), F.col("vec_id").alias("id"), "v"))
    right = (asked.join(cells, ["tab", "cell"]).withColumn("qb", _salt("query", F.col("q"))).withColumn("mb", _every(F.col("m")))
             .select(unit, F.lit(True).alias("asks"), F.col("query").alias("id"), "v"))
    return _rank_units(left.unionByName(right), space, keep)


def _everywhere(space: Space, vectors: DataFrame, queries: DataFrame, count: int, keep: int) -> DataFrame:
    """The queries against all vectors, in blocks."""
    m, n = 1 + count // BLOCK, 1 + queries.count() // QUERIES
    unit = F.xxhash64("mb", "qb").alias("unit")
    left = (vectors.withColumn("mb", _salt("vec_id", F.lit(m))).withColumn("qb", _every(F.lit(n).cast("bigint")))
            .select(unit, F.lit(False).alias("asks"), F.col("vec_id").alias("id"), "v"))
    right = (queries.withColumn("qb", _salt("query", F.lit(n))).withColumn("mb", _every(F.lit(m).cast("bigint")))
             .select(unit, F.lit(True).alias("asks"), F.col("query").alias("id"), "v"))
    return _rank_units(left.unionByName(right), space, keep)


def nearest(rows: DataFrame, asks: Column, k: int = 20, vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of every row for which `asks` holds,
    among all rows but those of its id."""
    keep = k + 1
    named = C.stored(valid(rows, vector))
    kind = "float64" if rows.schema[vector].dataType.elementType.typeName() != "float" else "float32"
    count, longest = named.agg(F.count("*"), F.max(F.octet_length("v"))).first()
    if not count:
        return rows.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    space = Space(kind, longest // np.dtype(kind).itemsize)

    # Of equal vectors only the smallest ids can be results.
    many = named.groupBy("name").agg(F.count("*").alias("n")).filter(F.col("n") > keep).select("name")
    copies = Window.partitionBy("name").orderBy("vec_id")
    few = (named.join(many, "name").dropDuplicates(["name", "vec_id"])
           .withColumn("r", F.row_number().over(copies)).filter(F.col("r") <= keep))
    vectors = C.stored(named.join(many, "name", "left_anti").select("vec_id", "v").unionByName(few.select("vec_id", "v")))

    # Equal query vectors are searched for once, under their smallest id.
    asking = named.filter(asks)
    leads = asking.groupBy("name").agg(F.min("vec_id").alias("vec_id"))
    queries = C.stored(asking.join(leads, ["name", "vec_id"]).dropDuplicates(["name"])
                       .select(F.monotonically_increasing_id().alias("query"), F.col("vec_id").alias("lead"), "name", "v"))
    settings = _measured(space, vectors, queries, k, count)
    queries = queries.select("query", "name", "v")
    if settings is None:
        return rows.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")

    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")

    def kept(found: DataFrame) -> DataFrame:
        return (found.groupBy("query", "vec_id").agg(F.max("score").alias("score"))
                .withColumn("r", F.row_number().over(best)).filter(F.col("r") <= keep).drop("r"))

    found = C.stored(kept(_in_cells(space, vectors, queries, *settings, keep)))
    enough = found.groupBy("query").agg(F.count("*").alias("n")).filter(F.col("n") >= min(keep, count)).select("query")
    short = C.stored(queries.join(enough, "query", "left_anti"))
    if not short.isEmpty():
        found = C.stored(found.join(short.select("query"), "query", "left_anti")
                         .unionByName(kept(_everywhere(space, vectors, short, count, keep))))
    every = (asking.select(F.col("vec_id").alias("query_id"), "name").distinct()
             .join(queries.select("name", "query"), "name").join(found, "query")
             .filter(F.col("vec_id") != F.col("query_id")).groupBy("query_id", "vec_id").agg(F.max("score").alias("score")))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return every.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
