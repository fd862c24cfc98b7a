"""Connected components of a graph given as edges, and a bounded filter on ids."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

#: Bits of the id filter: 8 MB when broadcast, whatever the number of ids.
FILTER_BITS = 1 << 26


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for the nodes of the edges (a, b); root is the smallest node reached.

    Rounds of large and small stars: every node hangs its larger neighbours, then all its
    neighbours that are not larger, on the smallest of them. Minima are aggregated before
    the shuffle, so a node with many edges is no burden to one task."""
    edges = C.stored(edges.filter(F.col("a") != F.col("b"))
                     .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while not _stars(edges):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (both.join(low, "a").filter(F.col("b") > F.col("a"))
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = C.stored(small.filter(F.col("a") != F.col("b")).unionByName(low.withColumnRenamed("m", "b")).distinct())
    # Every edge now leads from a node to its root.
    return (edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
            .unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct())


def _stars(edges: DataFrame) -> bool:
    """Whether every node that hangs on another hangs on one alone, which is a root."""
    hung = edges.groupBy("a").agg(F.count("*").alias("n"))
    roots = edges.select(F.col("b").alias("root")).distinct()
    return hung.join(roots, hung["a"] == roots["root"], "left").filter((F.col("n") > 1) | F.col("root").isNotNull()).isEmpty()


def id_filter(ids: DataFrame, column: str, hashed: bool = False) -> np.ndarray:
    """A bit set of fixed size that holds the hashes of all ids; others may pass as well.
    Ids that are hashes already are their own."""
    place = F.col(column).bitwiseAND(FILTER_BITS - 1) if hashed else place_in_filter(column)
    rows = ids.select(place.alias("p")).select(
        F.shiftright("p", 6).alias("w"), F.expr("shiftleft(1L, int(p & 63))").alias("b"))
    found = rows.groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
    out = np.zeros(FILTER_BITS >> 6, np.int64)
    out[found.column("w").to_numpy()] = found.column("b").to_numpy()
    return out.view(np.uint8)


def place_in_filter(column: str):
    """Where to look a row's id up."""
    return F.pmod(F.xxhash64(column), F.lit(FILTER_BITS))


def passes(bits: np.ndarray, place: np.ndarray) -> np.ndarray:
    return (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
