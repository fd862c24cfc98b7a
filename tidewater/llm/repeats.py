"""Finding windows of a fixed length that occur more than once: what the two substring
operators share.

The windows of a document fall into segments: runs of neighbouring windows with the same
anchor, a name that depends on the content of the window alone. Equal windows therefore lie
in segments with equal anchors, and a segment whose anchor occurs once has no repeats.

Anchors are counted over all documents. The others' segments are fetched from the texts; those
whose anchor occurs often (more than HOT times) are set apart, so that no task gets all
segments of a frequent anchor; equal segments are merged first.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from . import graph as G

cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(G)

#: Occurrences of an anchor from which on its segments are set apart.
HOT = 1000
#: Windows of a segment; longer runs are cut.
LONGEST = 512

ANCHORS = "anchor bigint, row bigint, start bigint, n int, times int"


def keyed(docs: DataFrame) -> DataFrame:
    """row, a key of id and text (equal rows share it), doc_id and text without nulls."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.xxhash64("doc_id", text).alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"),
                       text.alias("text"))


def minima(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of every `width` neighbouring values."""
    out, size = values, 1
    while size * 2 <= width:
        out = np.minimum(out[:out.size - size], out[size:])
        size *= 2
    if size < width:
        out = np.minimum(out[:out.size - (width - size)], out[width - size:])
    return out


def runs(anchor: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and sizes of the runs of equal anchors among the windows that are `inside` a
    document, cut to LONGEST."""
    if not anchor.size:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = np.ones(anchor.size, bool)
    edge[1:] = (anchor[1:] != anchor[:-1]) | (inside[1:] != inside[:-1])
    start = np.flatnonzero(edge)
    size = np.diff(np.append(start, anchor.size))
    keep = inside[start]
    start, size = start[keep], size[keep]
    pieces = -(-size // LONGEST)
    if (pieces > 1).any():
        nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        start, size = np.repeat(start, pieces) + nth * LONGEST, np.repeat(size, pieces) - nth * LONGEST
        size = np.minimum(size, LONGEST)
    return start, size


def repeated(anchors: DataFrame) -> DataFrame:
    """The segments whose anchor occurs at least twice, and whether it is frequent. anchors:
    one row for each segment; `times` tells how often the anchor occurs in it, up to 2."""
    anchors = C.stored(anchors)
    often = (anchors.groupBy("anchor").agg(F.sum("times").alias("times")).filter(F.col("times") > 1)
             .select("anchor", (F.col("times") > HOT).alias("hot")))
    return C.stored(anchors.join(often, "anchor"))


def lists(found: DataFrame, *more: str) -> DataFrame:
    """(row, segments): the segments of each document together."""
    return C.stored(found.groupBy("row").agg(F.collect_set(F.struct("start", "n", "hot", *more)).alias("segments")))


def grouped(batches, key: str):
    """Consecutive rows with the same key as tables; the input is sorted by the key."""
    held, last = [], None
    for batch in batches:
        values = batch.column(key).to_numpy(zero_copy_only=False)
        if not values.size:
            continue
        cuts = np.concatenate([[0], np.flatnonzero(values[1:] != values[:-1]) + 1, [values.size]])
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            if held and values[a] != last:
                yield pa.Table.from_batches(held).combine_chunks()
                held = []
            held.append(batch.slice(a, b - a))
            last = values[a]
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def with_text(docs: DataFrame, lists: DataFrame) -> DataFrame:
    """The keyed documents with their lists; texts without one are not shuffled, as far as
    the bounded filter tells."""
    return chosen(docs, lists, "row", True).join(lists, "row")


def chosen(rows: DataFrame, ids: DataFrame, column: str, inside: bool) -> DataFrame:
    """The rows whose key may be (or surely is not) among the ids."""
    return filtered(rows, sent_filter(ids, column), column, inside)


def sent_filter(ids: DataFrame, column: str):
    return ids.sparkSession.sparkContext.broadcast(G.id_filter(ids, column))


def filtered(rows: DataFrame, sent, column: str, inside: bool) -> DataFrame:
    """chosen() with a filter that was sent before."""
    placed = rows.withColumn("_place", G.place_in_filter(column))
    return C.map_batches(placed, lambda batches: passing(batches, sent.value, inside), placed.schema).drop("_place")


def passing(batches, bits: np.ndarray, inside: bool):
    """What is left of batches with the place of their keys in the filter."""
    for batch in batches:
        hit = G.passes(bits, batch.column("_place").to_numpy())
        yield batch.filter(pa.array(hit == inside))


def intervals(mask: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of true values inside groups: group, begin and end within the group."""
    edge = np.zeros(mask.size + 1, bool)
    edge[0] = edge[-1] = True
    edge[1:-1] = mask[1:] != mask[:-1]
    edge[first[:-1][first[:-1] < mask.size]] = True
    place = np.flatnonzero(edge)
    begin, end = place[:-1], place[1:]
    keep = mask[begin] if mask.size else np.zeros(0, bool)
    begin, end = begin[keep], end[keep]
    group = np.searchsorted(first, begin, "right") - 1
    return group, begin - first[group], end - first[group]
