"""Tumbling event-time windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S

WINDOW = "5 seconds"
LATENESS = "5 seconds"


def with_lateness(df: DataFrame, column: str = "et", lateness: str = LATENESS) -> DataFrame:
    """Bounded lateness for a stream. A batch has no late rows."""
    return df.withWatermark(column, lateness) if df.isStreaming else df


def merged(*streams: DataFrame, column: str = "et", lateness: str = LATENESS) -> DataFrame:
    """Rows of several sources under one watermark, which follows the newest row of any of them.
    A source that is idle holds nothing back. With a watermark for each source Spark takes
    the least by default, and a silent source would keep all windows open."""
    out = streams[0]
    for stream in streams[1:]:
        out = out.unionByName(stream)
    return with_lateness(out, column, lateness)


def tumble(df: DataFrame, size: str, keys: list[str], aggs: list[Column],
           time: str = "et", day_from: str = "start",
           day_format: str = S.PARTITION_DATE) -> DataFrame:
    """Aggregate per window and keys, and stamp the window's bounds and day.

    Without keys there is one row per non-empty window. Partial aggregation runs
    before the shuffle, so neither a hot key nor the missing key makes one task
    read all rows.
    """
    return stamped(grouped(df, size, keys, aggs, time), day_from, day_format)


def grouped(df: DataFrame, size: str, keys: list[str], aggs: list[Column], time: str = "et") -> DataFrame:
    """The same with a column window in place of its bounds and day as text, which are three
    times as wide: a batch that joins further columns shuffles this and stamps what comes out."""
    return df.groupBy(F.window(time, size), *keys).agg(*aggs)


def stamped(table: DataFrame, day_from: str = "start", day_format: str = S.PARTITION_DATE) -> DataFrame:
    """The bounds and the day of a column window, in front of the other columns."""
    assert day_from in ("start", "end")
    return table.select(
        F.date_format("window.start", S.DATETIME).alias("stt"),
        F.date_format("window.end", S.DATETIME).alias("edt"),
        F.date_format(f"window.{day_from}", day_format).alias("cur_date"),
        *[c for c in table.columns if c != "window"])


def tumble_distinct(df: DataFrame, size: str, keys: list[str], distinct: str, count: str,
                    summed: list[str], time: str = "et",
                    day_format: str = S.PARTITION_DATE) -> DataFrame:
    """Distinct values and sums per window and keys.

    The first step has one group per distinct value, so a hot key is spread over its
    values, and on a stream no set of values is kept in one state.
    """
    per = df.groupBy(F.window(time, size), *keys, distinct).agg(
        F.count(F.lit(1)).alias("_rows"), *sums(*summed))
    per = per.select(F.window_time("window").alias("_at"), *keys, distinct, *summed)
    return tumble(per, size, keys, [F.count(distinct).alias(count), *sums(*summed)],
                  time="_at", day_format=day_format)


def sums(*names: str) -> list[Column]:
    return [F.sum(n).alias(n) for n in names]
