"""Joins.

No side has a hint: Spark broadcasts a side when its size check, before or at run time,
allows it, and shuffles otherwise; a hot key in a shuffled join is split at run time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookup(df: DataFrame, dictionary: DataFrame, code: str, name: str) -> DataFrame:
    """Add the dictionary name of a code. A code not in the dictionary drops the row."""
    dic = dictionary.select(F.col("dic_code").alias("_code"),
                            F.col("info.dic_name").alias(name))
    return df.join(dic, F.col(code) == F.col("_code"), "inner").drop("_code")


def enrich(df: DataFrame, dim: DataFrame, key: str, add: dict[str, str],
           dim_key: str = "id") -> DataFrame:
    """Add dimension columns by key. A missing row leaves them null. A streaming dimension is
    its changes: rows get what they have come to so far."""
    if dim.isStreaming:
        from ..streaming.live import lookup
        return lookup(df, dim, key, add, shares=1)
    side = dim.select(F.col(dim_key).alias("_k"),
                      *[F.col(src).alias(out) for out, src in add.items()])
    return df.join(side, F.col(key) == F.col("_k"), "left").drop("_k")


def flatten_sku(dims: dict[str, DataFrame]) -> DataFrame:
    """The product snowflake as one row per sku. The hops join dimensions only, so
    facts are joined, and shuffled, once and not per hop."""
    sku = dims["sku"].select(
        F.col("id").alias("sku_id"), "sku_name", "spu_id",
        F.col("tm_id").alias("trademark_id"), "category3_id")
    flat = enrich(sku, dims["spu"], "spu_id", {"spu_name": "spu_name"})
    flat = enrich(flat, dims["trademark"], "trademark_id", {"trademark_name": "tm_name"})
    return flatten_category(flat, dims)


SKU_NAMES = {"sku_name": "sku_name", "spu_id": "spu_id", "trademark_id": "tm_id",
             "category3_id": "category3_id"}


def enrich_sku(df: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Add a sku's product, brand and categories."""
    if not dims["sku"].isStreaming:
        flat = flatten_sku(dims)
        names = [c for c in flat.columns if c != "sku_id"]
        return enrich(df, flat, "sku_id", {n: n for n in names}, dim_key="sku_id")
    df = enrich(df, dims["sku"], "sku_id", SKU_NAMES)
    df = enrich(df, dims["spu"], "spu_id", {"spu_name": "spu_name"})
    df = enrich(df, dims["trademark"], "trademark_id", {"trademark_name": "tm_name"})
    return flatten_category(df, dims)


def flatten_category(df: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Add names and parents above category3_id, each hop's key from the one before."""
    df = enrich(df, dims["category3"], "category3_id",
                {"category3_name": "name", "category2_id": "category2_id"})
    df = enrich(df, dims["category2"], "category2_id",
                {"category2_name": "name", "category1_id": "category1_id"})
    return enrich(df, dims["category1"], "category1_id", {"category1_name": "name"})


def interval(left: DataFrame, right: DataFrame, on: Column, time_left: str, time_right: str,
             before: str, after: str, how: str = "inner") -> DataFrame:
    """Join where the right row's time lies in [left - before, left + after]. On
    streams the bounds also tell how long state has to be kept."""
    bound = ((F.col(time_right) >= F.col(time_left) - F.expr(f"interval {before}"))
             & (F.col(time_right) <= F.col(time_left) + F.expr(f"interval {after}")))
    return left.join(right, on & bound, how)


def lateral_words(df: DataFrame, text: str, words: Column, name: str = "keyword") -> DataFrame:
    """One row per word of a text; a text without words gives no row."""
    return df.select("*", F.explode(words).alias(name)).drop(text)
