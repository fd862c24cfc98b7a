"""Row filters and projections on the raw logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Change types that count for dimensions and for facts.
DIM_CHANGE_TYPES = ("insert", "update", "delete", "bootstrap-insert")
FACT_CHANGE_TYPES = ("insert", "update")

# Status codes of the order, payment and refund tables.
ORDER_PLACED, ORDER_CANCELLED = "1001", "1003"
ORDER_REFUND_ASKED, ORDER_REFUND_DONE = "1005", "1006"
PAID, REFUND_PAID, REFUND_FINISHED = "1602", "1602", "0705"


def changes(log: DataFrame, database: str, types: tuple[str, ...]) -> DataFrame:
    """Changes of one database, of the given types, with a non-empty payload."""
    return log.where(
        (F.col("database") == database)
        & F.col("type").isin(*types)
        & (F.size("data") > 0)
    )


def table_changes(log: DataFrame, database: str, table: str, kind: str) -> DataFrame:
    return log.where(
        (F.col("database") == database)
        & (F.col("table") == table)
        & (F.col("type") == kind)
    )


def pick(log: DataFrame, *keys: str, **renamed: str) -> DataFrame:
    """Project payload keys to columns, keeping ts. An absent key gives null."""
    cols = [F.col("data")[k].alias(k) for k in keys]
    cols += [F.col("data")[k].alias(name) for name, k in renamed.items()]
    keep = [c for c in ("ts", "et") if c in log.columns]
    return log.select(*cols, *keep)


def moved(column: str, old: str, new: str) -> Column:
    """The column went from exactly old to exactly new."""
    return (F.col("old")[column] == old) & (F.col("data")[column] == new)


def became(column: str, new: str) -> Column:
    """The column was changed by this update and is now new."""
    return F.col("old")[column].isNotNull() & (F.col("data")[column] == new)


def keep_listed(payload: Column, listed: Column, extra: tuple[str, ...] = ()) -> Column:
    """Keep the payload keys named in a comma-separated list, and the extra ones."""
    names = F.split(listed, ",")
    if extra:
        names = F.concat(names, F.array(*[F.lit(e) for e in extra]))
    return F.map_filter(payload, lambda k, _: F.array_contains(names, k))


def explode_merged(log: DataFrame, column: str, parent_ts: bool) -> DataFrame:
    """One row per array element with the common fields merged in.

    A common field wins over an element field of the same name. With parent_ts the
    record's ts is set on the element too, otherwise the element keeps its own.
    """
    array = log.schema[column].dataType
    assert isinstance(array, T.ArrayType) and isinstance(array.elementType, T.StructType)
    common = log.schema["common"].dataType
    assert isinstance(common, T.StructType)
    taken = set(common.names) | ({"ts"} if parent_ts else set())
    own = [n for n in array.elementType.names if n not in taken]
    rows = log.select("common", "ts", F.explode(column).alias("element"))
    cols = [F.col(f"common.{n}").alias(n) for n in common.names]
    cols += [F.col(f"element.{n}").alias(n) for n in own]
    if parent_ts:
        cols.append(F.col("ts"))
    return rows.select(*cols)


def logins(pages: DataFrame) -> DataFrame:
    """Page records that open a logged-in visit."""
    last = F.col("page.last_page_id")
    return pages.where(F.col("common.uid").isNotNull() & (last.isNull() | (last == "login")))


def searches(pages: DataFrame) -> DataFrame:
    """Page records that carry a search keyword."""
    return pages.where(
        F.col("page")["last_page_id"].isin("search", "home")
        & (F.col("page")["item_type"] == "keyword")
        & F.col("page")["item"].isNotNull()
    )
