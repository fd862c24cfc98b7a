"""Tables kept up to date by changes: configuration, dimensions, keyed facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import etl
from .state import last_rows


def active_config(config: DataFrame, keys: list[str], order: list[str] = ["seq"]) -> DataFrame:
    """Last change of each key; a key whose last change is a deletion is gone."""
    return last_rows(config, keys, order).where("op <> 'd'").drop("op", *order)


def config_state(snapshot: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """Configuration in effect: a preloaded snapshot, overruled by later changes."""
    preload = snapshot.select(F.lit("r").alias("op"), F.lit(-1).cast("long").alias("seq"),
                              *[c for c in snapshot.columns if c not in ("op", "seq")])
    return active_config(preload.unionByName(changes), keys)


def created_targets(config: DataFrame) -> DataFrame:
    """Target tables that exist because some configuration row asked for them."""
    return config.where("op <> 'd'").select("sink_table", "sink_family").distinct()


def _with_rules(log: DataFrame, config: DataFrame, on: dict[str, str],
                preload: DataFrame | None) -> DataFrame:
    """Log rows with their configuration row. `on`: the log's column for each key column."""
    if config.isStreaming:
        from ..streaming.live import configured
        return configured(log, config, on, preload)
    same = [log[column] == config[key] for key, column in on.items()]
    return log.join(config, same, "inner")


def route_dim(log: DataFrame, config: DataFrame, preload: DataFrame | None = None) -> DataFrame:
    """Changes of configured tables, payload cut to the configured columns, with the
    change type added as op_type and the row key of the target."""
    joined = _with_rules(log, config, {"source_table": "table"}, preload)
    payload = F.map_concat(
        F.map_filter("data", lambda k, _: k != "op_type"),
        F.create_map(F.lit("op_type"), F.col("type")))
    return joined.select(
        "sink_table", "sink_family",
        F.col("data")[F.col("sink_row_key")].alias("row_key"),
        F.col("type").alias("op_type"),
        etl.keep_listed(payload, F.col("sink_columns"), ("op_type",)).alias("data"),
        "ts", "seq")


def route_facts(log: DataFrame, config: DataFrame, preload: DataFrame | None = None) -> DataFrame:
    """Changes configured by table and type, payload cut to the configured columns."""
    joined = _with_rules(log, config, {"source_table": "table", "source_type": "type"}, preload)
    return joined.select(
        "sink_table", etl.keep_listed(F.col("data"), F.col("sink_columns")).alias("data"),
        "ts", "seq")


# Stands for the whole row in a list of columns.
ROW = ""


# A cell of a dimension table: the value of a column, and when it was written. The column ROW
# says when the row was deleted.
CELLS = T.StructType([
    T.StructField("sink_table", T.StringType()), T.StructField("row_key", T.StringType()),
    T.StructField("column", T.StringType()), T.StructField("ts", T.LongType()),
    T.StructField("seq", T.LongType()), T.StructField("value", T.StringType()),
])


def cells(routed: DataFrame) -> DataFrame:
    """What dimension changes write: a deletion its row, any other change its non-null
    columns."""
    written = F.map_filter("data", lambda k, v: (k != "op_type") & v.isNotNull())
    gone = F.create_map(F.lit(ROW), F.lit(None).cast("string"))
    return routed.select(
        "sink_table", "row_key",
        F.explode(F.when(F.col("op_type") == "delete", gone).otherwise(written)).alias("column", "value"),
        F.col("ts").cast("bigint").alias("ts"), F.col("seq").cast("bigint").alias("seq")).select(*CELLS.names)


def newest_cells(cells: DataFrame) -> DataFrame:
    """One cell for each row and column, the newest."""
    newest = (cells.groupBy("sink_table", "row_key", "column")
              .agg(F.max(F.struct("ts", "seq", "value")).alias("newest")))
    return newest.select("sink_table", "row_key", "column", "newest.*")


def rows_of_cells(newest: DataFrame) -> DataFrame:
    """sink_table, row_key and fields, a map, from the newest cells. What a row's newest deletion
    is not older than is gone."""
    at = F.struct("ts", "seq")
    rows = newest.groupBy("sink_table", "row_key").agg(
        F.collect_list(F.struct("column", "value", at.alias("at"))).alias("cells"),
        F.max(F.when(F.col("column") == ROW, at)).alias("gone"))
    alive = F.filter("cells", lambda c: (c["column"] != ROW) & (
        F.col("gone").isNull() | (c["at"] > F.col("gone"))))
    return (rows.withColumn("cells", alive).where(F.size("cells") > 0)
            .select("sink_table", "row_key", F.map_from_entries(F.transform(
                "cells", lambda c: F.struct(c["column"], c["value"]))).alias("fields")))


def dim_rows(routed: DataFrame) -> DataFrame:
    """Dimension rows after all changes: sink_table, row_key, fields, a map.

    A deletion removes the row, any other change writes its non-null columns. So per
    column only the newest value matters and per row only the newest deletion. Both
    are one pre-aggregated maximum per column, not a replay of the row's changes;
    what then meets per row is at most one entry per configured column.
    """
    return rows_of_cells(newest_cells(cells(routed)))


def dim_table(rows: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """One dimension table with its columns side by side."""
    return rows.where(F.col("sink_table") == table).select(
        "row_key", *[F.col("fields")[c].alias(c) for c in columns])


def upsert_latest(df: DataFrame, keys: list[str], order: list[str],
                  deleted: str | None = None) -> DataFrame:
    """Last row of each key, without the keys whose last row is a deletion."""
    last = last_rows(df, keys, order)
    return last if deleted is None else last.where(~F.coalesce(F.expr(deleted), F.lit(False)))
