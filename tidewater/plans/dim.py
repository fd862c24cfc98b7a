"""Dimension tables from the change log, as the configuration table says."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import changelog, etl


def routed(log: DataFrame, config: DataFrame, database: str,
           preload: DataFrame | None = None) -> DataFrame:
    """Dimension changes with their target, row key and kept columns. A streaming
    configuration is its changes, which overrule what was preloaded."""
    return changelog.route_dim(etl.changes(log, database, etl.DIM_CHANGE_TYPES), config, preload)


def changes(routed: DataFrame, table: str) -> DataFrame:
    """The changes of one dimension, as live lookups take them."""
    return routed.where(F.col("sink_table") == table)


def latest(log: DataFrame, config: DataFrame, database: str) -> DataFrame:
    """All dimension rows after all changes."""
    return changelog.dim_rows(routed(log, config, database))
