"""Record schemas of the raw inputs."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


COMMON = _strings("mid", "uid", "sid", "vc", "ch", "ar", "is_new")

PAGE = T.StructType(
    _strings("page_id", "last_page_id", "item", "item_type").fields
    + [T.StructField("during_time", T.LongType())]
)

START = T.StructType([
    T.StructField("entry", T.StringType()),
    T.StructField("loading_time", T.LongType()),
])

ERR = T.StructType([
    T.StructField("error_code", T.LongType()),
    T.StructField("msg", T.StringType()),
])

DISPLAY = T.StructType([
    T.StructField("ch", T.StringType()),
    T.StructField("item", T.StringType()),
    T.StructField("pos", T.LongType()),
])

ACTION = T.StructType([
    T.StructField("action_id", T.StringType()),
    T.StructField("ch", T.StringType()),
    T.StructField("item", T.StringType()),
    T.StructField("ts", T.LongType()),
])

# One behaviour record. ts is epoch milliseconds; seq is the arrival number.
BEHAVIOUR = T.StructType([
    T.StructField("common", COMMON),
    T.StructField("start", START),
    T.StructField("page", PAGE),
    T.StructField("displays", T.ArrayType(DISPLAY)),
    T.StructField("actions", T.ArrayType(ACTION)),
    T.StructField("err", ERR),
    T.StructField("ts", T.LongType()),
    T.StructField("seq", T.LongType()),
])

STRING_MAP = T.MapType(T.StringType(), T.StringType())

# One database change. ts is epoch seconds; seq is the arrival number.
CHANGE = T.StructType([
    T.StructField("database", T.StringType()),
    T.StructField("table", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("data", STRING_MAP),
    T.StructField("old", STRING_MAP),
    T.StructField("ts", T.LongType()),
    T.StructField("seq", T.LongType()),
])

# Configuration rows: where a source table goes and which columns are kept.
DIM_CONFIG = _strings("source_table", "sink_table", "sink_columns", "sink_family",
                      "sink_row_key")
FACT_CONFIG = _strings("source_table", "source_type", "sink_table", "sink_columns")


def envelope(config: T.StructType) -> T.StructType:
    """Change envelope of a configuration table."""
    return T.StructType([
        T.StructField("op", T.StringType()),
        T.StructField("before", config),
        T.StructField("after", config),
        T.StructField("seq", T.LongType()),
    ])


# The streaming file sources need a declared schema for text records.
RAW = T.StructType([T.StructField("value", T.StringType())])
