"""Decoders from raw text records to typed tables. All work on batch and stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions import scalars as S


def drop_null_records(raw: DataFrame, column: str = "value") -> DataFrame:
    """A null record is a deletion marker of an upsert topic, not data."""
    return raw.where(F.col(column).isNotNull())


def is_json_object(text: Column) -> Column:
    """True for text that is one JSON object. A struct schema would also accept
    bad text, as a struct of nulls, so the check goes through a map."""
    return F.from_json(text, "map<string,string>").isNotNull()


def valid_json(raw: DataFrame, column: str = "value") -> DataFrame:
    """Keep the records that are JSON objects."""
    return raw.where(is_json_object(F.col(column)))


def _records(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """Typed fields of the records that are JSON objects.

    A record is parsed once. What does not fit the schema as it should comes back
    whole in _bad, and only then is the object check made: an object with a field of
    the wrong type stays, with that field null. The parsed record leaves through a
    generator because filters on its fields would otherwise be pushed below the
    parse, and parse again.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
    full = T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])
    parsed = F.array(F.from_json("value", full, options))
    objects = F.filter(parsed, lambda r: r.isNotNull() & (
        r["_bad"].isNull() | is_json_object(r["_bad"])))
    return raw.select(F.inline(objects)).drop("_bad")


def behaviour_log(raw: DataFrame) -> DataFrame:
    """Behaviour records with event time et from epoch milliseconds."""
    return _records(raw, schemas.BEHAVIOUR).withColumn("et", S.event_time_millis(F.col("ts")))


def change_log(raw: DataFrame) -> DataFrame:
    """Database changes with event time et from epoch seconds and the processing
    time pt, which in Spark is one value per micro-batch."""
    return (_records(raw, schemas.CHANGE)
            .withColumn("et", S.event_time_seconds(F.col("ts")))
            .withColumn("pt", F.current_timestamp()))


def page_log(raw: DataFrame, lateness: str = "5 seconds") -> DataFrame:
    """Page records as (page map, ts, et) with a watermark on et."""
    schema = T.StructType([
        T.StructField("page", schemas.STRING_MAP),
        T.StructField("ts", T.LongType()),
        T.StructField("seq", T.LongType()),
    ])
    return (_records(raw, schema)
            .withColumn("et", S.event_time_millis(F.col("ts")))
            .withWatermark("et", lateness))


def config_changes(raw: DataFrame, config: T.StructType) -> DataFrame:
    """Configuration changes: op, arrival number and the row the change is about,
    which for a deletion is the row as it was."""
    rec = _records(raw, schemas.envelope(config))
    row = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))
    return rec.select("op", "seq", row.alias("row")).select("op", "seq", "row.*")


def fact_table(facts: DataFrame, lateness: str | None = None) -> DataFrame:
    """A stored fact table read again as a source: with event time and watermark
    if a lateness is given, plain otherwise."""
    if lateness is None:
        return facts
    return (facts.withColumn("et", S.event_time_seconds(F.col("ts")))
            .withWatermark("et", lateness))
