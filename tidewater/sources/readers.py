"""Readers. Streams and batches of raw records have one text column, value."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas


def topic(spark: SparkSession, servers: str, name: str, group: str,
          starting: str = "latest", **options: str) -> DataFrame:
    """Records of a broker topic as text. Needs the kafka connector on the class path.
    A null record is dropped: it deletes a key in an upsert topic."""
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", servers).option("subscribe", name)
              .option("kafka.group.id", group).option("startingOffsets", starting))
    rows = reader.options(**options).load()
    return rows.select(F.col("value").cast("string").alias("value")).where("value is not null")


def text_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Records arriving as lines of files in a folder."""
    reader = spark.readStream.format("text").schema(schemas.RAW)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def text_batch(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.RAW).text(path)


def table_stream(spark: SparkSession, path: str, schema, files_per_batch: int | None = None
                 ) -> DataFrame:
    """A stored fact table read again as a stream of its new rows."""
    reader = spark.readStream.format("parquet").schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def table_batch(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def config_snapshot(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """Configuration rows preloaded from a database. Needs its JDBC driver; the column
    names stay as the table has them."""
    return (spark.read.format("jdbc").option("url", url).option("dbtable", table)
            .options(**options).load())


def state(spark: SparkSession, checkpoint: str, variable: str, operator: int = 0) -> DataFrame:
    """What a stopped query holds in a state variable of one of its keyed operators, which are
    numbered from the end of the plan."""
    return (spark.read.format("statestore").option("operatorId", operator)
            .option("stateVarName", variable).load(checkpoint))
