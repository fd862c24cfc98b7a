"""Writers of streams. File sinks are exactly-once; what goes through foreachBatch
writes under its batch number, so a batch that is run again replaces itself."""

from __future__ import annotations

import threading
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ..operators import changelog
from ..operators.state import last_rows
from ..plans import dwd
from .current import BUCKETS, FOLD, Current

TRIGGER = "5 seconds"


def checkpoint_root(spark: SparkSession, default: str | None = None) -> str:
    """Shared folder for checkpoints: what the cluster names, else the default."""
    root = spark.conf.get("spark.checkpoint.dir", None) or default
    if not root:
        raise ValueError("spark.checkpoint.dir is not set and no folder was given")
    return root.rstrip("/")


# Queries start one after the other, so that none takes the settings meant for another.
STARTING = threading.Lock()
NO_DATA_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"


@dataclass(frozen=True)
class Run:
    """How a streaming query runs: continuously, or through what is there now.

    ttl_state marks a query whose keyed state expires by processing time. Such a query
    asks for another batch as long as it lives, so a run through what is there has to
    do without batches that bring no data; its last windows close in the next run.
    """

    checkpoint: str
    available_now: bool = False
    ttl_state: bool = False
    trigger: str = TRIGGER

    def start(self, spark: SparkSession, writer: DataStreamWriter) -> StreamingQuery:
        writer = writer.option("checkpointLocation", self.checkpoint)
        if self.available_now:
            writer = writer.trigger(availableNow=True)
        else:
            writer = writer.trigger(processingTime=self.trigger)
        settings = {}
        if self.available_now and self.ttl_state:
            settings[NO_DATA_BATCHES] = "false"
        with STARTING:  # a query takes its session's settings when it starts
            before = {key: spark.conf.get(key) for key in settings}
            for key, value in settings.items():
                spark.conf.set(key, value)
            try:
                return writer.start()
            finally:
                for key, value in before.items():
                    spark.conf.set(key, value)


def as_json(df: DataFrame) -> DataFrame:
    """Rows as JSON text in one column, value."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))


def json_files(df: DataFrame, path: str, run: Run) -> StreamingQuery:
    """JSON lines into a folder."""
    return run.start(df.sparkSession, as_json(df).writeStream.format("text")
                     .option("path", path).outputMode("append"))


def topic(df: DataFrame, servers: str, name: str, run: Run, **options: str) -> StreamingQuery:
    """JSON records into a broker topic; at least once, the connector has no
    transactions. Needs the kafka connector on the class path."""
    writer = (as_json(df).writeStream.format("kafka")
              .option("kafka.bootstrap.servers", servers).option("topic", name).options(**options))
    return run.start(df.sparkSession, writer)


def routed_rows(routed: DataFrame) -> DataFrame:
    """Payloads as JSON text with their target; op_type is not part of a payload."""
    data = F.map_filter("data", lambda k, _: k != "op_type")
    return routed.select("sink_table", F.to_json(data).alias("value"))


def routed_files(routed: DataFrame, path: str, run: Run) -> StreamingQuery:
    """Payloads as JSON lines, one folder per target. A target's folder comes into
    being with its first row."""
    return run.start(routed.sparkSession, routed_rows(routed).writeStream.format("text")
                     .option("path", path).partitionBy("sink_table").outputMode("append"))


def routed_topics(routed: DataFrame, servers: str, run: Run, **options: str) -> StreamingQuery:
    """Payloads into the topic each row names."""
    rows = routed_rows(routed).withColumnRenamed("sink_table", "topic")
    writer = (rows.writeStream.format("kafka")
              .option("kafka.bootstrap.servers", servers).options(**options))
    return run.start(routed.sparkSession, writer)


def day_table(df: DataFrame, path: str, run: Run) -> StreamingQuery:
    """Windowed rows into a table partitioned by day. Column names are snake_case and
    helper columns have been left behind by the pipelines."""
    return run.start(df.sparkSession, df.writeStream.format("parquet").option("path", path)
                     .partitionBy("cur_date").outputMode("append"))


def fact_table(df: DataFrame, path: str, run: Run) -> StreamingQuery:
    return run.start(df.sparkSession, df.writeStream.format("parquet").option("path", path)
                     .outputMode("append"))


def _foreach(df: DataFrame, write: Callable[[DataFrame, int], None],
             run: Run) -> StreamingQuery:
    return run.start(df.sparkSession, df.writeStream.foreachBatch(write))


def _put(df: DataFrame, path: str, batch: int) -> None:
    df.write.mode("overwrite").parquet(f"{path}/batch={batch}")


def split_logs(log: DataFrame, path: str, run: Run) -> StreamingQuery:
    """The repaired behaviour log into one table per kind of record. A batch is kept
    while its five tables are written, so that it is read and repaired once."""
    def write(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        try:
            for name, part in dwd.TRAFFIC_LOGS.items():
                _put(part(batch), f"{path}/{name}", number)
        finally:
            batch.unpersist()
    return _foreach(log, write, run)


def live_table(df: DataFrame, path: str, build: Callable[[DataFrame], DataFrame],
               run: Run) -> StreamingQuery:
    """What build makes of each micro-batch. A dimension or configuration that build
    reads is read anew for every batch, so changes count from the next batch on."""
    return _foreach(df, lambda batch, number: _put(build(batch), path, number), run)


def _upserts(path: str, keys: list[str], order: list[str], **how) -> Current:
    """Keyed rows; of a key's rows the last in order stays, of equal ones that of the later batch."""
    return Current(path, tuple(keys), lambda rows: last_rows(rows, keys, [*order, "_batch"]), **how)


def upsert_table(df: DataFrame, path: str, keys: list[str], order: list[str],
                 run: Run, fold: int = FOLD, buckets: int = BUCKETS) -> StreamingQuery:
    """The last row of every key. A batch writes its own rows and one in `fold` buckets of
    the table; see sources.current."""
    def numbered(batch: DataFrame, number: int) -> DataFrame:
        return batch.withColumn("_batch", F.lit(number).cast("bigint"))
    table = _upserts(path, keys, order, fold=fold, buckets=buckets)
    table.create(df.sparkSession, T.StructType([*df.schema.fields, T.StructField("_batch", T.LongType())]),
                 run.checkpoint)
    return _foreach(df, lambda batch, number: table.put(numbered(batch, number), number), run)


def read_upserts(spark: SparkSession, path: str, keys: list[str], order: list[str],
                 deleted: str | None = None) -> DataFrame:
    """The last row of each key, without the keys whose last row is a deletion."""
    rows = _upserts(path, keys, order).read(spark).drop("_batch")
    return rows if deleted is None else rows.where(~F.coalesce(F.expr(deleted), F.lit(False)))


def tombstones(df: DataFrame, keys: list[str], deleted: str) -> DataFrame:
    """Keyed JSON records of an upsert topic; a deleted key has a null value."""
    value = F.to_json(F.struct(*df.columns))
    return df.select(F.to_json(F.struct(*keys)).alias("key"),
                     F.when(~F.coalesce(F.expr(deleted), F.lit(False)), value).alias("value"))


def _cells(path: str, **how) -> Current:
    return Current(path, ("sink_table", "row_key"), changelog.newest_cells, **how)


def dim_tables(routed: DataFrame, path: str, run: Run, fold: int = 1,
               buckets: int = BUCKETS) -> StreamingQuery:
    """Dimension tables as of now, cell by cell: the newest value of each row and column, and the
    newest deletion of each row. A column that a change leaves null keeps its value. Dimensions
    change seldom, so every batch rewrites the buckets it touches unless told otherwise."""
    table = _cells(path, fold=fold, buckets=buckets)
    table.create(routed.sparkSession, changelog.CELLS, run.checkpoint)
    return _foreach(routed, lambda batch, number: table.put(changelog.cells(batch), number), run)


def read_dims(spark: SparkSession, path: str) -> DataFrame:
    """Dimension rows after all changes so far; a fresh read sees the newest ones."""
    return changelog.rows_of_cells(_cells(path).read(spark))
