"""Stored layers between pipelines: the change log by source table, windowed tables by day.

A pipeline that needs three tables of a mixed log, or one day of a windowed table, reads the
folders of those and nothing else. Both are written once, by one pass over their input; a day
that is written again replaces itself.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..session import cleaned, setting
from . import sinks


def folder(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir, which driver and executors share. Only a session
    that runs in one process can do without that setting."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir is not set")
        root = f"file://{tempfile.gettempdir()}"
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


# --- change log by source table -----------------------------------------------------------

#: Columns of the stored change log; table and type are folders.
CHANGES = T.StructType([*[f for f in schemas.CHANGE.fields if f.name not in ("table", "type")],
                        T.StructField("et", T.TimestampType()),
                        T.StructField("table", T.StringType()), T.StructField("type", T.StringType())])


#: Files that a task keeps open at once, and how stored layers are compressed.
FOLDERS, CODEC = 32, "zstd"
OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"


def _open_files(spark: SparkSession, most: int = FOLDERS):
    return setting(spark, OPEN_FILES, str(most))


def _by_source(log: DataFrame) -> DataFrame:
    return log.where(F.col("table").isNotNull() & F.col("type").isNotNull()).select(*CHANGES.names)


def split_changes(log: DataFrame, path: str) -> None:
    """A parsed change log into folders by source table and change type. No shuffle and no sort:
    a task keeps a file of each folder open and writes what it has, as long as there are not
    more than FOLDERS; beyond that Spark sorts the rest."""
    with _open_files(log.sparkSession), cleaned(log.sparkSession):
        (_by_source(log).write.mode("overwrite").option("compression", CODEC)
         .partitionBy("table", "type").parquet(path))


def split_stream(log: DataFrame, path: str, run: sinks.Run) -> StreamingQuery:
    """The same for a stream, exactly once."""
    return run.start(log.sparkSession, _by_source(log).writeStream.format("parquet").option("path", path)
                     .partitionBy("table", "type").outputMode("append"))


def changes(spark: SparkSession, path: str) -> DataFrame:
    """The stored change log. A filter on table and type chooses folders."""
    return spark.read.schema(CHANGES).parquet(path)


def changes_stream(spark: SparkSession, path: str, **options) -> DataFrame:
    return spark.readStream.schema(CHANGES).options(**options).parquet(path)


# --- windowed tables by day ---------------------------------------------------------------

#: Days of which a task keeps a file open at once.
OPEN_DAYS = 128


def put_days(table: DataFrame, path: str) -> None:
    """A windowed table into folders by day. The days it has replace those stored; other days
    stay as they are. The rows are not dealt by day before: a day has a file of every task."""
    with _open_files(table.sparkSession, OPEN_DAYS), cleaned(table.sparkSession):
        (table.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .option("compression", CODEC).partitionBy("cur_date").parquet(path))


def put_facts(facts: DataFrame, path: str) -> None:
    """A fact table, whole."""
    with cleaned(facts.sparkSession):
        facts.write.option("compression", CODEC).parquet(path)


def days(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A stored windowed table. The day is text, as the reports compare it."""
    return spark.read.schema(schema).parquet(path)
