"""Tables that streams keep up to date: the newest state of every key, in hash buckets.

A micro-batch writes what it changes (reduced, so a few rows for each key). Each batch one in
`fold` buckets is due, and is rewritten if it has changes since its last turn. So a read opens
one version of each bucket and the changes of fewer than `fold` batches; with fold=1, for tables
that change seldom, it opens the versions alone.

Nothing is deleted by hand and nothing grows with the number of batches. A bucket has
KEEP places for its versions, taken in turn; changes have 2 * fold places, manifests MANIFESTS.
What a write replaces is a version that no recent manifest refers to. A batch counts once its
manifest, one small file, is there; until then readers see the state before. A batch that is
run again after that is skipped, one that was interrupted writes the same places anew. A state
that a reader has opened stays readable until its buckets have been rewritten KEEP - 1 times.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS, FOLD, KEEP, MANIFESTS = 64, 20, 3, 8

# places: where the version of each bucket lies, -1 for none.
MANIFEST = "number bigint, owner string, buckets int, fold int, columns string, places array<int>"


@dataclass(frozen=True)
class Current:
    """Where a table is, what its rows are keyed by, and how rows of the same keys
    become fewer. reduce gives the same for rows that it has reduced in parts before."""

    path: str
    keys: tuple[str, ...]
    reduce: Callable[[DataFrame], DataFrame]
    buckets: int = BUCKETS
    fold: int = FOLD

    # --- manifest -------------------------------------------------------------------

    def _newest(self, spark: SparkSession) -> Row:
        """The newest manifest; number -1 before the first batch."""
        return (spark.read.schema(MANIFEST).parquet(f"{self.path}/manifest")
                .orderBy(F.desc("number")).first())

    def _commit(self, spark: SparkSession, state: tuple, place: object, mode: str) -> None:
        (spark.createDataFrame([state], MANIFEST).coalesce(1).write.mode(mode)
         .parquet(f"{self.path}/manifest/place={place}"))

    def create(self, spark: SparkSession, columns: T.StructType, owner: str) -> Current:
        """Make the table if there is none. It belongs to one checkpoint, since it goes by
        that one's batch numbers."""
        state = (-1, owner, self.buckets, self.fold, columns.json(), [-1] * self.buckets)
        self._commit(spark, state, "none", "ignore")
        empty = spark.createDataFrame([], T.StructType([*columns.fields, T.StructField("bucket", T.IntegerType())]))
        for part in ("base", "changes"):
            empty.write.mode("ignore").partitionBy("bucket").parquet(f"{self.path}/{part}/place=0")
        newest = self._newest(spark)
        if tuple(newest)[1:4] != state[1:4]:
            raise ValueError(f"{self.path} is kept by {newest.owner} in {newest.buckets} buckets, "
                             f"folded every {newest.fold} batches")
        return self

    # --- files ----------------------------------------------------------------------

    def _read(self, spark: SparkSession, part: str, columns: T.StructType) -> DataFrame:
        spec = T.StructType([*columns.fields, T.StructField("place", T.IntegerType()),
                             T.StructField("bucket", T.IntegerType())])
        return spark.read.schema(spec).parquet(f"{self.path}/{part}")

    def _versions(self, spark: SparkSession, columns: T.StructType, places: list[int]) -> DataFrame:
        """The bucket versions; which are chosen by folder."""
        chosen: Column = F.lit(False)
        for place in range(KEEP):
            mine = [b for b, p in enumerate(places) if p == place]
            if mine:
                chosen = chosen | ((F.col("place") == place) & F.col("bucket").isin(mine))
        return self._read(spark, "base", columns).where(chosen).drop("place")

    def _changes(self, spark: SparkSession, columns: T.StructType, number: int) -> DataFrame:
        """The changes of the last `fold` batches, with their batch."""
        last = range(max(0, number - self.fold + 1), number + 1)
        spec = T.StructType([*columns.fields, T.StructField("batch", T.LongType())])
        rows = self._read(spark, "changes", spec)
        return rows.where(F.col("place").isin([n % (2 * self.fold) for n in last])
                          & F.col("batch").between(last[0], number)).drop("place")

    # --- use ------------------------------------------------------------------------

    def put(self, batch: DataFrame, number: int) -> None:
        """Take in a micro-batch."""
        spark = batch.sparkSession
        newest = self._newest(spark)
        if newest.number >= number:
            return
        delta = self.reduce(batch)
        columns = delta.schema
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        (delta.withColumn("batch", F.lit(number).cast("bigint")).withColumn("bucket", bucket)
         .repartition("bucket").write.mode("overwrite").partitionBy("bucket")
         .parquet(f"{self.path}/changes/place={number % (2 * self.fold)}"))
        due = [b for b in range(self.buckets) if (number - b) % self.fold == 0]
        recent = self._changes(spark, columns, number).where(F.col("bucket").isin(due)).drop("batch")
        places = list(newest.places)
        turn = [r.bucket for r in recent.select("bucket").distinct().collect()] if due else []
        if turn:
            before = self._versions(spark, columns, places).where(F.col("bucket").isin(turn))
            for b in turn:
                places[b] = (places[b] + 1) % KEEP
            place = F.element_at(F.array(*[F.lit(p) for p in places]), F.col("bucket") + 1)
            (self.reduce(recent.unionByName(before).drop("bucket")).withColumn("bucket", bucket)
             .withColumn("place", place).repartition("bucket")
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("place", "bucket").parquet(f"{self.path}/base"))
        state = (number, newest.owner, self.buckets, self.fold, columns.json(), places)
        self._commit(spark, state, number % MANIFESTS, "overwrite")

    def read(self, spark: SparkSession) -> DataFrame:
        """The reduced rows as of the newest batch."""
        newest = self._newest(spark)
        table = replace(self, buckets=newest.buckets, fold=newest.fold)
        columns = T.StructType.fromJson(json.loads(newest.columns))
        rows = table._versions(spark, columns, newest.places)
        if table.fold > 1:
            through = newest.number - F.pmod(newest.number - F.col("bucket"), F.lit(table.fold))
            later = table._changes(spark, columns, newest.number).where(F.col("batch") > through)
            rows = table.reduce(rows.unionByName(later.drop("batch")).drop("bucket"))
        return rows.drop("bucket")
