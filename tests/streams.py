"""Running a pipeline as a stream over files and reading its result."""

import time
from collections import Counter

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewater.sources import sinks


#: Files of a micro-batch, over which its rows are dealt without regard to their order.
FILES = 8


class Feed:
    """A folder that a stream reads; what is put there at a time is a micro-batch."""

    def __init__(self, spark, folder, files=FILES):
        self.spark, self.folder, self.n, self.files = spark, str(folder), 0, files

    def put(self, df, order=(), batches=1):
        """One micro-batch, or several that follow each other in the order given."""
        self.schema = df.schema
        if batches > 1:
            rank = F.ntile(batches).over(Window.orderBy(*order))
            cut = df.withColumn("_part", rank).persist()
            for i in range(1, batches + 1):
                self.put(cut.where(f"_part = {i}").drop("_part"))
            return self
        # Kept, or every file would deal the rows anew.
        rows = df.withColumn("_file", F.row_number().over(Window.orderBy(F.rand(7))) % self.files).persist()
        rows.count()
        for i in range(self.files):  # as many files each time, some of them empty
            (rows.where(f"_file = {i}").drop("_file").coalesce(1)
             .write.parquet(f"{self.folder}/f{self.n:03d}{i}"))
        self.n += 1
        time.sleep(1.05)  # files are taken by their modification time, in seconds
        return self

    def stream(self):
        return (self.spark.readStream.schema(self.schema).option("maxFilesPerTrigger", self.files)
                .parquet(f"{self.folder}/f*"))


def run(df, folder, **how):
    """Run a streaming frame through what is there and return what it has written."""
    query = sinks.fact_table(df, f"{folder}/out", sinks.Run(f"{folder}/cp", True, **how))
    query.awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/out")


def counted(df, columns=None):
    rows = df.select(*(columns or df.columns)).collect()
    return Counter(tuple(r) for r in rows)


def same(stream, batch, where=None, columns=None):
    """Both results are the same, as multisets of rows."""
    if where is not None:
        stream, batch = stream.where(where), batch.where(where)
    columns = columns or batch.columns
    batch = batch.select(*[F.col(c).cast(stream.schema[c].dataType).alias(c) for c in columns])
    a, b = counted(stream, columns), counted(batch, columns)
    assert b and a == b, (list((a - b).items())[:3], list((b - a).items())[:3])
