"""Headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; one JSON line on stdout.

The tables are dealt over as many files as there are cores first: they come as one file of
one row group, which only one task can read, as no warehouse table does. Batch queries write
their whole result to a no-op sink; the best of three runs counts.
The stream is one availableNow run over the page log in 8 files, in rows per second.
"""

import json
import os
import tempfile
import time

from tidewater import bindings as B
from tidewater import registry, session
from tidewater.plans import dws
from tidewater.sources import sinks

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
TABLES = "region nation customer supplier part orders lineitem events benchmark".split()
FLAGSHIP = "ads_channel_uv"
QUERIES = [FLAGSHIP, "dws_sku_order", "join_interval", "ads_category", "dws_traffic",
           "dwd_page", "dwd_trade_order_detail", "dim_latest", "dws_province_order",
           "st_is_new_repair", "st_delta_correct", "upsert_latest"]


def dealt(spark):
    """A copy of the tables that the queries read, in several files each."""
    folder = tempfile.mkdtemp(prefix="bench-tables-")
    for table in TABLES:
        (spark.read.parquet(f"{SF_DIR}/{table}.parquet").repartition(int(CPUS))
         .write.parquet(f"{folder}/{table}.parquet"))
    return folder


def timed(spark, name, sf_dir):
    best = None
    for _ in range(3):
        start = time.perf_counter()
        df = registry.QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        took = time.perf_counter() - start
        best = took if best is None else min(best, took)
    return best


def streamed(spark, sf_dir):
    """Rows per second of the traffic stream, keyed state included."""
    folder = tempfile.mkdtemp(prefix="bench-")
    pages = B.page_log(spark, sf_dir)
    pages.repartitionByRange(8, "ts").sortWithinPartitions("ts").write.parquet(f"{folder}/in")
    rows = spark.read.parquet(f"{folder}/in").count()
    stream = spark.readStream.schema(pages.schema).parquet(f"{folder}/in")
    start = time.perf_counter()
    query = sinks.day_table(dws.traffic(stream, "1 day"), f"{folder}/out",
                            sinks.Run(f"{folder}/cp", available_now=True))
    query.awaitTermination()
    return rows / (time.perf_counter() - start)


def main():
    spark = session.build(f"local[{CPUS}]", "tidewater-bench", spark__driver__memory="16g",
                          spark__sql__shuffle__partitions=CPUS, spark__ui__enabled="false",
                          spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    folder = dealt(spark)
    seconds = {name: round(timed(spark, name, folder), 3) for name in QUERIES}
    rate = streamed(spark, folder)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "stream_rows_per_sec": {"dws_traffic": round(rate, 1)},
        "sf": os.path.basename(SF_DIR.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
