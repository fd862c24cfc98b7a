"""Facts, sinks and the life of a stream: restart, late rows, expiry."""

import json
import os
import time
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from streams import Feed, counted, run, same
from tidewater import bindings as B
from tidewater import registry, schemas
from tidewater.operators import changelog, joins, windows
from tidewater.plans import ads, dim, dwd, dws
from tidewater.sources import decode, layers, readers, sinks
from tidewater.streaming import state as streaming_state
from tidewater.streaming.monitor import LateRows

SF = "/root/testdata/sf0.001"
T0 = 1_704_074_400
END = 4_102_444_800
DB = "shop"


def change(ts, table, kind, data, old=None):
    return {"database": DB, "table": table, "type": kind, "data": data, "old": old, "ts": ts}


def detail(i, order, ts, **more):
    return change(ts, "order_detail", "insert", {
        "id": i, "order_id": order, "sku_id": f"s{i}", "sku_name": "n",
        "create_time": "2024-01-01 02:00:00", "sku_num": "2", "order_price": "1.50",
        "split_total_amount": "3.00", **more})


def order(i, ts, status=None, old=None):
    if status is None:
        return change(ts, "order_info", "insert", {"id": i, "user_id": "u", "province_id": "1"})
    return change(ts, "order_info", "update", {
        "id": i, "user_id": "u", "province_id": "1", "order_status": status,
        "operate_time": "2024-01-01 02:20:00"}, {"order_status": old})


def payment(i, ts, status="1602"):
    return change(ts, "payment_info", "update", {
        "order_id": i, "payment_type": "1", "payment_status": status,
        "callback_time": "2024-01-01 02:01:00"}, {"payment_status": "1601"})


def refund_row(i, ts, kind="insert", status="0701", old=None):
    return change(ts, "order_refund_info", kind, {
        "id": f"r{i}", "user_id": "u", "order_id": i, "sku_id": "s11", "refund_type": "1",
        "refund_num": "1", "refund_amount": "1.50", "refund_reason_type": "2",
        "refund_reason_txt": "x", "create_time": "2024-01-01 03:00:00",
        "refund_status": status}, old)


LOG = [
    order("1", T0), order("2", T0), order("3", T0 + 1),
    detail("11", "1", T0), detail("12", "1", T0 + 1), detail("21", "2", T0 + 2),
    detail("31", "3", T0 + 2), detail("99", "no such order", T0),
    change(T0 + 1, "order_detail_activity", "insert",
           {"order_detail_id": "11", "activity_id": "a", "activity_rule_id": "b"}),
    change(T0 + 1, "order_detail_coupon", "insert", {"order_detail_id": "12", "coupon_id": "c"}),
    payment("1", T0 + 60), payment("1", T0 + 61, "1603"), payment("2", T0 + 2400),
    order("3", T0 + 1200, "1003", "1001"), order("2", T0 + 1200, "1003", "1002"),
    refund_row("1", T0 + 3600), order("1", T0 + 3601, "1005", "1002"),
    change(T0 + 7200, "refund_payment", "update", {
        "id": "p1", "order_id": "1", "sku_id": "s11", "payment_type": "1",
        "callback_time": "2024-01-01 04:00:00", "total_amount": "1.50", "refund_status": "1602"},
        {"refund_status": "0701"}),
    refund_row("1", T0 + 7200, "update", "0705", {"refund_status": "0702"}),
    order("1", T0 + 7201, "1006", "1005"),
]
CLOSING = [
    order("e", END), detail("e", "e2", END),
    change(END, "order_detail_activity", "insert", {"order_detail_id": "e3"}),
    change(END, "order_detail_coupon", "insert", {"order_detail_id": "e4"}),
]


def lines(spark, rows):
    return spark.createDataFrame([(json.dumps(r),) for r in rows], schemas.RAW)


@pytest.fixture(scope="module")
def log(spark):
    return decode.change_log(lines(spark, LOG))


@pytest.fixture(scope="module")
def dictionary(spark):
    return B.dictionary(spark, SF)


def log_stream(spark, folder, *batches):
    feed = Feed(spark, folder)
    for rows in batches:
        feed.put(lines(spark, rows))
    return decode.change_log(feed.stream())


def test_order_detail(spark, tmp_path, log):
    batch = dwd.order_detail(log, DB)
    assert batch.count() == 4
    stream = dwd.order_detail(log_stream(spark, tmp_path / "in", LOG, CLOSING), DB)
    same(run(stream, tmp_path), batch)


def test_cancel_and_payment(spark, tmp_path, log, dictionary):
    details = dwd.order_detail(log, DB)
    stored = Feed(spark, tmp_path / "details").put(details)
    changes = log_stream(spark, tmp_path / "in", LOG)
    cancelled = dwd.order_cancel(log, details, DB)
    assert [r.id for r in cancelled.collect()] == ["31"]
    same(run(dwd.order_cancel(changes, stored.stream(), DB), tmp_path / "c"), cancelled)
    paid = dwd.order_payment(log, details, dictionary, DB)
    # Order 2 was paid 40 minutes after it was placed.
    assert sorted(r.order_detail_id for r in paid.collect()) == ["11", "12"]
    same(run(dwd.order_payment(changes, stored.stream(), dictionary, DB), tmp_path / "p"), paid)


def test_refunds(spark, tmp_path, log, dictionary):
    changes = log_stream(spark, tmp_path / "in", LOG)
    asked, paid = dwd.order_refund(log, dictionary, DB), dwd.refund_payment(log, dictionary, DB)
    assert asked.count() == paid.count() == 1
    same(run(dwd.order_refund(changes, dictionary, DB), tmp_path / "a"), asked)
    same(run(dwd.refund_payment(changes, dictionary, DB), tmp_path / "p"), paid)


def test_split_logs(spark, tmp_path):
    raw = B.raw_behaviour(spark, SF)
    log = decode.behaviour_log(raw)
    ordered = log.select(F.to_json(F.struct(*schemas.BEHAVIOUR.names)).alias("value"), "ts", "seq")
    bad = spark.createDataFrame([(v,) for v in ("{bad", "[1]", "123", "", None)], schemas.RAW)
    folder = tmp_path / "in"
    feed = Feed(spark, folder)
    feed.put(ordered.orderBy("ts", "seq").coalesce(1).select("value"))
    feed.put(bad)
    stream = dwd.base_log(decode.behaviour_log(feed.stream()))
    sinks.split_logs(stream, f"{tmp_path}/out", sinks.Run(f"{tmp_path}/cp", True)).awaitTermination()
    batch = dwd.base_log(log)
    for name, part in dwd.TRAFFIC_LOGS.items():
        out = spark.read.parquet(f"{tmp_path}/out/{name}").drop("batch")
        def text(df):
            return df.select(F.to_json(F.struct(*part(batch).columns)).alias("value"))
        same(text(out), text(part(batch)))


def _generic_feed(spark, folder):
    raw = B.generic_changes(spark, SF)
    text = raw.select(F.to_json(F.struct(*schemas.CHANGE.names)).alias("value"), "ts", "seq")
    half = raw.agg(F.avg("seq")).first()[0]
    feed = Feed(spark, folder)
    for part in (text.where(F.col("seq") < half), text.where(F.col("seq") >= half)):
        feed.put(part.orderBy("ts", "seq").coalesce(1).select("value"))
    return decode.change_log(feed.stream()), decode.change_log(text.select("value"))


def test_routed_sink(spark, tmp_path):
    stream, batch = _generic_feed(spark, tmp_path / "in")
    config = registry._fact_config(spark, SF)
    routed = dwd.routed_facts(stream, config, B.DATABASE)
    sinks.routed_files(routed, f"{tmp_path}/out",
                       sinks.Run(f"{tmp_path}/cp", True)).awaitTermination()
    out = spark.read.text(f"{tmp_path}/out").select("sink_table", "value")
    want = sinks.routed_rows(dwd.routed_facts(batch, config, B.DATABASE))
    same(out, want, columns=["sink_table", "value"])
    assert "op_type" not in out.first().value


def test_dimension_sink_and_restart(spark, tmp_path):
    """Dimensions over two runs of one query, the second going on where the first was."""
    config = changelog.active_config(registry._dim_config(spark, SF), ["source_table"])
    raw = B.generic_changes(spark, SF)
    text = raw.select(F.to_json(F.struct(*schemas.CHANGE.names)).alias("value"), "ts", "seq")
    half = raw.agg(F.avg("seq")).first()[0]
    feed = Feed(spark, tmp_path / "in")
    for n, part in enumerate((text.where(F.col("seq") < half), text.where(F.col("seq") >= half))):
        feed.put(part.orderBy("ts", "seq").coalesce(1).select("value"))
        stream = dim.routed(decode.change_log(feed.stream()), config, B.DATABASE)
        sinks.dim_tables(stream, f"{tmp_path}/out",
                         sinks.Run(f"{tmp_path}/cp", True)).awaitTermination()
        seen = text.where(F.col("seq") < half) if n == 0 else text
        batch = dim.latest(decode.change_log(seen.select("value")), config, B.DATABASE)
        flat = ["sink_table", "row_key", "id", "name", "score"]
        def table(rows):
            return rows.select("sink_table", "row_key",
                               *[F.col("fields")[c].alias(c) for c in flat[2:]])
        same(table(sinks.read_dims(spark, f"{tmp_path}/out")), table(batch))


def test_upsert_sink(spark, tmp_path):
    stream, batch = _generic_feed(spark, tmp_path / "in")
    def rows(log):
        return log.where("data is not null").select(
            "table", F.col("data")["id"].alias("id"), F.col("data")["score"].alias("score"),
            "type", "ts", "seq")
    keys, order, gone = ["table", "id"], ["ts", "seq"], "type = 'delete'"
    sinks.upsert_table(rows(stream), f"{tmp_path}/out", keys, order,
                       sinks.Run(f"{tmp_path}/cp", True)).awaitTermination()
    out = sinks.read_upserts(spark, f"{tmp_path}/out", keys, order, gone)
    same(out, changelog.upsert_latest(rows(batch), keys, order, gone))
    marks = sinks.tombstones(rows(batch), keys, gone)
    assert marks.where("value is null").count() == rows(batch).where(gone).count()


def test_json_sink(spark, tmp_path):
    facts = dwd.cart_add(B.order_changes(spark, SF, "cart_info"), B.DATABASE)
    stream = Feed(spark, tmp_path / "in").put(facts).stream()
    sinks.json_files(stream, f"{tmp_path}/out", sinks.Run(f"{tmp_path}/cp", True)).awaitTermination()
    back = readers.text_batch(spark, f"{tmp_path}/out")
    same(back.select(F.from_json("value", facts.schema).alias("r")).select("r.*"), facts)


def test_day_table_is_read_by_day(spark, tmp_path):
    pages = B.page_log(spark, SF)
    stream = Feed(spark, tmp_path / "in").put(pages, ["ts", "seq"]).stream()
    sinks.day_table(dws.home_detail(stream, "1 day"), f"{tmp_path}/out",
                    sinks.Run(f"{tmp_path}/cp", True)).awaitTermination()
    table = spark.read.schema("stt string, edt string, home_uv_ct bigint, "
                              "good_detail_uv_ct bigint, cur_date string").parquet(f"{tmp_path}/out")
    day = ads.of_day(table, 20240102)
    assert day.count() == 1
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(cur_date" in plan


def _ticks(spark, rows):
    return spark.createDataFrame(rows, "k string, ms bigint").select(
        "k", F.timestamp_millis(F.col("ms") + T0 * 1000).alias("et"))


def test_late_row_is_dropped(spark, tmp_path):
    feed = Feed(spark, tmp_path / "in")
    # A row counts as late against the watermark of the batch before its own.
    for rows in ([("a", 1000), ("a", 2000)], [("a", 60_000)], [("a", 61_000)],
                 [("late", 3000), ("a", 62_000)], [("a", 200_000)]):
        feed.put(_ticks(spark, rows))
    rows = windows.with_lateness(feed.stream())
    out = run(windows.tumble(rows, "5 seconds", [], [F.count("*").alias("n")]), tmp_path)
    assert counted(out, ["stt", "n"]) == {
        ("2024-01-01 02:00:00", 2): 1, ("2024-01-01 02:01:00", 3): 1}


def test_late_rows_do_not_stop_keyed_state(spark, tmp_path):
    """Late rows, at once and after the watermark has moved on, are left out."""
    feed = Feed(spark, tmp_path / "in")
    for rows in ([("a", 1000)], [("a", 60_000)], [("late", 2000), ("b", 61_000)],
                 [("late", 3000), ("a", 62_000)], [("z", 400_000)]):
        feed.put(_ticks(spark, rows))
    stream = windows.with_lateness(feed.stream())
    flagged = streaming_state.first_of_day(stream, ["k"])
    out = run(windows.tumble(flagged, "5 seconds", ["k"], [F.count("*").alias("n")]),
              tmp_path / "day")
    assert counted(out, ["stt", "k", "n"]) == {
        ("2024-01-01 02:00:00", "a", 1): 1, ("2024-01-01 02:01:00", "b", 1): 1}
    first = streaming_state.first_of_session(stream, "k", "1 hour")
    out = run(windows.tumble(first, "5 seconds", ["k"], [F.count("*").alias("n")]),
              tmp_path / "session")
    assert counted(out, ["stt", "k", "n"]) == {
        ("2024-01-01 02:00:00", "a", 1): 1, ("2024-01-01 02:01:00", "b", 1): 1}


def test_session_expires_by_event_time(spark, tmp_path):
    feed = Feed(spark, tmp_path / "in")
    for rows in ([("a", 0), ("a", 1000)], [("a", 9000)], [("a", 10_500)], [("a", 12_000)]):
        feed.put(_ticks(spark, rows))
    stream = windows.with_lateness(feed.stream())
    out = run(streaming_state.first_of_session(stream, "k", "10 seconds"), tmp_path)
    assert sorted(r.et.second for r in out.collect()) == [0, 10]


def test_session_expires_by_processing_time(spark, tmp_path):
    feed = Feed(spark, tmp_path / "in")
    for ttl, folder, want in (("2 seconds", "short", 2), ("1 hour", "long", 1)):
        feed.put(_ticks(spark, [("a", 0), ("a", 1)]))
        for _ in range(2):
            stream = windows.with_lateness(Feed.stream(feed))
            first = streaming_state.first_of_session(stream, "k", ttl, clock="processing")
            out = run(first, tmp_path / folder, ttl_state=True)
            time.sleep(3)
            feed.put(_ticks(spark, [("a", 2)]))
        assert out.count() == want


def test_checkpoint_root(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert sinks.checkpoint_root(spark, "/other") == named.rstrip("/")
    else:
        with pytest.raises(ValueError):
            sinks.checkpoint_root(spark)
        assert sinks.checkpoint_root(spark, "/tmp/x/") == "/tmp/x"


def _files(folder):
    return sum(f.endswith(".parquet") for _, _, names in os.walk(folder) for f in names)


def test_upserts_are_folded(spark, tmp_path):
    """After many batches a read takes one version of each bucket and the batches behind it;
    a batch that is written again changes nothing."""
    keys, order, path = ["k"], ["ts"], f"{tmp_path}/out"
    feed = Feed(spark, tmp_path / "in")
    for i in range(7):
        feed.put(_ticks(spark, [(f"k{i % 3}", i * 1000), (f"only{i}", i * 1000)]))
    stream = feed.stream().withColumn("ts", F.unix_millis("et"))
    sinks.upsert_table(stream, path, keys, order, sinks.Run(f"{tmp_path}/cp", True),
                       fold=2, buckets=3).awaitTermination()
    want = {"k0": 6000, "k1": 4000, "k2": 5000, **{f"only{i}": i * 1000 for i in range(7)}}
    def out():
        return {r.k: r.ts % 60_000 for r in sinks.read_upserts(spark, path, keys, order).collect()}
    assert out() == want
    with pytest.raises(ValueError):
        sinks.upsert_table(stream, path, keys, order, sinks.Run(f"{tmp_path}/other", True), fold=2, buckets=3)
    table = sinks._upserts(path, keys, order, fold=2, buckets=3)
    old = _ticks(spark, [("k0", 59_000)]).select("k", "et", F.unix_millis("et").alias("ts"),
                                                 F.lit(3).cast("bigint").alias("_batch"))
    table.put(old, 3)
    assert out() == want


ROUTED = "sink_table string, row_key string, op_type string, data map<string,string>, ts bigint, seq bigint"


@pytest.mark.parametrize("fold", [1, 3])
def test_dimension_table_over_many_batches(spark, tmp_path, fold):
    """Nulls keep the old value, deletions hold against older changes, files stay as many as
    places, and what a read opens is one version of a bucket and fewer than `fold` batches."""
    path = f"{tmp_path}/dims"
    table = sinks._cells(path, fold=fold, buckets=4).create(spark, changelog.CELLS, "here")
    every, seen = [], []
    for n in range(26):
        rows = [(f"r{n % 5}", "update", {"a": f"a{n}", "b": None if n % 2 else f"b{n}"}, n)]
        if n % 7 == 3:
            rows.append((f"r{(n + 1) % 5}", "delete", {"a": "x"}, n))
        batch = [("t", k, op, data, ts, 10 * n + i) for i, (k, op, data, ts) in enumerate(rows)]
        every += batch
        table.put(changelog.cells(spark.createDataFrame(batch, ROUTED)), n)
        seen.append(_files(path))
        if n in (0, 1, 7, 25):
            want = changelog.dim_rows(spark.createDataFrame(every, ROUTED))
            assert counted(_flat(sinks.read_dims(spark, path))) == counted(_flat(want))
    assert max(seen[18:]) <= 4 * 3 + 4 * 2 * fold + 9 and seen[25] <= max(seen[12:18]) + 2
    table.put(changelog.cells(spark.createDataFrame(every[:1], ROUTED)), 25)  # run again: no effect
    assert counted(_flat(sinks.read_dims(spark, path))) == counted(_flat(want))
    def opened_by(rows):
        return [r.f.split("/dims/")[1] for r in rows.select(F.input_file_name().alias("f")).distinct().collect()]
    places = table._newest(spark).places
    opened = opened_by(table._versions(spark, changelog.CELLS, places))
    if fold == 1:
        assert sorted(opened) == sorted(opened_by(sinks._cells(path).read(spark)))
    versions = [f.split("/")[2] for f in opened if f.startswith("base/")]
    assert len(versions) == len(opened) == len(set(versions)) == sum(p >= 0 for p in places)


def _flat(rows):
    return rows.select("sink_table", "row_key", F.col("fields")["a"].alias("a"), F.col("fields")["b"].alias("b"))


def test_interrupted_batch_is_written_again(spark, tmp_path, monkeypatch):
    """A batch that fails before its manifest leaves readers with the state before."""
    path = f"{tmp_path}/dims"
    table = sinks._cells(path, fold=1, buckets=2).create(spark, changelog.CELLS, "here")
    def cells(n):
        return changelog.cells(spark.createDataFrame([("t", "r", "update", {"a": str(n)}, n, n)], ROUTED))
    def value():
        return [r.fields["a"] for r in sinks.read_dims(spark, path).collect()]
    table.put(cells(0), 0)
    with monkeypatch.context() as m:
        m.setattr(type(table), "_commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            table.put(cells(1), 1)
    assert value() == ["0"]
    table.put(cells(1), 1)
    assert value() == ["1"]


def test_dimensions_and_configuration_are_live(spark, tmp_path):
    """A dimension row, a configured table and a removal that come between two batches of a
    running query count in the second."""
    dims, config = f"{tmp_path}/dims", f"{tmp_path}/config"
    spark.createDataFrame([("a", "A")], "id string, name string").write.parquet(dims)
    setting = "source_table string, sink_table string"
    spark.createDataFrame([("a", "first"), ("b", "second")], setting).write.parquet(config)

    def build(batch):
        named = joins.enrich(batch, spark.read.parquet(dims), "k", {"name": "name"})
        return named.join(spark.read.parquet(config), named["k"] == F.col("source_table"))

    feed = Feed(spark, tmp_path / "in").put(_ticks(spark, [("a", 0), ("b", 0), ("c", 0)]))
    query = sinks.live_table(feed.stream(), f"{tmp_path}/out", build,
                             sinks.Run(f"{tmp_path}/cp", trigger="0 seconds"))
    try:
        query.processAllAvailable()
        spark.createDataFrame([("b", "B")], "id string, name string").write.mode("append").parquet(dims)
        spark.createDataFrame([("b", "second"), ("c", "third")], setting).write.mode("overwrite").parquet(config)
        feed.put(_ticks(spark, [("a", 0), ("b", 0), ("c", 0)]))
        query.processAllAvailable()
    finally:
        query.stop()
    rows = spark.read.parquet(f"{tmp_path}/out").where("batch = 0").select("k", "name", "sink_table").collect()
    assert sorted(map(tuple, rows)) == [("a", "A", "first"), ("b", None, "second")]
    rows = spark.read.parquet(f"{tmp_path}/out").where("batch > 0").select("k", "name", "sink_table").collect()
    assert sorted(map(tuple, rows), key=repr) == [("b", "B", "second"), ("c", None, "third")]


def test_late_rows_are_counted(spark, tmp_path):
    """What windows drop, and what keyed state leaves out."""
    seen = LateRows(spark)
    def counted_rows(stream, folder):
        query = sinks.fact_table(stream, f"{folder}/out", sinks.Run(f"{folder}/cp", True))
        query.awaitTermination()
        time.sleep(1)  # progress comes by another thread
        return seen.of(query)
    try:
        feed = Feed(spark, tmp_path / "in")
        for rows in ([("a", 1000)], [("a", 60_000)], [("a", 61_000)], [("late", 2000), ("late", 12_000), ("a", 62_000)],
                     [("a", 200_000)], [("a", 300_000)]):
            feed.put(_ticks(spark, rows))
        stream = windows.with_lateness(feed.stream())
        plain = counted_rows(windows.tumble(stream, "5 seconds", [], [F.count("*").alias("n")]), tmp_path / "w")
        assert sum(plain.values()) == 2
        flagged = streaming_state.first_of_day(stream, ["k"])
        assert sum(counted_rows(flagged, tmp_path / "d").values()) == 2
        # The correction of a row whose window is closed.
        feed = Feed(spark, tmp_path / "deltas")
        def detail_rows(*rows):
            return spark.createDataFrame(rows, "id string, ms bigint, sku_id string, a decimal(18,4)").select(
                "id", F.timestamp_millis(F.col("ms") + T0 * 1000).alias("et"), "sku_id", "a")
        for rows in ([("x", 1000, "s", Decimal(1))], [("y", 60_000, "s", Decimal(1))], [("y", 61_000, "s", Decimal(2))],
                     [("x", 62_000, "s", Decimal(3))], [("z", 100_000, "s", Decimal(1))]):
            feed.put(detail_rows(*rows))
        deltas = streaming_state.delta_correct(windows.with_lateness(feed.stream()), "id", ["a"], "1 hour")
        assert counted_rows(deltas, tmp_path / "c") == {"late_last_of_id": 1}
    finally:
        spark.streams.removeListener(seen)


def test_an_idle_source_holds_nothing_back(spark, tmp_path):
    """Two sources, one of them silent for a while: windows close, and its rows count when it
    wakes."""
    busy, idle = Feed(spark, tmp_path / "busy"), Feed(spark, tmp_path / "idle")
    idle.put(_ticks(spark, [("i", 0)]))
    busy.put(_ticks(spark, [("b", 0)]))
    both = windows.merged(busy.stream(), idle.stream())
    table = windows.tumble(both, "5 seconds", ["k"], [F.count("*").alias("n")])
    query = sinks.fact_table(table, f"{tmp_path}/out", sinks.Run(f"{tmp_path}/cp", trigger="0 seconds"))
    def rows():
        query.processAllAvailable()
        return counted(spark.read.schema(table.schema).parquet(f"{tmp_path}/out"), ["stt", "k", "n"])
    try:
        for ms in (20_000, 40_000):
            busy.put(_ticks(spark, [("b", ms)]))
            query.processAllAvailable()
        first = ("2024-01-01 02:00:00", "i", 1)
        assert first in rows()
        idle.put(_ticks(spark, [("i", 41_000)]))
        query.processAllAvailable()
        for ms in (80_000, 100_000):
            busy.put(_ticks(spark, [("b", ms)]))
            query.processAllAvailable()
        got = rows()
        assert got[("2024-01-01 02:00:40", "i", 1)] == 1 and got[("2024-01-01 02:00:40", "b", 1)] == 1
    finally:
        query.stop()


def test_split_change_log_stream(spark, tmp_path, log):
    """The log, split once on a stream, is what the fact plans read from folders."""
    layers.split_stream(log_stream(spark, tmp_path / "in", LOG), f"{tmp_path}/out",
                        sinks.Run(f"{tmp_path}/cp", True)).awaitTermination()
    stored = layers.changes(spark, f"{tmp_path}/out")
    same(dwd.order_detail(stored, DB), dwd.order_detail(log, DB))
    again = dwd.cart_add(layers.changes_stream(spark, f"{tmp_path}/out"), DB)
    assert again.isStreaming


def test_first_rows_are_forgotten(spark, tmp_path):
    """Keys that the watermark has left a TTL behind go from the state, and only the keys of a
    micro-batch are written."""
    feed = Feed(spark, tmp_path / "in")
    for n in range(6):
        feed.put(_ticks(spark, [(f"k{n}", n * 20_000), ("again", n * 20_000)]))
    stream = windows.with_lateness(feed.stream())
    out = run(streaming_state.first_of_keys(stream, ["k"], "30 seconds", [], buckets=2), tmp_path)
    assert counted(out, ["k"]) == {**{(f"k{n}",): 1 for n in range(6)}, ("again",): 3}
    held = readers.state(spark, f"{tmp_path}/cp", "seen")
    names = {json.loads(r.user_map_key.key)["k"] for r in held.collect()}
    assert {"k5", "again"} <= names and "k0" not in names
