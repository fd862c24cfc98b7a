"""Dimensions and configuration that change while a stream runs."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import streams
from streams import counted, same
from tidewater import bindings as B
from tidewater import schemas
from tidewater.operators import changelog, state, windows
from tidewater.plans import dim, dwd, dws
from tidewater.sources import decode, readers, sinks
from tidewater.streaming import live

SF = "/root/testdata/sf0.001"
T0 = 1_704_074_400
FUTURE = 4_102_444_800
ROUTED = "sink_table string, row_key string, op_type string, data map<string,string>, ts bigint, seq bigint"
CLOSED = "stt < '2099'"


class Feed(streams.Feed):
    """Micro-batches of one file: a running query takes a file as soon as it is there."""

    def __init__(self, spark, folder):
        super().__init__(spark, folder, files=1)


class Running:
    """A query that takes one micro-batch at a time."""

    def __init__(self, df, folder):
        self.spark, self.folder, self.schema = df.sparkSession, str(folder), df.schema
        self.start = lambda: sinks.live_table(df, f"{folder}/out", lambda rows: rows,
                                              sinks.Run(f"{folder}/cp", trigger="0 seconds"))
        self.before = self.spark.conf.get("spark.sql.shuffle.partitions")
        self.spark.conf.set("spark.sql.shuffle.partitions", "2")  # every keyed operator has as many tasks
        self.query = self.start()

    def step(self):
        self.query.processAllAvailable()
        return self.rows()

    def rows(self):
        return self.spark.read.schema(self.schema).parquet(f"{self.folder}/out")

    def restart(self):
        self.query.stop()
        self.query = self.start()

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self.query.stop()
        self.spark.conf.set("spark.sql.shuffle.partitions", self.before)


def ticks(spark, rows):
    return spark.createDataFrame(rows, "k string, n bigint, ms bigint").select(
        "k", "n", F.timestamp_millis(F.col("ms") + T0 * 1000).alias("et"))


def routed(spark, rows):
    return spark.createDataFrame([("d", *r) for r in rows], ROUTED)


def up(key, ts, seq=0, **data):
    return key, "update", data, ts, seq


def test_lookup_sees_changes(spark, tmp_path):
    """A new row, a changed column, a null that keeps the old value, a deletion, an old change
    that comes again, and a restart between them."""
    facts = Feed(spark, tmp_path / "facts").put(ticks(spark, [("a", 1, 0), ("b", 1, 0), (None, 1, 0)]))
    news = Feed(spark, tmp_path / "news").put(routed(spark, [up("a", 1, name="A", size="1")]))
    found = live.lookup(facts.stream(), news.stream(), "k", {"title": "name", "size": "size"}, shares=3)
    with Running(found, tmp_path) as q:
        q.step()
        news.put(routed(spark, [up("b", 2, name="B", other="x"), up("a", 3, name=None, size="2"), up("a", 1, name="old", size="9")]))
        facts.put(ticks(spark, [("a", 2, 1000), ("b", 2, 1000), ("c", 2, 1000)]))
        q.step()
        q.restart()
        news.put(routed(spark, [("a", "delete", {"name": "A"}, 5, 0), up("a", 4, name="late")]))
        facts.put(ticks(spark, [("a", 3, 2000), ("b", 3, 2000)]))
        q.step()
        news.put(routed(spark, [up("a", 6, size="3")]))
        facts.put(ticks(spark, [("a", 4, 3000)]))
        rows = q.step()
    assert counted(rows, ["k", "n", "title", "size"]) == {
        ("a", 1, "A", "1"): 1, ("b", 1, None, None): 1, (None, 1, None, None): 1, ("a", 2, "A", "2"): 1, ("b", 2, "B", None): 1,
        ("c", 2, None, None): 1, ("a", 3, None, None): 1, ("b", 3, "B", None): 1, ("a", 4, None, "3"): 1}


def test_lookup_starts_from_a_stored_table(spark, tmp_path):
    before = routed(spark, [up("a", 1, name="A"), up("b", 1, name="B"), up("c", 1, name="C"), ("c", "delete", {}, 2, 0)])
    stored = changelog.newest_cells(changelog.cells(before))
    facts = Feed(spark, tmp_path / "facts").put(ticks(spark, [(k, 1, 0) for k in "abcd"]))
    news = Feed(spark, tmp_path / "news").put(routed(spark, [up("a", 5, name="A5"), up("b", 0, name="older")]))
    found = live.lookup(facts.stream(), news.stream(), "k", {"title": "name"}, preload=stored)
    with Running(found, tmp_path) as q:
        rows = q.step()
    assert {r.k: r.title for r in rows.collect()} == {"a": "A5", "b": "B", "c": None, "d": None}


def test_facts_wait_for_their_row(spark, tmp_path):
    """A fact without a row goes out when the row comes, or without one after the wait, and
    is in the row of its own window."""
    facts = Feed(spark, tmp_path / "facts").put(ticks(spark, [("a", 1, 1000), ("b", 1, 1000), ("c", 1, 1000)]))
    news = Feed(spark, tmp_path / "news").put(routed(spark, [up("a", 1, name="A")]))
    stream = windows.with_lateness(facts.stream())
    rows = live.lookup(stream, news.stream(), "k", {"title": "name"}, "et", wait="60 seconds")
    table = windows.tumble(live.own_window(rows, "5 seconds"), "5 seconds", ["title", "_start"], windows.sums("n"))
    with Running(live.stamped(table, "5 seconds"), tmp_path) as q:
        q.step()
        facts.put(ticks(spark, [("a", 10, 30_000)]))
        q.step()
        news.put(routed(spark, [up("b", 2, name="B")]))
        facts.put(ticks(spark, [("a", 100, 40_000)]))
        q.step()
        for ms in (200_000, 300_000, 400_000):
            facts.put(ticks(spark, [("a", 0, ms)]))
            out = q.step()
    got = counted(out.where("n > 0"), ["stt", "title", "n"])
    assert got == {("2024-01-01 02:00:00", "A", 1): 1, ("2024-01-01 02:00:30", "A", 10): 1, ("2024-01-01 02:00:40", "A", 100): 1,
                   ("2024-01-01 02:00:00", "B", 1): 1, ("2024-01-01 02:00:00", None, 1): 1}


# --- the windowed tables ----------------------------------------------------------------

def dim_feed(spark, folder, dims):
    """One stream of routed changes with the rows of all dimensions."""
    def changes(name, df):
        data = F.create_map(*[x for c in df.columns for x in (F.lit(c), F.col(c).cast("string"))])
        return df.select(F.lit(name).alias("sink_table"), F.col("id").alias("row_key"), F.lit("insert").alias("op_type"),
                         data.alias("data"), F.lit(1).cast("bigint").alias("ts"), F.lit(0).cast("bigint").alias("seq"))
    every = None
    for name, df in dims.items():
        rows = changes(name, df)
        every = rows if every is None else every.unionByName(rows)
    return Feed(spark, folder).put(every)


def far(df, days, **own):
    ts = FUTURE + days * 86400
    return df.limit(1).withColumns({"ts": F.lit(ts).cast("bigint"), **{k: F.lit(f"{v}{days}") for k, v in own.items()}})


def later_row(table, key, **data):
    return [(table, key, "update", data, 9, 0)]


def test_refund_with_live_products(spark, tmp_path):
    """The batch result on what is there; a product that comes between two micro-batches of the
    running query is in the groups of the refunds after it."""
    dims = B.dimensions(spark, SF)
    log = B.order_changes(spark, SF, "order_refund_info", "order_info")
    refunds = dwd.order_refund(log, B.dictionary(spark, SF), B.DATABASE).persist()
    news = dim_feed(spark, tmp_path / "dims", dims)
    facts = Feed(spark, tmp_path / "facts").put(refunds, ["ts"])
    stream = {name: dim.changes(news.stream(), name) for name in dims}
    with Running(dws.refund(facts.stream(), stream, "30 days"), tmp_path) as q:
        q.step()
        news.put(spark.createDataFrame(later_row("sku", "new", tm_id="tm", category3_id="c3")
                                       + later_row("trademark", "tm", tm_name="TM"), ROUTED))
        q.step()
        for days in (0, 400, 800):
            facts.put(far(refunds, days, sku_id="").withColumn("sku_id", F.lit("new")))
            q.step()
        out = q.rows()
    same(out, dws.refund(refunds, dims, "30 days"), CLOSED)
    assert {(r.trademark_id, r.trademark_name, r.category3_id, r.category3_name)
            for r in out.where("stt > '2099'").collect()} == {("tm", "TM", "c3", None)}


def test_province_with_live_names(spark, tmp_path):
    details = B.order_detail_facts(spark, SF).persist()
    provinces = B.provinces(spark, SF)
    news = dim_feed(spark, tmp_path / "dims", {"province": provinces})
    facts = Feed(spark, tmp_path / "facts").put(details, ["ts"])
    table = dws.province_order(facts.stream(), dim.changes(news.stream(), "province"), "30 days")
    with Running(table, tmp_path) as q:
        q.step()
        news.put(spark.createDataFrame(later_row("province", "p", name="P"), ROUTED))
        for days in (0, 400, 800):
            facts.put(far(details, days, id="end").withColumn("province_id", F.lit("p")))
            q.step()
        out = q.rows()
    same(out, dws.province_order(details, provinces, "30 days"), CLOSED)
    assert {r.province_name for r in out.where("stt > '2099'").collect()} == {"P"}


def test_sku_with_live_names(spark, tmp_path):
    details = B.order_detail_facts(spark, SF).persist()
    dims = B.dimensions(spark, SF)
    news = dim_feed(spark, tmp_path / "dims", dims)
    facts = Feed(spark, tmp_path / "facts").put(details, ["ts"])
    stream = {name: dim.changes(news.stream(), name) for name in dims}
    table = dws.sku_order(facts.stream(), stream, "30 days", delta_ttl="4000 days")
    with Running(table, tmp_path) as q:
        q.step()
        news.put(spark.createDataFrame(
            later_row("sku", "new", sku_name="N", spu_id="s", tm_id="t", category3_id="3") + later_row("spu", "s", spu_name="S")
            + later_row("category3", "3", name="three", category2_id="2") + later_row("category2", "2", name="two", category1_id="1")
            + later_row("category1", "1", name="one"), ROUTED))
        for days in (0, 400, 800):
            facts.put(far(details, days, id="end").withColumn("sku_id", F.lit("new")))
            q.step()
        out = q.rows()
    same(out, dws.sku_order(details, dims, "30 days"), CLOSED)
    rows = out.where("stt > '2099'").select("sku_name", "spu_name", "trademark_name", "category3_name", "category2_name",
                                            "category1_name").distinct().collect()
    assert [tuple(r) for r in rows] == [("N", "S", None, "three", "two", "one")]


# --- configuration ----------------------------------------------------------------------

def raw(df, names):
    return df.select(F.to_json(F.struct(*names)).alias("value"))


def test_live_configuration(spark, tmp_path):
    """Preloaded rules count from the start, live ones overrule them; a put, a change and a
    removal count from their micro-batch on, also after a restart."""
    log = "database string, table string, type string, data map<string,string>, old map<string,string>, ts bigint, seq bigint"
    def rows(n):
        return spark.createDataFrame([("db", t, "insert", {"id": str(n), "a": "1", "b": "2"}, None, n, n) for t in "pqr"], log)
    def rule(op, table, columns, seq):
        return op, table, "insert", f"sink_{table}", columns, seq
    config = "op string, source_table string, source_type string, sink_table string, sink_columns string, seq bigint"
    preload = spark.createDataFrame([("p", "insert", "sink_p", "id"), ("q", "insert", "sink_q", "id")], schemas.FACT_CONFIG)
    facts = Feed(spark, tmp_path / "log").put(rows(0))
    rules = Feed(spark, tmp_path / "rules").put(spark.createDataFrame([rule("u", "q", "id,a", 1)], config))
    found = dwd.routed_facts(facts.stream(), rules.stream(), "db", preload)
    with Running(found, tmp_path) as q:
        q.step()
        rules.put(spark.createDataFrame([rule("c", "r", "b", 2), rule("d", "p", "id", 3)], config))
        facts.put(rows(1))
        q.step()
        q.restart()
        rules.put(spark.createDataFrame([rule("u", "r", "id,b", 5), rule("u", "p", "a", 2)], config))
        facts.put(rows(2))
        q.step()
        facts.put(rows(3))
        out = q.step()
    got = {(r.sink_table, r.seq if "seq" in out.columns else r.ts): dict(r.data) for r in out.collect()}
    assert got == {("sink_p", 0): {"id": "0"}, ("sink_q", 0): {"id": "0", "a": "1"},
                   ("sink_q", 1): {"id": "1", "a": "1"}, ("sink_r", 1): {"b": "2"},
                   ("sink_q", 2): {"id": "2", "a": "1"}, ("sink_r", 2): {"id": "2", "b": "2"},
                   ("sink_q", 3): {"id": "3", "a": "1"}, ("sink_r", 3): {"id": "3", "b": "2"}}


@pytest.mark.parametrize("facts", [False, True])
def test_configuration_stream_equals_batch(spark, tmp_path, facts):
    """With all changes in before the log, the stream routes as the batch does."""
    kind = schemas.FACT_CONFIG if facts else schemas.DIM_CONFIG
    keys = ["source_table", "source_type"] if facts else ["source_table"]
    changes = decode.config_changes(B.raw_config(spark, SF, facts), kind)
    preload = state.last_rows(changes.where("op = 'r'"), keys, ["seq"]).drop("op", "seq")
    later = changes.where("op <> 'r'")
    text = raw(B.generic_changes(spark, SF), schemas.CHANGE.names)
    rules = Feed(spark, tmp_path / "rules").put(later)
    log = Feed(spark, tmp_path / "log").put(text)
    build = dwd.routed_facts if facts else dim.routed
    stream = build(decode.change_log(log.stream()), rules.stream(), B.DATABASE, preload)
    with Running(stream, tmp_path) as q:
        out = q.step()
    batch = build(decode.change_log(text), changelog.config_state(preload, later, keys), B.DATABASE)
    def flat(df):
        return df.select(*[c for c in df.columns if c != "data"], F.to_json("data").alias("data"))
    same(flat(out), flat(batch))


# --- left joins that correct themselves ---------------------------------------------------

def test_late_activity_replaces_the_detail(spark, tmp_path):
    """A detail is in the table at once with nulls; activity and coupon replace it when they come;
    in the end the table is the left join."""
    import test_streaming_facts as facts
    t0 = facts.T0
    first = [facts.order("1", t0), facts.detail("11", "1", t0), facts.detail("12", "1", t0 + 1),
             facts.change(t0, "order_detail_coupon", "insert", {"order_detail_id": "12", "coupon_id": "c"})]
    late = [facts.change(t0 + 1, "order_detail_activity", "insert",
                         {"order_detail_id": "11", "activity_id": "a", "activity_rule_id": "r"}),
            facts.change(t0 + 1, "order_detail_coupon", "insert", {"order_detail_id": "13", "coupon_id": "d"})]
    last = [facts.change(t0 + 2, "order_detail_coupon", "insert", {"order_detail_id": "11", "coupon_id": "e"}),
            facts.detail("13", "1", t0 + 2)]
    feed = Feed(spark, tmp_path / "in").put(facts.lines(spark, first))
    stream = dwd.order_detail_early(decode.change_log(feed.stream()), facts.DB, ttl=None)
    path, keys, order = f"{tmp_path}/out", dwd.DETAIL_KEYS, dwd.DETAIL_ORDER
    query = sinks.upsert_table(stream, path, keys, order, sinks.Run(f"{tmp_path}/cp", trigger="0 seconds"), fold=2, buckets=2)
    def table():
        query.processAllAvailable()
        return sinks.read_upserts(spark, path, keys, order)
    def ids():
        return {r.id: (r.activity_id, r.coupon_id) for r in table().collect()}
    try:
        assert ids() == {"11": (None, None), "12": (None, "c")}
        feed.put(facts.lines(spark, late))
        assert ids() == {"11": ("a", None), "12": (None, "c")}
        feed.put(facts.lines(spark, last))
        assert ids() == {"11": ("a", "e"), "12": (None, "c"), "13": (None, "d")}
        batch = dwd.order_detail(decode.change_log(facts.lines(spark, first + late + last)), facts.DB)
        assert counted(table().drop("_version"), batch.columns) == counted(batch)
    finally:
        query.stop()


# --- restarts of keyed state --------------------------------------------------------------

def parts(df, order, n=3):
    rank = F.ntile(n).over(Window.orderBy(*order))
    cut = df.withColumn("_part", rank).persist()
    return [cut.where(f"_part = {i}").drop("_part") for i in range(1, n + 1)]


def test_traffic_survives_restarts(spark, tmp_path):
    """Stopped and started again after every micro-batch, the state going on from where it was."""
    from test_streaming_windows import later, page_end
    pages = B.page_log(spark, SF)
    feed = Feed(spark, tmp_path / "in").put(pages.limit(0))
    table = dws.traffic(feed.stream(), "1 day", session_ttl="2 days")
    with Running(table, tmp_path) as q:
        for part in parts(pages, ["ts", "seq"]):
            feed.put(part)
            q.step()
            q.restart()
        held = readers.state(spark, f"{tmp_path}/cp", "seen", operator=1)
        assert held.count() > 0
        for i in (0, 400 * 86400):
            feed.put(page_end(later(pages, i), i))
            q.step()
            q.restart()
        out = q.rows()
    batch = dws.traffic(pages, "1 day")
    same(out, batch, CLOSED, [c for c in batch.columns if c != "uj_ct"])


def test_sku_order_survives_restarts(spark, tmp_path):
    """Corrections follow the row before also when that came before the restart."""
    rows = [("a", 0, "10"), ("b", 1, "5"), ("a", 2, "12"), ("a", 3, "9"), ("b", 4, "5")]
    def details(part):
        return spark.createDataFrame([(i, "s", T0 + t, v, v, v, v) for i, t, v in part],
                                     "id string, sku_id string, ts bigint, split_original_amount string, "
                                     "split_activity_amount string, split_coupon_amount string, split_total_amount string")
    dims = B.dimensions(spark, SF)
    feed = Feed(spark, tmp_path / "in").put(details(rows[:2]))
    with Running(dws.sku_order(feed.stream(), dims, "1 hour", delta_ttl="4000 days"), tmp_path) as q:
        q.step()
        for part in (rows[2:3], rows[3:]):
            q.restart()
            feed.put(details(part))
            q.step()
        for i in (10_000, 20_000):
            feed.put(details([(f"end{i}", i, "1")]))
            q.step()
        out = q.rows().where(F.col("order_amount") > 1)
    batch = dws.sku_order(details(rows), dims, "1 hour")
    same(out, batch, columns=["stt", "sku_id", *dws.SKU_AMOUNTS])
