"""Small cases worked by hand, properties, and hot keys."""

import json
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewater import bindings as B
from tidewater import registry, schemas
from tidewater.functions import scalars as S
from tidewater.operators import changelog, etl, joins, state
from tidewater.plans import ads, dwd, dws
from tidewater.sources import decode, sinks

DAY = 86_400_000
T0 = 1_704_067_200_000  # 2024-01-01 00:00:00
FEW = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


def rows(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


# --- worked cases -----------------------------------------------------------------------

def visits(spark, data):
    """(mid, day, is_new) in arrival order."""
    df = spark.createDataFrame(
        [(m, n, T0 + (d - 1) * DAY + i, i) for i, (m, d, n) in enumerate(data)],
        "mid string, is_new string, ts bigint, seq bigint")
    return df.select(F.struct("mid", "is_new").alias("common"), "ts", "seq")


def test_new_visitor_repair(spark):
    log = visits(spark, [("a", 1, "1"), ("a", 1, "1"), ("a", 2, "1"), ("b", 1, "0"), ("b", 1, "1")])
    out = state.repair_new_visitor(log).orderBy("seq")
    assert [r[0] for r in rows(out, "common.is_new")] == ["1", "1", "0", "0", "0"]


def test_returning_user(spark):
    noon = T0 + DAY // 2
    df = spark.createDataFrame([("u", noon + d * DAY, d) for d in (0, 7, 15)],
                               "uid string, ts bigint, seq bigint")
    df = df.withColumn("et", F.timestamp_millis("ts"))
    out = state.returning(state.day_visits(df, "uid", ["ts", "seq"]), 7).orderBy("ts")
    assert rows(out, "uu_ct", "back_ct") == [(1, 0), (1, 0), (1, 1)]


def deltas(spark, data):
    """Delta rows of (id, t, sku, amount), t in seconds."""
    df = spark.createDataFrame(data, "id string, t bigint, sku_id string, a decimal(18,4)")
    df = df.withColumn("et", F.timestamp_seconds("t"))
    groups = state.delta_groups(df, "id", "et", ["et", "sku_id", "a"], ["a"], ["et", "sku_id"])
    return groups, state.delta_rows(groups, ["a"], ["et", "sku_id"])


def expected_deltas(data):
    """The same by replaying the rows one by one."""
    last, out = {}, []
    for i, t, sku, a in sorted(data, key=lambda r: (r[0], r[1], r[2], r[3])):
        prev = last.get(i)
        out.append((i, t, sku, a) if prev is None else (i, prev[0], prev[1], a - prev[2]))
        last[i] = (t, sku, a)
    return sorted(out)


def got_deltas(df):
    out = df.select("id", F.unix_seconds("et").alias("t"), "sku_id", "a")
    return sorted(tuple(r) for r in out.collect())


def test_delta_correction(spark):
    data = [("x", 1, "s", Decimal(10)), ("x", 9, "s", Decimal(15))]
    assert got_deltas(deltas(spark, data)[1]) == [("x", 1, "s", 5), ("x", 1, "s", 10)]


def test_delta_on_hot_key_and_copies(spark, monkeypatch):
    """One id with most rows, over days and on one instant, and copies by the dozen."""
    monkeypatch.setattr(state, "COPY_CHUNK", 7)
    data = [("hot", 86_400 * (i % 5) + i, f"s{i % 3}", Decimal(i * i % 17)) for i in range(120)]
    data += [("hot", 500, "s9", Decimal(4))] * 50
    data += [(f"c{i}", i, "s1", Decimal(i)) for i in range(30)]
    groups, out = deltas(spark, data)
    assert got_deltas(out) == expected_deltas(data)
    sums = state.delta_sums(groups, ["a"], ["et", "sku_id"])
    want = {}
    for _, t, sku, a in expected_deltas(data):
        want[(t, sku)] = want.get((t, sku), 0) + a
    by = sums.groupBy(F.unix_seconds("et").alias("t"), "sku_id").agg(F.sum("a").alias("a"))
    assert {(r.t, r.sku_id): r.a for r in by.collect()} == want


def dim_state(spark, changes):
    """fields after (row key, op, data) changes."""
    df = spark.createDataFrame(
        [("t", "f", k, op, d, i, i) for i, (k, op, d) in enumerate(changes)],
        "sink_table string, sink_family string, row_key string, op_type string, "
        "data map<string,string>, ts bigint, seq bigint")
    return {r.row_key: r.fields for r in changelog.dim_rows(df).collect()}


def test_dimension_updates(spark):
    assert dim_state(spark, [
        ("p", "insert", {"a": "1", "b": "2"}), ("p", "update", {"a": "3", "b": None}),
        ("q", "insert", {"a": "1", "b": "2"}), ("q", "delete", {"a": "1"}),
        ("q", "insert", {"a": "9"}),
        ("r", "insert", {"a": "1"}), ("r", "delete", {"a": "1"}),
    ]) == {"p": {"a": "3", "b": "2"}, "q": {"a": "9"}}


def change_log(spark, changes):
    body = [(json.dumps({"database": "db", "table": t, "type": k, "data": d, "old": o, "ts": ts}),)
            for t, k, d, o, ts in changes]
    return decode.change_log(spark.createDataFrame(body, schemas.RAW))


def test_cart_quantity(spark):
    def cart(i, kind, new, old=None):
        return ("cart_info", kind, {"id": i, "user_id": "u", "sku_id": "s", "sku_num": new}, old, 1)
    log = change_log(spark, [
        cart("1", "insert", "2"), cart("2", "update", "5", {"sku_num": "2"}),
        cart("3", "update", "1", {"sku_num": "5"}), cart("4", "update", "3", {"sku_id": "x"}),
        cart("5", "delete", "3")])
    assert sorted(rows(dwd.cart_add(log, "db"), "id", "sku_num")) == [("1", 2), ("2", 3)]


def test_interval_edges(spark):
    at = T0 // 1000
    pay = spark.createDataFrame([("o", at)], "paid string, t bigint").select(
        "paid", F.timestamp_seconds("t").alias("pi"))
    od = spark.createDataFrame([(n, "o", at + d) for n, d in (
        ("in1", -1800), ("out1", -1801), ("in2", 5), ("out2", 6))], "id string, o string, t bigint")
    od = od.select("id", "o", F.timestamp_seconds("t").alias("od"))
    out = joins.interval(pay, od, F.col("paid") == F.col("o"), "pi", "od", "30 minutes",
                         "5 seconds")
    assert sorted(r.id for r in out.collect()) == ["in1", "in2"]


def test_lookup_drops_and_enrich_keeps(spark):
    df = spark.createDataFrame([("a",), ("z",), (None,)], "code string")
    dic = spark.createDataFrame([("a", ("A",))], "dic_code string, info struct<dic_name:string>")
    assert rows(joins.lookup(df, dic, "code", "name"), "code", "name") == [("a", "A")]
    dim = spark.createDataFrame([("a", "A")], "id string, name string")
    out = joins.enrich(df, dim, "code", {"label": "name"})
    assert set(rows(out, "code", "label")) == {("a", "A"), ("z", None), (None, None)}


def test_zero_sessions(spark):
    traffic = spark.createDataFrame(
        [("20240101", "ch", "1", 1, 0, 3, 10, 0)],
        "cur_date string, ch string, is_new string, uv_ct bigint, sv_ct bigint, pv_ct bigint, "
        "dur_sum bigint, uj_ct bigint")
    assert rows(ads.channel_bounce(traffic), "uj_rate") == [(None,)]
    assert rows(ads.visitor_types(traffic), "uj_rate", "avg_dur_sum", "avg_pv_ct") == [(0, 0, 0)]
    table = {r.type: (r.new_visitor, r.old_visitor)
             for r in ads.visitor_type_table(traffic).collect()}
    assert table["pv_ct"] == (3.0, 0.0)
    assert ads.channel_uv(traffic, 20240102).count() == 0
    assert ads.total_amount(traffic.withColumn("order_amount", F.lit(1)), 20240102).first()[0] is None


def test_full_outer_names(spark):
    order = spark.createDataFrame([("20240101", "1", "A", 5)],
                                  "cur_date string, trademark_id string, trademark_name string, "
                                  "order_amount int")
    refund = spark.createDataFrame([("2024-01-01", "2", "B", "u", 3)],
                                   "cur_date string, trademark_id string, trademark_name string, "
                                   "user_id string, refund_count int")
    plain = ads.trademark(order, refund, 20240101)
    assert sorted(rows(plain, "trademark_name", "refund_count"), key=str) == [("A", None), (None, 3)]
    merged = ads.trademark(order, refund, 20240101, merge_names=True)
    assert sorted(r[0] for r in rows(merged, "trademark_name")) == ["A", "B"]


TEXTS = ["{bad", "[1]", "[]", '[{"ts":1}]', "123", '"x"', "null", "true", "", " ", "{}",
         '{"ts":1}', '{"ts":"x","seq":2}', '{"common":5,"ts":3}', '{"other":1}', ' {"ts":4} ',
         '{"ts":1}}', '{"ts":1', None]


def test_json_guard(spark):
    """The one-pass parse keeps what the object check keeps."""
    raw = spark.createDataFrame([(t,) for t in TEXTS], schemas.RAW)
    kept = [r.value for r in decode.valid_json(raw).collect()]
    assert "{}" in kept and "[1]" not in kept and "" not in kept
    parsed = decode.behaviour_log(raw).select("ts", "seq").collect()
    assert len(parsed) == len(kept)
    assert (None, 2) in [tuple(r) for r in parsed]


def test_split_precedence(spark):
    """A common field wins over an element's; displays take the record's time."""
    rec = {"common": {"mid": "m", "ch": "web"}, "ts": 5, "seq": 1,
           "displays": [{"ch": "own", "item": "1", "pos": 1}],
           "actions": [{"ch": "own", "item": "2", "action_id": "a", "ts": 9}],
           "err": {"error_code": 1}, "page": {"page_id": "p"}, "start": {"entry": "e"}}
    log = decode.behaviour_log(spark.createDataFrame([(json.dumps(rec),)], schemas.RAW))
    assert rows(dwd.display(log), "ch", "item", "ts") == [("web", "1", 5)]
    assert rows(dwd.action(log), "ch", "item", "ts") == [("web", "2", 9)]
    assert {"displays", "actions"} <= set(dwd.start(log).columns)
    assert "err" in dwd.err(log).columns and "displays" not in dwd.err(log).columns
    assert not {"err", "displays", "actions"} & set(dwd.page(log).columns)


def test_config_state(spark):
    snap = spark.createDataFrame([("a", "1"), ("b", "1"), ("c", "1")], "k string, v string")
    changes = spark.createDataFrame([("u", 1, "a", "2"), ("d", 2, "b", "1"), ("c", 3, "e", "1"),
                                     ("d", 4, "e", "1")], "op string, seq bigint, k string, v string")
    out = changelog.config_state(snap, changes, ["k"])
    assert sorted(rows(out, "k", "v")) == [("a", "2"), ("c", "1")]


def test_words(spark):
    df = spark.createDataFrame([("Red red, blue!",), ("",), (None,)], "t string")
    out = joins.lateral_words(df, "t", S.words(F.col("t")))
    assert sorted(r.keyword for r in out.collect()) == ["blue", "red"]


def test_empty_payload(spark):
    log = change_log(spark, [("t", "insert", {}, None, 1), ("t", "insert", {"a": "1"}, None, 2),
                             ("t", "replace", {"a": "1"}, None, 3), ("t", "insert", None, None, 4)])
    assert rows(etl.changes(log, "db", etl.DIM_CHANGE_TYPES), "ts") == [(2,)]
    assert etl.changes(log, "other", etl.DIM_CHANGE_TYPES).count() == 0


# --- properties ---------------------------------------------------------------------------

ITEM = st.tuples(st.sampled_from("xyz"), st.integers(0, 400_000), st.sampled_from(["s", "t"]),
                 st.integers(0, 50).map(Decimal))


@FEW
@given(st.lists(ITEM, min_size=1, max_size=40))
def test_delta_replay(spark, data):
    """Deltas are those of a replay, and sum to each id's last amount."""
    out = got_deltas(deltas(spark, data)[1])
    assert out == expected_deltas(data)
    for key in {r[0] for r in data}:
        last = max((r for r in data if r[0] == key), key=lambda r: r[1:])
        assert sum(r[3] for r in out if r[0] == key) == last[3]


@FEW
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 5)), min_size=1, max_size=30))
def test_day_flags_count_days(spark, data):
    data = sorted(data, key=lambda r: r[1])
    df = spark.createDataFrame([(m, T0 + d * DAY + i, i) for i, (m, d) in enumerate(data)],
                               "mid string, ts bigint, seq bigint")
    df = df.withColumn("day", F.to_date(F.timestamp_millis("ts")))
    flagged = state.flag_first(df, ["mid", "day"], ["ts", "seq"], "seq", "uv")
    assert flagged.count() == len(data)
    assert flagged.agg(F.sum("uv")).first()[0] == len(set(data))


CHANGE = st.tuples(st.sampled_from("pq"), st.sampled_from(["insert", "update", "delete"]),
                   st.dictionaries(st.sampled_from("abc"), st.one_of(st.none(), st.text("01", min_size=1))))


@FEW
@given(st.lists(CHANGE, min_size=1, max_size=20))
def test_dimension_replay(spark, changes):
    want = {}
    for key, op, data in changes:
        if op == "delete":
            want.pop(key, None)
        else:
            written = {c: v for c, v in data.items() if v is not None}
            if written or key in want:
                want.setdefault(key, {}).update(written)
    got = dim_state(spark, changes)
    assert got == {k: v for k, v in want.items() if v}
    assert dim_state(spark, changes + changes) == got


# --- plans ----------------------------------------------------------------------------------

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


#: Aggregates that a user writes in Python.
USER = {"agg_user_count", "agg_user_spread"}


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - USER))
def test_plan_has_no_cross_join_and_no_python(spark, name):
    text = plan(registry.QUERIES[name](spark, SF))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert word not in text


def test_first_rows_are_cut_before_the_shuffle(spark):
    text = plan(registry.QUERIES["st_dedup_first"](spark, SF))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_one_table_reads_one_branch(spark):
    log = etl.table_changes(B.order_changes(spark, SF), B.DATABASE, "cart_info", "insert")
    text = plan(log)
    assert text.count("FileScan") == 1 and "events.parquet" in text


def test_pushdown(spark):
    text = plan(registry.QUERIES["ads_channel_uv"](spark, SF))
    assert "html" not in text and "lineitem" not in text


@pytest.mark.parametrize("name", sorted(USER))
def test_users_aggregates_are_partial_before_the_shuffle(spark, name):
    """One exchange of accumulators, each task's rows being added up below it."""
    text = plan(registry.QUERIES[name](spark, SF))
    above, below = text.split("Exchange hashpartitioning")
    assert "MapInPandas" in above and "MapInPandas" in below


def test_traffic_reads_and_parses_once(spark):
    """One scan of the events and one parse, with the check of bad records the second from_json,
    shuffled once for both sides of the visitor join."""
    df = registry.QUERIES["dws_traffic"](spark, SF)
    df.collect()
    text = plan(df).split("+- == Initial Plan ==")[0]
    assert text.count("events.parquet") == 1 and text.count("from_json(") == 2
    assert "ReusedExchange" in text or "ReusedQueryStage" in text or text.count("FileScan") <= 2


@pytest.mark.parametrize("name, folders", [("log_order_detail", 4), ("log_refund_pay_suc", 3)])
def test_split_log_is_read_by_folder(spark, name, folders):
    text = plan(registry.QUERIES[name](spark, SF)).replace("\n", " ")
    assert text.count("PartitionFilters: [isnotnull(table") == folders and "from_json" not in text


@pytest.mark.parametrize("name", ["ads_channel_uv_day", "ads_category_day"])
def test_day_reports_read_a_day(spark, name):
    text = plan(registry.QUERIES[name](spark, SF))
    assert "PartitionFilters: [isnotnull(cur_date" in text and "events" not in text and "lineitem" not in text


def test_a_day_replaces_itself(spark, tmp_path):
    from tidewater.sources import layers
    one = spark.createDataFrame([("20240101", 1), ("20240102", 2)], "cur_date string, n int")
    layers.put_days(one, f"{tmp_path}/t")
    layers.put_days(one.where("n = 2").withColumn("n", F.lit(5)), f"{tmp_path}/t")
    table = layers.days(spark, f"{tmp_path}/t", one.schema)
    assert sorted(map(tuple, table.select("cur_date", "n").collect())) == [("20240101", 1), ("20240102", 5)]
    today = spark.sql("SELECT date_format(current_date(), 'yyyyMMdd') AS cur_date, 7 AS n")
    layers.put_days(today, f"{tmp_path}/t")
    assert [r.n for r in ads.of_day(table.sparkSession.read.schema(one.schema).parquet(f"{tmp_path}/t"), ads.TODAY).collect()] == [7]


def test_users_aggregates(spark, monkeypatch):
    """Null keys, no values, hot keys, and tasks that hand over before they are done."""
    from tidewater.operators import aggregates
    monkeypatch.setattr(aggregates, "HELD", 2)
    data = [(k, float(i % 13) if i % 5 else None) for i, k in enumerate(["hot"] * 500 + ["a", "b", None] * 7)]
    df = spark.createDataFrame(data, "k string, v double").repartition(5)
    got = {r.k: (r.n, r.mean, r.variance) for r in aggregates.aggregate(df, ["k"], ["v"], aggregates.Spread()).collect()}
    want = {r.k: r for r in df.groupBy("k").agg(F.count("v").alias("n"), F.avg("v").alias("m"), F.var_pop("v").alias("s")).collect()}
    assert set(got) == set(want)
    for k, (n, mean, variance) in got.items():
        assert n == want[k].n and mean == pytest.approx(want[k].m) and variance == pytest.approx(want[k].s)
    none = spark.createDataFrame([("a", None)], "k string, v double")
    assert [tuple(r) for r in aggregates.aggregate(none, ["k"], ["v"], aggregates.Spread()).collect()] == [("a", 0, None, None)]
    assert aggregates.aggregate(none.limit(0), ["k"], ["v"], aggregates.Count()).collect() == []


def test_plans_are_built_without_jobs(spark):
    """No join looks at its sides before it runs."""
    dictionary = B.dictionary(spark, SF)
    log = B.order_changes(spark, SF)
    spark.sparkContext.setJobGroup("building", "")
    try:
        dwd.comment(log, dictionary, B.DATABASE)
        dwd.order_refund(log, dictionary, B.DATABASE)
        assert "ResolvedHint" not in plan(dwd.comment(log, dictionary, B.DATABASE))
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("building")
    finally:
        spark.sparkContext.setJobGroup("", "")


def test_null_delete_mark_deletes_nothing(spark):
    rows = spark.createDataFrame([("a", 1, None), ("b", 1, "d"), ("c", 1, "x")], "k string, ts int, op string")
    kept = changelog.upsert_latest(rows, ["k"], ["ts"], "op = 'd'")
    assert sorted(r.k for r in kept.collect()) == ["a", "c"]
    values = sinks.tombstones(rows, ["k"], "op = 'd'").collect()
    assert sum(r.value is None for r in values) == 1


def test_values_out_of_range_are_null(spark):
    rows = spark.createDataFrame([("9" * 15, "9" * 15), ("2", "1.5"), ("x", "1")], "q string, p string")
    assert [r[0] for r in rows.select(S.line_amount(F.col("q"), F.col("p"))).collect()][1:] == ["3.0000", None]


def test_hot_visitor_is_split_at_run_time(spark):
    """With the run-time bounds scaled down to the test, a visitor with most of the
    records is split in the join, and the result is as without the split."""
    rows_in = spark.range(0, 60_000, numPartitions=8).select(
        F.struct(F.when(F.col("id") % 10 < 9, F.lit("hot")).otherwise(
            F.concat(F.lit("m"), F.col("id"))).alias("mid"), F.lit("1").alias("is_new"))
        .alias("common"),
        (F.lit(T0) + F.col("id") * 10_000).alias("ts"), F.col("id").alias("seq"))
    scaled = {"spark.sql.autoBroadcastJoinThreshold": "-1",
              "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
              "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
              "spark.sql.adaptive.coalescePartitions.enabled": "false",
              "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
              "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    before = {k: spark.conf.get(k, None) for k in scaled}
    try:
        for k, v in scaled.items():
            spark.conf.set(k, v)
        out = state.repair_new_visitor(rows_in)
        kept = out.where(F.col("common.is_new") == "1").select("common.mid").collect()
        final = out.where(F.col("common.is_new") == "1").select("common.mid")
        n = len(final.collect())
        assert "skew=true" in plan(final)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    first_day = sum(1 for i in range(60_000) if i % 10 < 9 and i * 10_000 < DAY)
    assert len(kept) == n == first_day + 6_000


@pytest.mark.parametrize("name, value", [("ads_channel_uv", "uv_ct"), ("ads_channel_sv", "sv_ct")])
def test_reports_come_in_order(spark, name, value):
    found = [(-r[value], r.ch) for r in registry.QUERIES[name](spark, SF).collect()]
    assert len(found) > 1 and found == sorted(found)


def test_report_order_has_a_rule_for_ties(spark):
    traffic = spark.createDataFrame([("c", 20240101, 2), ("a", 20240101, 2), ("b", 20240101, 3)],
                                    "ch string, cur_date int, uv_ct long")
    assert [r.ch for r in ads.channel_uv(traffic).collect()] == ["b", "a", "c"]
