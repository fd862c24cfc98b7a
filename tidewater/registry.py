"""One query per operator and pipeline, over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import bindings as B
from . import schemas
from .functions import scalars as S
from .operators import aggregates, changelog, etl, joins, state, windows
from .plans import ads, dim, dwd, dws
from .sources import decode, layers

Query = Callable[[SparkSession, str], DataFrame]

# Event times of the page log span a month, those of trade seven years.
PAGE_WINDOW = "1 day"
HOUR_WINDOW = "1 hour"
TRADE_WINDOW = "30 days"

QUERIES: dict[str, Query] = {}


def plain(df: DataFrame) -> DataFrame:
    """Columns in types that any SQL engine reports the same way: whole numbers as
    bigint, amounts as double, times and dates as text."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = F.round(c.cast("double"), 4)
        elif isinstance(f.dataType, T.DoubleType):
            c = F.round(c, 6)
        elif isinstance(f.dataType, (T.IntegerType, T.BooleanType)):
            c = c.cast("long")
        elif isinstance(f.dataType, T.TimestampType):
            c = F.date_format(c, S.DATETIME)
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, S.DATE)
        out.append(c.alias(f.name))
    return df.select(*out)


def query(build: Query) -> Query:
    """Register a query under its function name."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(build(spark, sf_dir))
    QUERIES[build.__name__] = run
    return build


# --- inputs shared by queries ---------------------------------------------------------

# Trade dates of the test tables are whole days, so the half hour before a payment and
# the five seconds after it are taken as days.
PAY_INTERVAL = ("30 days", "5 days")


def _changes(spark, sf, *tables):
    return B.order_changes(spark, sf, *tables)


def _details(spark, sf):
    """The order-detail fact, from the change log."""
    log = _changes(spark, sf, "order_detail", "order_info", "order_detail_activity",
                   "order_detail_coupon")
    return dwd.order_detail(log, B.DATABASE, by_order=True)


def _facts(spark, sf):
    """The order-detail fact, as a stored table's readers find it."""
    return B.order_detail_facts(spark, sf)


def _carts(spark, sf):
    return dwd.cart_add(_changes(spark, sf, "cart_info"), B.DATABASE)


def _refunds(spark, sf):
    log = _changes(spark, sf, "order_refund_info", "order_info")
    return dwd.order_refund(log, B.dictionary(spark, sf), B.DATABASE)


def _paid(spark, sf, details=_facts):
    return dwd.order_payment(_changes(spark, sf, "payment_info"), details(spark, sf),
                             B.dictionary(spark, sf), B.DATABASE, *PAY_INTERVAL)


def _dim_config(spark, sf):
    return decode.config_changes(B.raw_config(spark, sf), schemas.DIM_CONFIG)


def _fact_config(spark, sf):
    """Fact configuration: the preloaded part, then the changes to it."""
    changes = decode.config_changes(B.raw_config(spark, sf, facts=True), schemas.FACT_CONFIG)
    keys = ["source_table", "source_type"]
    preload = state.last_rows(changes.where("op = 'r'"), keys, ["seq"]).drop("op", "seq")
    return changelog.config_state(preload, changes.where("op <> 'r'"), keys)


def _generic(spark, sf):
    return decode.change_log(B.raw_changes(spark, sf))


def _payload(df, *columns):
    return df.select(*[c for c in df.columns if c not in ("data", "old", "et", "pt")],
                     *[F.col("data")[c].alias(c) for c in columns])


def _flat_page(df):
    names = ("mid", "uid", "sid", "vc", "ch", "ar", "is_new")
    pages = ("page_id", "last_page_id", "item", "item_type", "during_time")
    return df.select("seq", "ts", *[F.col(f"common.{n}").alias(n) for n in names],
                     *[F.col(f"page.{n}").alias(n) for n in pages])


# --- sources --------------------------------------------------------------------------

@query
def src_raw_json(spark, sf):
    raw = decode.drop_null_records(B.raw_behaviour(spark, sf))
    good = decode.is_json_object(F.col("value"))
    return raw.select(F.get_json_object("value", "$.seq").cast("long").alias("seq"),
                      F.when(~good, F.col("value")).alias("broken"))


@query
def src_change_log(spark, sf):
    log = _generic(spark, sf)
    return _payload(log.withColumn("at", F.col("et")).withColumn("old_score", F.col("old")["score"]),
                    "id", "name", "score")


@query
def src_page_log(spark, sf):
    log = decode.page_log(B.raw_behaviour(spark, sf))
    return log.select("seq", F.col("et").alias("at"),
                      *[F.col("page")[c].alias(c) for c in ("page_id", "item_type", "item")])


@query
def src_fact_reread(spark, sf):
    facts = decode.fact_table(_facts(spark, sf), "3 seconds")
    return facts.select("id", "order_id", "ts", F.col("et").alias("at"))


@query
def lkp_dictionary(spark, sf):
    return B.dictionary(spark, sf).select("dic_code", F.col("info.dic_name").alias("dic_name"))


@query
def cdc_config_decode(spark, sf):
    return _dim_config(spark, sf)


@query
def cdc_config_snapshot(spark, sf):
    loaded = _dim_config(spark, sf).where("op = 'r'")
    return state.last_rows(loaded, ["source_table"], ["seq"]).drop("op", "seq")


@query
def cdc_config_active(spark, sf):
    return changelog.active_config(_dim_config(spark, sf), ["source_table"])


# --- sinks as tables ------------------------------------------------------------------

@query
def dwd_routed_facts(spark, sf):
    facts = dwd.routed_facts(_generic(spark, sf), _fact_config(spark, sf), B.DATABASE)
    return _payload(facts, "id", "name", "score", "note")


@query
def upsert_latest(spark, sf):
    log = etl.changes(_generic(spark, sf), B.DATABASE, etl.DIM_CHANGE_TYPES)
    rows = _payload(log.withColumnRenamed("table", "source"), "id", "name", "score")
    kept = changelog.upsert_latest(rows, ["source", "id"], ["ts", "seq"],
                                   deleted="type = 'delete'")
    return kept.select("source", "id", "name", "score", "ts", "seq")


@query
def dim_config_route(spark, sf):
    config = changelog.active_config(_dim_config(spark, sf), ["source_table"])
    routed = dim.routed(_generic(spark, sf), config, B.DATABASE)
    return _payload(routed, "id", "name", "score", "note")


@query
def dim_latest(spark, sf):
    config = changelog.active_config(_dim_config(spark, sf), ["source_table"])
    rows = dim.latest(_generic(spark, sf), config, B.DATABASE)
    return rows.select("sink_table", "row_key", *[F.col("fields")[c].alias(c)
                                                  for c in ("id", "name", "score")])


@query
def dim_targets(spark, sf):
    config = _dim_config(spark, sf)
    live = changelog.active_config(config, ["source_table"]).select(
        "sink_table", F.lit(1).alias("in_effect"))
    return (changelog.created_targets(config).join(live, "sink_table", "left")
            .withColumn("in_effect", F.coalesce("in_effect", F.lit(0))))


# --- projections and filters ----------------------------------------------------------

@query
def etl_valid_json(spark, sf):
    good = decode.valid_json(B.raw_behaviour(spark, sf))
    return good.select(F.get_json_object("value", "$.seq").cast("long").alias("seq"),
                       F.get_json_object("value", "$.common.mid").alias("mid"))


@query
def etl_change_log_dim(spark, sf):
    log = etl.changes(_generic(spark, sf), B.DATABASE, etl.DIM_CHANGE_TYPES)
    return _payload(log, "id", "score")


@query
def etl_change_log_dwd(spark, sf):
    log = etl.changes(_generic(spark, sf), B.DATABASE, etl.FACT_CHANGE_TYPES)
    return _payload(log, "id", "score")


@query
def prj_map_extract(spark, sf):
    rows = etl.pick(B.generic_changes(spark, sf).select("data", "ts"), "id", "name",
                    points="score", absent="no_such_key")
    return rows


@query
def prj_config_columns(spark, sf):
    config = changelog.active_config(_dim_config(spark, sf), ["source_table"])
    log = B.generic_changes(spark, sf)
    joined = log.join(config, log["table"] == config["source_table"])
    payload = F.map_concat("data", F.create_map(F.lit("op_type"), F.col("type")))
    kept = joined.select("seq", etl.keep_listed(payload, F.col("sink_columns"), ("op_type",))
                         .alias("data"))
    return kept.select("seq", F.array_join(F.array_sort(F.map_keys("data")), ",").alias("names"),
                       F.col("data")["op_type"].alias("op_type"),
                       F.col("data")["score"].alias("score"))


@query
def flt_status_exact(spark, sf):
    log = etl.table_changes(_changes(spark, sf, "order_info"), B.DATABASE, "order_info", "update")
    rows = log.where(etl.moved("order_status", etl.ORDER_PLACED, etl.ORDER_CANCELLED))
    return etl.pick(rows, "id", "user_id", "operate_time")


@query
def flt_status_changed(spark, sf):
    cases = [("payment_info", "payment_status", etl.PAID, "order_id"),
             ("order_info", "order_status", etl.ORDER_REFUND_ASKED, "id"),
             ("order_info", "order_status", etl.ORDER_REFUND_DONE, "id"),
             ("order_refund_info", "refund_status", etl.REFUND_FINISHED, "id"),
             ("refund_payment", "refund_status", etl.REFUND_PAID, "id")]
    out = None
    for table, column, status, key in cases:
        log = etl.table_changes(_changes(spark, sf, table), B.DATABASE, table, "update")
        rows = log.where(etl.became(column, status)).select(
            F.lit(table).alias("source"), F.lit(status).alias("status"),
            F.col("data")[key].alias("id"), "ts")
        out = rows if out is None else out.unionByName(rows)
    return out


@query
def flt_login(spark, sf):
    return _flat_page(etl.logins(B.page_log(spark, sf))).select("seq", "ts", "uid", "last_page_id")


@query
def flt_keyword(spark, sf):
    return _flat_page(etl.searches(B.page_log(spark, sf))).select("seq", "ts", "item")


@query
def fn_decimal_amount(spark, sf):
    parts = B.load(spark, sf, "part").withColumnRenamed("p_partkey", "l_partkey")
    lines = B.load(spark, sf, "lineitem").join(parts, "l_partkey")
    num = F.col("l_quantity").cast(S.MONEY).cast("string")
    price = F.col("p_retailprice").cast(S.MONEY).cast("string")
    return lines.select("l_orderkey", "l_linenumber", num.alias("sku_num"),
                        S.line_amount(num, price).alias("amount"))


@query
def fn_amount_default(spark, sf):
    facts = _facts(spark, sf)
    return facts.select("id", "ts", "sku_id",
                        S.amount_or_zero(F.col("split_activity_amount")).alias("activity"),
                        S.amount_or_zero(F.col("split_coupon_amount")).alias("coupon"))


@query
def fn_date_formats(spark, sf):
    ms = F.col("ts")
    text = S.millis_to_datetime(ms)
    return B.events(spark, sf).select(
        "seq", text.alias("datetime"), S.millis_to_date(ms).alias("date"),
        S.millis_to_partition(ms).alias("partition_date"), S.date_id(text).alias("date_id"),
        S.datetime_to_millis(text).alias("datetime_ms"),
        S.date_to_millis(S.millis_to_date(ms)).alias("date_ms"))


@query
def fn_epoch(spark, sf):
    ms = F.col("ts")
    return B.events(spark, sf).select(
        "seq", S.event_time_millis(ms).alias("from_millis"),
        S.event_time_seconds(F.floor(ms / 1000)).alias("from_seconds"),
        (F.unix_millis(S.event_time_millis(ms)) % 1000).alias("millis"))


@query
def prj_nested(spark, sf):
    log = B.behaviour_log(spark, sf)
    return log.select("seq", F.col("common.mid").alias("mid"),
                      F.col("page.page_id").alias("page_id"),
                      F.col("start.entry").alias("entry"),
                      F.col("err.error_code").alias("error_code"))


# --- behaviour log split --------------------------------------------------------------

def _base_log(spark, sf):
    return dwd.base_log(decode.behaviour_log(B.raw_behaviour(spark, sf)))


@query
def dwd_start(spark, sf):
    log = dwd.start(_base_log(spark, sf))
    return log.select("seq", "ts", F.col("common.mid").alias("mid"),
                      F.col("common.is_new").alias("is_new"), F.col("start.entry").alias("entry"),
                      F.col("start.loading_time").alias("loading_time"),
                      F.size(F.coalesce("displays", F.array())).alias("displays"))


@query
def dwd_display(spark, sf):
    return dwd.display(_base_log(spark, sf))


@query
def dwd_action(spark, sf):
    return dwd.action(_base_log(spark, sf))


@query
def dwd_err(spark, sf):
    log = dwd.err(_base_log(spark, sf))
    return log.select("seq", "ts", F.col("common.mid").alias("mid"),
                      F.col("common.is_new").alias("is_new"),
                      F.col("err.error_code").alias("error_code"), F.col("err.msg").alias("msg"),
                      F.col("page.page_id").alias("page_id"))


@query
def dwd_page(spark, sf):
    return _flat_page(dwd.page(_base_log(spark, sf)))


# --- joins ----------------------------------------------------------------------------

@query
def join_inner(spark, sf):
    log = _changes(spark, sf, "order_detail", "order_info")
    od = etl.pick(etl.table_changes(log, B.DATABASE, "order_detail", "insert"),
                  "id", "order_id", "sku_id")
    oi = etl.pick(etl.table_changes(log, B.DATABASE, "order_info", "insert"),
                  "user_id", "province_id", info_id="id").drop("ts")
    return od.join(oi, F.col("order_id") == F.col("info_id")).drop("info_id")


@query
def join_left_chain(spark, sf):
    return _details(spark, sf).select("id", "sku_id", "ts", "split_total_amount", "activity_id",
                                      "activity_rule_id", "coupon_id")


@query
def join_composite(spark, sf):
    log = _changes(spark, sf, "refund_payment", "order_refund_info")
    rp = etl.pick(etl.table_changes(log, B.DATABASE, "refund_payment", "update"),
                  "id", "order_id", "sku_id", "total_amount")
    ri = etl.pick(etl.table_changes(log, B.DATABASE, "order_refund_info", "update"),
                  "order_id", "sku_id", "refund_num").drop("ts")
    return rp.join(ri, ["order_id", "sku_id"])


@query
def join_interval(spark, sf):
    pi = dwd.payments(_changes(spark, sf, "payment_info"), B.DATABASE)
    od = dwd.timed(_facts(spark, sf), "od_et").select(
        "id", "order_id", "sku_id", "split_total_amount", "od_et")
    rows = joins.interval(pi, od, F.col("paid_order") == F.col("order_id"), "pi_et", "od_et",
                          *PAY_INTERVAL)
    return rows.select("id", "order_id", "sku_id", "split_total_amount", "payment_type",
                       F.col("od_et").alias("ordered_at"), F.col("pi_et").alias("paid_at"))


@query
def join_lookup(spark, sf):
    log = _changes(spark, sf, "payment_info")
    rows = etl.pick(etl.table_changes(log, B.DATABASE, "payment_info", "update"),
                    "order_id", "payment_type")
    return joins.lookup(rows, B.dictionary(spark, sf), "payment_type", "payment_type_name")


@query
def join_lookup_twice(spark, sf):
    log = _changes(spark, sf, "order_refund_info")
    rows = etl.pick(etl.table_changes(log, B.DATABASE, "order_refund_info", "insert"),
                    "id", "sku_id", "refund_type", "refund_reason_type")
    dic = B.dictionary(spark, sf)
    rows = joins.lookup(rows, dic, "refund_type", "refund_type_name")
    return joins.lookup(rows, dic, "refund_reason_type", "refund_reason_type_name")


@query
def join_lateral_words(spark, sf):
    rows = etl.searches(B.page_log(spark, sf)).select("seq", F.col("page.item").alias("kw"))
    return joins.lateral_words(rows, "kw", S.words(F.col("kw")))


@query
def enrich_one_hop(spark, sf):
    rows = _facts(spark, sf).select("id", "sku_id", "ts", "province_id", "split_total_amount")
    return joins.enrich(rows, B.provinces(spark, sf), "province_id",
                        {"province_name": "name", "region_name": "region"})


@query
def enrich_snowflake(spark, sf):
    rows = _facts(spark, sf).select("id", "sku_id", "ts", "split_total_amount")
    flat = joins.flatten_sku(B.dimensions(spark, sf))
    return joins.enrich(rows, flat, "sku_id",
                        {n: n for n in flat.columns if n != "sku_id"}, dim_key="sku_id")


# --- windows and aggregates -----------------------------------------------------------

@query
def agg_window_keyed(spark, sf):
    facts = dws.sku_facts(_facts(spark, sf))
    return windows.tumble(facts, TRADE_WINDOW, ["sku_id"], windows.sums(*dws.SKU_AMOUNTS))


@query
def agg_window_global(spark, sf):
    rows = B.page_log(spark, sf).select("et", F.col("page.during_time").alias("dur_sum"))
    return windows.tumble(rows, windows.WINDOW, [], windows.sums("dur_sum"))


@query
def agg_window_distinct(spark, sf):
    rows = _facts(spark, sf).select(S.event_time_seconds(F.col("ts")).alias("et"),
                                      "province_id", "order_id")
    return windows.tumble_distinct(rows, TRADE_WINDOW, ["province_id"], "order_id",
                                   "order_count", [])


@query
def agg_user_count(spark, sf):
    """Registrations by hour, counted by a user's aggregate."""
    rows = B.registrations(spark, sf).select(
        F.window(S.event_time_millis(F.expr("try_cast(create_time AS bigint)")), HOUR_WINDOW).alias("w"))
    hours = rows.select(F.col("w.start").alias("hour"), F.lit(1).alias("one"))
    return aggregates.aggregate(hours, ["hour"], ["one"], aggregates.Count()).withColumnRenamed("n", "register_ct")


@query
def agg_user_spread(spark, sf):
    rows = B.events(spark, sf).select("event_type", (F.col("k") % 10).alias("last"), "value")
    found = aggregates.aggregate(rows, ["event_type", "last"], ["value"], aggregates.Spread())
    return found.withColumn("variance", F.round("variance", 2))


@query
def win_tumble(spark, sf):
    rows = B.page_log(spark, sf).select("et", F.col("page.page_id").alias("page_id"))
    return windows.tumble(rows, windows.WINDOW, ["page_id"], [F.count(F.lit(1)).alias("n")])


@query
def win_bounds(spark, sf):
    rows = B.page_log(spark, sf).select("et")
    n = [F.count(F.lit(1)).alias("n")]
    by_start = windows.tumble(rows, HOUR_WINDOW, [], n)
    by_end = windows.tumble(rows, HOUR_WINDOW, [], n, day_from="end")
    iso = windows.tumble(rows, HOUR_WINDOW, [], n, day_format=S.DATE)
    return (by_start.select(F.lit("start").alias("day_from"), "*")
            .unionByName(by_end.select(F.lit("end").alias("day_from"), "*"))
            .unionByName(iso.select(F.lit("iso").alias("day_from"), "*")))


# --- keyed state ----------------------------------------------------------------------

@query
def st_is_new_repair(spark, sf):
    log = state.repair_new_visitor(B.behaviour_log(spark, sf).select("common", "ts", "seq"))
    return log.select("seq", "ts", F.col("common.mid").alias("mid"),
                      F.col("common.is_new").alias("is_new"))


def _visits(spark, sf):
    return B.page_log(spark, sf).select(
        "seq", "ts", "et", F.col("common.mid").alias("mid"), F.col("common.sid").alias("sid"),
        F.col("common.uid").alias("uid"), F.col("page.page_id").alias("page_id"))


@query
def st_uv_first_of_day(spark, sf):
    rows = _visits(spark, sf).withColumn("day", F.to_date("et")).drop("et", "uid", "sid")
    return state.flag_first(rows, ["mid", "day"], dws.ORDER, "seq", "uv_ct")


@query
def st_session_first(spark, sf):
    rows = _visits(spark, sf).select("seq", "ts", "sid")
    return state.flag_first(rows, ["sid"], dws.ORDER, "seq", "sv_ct")


@query
def st_home_detail_uv(spark, sf):
    rows = _visits(spark, sf).where(F.col("page_id").isin("home", "good_detail"))
    return dws._day_firsts(rows, ["mid", "page_id"], dws.ORDER).select("seq", "ts", "mid", "page_id")


def _login_back(spark, sf, days):
    rows = etl.logins(B.page_log(spark, sf)).select("seq", "ts", "et",
                                                    F.col("common.uid").alias("uid"))
    visits = state.day_visits(rows, "uid", dws.ORDER)
    return state.returning(visits, days).select("seq", "ts", "uid", "uu_ct", "back_ct")


@query
def st_login_back(spark, sf):
    return _login_back(spark, sf, dws.BACK_AFTER_DAYS)


@query
def st_login_back_1d(spark, sf):
    return _login_back(spark, sf, 1)


@query
def st_cart_uu(spark, sf):
    rows = _carts(spark, sf).select("ts", "user_id").withColumn(
        "et", S.event_time_seconds(F.col("ts")))
    return dws._day_firsts(rows, ["user_id"], ["ts"]).select("user_id", "ts")


def _users(facts, unique, new):
    rows = facts.select("ts", "user_id").withColumn("et", S.event_time_seconds(F.col("ts")))
    visits = state.day_visits(rows, "user_id", ["ts"])
    return state.unique_and_new(visits, unique, new).select("user_id", "ts", unique, new)


@query
def st_order_uu_new(spark, sf):
    return _users(_facts(spark, sf), "uu_ct", "new_ct")


@query
def st_pay_uu_new(spark, sf):
    return _users(_paid(spark, sf), "uu_ct", "new_ct")


@query
def st_dedup_first(spark, sf):
    rows = _facts(spark, sf).select(
        "id", "ts", "sku_id", "order_id", "province_id",
        S.amount(F.col("split_total_amount")).alias("order_amount"))
    return state.first_rows(rows, ["id"], dws.DETAIL_ORDER)


@query
def st_delta_correct(spark, sf):
    groups = dws.sku_deltas(_facts(spark, sf))
    return state.delta_rows(groups, dws.SKU_AMOUNTS, dws.SKU_CARRY)


# --- facts ----------------------------------------------------------------------------

@query
def dwd_comment(spark, sf):
    return dwd.comment(_changes(spark, sf, "comment_info"), B.dictionary(spark, sf), B.DATABASE)


@query
def dwd_trade_cart_add(spark, sf):
    return _carts(spark, sf)


@query
def dwd_trade_order_detail(spark, sf):
    return _details(spark, sf)


@query
def dwd_trade_order_cancel(spark, sf):
    return dwd.order_cancel(_changes(spark, sf, "order_info"), _details(spark, sf), B.DATABASE)


@query
def dwd_trade_pay_suc(spark, sf):
    return _paid(spark, sf, _details)


@query
def dwd_trade_refund(spark, sf):
    return _refunds(spark, sf)


@query
def dwd_refund_pay_suc(spark, sf):
    log = _changes(spark, sf, "refund_payment", "order_refund_info", "order_info")
    return dwd.refund_payment(log, B.dictionary(spark, sf), B.DATABASE)


# --- from the mixed log, through stored layers ------------------------------------------

def _split_log(spark, sf):
    """The raw log of all order tables, parsed once and stored by source table and type."""
    path = layers.folder(spark, "changes")
    layers.split_changes(decode.change_log(B.raw_order_changes(spark, sf)), path)
    return layers.changes(spark, path)


def _stored(spark, facts, name):
    """A fact table as its readers find it."""
    path = layers.folder(spark, name)
    layers.put_facts(facts, path)
    return spark.read.schema(facts.schema).parquet(path)


@query
def log_order_detail(spark, sf):
    return dwd.order_detail(_split_log(spark, sf), B.DATABASE)


@query
def log_refund(spark, sf):
    return dwd.order_refund(_split_log(spark, sf), B.dictionary(spark, sf), B.DATABASE)


@query
def log_refund_pay_suc(spark, sf):
    return dwd.refund_payment(_split_log(spark, sf), B.dictionary(spark, sf), B.DATABASE)


@query
def log_pay_suc(spark, sf):
    log = _split_log(spark, sf)
    details = _stored(spark, dwd.order_detail(log, B.DATABASE, by_order=True), "details")
    return dwd.order_payment(log, details, B.dictionary(spark, sf), B.DATABASE, *PAY_INTERVAL)


@query
def log_province_order(spark, sf):
    details = _stored(spark, dwd.order_detail(_split_log(spark, sf), B.DATABASE, by_order=True), "details")
    return dws.province_order(details, B.provinces(spark, sf), TRADE_WINDOW)


# --- windowed tables ------------------------------------------------------------------

def _pages(spark, sf):
    """Page facts as the layers make them: raw text, parsed, the visitor flag repaired."""
    return dwd.page(dwd.base_log(decode.behaviour_log(B.raw_behaviour(spark, sf))))


@query
def dws_traffic(spark, sf):
    return dws.traffic_of_log(decode.behaviour_log(B.raw_behaviour(spark, sf)), PAGE_WINDOW)


@query
def dws_home_detail(spark, sf):
    return dws.home_detail(_pages(spark, sf), PAGE_WINDOW)


@query
def dws_keyword(spark, sf):
    return dws.keyword(_pages(spark, sf), PAGE_WINDOW)


@query
def dws_user_login(spark, sf):
    return dws.user_login(_pages(spark, sf), PAGE_WINDOW)


@query
def dws_user_register(spark, sf):
    return dws.user_register(B.registrations(spark, sf), HOUR_WINDOW)


@query
def dws_cart_uu(spark, sf):
    return dws.cart_users(_carts(spark, sf), PAGE_WINDOW)


@query
def dws_order(spark, sf):
    return dws.order_users(_facts(spark, sf), TRADE_WINDOW)


@query
def dws_payment(spark, sf):
    return dws.payment_users(_paid(spark, sf), TRADE_WINDOW)


@query
def dws_province_order(spark, sf):
    return dws.province_order(_facts(spark, sf), B.provinces(spark, sf), TRADE_WINDOW)


@query
def dws_refund(spark, sf):
    return dws.refund(_refunds(spark, sf), B.dimensions(spark, sf), TRADE_WINDOW)


@query
def dws_sku_order(spark, sf):
    return dws.sku_order(_facts(spark, sf), B.dimensions(spark, sf), TRADE_WINDOW)


# --- reports, over all days -------------------------------------------------------------

def _report(name: str, build, *tables) -> None:
    def run(spark, sf):
        return build(*[t(spark, sf) for t in tables])
    run.__name__ = name
    query(run)


def _traffic_by_hour(spark, sf):
    return dws.traffic_of_log(decode.behaviour_log(B.raw_behaviour(spark, sf)), HOUR_WINDOW)


def _sku_amounts(spark, sf):
    return dws.sku_amounts(_facts(spark, sf), TRADE_WINDOW)


_report("ads_activity", ads.activity, _sku_amounts)
_report("ads_coupon", ads.coupon, _sku_amounts)
_report("ads_trademark", ads.trademark, dws_sku_order, dws_refund)
_report("ads_trademark_amount", ads.trademark_amount, dws_sku_order)
_report("ads_category", ads.category, dws_sku_order, dws_refund)
_report("ads_spu", ads.spu_amount, dws_sku_order)
_report("ads_total_amount", ads.total_amount, dws_province_order)
_report("ads_trade_stats", ads.trade_stats, dws_province_order, dws_order, dws_refund)
_report("ads_province_ct", ads.province_count, dws_province_order)
_report("ads_province_amount", ads.province_amount, dws_province_order)
_report("ads_channel_uv", ads.channel_uv, dws_traffic)
_report("ads_channel_sv", ads.channel_sv, dws_traffic)
_report("ads_channel_pv_per_session", ads.channel_pv_per_session, dws_traffic)
_report("ads_channel_dur_per_session", ads.channel_dur_per_session, dws_traffic)
_report("ads_channel_bounce", ads.channel_bounce, dws_traffic)
_report("ads_keywords", ads.keywords, dws_keyword)
_report("ads_visitor_per_hour", ads.visitors_per_hour, _traffic_by_hour)
_report("ads_visitor_type", ads.visitor_types, dws_traffic)
_report("ads_visitor_type_pivot", ads.visitor_type_table, dws_traffic)
_report("ads_user_change", ads.user_change, dws_user_login, dws_user_register)
_report("ads_uv_by_page", ads.uv_by_page, dws_home_detail, dws_cart_uu, dws_order, dws_payment)
_report("ads_trade_users", ads.trade_users, dws_order, dws_payment)


# --- reports of one day, over stored days -------------------------------------------------

def _days(spark, sf, build):
    """A windowed table, stored by day."""
    table = build(spark, sf)
    path = layers.folder(spark, build.__name__.strip("_"))
    layers.put_days(table, path)
    return layers.days(spark, path, table.schema)


def _day_report(name: str, build, *tables) -> None:
    """The report of the newest day of its last table, given as yyyyMMdd."""
    def run(spark, sf):
        stored = [_days(spark, sf, t) for t in tables]
        newest = stored[-1].agg(F.max("cur_date")).first()[0]
        return build(*stored, date=(newest or "19700101").replace("-", ""))
    run.__name__ = name
    query(run)


_day_report("ads_channel_uv_day", ads.channel_uv, dws_traffic)
_day_report("ads_visitor_type_day", ads.visitor_types, dws_traffic)
_day_report("ads_visitor_per_hour_day", ads.visitors_per_hour, _traffic_by_hour)
_day_report("ads_keywords_day", ads.keywords, dws_keyword)
_day_report("ads_province_amount_day", ads.province_amount, dws_province_order)
_day_report("ads_trademark_day", ads.trademark, dws_sku_order, dws_refund)
_day_report("ads_category_day", ads.category, dws_sku_order, dws_refund)
_day_report("ads_trade_stats_day", ads.trade_stats, dws_province_order, dws_order, dws_refund)
