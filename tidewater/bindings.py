"""The test tables seen as the warehouse's inputs.

events become the behaviour log, the cart and comment changes, and the changes of
configured tables and of the configuration itself; orders and lineitem become the order
here is small by construction, so nothing is broadcast by hint.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import schemas
from .functions import scalars as S
from .session import prepare

DATABASE = "shop"
DAY = 86_400


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A test table, read as it lies."""
    return prepare(spark).read.parquet(f"{sf_dir}/{table}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with k, the number in props, and ts in epoch milliseconds."""
    return load(spark, sf_dir, "events").select(
        F.col("event_id").alias("seq"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("ts"),
        F.col("user_id").cast("string").alias("user"), "event_type", "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"))


def _by_type(**values) -> Column:
    """A value by event type, null for the others."""
    out = F.lit(None)
    for kind, value in values.items():
        out = F.when(F.col("event_type") == kind, value).otherwise(out)
    return out


def _numbered(n: Column, element) -> Column:
    """An array of n elements, null for none."""
    return F.when(n > 0, F.transform(F.sequence(F.lit(1), n), element))


# --- behaviour log --------------------------------------------------------------------

def behaviour_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One behaviour record per event, typed, with event time et."""
    words = load(spark, sf_dir, "benchmark").select(
        F.col("item_id").cast("int").alias("k"), "text")
    k, user = F.col("k"), F.col("user")
    ev = events(spark, sf_dir).join(words, "k", "left")
    day = F.date_format(F.timestamp_millis("ts"), S.DATE)
    common = F.struct(
        user.alias("mid"),
        F.when(k % 10 != 0, user).alias("uid"),
        F.concat_ws("-", user, day).alias("sid"),
        F.concat(F.lit("v"), k % 3).alias("vc"),
        F.concat(F.lit("ch"), k % 5).alias("ch"),
        F.concat(F.lit("ar"), k % 7).alias("ar"),
        F.when(k < 50, "1").otherwise("0").alias("is_new"))
    start = F.when(F.col("event_type") == "signup", F.struct(
        F.lit("icon").alias("entry"), F.col("k").cast("long").alias("loading_time")))
    page = F.struct(
        _by_type(view="home", click="good_detail", purchase="trade", signup="login",
                 error="search").alias("page_id"),
        F.when(k % 4 == 1, "login").when(k % 4 == 2, "search").when(k % 4 == 3, "home")
        .alias("last_page_id"),
        F.when(k % 3 == 0, F.col("text")).otherwise(k.cast("string")).alias("item"),
        F.when(k % 3 == 0, "keyword").otherwise("sku_id").alias("item_type"),
        F.round(F.col("value") * 1000).cast("long").alias("during_time"))
    displays = _numbered(k % 4, lambda i: F.struct(
        F.lit("own").alias("ch"), (k + i).cast("string").alias("item"),
        i.cast("long").alias("pos")))
    actions = _numbered(k % 3, lambda i: F.struct(
        F.concat(F.lit("a"), i).alias("action_id"), F.lit("own").alias("ch"),
        (k - i).cast("string").alias("item"), (F.col("ts") + i).alias("ts")))
    err = F.when(F.col("event_type") == "error", F.struct(
        k.cast("long").alias("error_code"), F.col("event_type").alias("msg")))
    return ev.select(common.alias("common"), start.alias("start"), page.alias("page"),
                     displays.alias("displays"), actions.alias("actions"), err.alias("err"),
                     "ts", "seq", F.timestamp_millis("ts").alias("et"), "k")


# Some events stand for records that are not JSON objects.
BROKEN = {90: "{bad", 91: "[1]", 92: "123", 93: ""}
TOMBSTONE = 94


def _damaged(text: Column) -> Column:
    k = F.col("k")
    out = F.when(k != TOMBSTONE, text)
    for code, value in BROKEN.items():
        out = F.when(k == code, value).otherwise(out)
    return out


def raw_behaviour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The behaviour log as text, damaged records and tombstones included."""
    log = behaviour_log(spark, sf_dir)
    fields = schemas.BEHAVIOUR.names
    return log.select(_damaged(F.to_json(F.struct(*fields))).alias("value"))


def page_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return behaviour_log(spark, sf_dir).select("common", "page", "ts", "seq", "et")


# --- changes of configured tables -------------------------------------------------------

def generic_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of the tables t0 to t7, keyed by user; ts in epoch seconds."""
    k, value = F.col("k"), F.col("value")
    payload = F.create_map(
        F.lit("id"), F.col("user"),
        F.lit("name"), F.when(k >= 20, F.concat(F.lit("n"), k)),
        F.lit("score"), F.round(value).cast("long").cast("string"),
        F.lit("note"), F.lit("internal"))
    none = F.lit(None).cast(schemas.STRING_MAP)
    return events(spark, sf_dir).select(
        F.when(k == 99, "other").otherwise(DATABASE).alias("database"),
        F.concat(F.lit("t"), k % 8).alias("table"),
        _by_type(signup="insert", click="update", view="update", error="delete",
                 purchase="bootstrap-insert").alias("type"),
        F.when(k == 95, none).when(k == 96, F.create_map().cast(schemas.STRING_MAP))
        .otherwise(payload).alias("data"),
        F.when(F.col("event_type").isin("click", "view"),
               F.create_map(F.lit("score"), k.cast("string"))).alias("old"),
        F.floor(F.col("ts") / 1000).alias("ts"), "seq", "k")


def raw_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = generic_changes(spark, sf_dir)
    return log.select(_damaged(F.to_json(F.struct(*schemas.CHANGE.names))).alias("value"))


def _config_op() -> Column:
    return _by_type(signup="c", click="u", view="u", purchase="r", error="d")


def raw_config(spark: SparkSession, sf_dir: str, facts: bool = False) -> DataFrame:
    """Configuration changes as text envelopes, one per event. Each concerns one of the
    tables t0 to t7, for facts also one change type."""
    k = F.col("k")
    table = F.concat(F.lit("t"), F.floor(k / 10) % 8)
    columns = F.when(k % 2 == 0, "id,name").otherwise("id,score")
    if facts:
        row = F.struct(
            table.alias("source_table"),
            F.when(k % 10 < 5, "insert").otherwise("update").alias("source_type"),
            F.concat(F.lit("dwd_"), table).alias("sink_table"),
            columns.alias("sink_columns"))
    else:
        row = F.struct(
            table.alias("source_table"), F.concat(F.lit("dim_"), table).alias("sink_table"),
            columns.alias("sink_columns"), F.lit("info").alias("sink_family"),
            F.lit("id").alias("sink_row_key"))
    op = _config_op()
    body = F.struct(op.alias("op"),
                    F.when(op.isin("u", "d"), row).alias("before"),
                    F.when(op != "d", row).alias("after"), "seq")
    return events(spark, sf_dir).select(F.to_json(body).alias("value"))


# --- order changes ----------------------------------------------------------------------

def _text(column: str) -> Column:
    return F.col(column).cast("string")


def _money(column: str) -> Column:
    return F.col(column).cast(S.MONEY)


def _epoch(column: str) -> Column:
    return F.unix_seconds(F.col(column).cast("timestamp"))


def _datetime(column: str) -> Column:
    return F.date_format(F.col(column).cast("timestamp"), S.DATETIME)


def _map(**values: Column) -> Column:
    return F.create_map(*[x for name, value in values.items()
                          for x in (F.lit(name), value.cast("string"))])


def _change(df: DataFrame, table: str, kind: str, data: Column, old: Column | None,
            ts: Column) -> DataFrame:
    return df.select(
        F.lit(DATABASE).alias("database"), F.lit(table).alias("table"),
        F.lit(kind).alias("type"), data.alias("data"),
        (F.lit(None).cast(schemas.STRING_MAP) if old is None else old).alias("old"),
        ts.cast("long").alias("ts"))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem with the detail id and the discount and tax parts as exact text."""
    return _described(load(spark, sf_dir, "lineitem"))


def _described(lines: DataFrame) -> DataFrame:
    """The same for lines that were joined first. A join that is shuffled then moves what
    lineitem holds, and not these columns as well."""
    price = _money("l_extendedprice")
    return lines.withColumns({
        "id": F.concat_ws("-", "l_orderkey", "l_linenumber"),
        "activity": F.when(F.col("l_discount") > 0,
                           (price * _money("l_discount")).cast(S.AMOUNT)),
        "coupon": F.when(F.col("l_tax") > 0, (price * _money("l_tax")).cast(S.AMOUNT)),
        "ship": _epoch("l_shipdate")})


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = load(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    return load(spark, sf_dir, "orders").join(customer, "o_custkey")


def _payment_code() -> Column:
    return F.substring("o_orderpriority", 1, 1)


def _order_info(spark, sf_dir):
    """Orders placed; cancelled (P), set to refund (F, O) and refunded (F) later."""
    orders = _orders(spark, sf_dir)
    order = dict(id=_text("o_orderkey"), user_id=_text("o_custkey"),
                 province_id=_text("c_nationkey"))
    placed, status = _epoch("o_orderdate"), F.col("o_orderstatus")

    def moved(rows, old, new, days):
        when = placed + days * DAY
        data = _map(**order, order_status=F.lit(new),
                    operate_time=S.millis_to_datetime(when * 1000))
        return _change(rows, "order_info", "update", data, _map(order_status=F.lit(old)), when)

    return [
        _change(orders, "order_info", "insert",
                _map(**order, order_status=F.lit("1001"), create_time=_datetime("o_orderdate")),
                None, placed),
        moved(orders.where(status == "P"), "1001", "1003", 1),
        moved(orders.where(status != "P"), "1002", "1005", 6),
        moved(orders.where(status == "F"), "1005", "1006", 7),
    ]


def _payment_info(spark, sf_dir):
    """Payments five days after the order: successful for F, still open for O."""
    orders = load(spark, sf_dir, "orders").where("o_orderstatus <> 'P'")
    when = _epoch("o_orderdate") + 5 * DAY
    data = _map(order_id=_text("o_orderkey"), user_id=_text("o_custkey"),
                payment_type=_payment_code(),
                payment_status=F.when(F.col("o_orderstatus") == "F", "1602").otherwise("1601"),
                callback_time=S.millis_to_datetime(when * 1000))
    return [_change(orders, "payment_info", "update", data, _map(payment_status=F.lit("1600")),
                    when)]


def _order_detail(spark, sf_dir):
    parts = load(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), "p_name", "p_retailprice")
    rows = _described(load(spark, sf_dir, "lineitem").join(parts, "l_partkey"))
    data = _map(id=F.col("id"), order_id=_text("l_orderkey"), sku_id=_text("l_partkey"),
                sku_name=F.col("p_name"), create_time=_datetime("l_shipdate"),
                sku_num=_money("l_quantity"), order_price=_money("p_retailprice"),
                split_total_amount=_money("l_extendedprice"),
                split_activity_amount=F.col("activity"), split_coupon_amount=F.col("coupon"))
    return [_change(rows, "order_detail", "insert", data, None, F.col("ship"))]


def _order_detail_activity(spark, sf_dir):
    rows = (_lines(spark, sf_dir).where("l_discount > 0.05").groupBy("id")
            .agg(F.min("ship").alias("ship"), F.max("l_suppkey").alias("l_suppkey")))
    data = _map(order_detail_id=F.col("id"), activity_id=_text("l_suppkey"),
                activity_rule_id=F.lit("1"))
    return [_change(rows, "order_detail_activity", "insert", data, None, F.col("ship"))]


def _order_detail_coupon(spark, sf_dir):
    rows = (_lines(spark, sf_dir).where("l_tax > 0.04").groupBy("id")
            .agg(F.min("ship").alias("ship"), F.min("l_suppkey").alias("l_suppkey")))
    data = _map(order_detail_id=F.col("id"), coupon_id=_text("l_suppkey"))
    return [_change(rows, "order_detail_coupon", "insert", data, None, F.col("ship"))]


def _returned(spark, sf_dir, with_order: bool):
    rows = load(spark, sf_dir, "lineitem").where("l_returnflag = 'R'")
    if not with_order:
        return _described(rows)
    return _described(rows.join(load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderpriority"), "l_orderkey"))


def _refund_data(**more) -> Column:
    return _map(id=F.col("id"), order_id=_text("l_orderkey"), sku_id=_text("l_partkey"),
                refund_num=_money("l_quantity"), refund_amount=_money("l_extendedprice"), **more)


def _order_refund_info(spark, sf_dir):
    """Refund requests for returned lines, finished a day later where the line is F."""
    asked = _refund_data(
        user_id=_text("o_custkey"), refund_type=_payment_code(),
        refund_reason_type=F.least("l_linenumber", F.lit(5)),
        refund_reason_txt=F.col("l_linestatus"), create_time=_datetime("l_shipdate"),
        refund_status=F.lit("0701"))
    done = _returned(spark, sf_dir, False).where("l_linestatus = 'F'")
    return [
        _change(_returned(spark, sf_dir, True), "order_refund_info", "insert", asked, None,
                F.col("ship")),
        _change(done, "order_refund_info", "update", _refund_data(refund_status=F.lit("0705")),
                _map(refund_status=F.lit("0702")), F.col("ship") + DAY),
    ]


def _refund_payment(spark, sf_dir):
    rows = _returned(spark, sf_dir, True).where("l_linestatus = 'F'")
    data = _map(id=F.col("id"), order_id=_text("l_orderkey"), sku_id=_text("l_partkey"),
                payment_type=_payment_code(),
                callback_time=S.millis_to_datetime((F.col("ship") + DAY) * 1000),
                total_amount=_money("l_extendedprice"), refund_status=F.lit("1602"))
    return [_change(rows, "refund_payment", "update", data, _map(refund_status=F.lit("1601")),
                    F.col("ship") + DAY)]


def order_changes(spark: SparkSession, sf_dir: str, *tables: str) -> DataFrame:
    """Changes of the order, payment, refund, cart and comment tables, or of those
    named. A filter on table and type leaves only the branches it asks for, so a
    reader of one table scans only what that table comes from."""
    parts = [part for name, build in CHANGED.items() if not tables or name in tables
             for part in build(spark, sf_dir)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def raw_order_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The changes of all these tables as one log of text records."""
    log = order_changes(spark, sf_dir)
    return log.select(F.to_json(F.struct(*log.columns)).alias("value"))


def order_detail_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order-detail fact table as its readers find it, without promotions."""
    parts = load(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), "p_name", "p_retailprice")
    orders = _orders(spark, sf_dir).select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "c_nationkey")
    rows = _described(load(spark, sf_dir, "lineitem").join(parts, "l_partkey").join(orders, "l_orderkey"))
    none = F.lit(None).cast("string")
    return rows.select(
        "id", _text("l_orderkey").alias("order_id"), _text("o_custkey").alias("user_id"),
        _text("l_partkey").alias("sku_id"), F.col("p_name").alias("sku_name"),
        _text("c_nationkey").alias("province_id"), none.alias("activity_id"),
        none.alias("activity_rule_id"), none.alias("coupon_id"),
        F.date_format("l_shipdate", S.DATE).alias("date_id"),
        _datetime("l_shipdate").alias("create_time"),
        _money("l_quantity").cast("string").alias("sku_num"),
        (_money("l_quantity") * _money("p_retailprice")).cast(S.AMOUNT).cast("string")
        .alias("split_original_amount"),
        _text("activity").alias("split_activity_amount"),
        _text("coupon").alias("split_coupon_amount"),
        _money("l_extendedprice").cast("string").alias("split_total_amount"),
        F.col("ship").alias("ts"))


def _cart_info(spark, sf_dir):
    """Cart inserts for sign-ups and purchases, quantity updates for views and clicks,
    other updates for errors."""
    k = F.col("k")
    ev = events(spark, sf_dir)
    kind = F.when(F.col("event_type").isin("signup", "purchase"), "insert").otherwise("update")
    data = _map(id=F.col("seq"), user_id=F.col("user"), sku_id=k, sku_num=k % 5 + 1)
    old = (F.when(F.col("event_type").isin("view", "click"), _map(sku_num=k % 7))
           .when(F.col("event_type") == "error", _map(sku_id=k + 1)))
    return [ev.select(
        F.lit(DATABASE).alias("database"), F.lit("cart_info").alias("table"),
        kind.alias("type"), data.alias("data"), old.alias("old"),
        F.floor(F.col("ts") / 1000).alias("ts"))]


def _comment_info(spark, sf_dir):
    ev = events(spark, sf_dir).where("event_type = 'purchase'")
    data = _map(id=F.col("seq"), user_id=F.col("user"), sku_id=F.col("k"),
                appraise=F.col("k") % 6 + 1, comment_txt=F.col("event_type"),
                create_time=S.millis_to_datetime(F.col("ts")))
    return [_change(ev, "comment_info", "insert", data, None, F.floor(F.col("ts") / 1000))]


CHANGED = {
    "order_info": _order_info,
    "payment_info": _payment_info,
    "order_detail": _order_detail,
    "order_detail_activity": _order_detail_activity,
    "order_detail_coupon": _order_detail_coupon,
    "order_refund_info": _order_refund_info,
    "refund_payment": _refund_payment,
    "cart_info": _cart_info,
    "comment_info": _comment_info,
}


def registrations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered users as the configured fact job leaves them."""
    return events(spark, sf_dir).where("event_type = 'signup'").select(
        F.col("user").alias("id"), _text("ts").alias("create_time"))


# --- dimensions -------------------------------------------------------------------------

def dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes and names from the order priorities; one code is left out."""
    p = F.split("o_orderpriority", "-")
    codes = load(spark, sf_dir, "orders").select(
        p[0].alias("dic_code"), p[1].alias("dic_name")).distinct()
    return codes.where("dic_name <> 'NOT SPECIFIED'").select(
        "dic_code", F.struct("dic_name").alias("info"))


def provinces(spark: SparkSession, sf_dir: str) -> DataFrame:
    region = load(spark, sf_dir, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    return load(spark, sf_dir, "nation").join(region, "n_regionkey").select(
        _text("n_nationkey").alias("id"), F.col("n_name").alias("name"),
        F.col("r_name").alias("region"))


def dimensions(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The product snowflake from part: sku, spu, brand, three category levels. One
    brand is left out of its table."""
    part = load(spark, sf_dir, "part")
    kind = F.col("p_type")
    types = part.select("p_type").distinct()
    level2 = F.when(kind.isin("SMALL", "MEDIUM", "LARGE"), "sized").otherwise("plain")
    category2 = types.select(level2.alias("id")).distinct()
    return {
        "sku": part.select(_text("p_partkey").alias("id"), F.col("p_name").alias("sku_name"),
                           F.col("p_name").alias("spu_id"), F.col("p_brand").alias("tm_id"),
                           kind.alias("category3_id")),
        "spu": part.select(F.col("p_name").alias("id"),
                           F.upper("p_name").alias("spu_name")).distinct(),
        "trademark": part.where("p_brand <> 'Brand#13'").select(
            F.col("p_brand").alias("id"), F.upper("p_brand").alias("tm_name")).distinct(),
        "category3": types.select(kind.alias("id"), F.lower(kind).alias("name"),
                                  level2.alias("category2_id")),
        "category2": category2.select("id", F.upper("id").alias("name"),
                                      F.substring("id", 1, 1).alias("category1_id")),
        "category1": category2.select(F.substring("id", 1, 1).alias("id"),
                                      F.initcap("id").alias("name")).distinct(),
    }
