"""Windowed tables from facts and page records, on batch and stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import etl, joins, state
from ..operators.windows import WINDOW, grouped, stamped, sums, tumble, tumble_distinct, with_lateness
from . import dwd

ORDER = ["ts", "seq"]
TRAFFIC_KEYS = ["vc", "ch", "ar", "is_new"]
BACK_AFTER_DAYS = 7


def _zero(name: str):
    return F.lit(0).cast("long").alias(name)


def _one(name: str):
    return F.lit(1).cast("long").alias(name)


def _timed(facts: DataFrame) -> DataFrame:
    """Facts with event time et; ts is epoch seconds."""
    if "et" not in facts.columns:
        facts = facts.withColumn("et", S.event_time_seconds(F.col("ts")))
    return with_lateness(facts)


def _day_firsts(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """First row of each key and day."""
    if df.isStreaming:
        from ..streaming.state import first_of_day
        return first_of_day(df, keys, order)
    return (state.first_rows(df.withColumn("_day", F.to_date("et")), [*keys, "_day"], order)
            .drop("_day"))


def _day_visits(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    if df.isStreaming:
        from ..streaming.state import day_visits
        return day_visits(df, [key], order)
    return state.day_visits(df, key, order)


# --- traffic ------------------------------------------------------------------------

def traffic(pages: DataFrame, size: str = WINDOW, session_ttl: str = "1 hour") -> DataFrame:
    """Visitors, sessions, views, time and one-page sessions by version, channel,
    area and new-visitor flag.

    A batch is read once: each view counts for its window, for the visitor's day and for the
    session, and these three are aggregated, before and after one shuffle, to what the
    window gets from them. No task gets all rows of a busy visitor or session. uj_ct is our
    addition; on a stream it is written by bounces() and is 0 here.

    On a stream the measures come from three flows of narrow rows that are added up in one
    window. The first views come from keyed state, which remembers a visitor's day for
    a day and a session for its TTL. All flows have the same lateness, so their windows
    close together.
    """
    rows = pages.select(
        "et", *ORDER, F.col("common.mid").alias("mid"), F.col("common.sid").alias("sid"),
        *[F.col(f"common.{k}").alias(k) for k in TRAFFIC_KEYS],
        F.col("page.during_time").alias("dur_sum"))
    if not rows.isStreaming:
        first = F.struct(*ORDER)
        return _traffic(rows.select(
            F.window("et", size).alias("window"), F.to_date("et").alias("day"), "mid", "sid", *TRAFFIC_KEYS,
            first.alias("first"), _one("pv_ct"), "dur_sum"))
    from ..streaming.state import first_of_keys
    rows = with_lateness(rows)
    views = rows.select(
        "et", *TRAFFIC_KEYS, _zero("uv_ct"), _zero("sv_ct"), _one("pv_ct"), "dur_sum",
        _zero("uj_ct"))
    by_day = rows.select("et", *ORDER, "mid", *TRAFFIC_KEYS, F.to_date("et").alias("day"))
    narrow = rows.select("et", *ORDER, "sid", *TRAFFIC_KEYS)
    visitors = first_of_keys(by_day, ["mid", "day"], "1 day", ORDER)
    sessions = first_of_keys(narrow, ["sid"], session_ttl, ORDER)
    visitors = visitors.select("et", *TRAFFIC_KEYS, _one("uv_ct"), _zero("sv_ct"),
                               _zero("pv_ct"), _zero("dur_sum"), _zero("uj_ct"))
    sessions = sessions.select("et", *TRAFFIC_KEYS, _zero("uv_ct"), _one("sv_ct"),
                               _zero("pv_ct"), _zero("dur_sum"), _zero("uj_ct"))
    flows = views.unionByName(visitors).unionByName(sessions)
    return tumble(flows, size, TRAFFIC_KEYS, sums(*TRAFFIC_MEASURES))


TRAFFIC_MEASURES = ["uv_ct", "sv_ct", "pv_ct", "dur_sum", "uj_ct"]
# What a view, or a group of views, counts for: its window, its visitor's day, its session. The
# last two are of the window and keys of their first view, `at`.
TRAFFIC_FLOWS = """inline(array(
    named_struct('kind', 'view', 'who', string(null), 'day', date(null), 'window', window,
                 'vc', vc, 'ch', ch, 'ar', ar, 'is_new', is_new, 'at', if(true, null, {at}), 'pv_ct', pv_ct, 'dur_sum', dur_sum),
    named_struct('kind', 'visitor', 'who', string(mid), 'day', day, 'window', if(true, null, window),
                 'vc', string(null), 'ch', string(null), 'ar', string(null), 'is_new', string(null), 'at', {at},
                 'pv_ct', 0L, 'dur_sum', 0L),
    named_struct('kind', 'session', 'who', string(sid), 'day', date(null), 'window', if(true, null, window),
                 'vc', string(null), 'ch', string(null), 'ar', string(null), 'is_new', string(null), 'at', {at},
                 'pv_ct', pv_ct, 'dur_sum', 0L)))""".format(
    at="named_struct('first', first, 'window', window, 'vc', vc, 'ch', ch, 'ar', ar, 'is_new', is_new)")


def _traffic(views: DataFrame) -> DataFrame:
    """The traffic table from views, or from groups of views with the same window, day,
    visitor, session and keys; `first` orders them."""
    met = (views.selectExpr(TRAFFIC_FLOWS).groupBy("kind", "who", "day", "window", *TRAFFIC_KEYS)
           .agg(F.expr("min(at) AS at"), F.expr("sum(pv_ct) AS pv_ct"), F.expr("sum(dur_sum) AS dur_sum")))
    rows = met.selectExpr(
        "coalesce(window, at.window) AS window",
        *[f"if(kind = 'view', {k}, at.{k}) AS {k}" for k in TRAFFIC_KEYS],
        "bigint(kind = 'visitor') AS uv_ct", "bigint(kind = 'session') AS sv_ct",
        "if(kind = 'view', pv_ct, 0L) AS pv_ct", "if(kind = 'view', dur_sum, 0L) AS dur_sum",
        "bigint(kind = 'session' AND pv_ct = 1) AS uj_ct")
    return stamped(rows.groupBy("window", *TRAFFIC_KEYS).agg(*sums(*TRAFFIC_MEASURES)))


def traffic_of_log(log: DataFrame, size: str = WINDOW) -> DataFrame:
    """The traffic table from the behaviour log, the visitor flag repaired on the way.

    A batch parses and shuffles the log once: records of one visitor, session, window and keys
    become one row. The first days of visitors come from these rows, through the same shuffle,
    and are joined to them."""
    if log.isStreaming:
        return traffic(dwd.page(dwd.base_log(log)), size)
    viewed = F.col("page").isNotNull().cast("long")
    records = log.select(
        F.window("et", size).alias("window"), F.to_date("et").alias("day"), F.col("common.mid").alias("mid"),
        F.col("common.sid").alias("sid"), *[F.col(f"common.{k}").alias(k) for k in TRAFFIC_KEYS],
        viewed.alias("viewed"), F.struct(*ORDER).alias("first"), F.col("page.during_time").alias("dur_sum"))
    groups = records.groupBy("window", "day", "mid", "sid", *TRAFFIC_KEYS, "viewed").agg(
        F.min("first").alias("first"), F.sum("viewed").alias("pv_ct"), *sums("dur_sum"))
    # All columns take part in the minimum, behind those that decide it, and views are chosen by
    # their number: with another choice of columns or rows below, Spark would not see that both
    # sides of the join start from the same shuffle.
    rest = [c for c in groups.columns if c not in ("first", "is_new", "day", "mid")]
    opened = groups.groupBy(F.col("mid").alias("_mid")).agg(F.min(F.struct("first", "is_new", "day", *rest)).alias("m"))
    stored = opened.select("_mid", state.first_day(F.col("m.is_new"), F.col("m.day")).alias("_stored"))
    joined = groups.join(stored, F.col("mid").eqNullSafe(F.col("_mid")), "left").where("pv_ct > 0")
    is_new = F.when(F.col("mid").isNull(), F.col("is_new")).otherwise(
        state.repaired_flag(F.col("is_new"), F.col("day"), F.col("_stored")))
    return _traffic(joined.withColumn("is_new", is_new).drop("viewed", "_mid", "_stored"))


def bounces(pages: DataFrame, size: str = WINDOW, gap: str = "1 hour") -> DataFrame:
    """Sessions of one page view as further rows of the traffic table, for streams.

    That a session has one view is known only after it has been quiet for the gap, long
    after the window of the view went out. The row adds to that window's others: the
    reports sum over rows.
    """
    rows = with_lateness(pages.select(
        "et", *ORDER, F.col("common.sid").alias("sid"),
        *[F.col(f"common.{k}").alias(k) for k in TRAFFIC_KEYS]))
    first = F.min(F.struct(*ORDER, "et", *TRAFFIC_KEYS)).alias("first")
    sessions = (rows.groupBy(F.session_window("et", gap), "sid")
                .agg(first, F.count(F.lit(1)).alias("n")).where("n = 1").select("first.*"))
    at = sessions.withColumn("w", F.window("et", size))
    return at.select(
        F.date_format("w.start", S.DATETIME).alias("stt"),
        F.date_format("w.end", S.DATETIME).alias("edt"),
        F.date_format("w.start", S.PARTITION_DATE).alias("cur_date"), *TRAFFIC_KEYS,
        _zero("uv_ct"), _zero("sv_ct"), _zero("pv_ct"), _zero("dur_sum"), _one("uj_ct"))


def home_detail(pages: DataFrame, size: str = WINDOW) -> DataFrame:
    """Daily visitors of the home page and of the product page."""
    page = F.col("page.page_id")
    rows = with_lateness(pages.where(page.isin("home", "good_detail")).select(
        "et", *ORDER, F.col("common.mid").alias("mid"), page.alias("page_id")))
    firsts = _day_firsts(rows, ["mid", "page_id"], ORDER).select(
        "et", (F.col("page_id") == "home").cast("long").alias("home_uv_ct"),
        (F.col("page_id") == "good_detail").cast("long").alias("good_detail_uv_ct"))
    return tumble(firsts, size, [], sums("home_uv_ct", "good_detail_uv_ct"))


def keyword(pages: DataFrame, size: str = WINDOW, words=S.words) -> DataFrame:
    """Words of search keywords. source is our addition, for the keyword score."""
    rows = with_lateness(etl.searches(pages).select("et", F.col("page")["item"].alias("kw")))
    split = joins.lateral_words(rows, "kw", words(F.col("kw")))
    counted = tumble(split, size, ["keyword"], [F.count(F.lit(1)).alias("keyword_count")])
    return counted.withColumn("source", F.lit("SEARCH"))


# --- users --------------------------------------------------------------------------

def user_login(pages: DataFrame, size: str = WINDOW,
               back_after_days: int = BACK_AFTER_DAYS) -> DataFrame:
    """Users logged in that day, and those back after a longer time."""
    rows = with_lateness(etl.logins(pages).select("et", *ORDER, F.col("common.uid").alias("uid")))
    flagged = state.returning(_day_visits(rows, "uid", ORDER), back_after_days)
    return tumble(flagged, size, [], sums("back_ct", "uu_ct"))


def user_register(registrations: DataFrame, size: str = WINDOW) -> DataFrame:
    """Registrations by their creation time in epoch milliseconds."""
    rows = with_lateness(registrations.select(
        S.event_time_millis(F.expr("try_cast(create_time AS bigint)")).alias("et")))
    return tumble(rows, size, [], [F.count(F.lit(1)).alias("register_ct")], day_from="end")


# --- trade --------------------------------------------------------------------------

def cart_users(carts: DataFrame, size: str = WINDOW) -> DataFrame:
    rows = _timed(carts).select("et", "ts", "user_id")
    firsts = _day_firsts(rows, ["user_id"], ["ts"]).select("et", _one("cart_add_uu_ct"))
    return tumble(firsts, size, [], sums("cart_add_uu_ct"))


def _trade_users(facts: DataFrame, size: str, unique: str, new: str) -> DataFrame:
    rows = _timed(facts).select("et", "ts", "user_id")
    flagged = state.unique_and_new(_day_visits(rows, "user_id", ["ts"]), unique, new)
    return tumble(flagged, size, [], sums(unique, new))


def order_users(details: DataFrame, size: str = WINDOW) -> DataFrame:
    """Users ordering that day, and ordering for the first time."""
    return _trade_users(details, size, "order_unique_user_count", "order_new_user_count")


def payment_users(paid: DataFrame, size: str = WINDOW) -> DataFrame:
    return _trade_users(paid, size, "payment_suc_unique_user_count",
                        "payment_suc_new_user_count")


# Total order of repeated order details, equal rows aside.
DETAIL_ORDER = ["ts", "sku_id", "province_id", "order_id", "order_amount"]


def province_order(details: DataFrame, provinces: DataFrame, size: str = WINDOW) -> DataFrame:
    """Orders and amount by province, each order detail counted once. Streaming provinces
    are the changes of the dimension."""
    rows = _timed(details).select(
        "et", "ts", "id", "sku_id", "order_id", "province_id",
        S.amount(F.col("split_total_amount")).alias("order_amount"))
    if rows.isStreaming:
        from ..streaming.state import first_of_session
        once = first_of_session(rows, "id", None, DETAIL_ORDER)
    else:
        once = state.first_rows(rows, ["id"], DETAIL_ORDER)
    table = tumble_distinct(once, size, ["province_id"], "order_id", "order_count",
                            ["order_amount"])
    return joins.enrich(table, provinces, "province_id", {"province_name": "name"})


def refund(refunds: DataFrame, dims: dict[str, DataFrame], size: str = WINDOW,
           wait: str | None = None) -> DataFrame:
    """Refunded orders by brand, category and user. Brand and category are group
    keys, so the product comes in before the window and the names after it.

    Streaming dims are the dimensions' changes (plans.dim.changes): a refund gets the product as it
    is when it comes. With `wait` one whose product is not there yet waits for it; if its
    window is closed by then, it makes a further row of that window."""
    rows = _timed(refunds).select("et", "order_id", "sku_id", "user_id")
    product = {"trademark_id": "tm_id", "category3_id": "category3_id"}
    keys = ["trademark_id", "category3_id", "user_id"]
    own = []
    if dims["sku"].isStreaming:
        from ..streaming import live
        rows = live.lookup(rows, dims["sku"], "sku_id", product, "et", wait)
        if wait is not None:
            rows, own = live.own_window(rows, size), ["_start"]
    else:
        rows = joins.enrich(rows, dims["sku"], "sku_id", product)
    table = tumble_distinct(rows, size, [*keys, *own], "order_id", "refund_count", [],
                            day_format=S.DATE)
    if own:
        table = live.stamped(table, size, S.DATE)
    table = joins.enrich(table, dims["trademark"], "trademark_id", {"trademark_name": "tm_name"})
    return joins.flatten_category(table, dims)


SKU_AMOUNTS = ["original_amount", "activity_reduce_amount", "coupon_reduce_amount",
               "order_amount"]
SKU_CARRY = ["et", "sku_id"]


def sku_facts(details: DataFrame) -> DataFrame:
    return _timed(details).select(
        "et", "id", "sku_id",
        S.amount(F.col("split_original_amount")).alias("original_amount"),
        S.amount_or_zero(F.col("split_activity_amount")).alias("activity_reduce_amount"),
        S.amount_or_zero(F.col("split_coupon_amount")).alias("coupon_reduce_amount"),
        S.amount(F.col("split_total_amount")).alias("order_amount"))


def sku_deltas(details: DataFrame) -> DataFrame:
    """Repeated order details as corrections of the one before, copies counted."""
    return state.delta_groups(sku_facts(details), "id", "et", [*SKU_CARRY, *SKU_AMOUNTS],
                              SKU_AMOUNTS, SKU_CARRY)


def sku_order(details: DataFrame, dims: dict[str, DataFrame], size: str = WINDOW,
              delta_ttl: str = "60 seconds") -> DataFrame:
    """Amounts by sku, repeated details corrected, with the product's names. The names
    come in after the window, so they are looked up per result row; streaming dims are the
    dimensions' changes, and a row gets the names as they are when its window closes."""
    if details.isStreaming:
        from ..streaming.state import delta_correct
        rows = delta_correct(sku_facts(details), "id", SKU_AMOUNTS, ttl=delta_ttl)
        table = tumble(rows, size, ["sku_id"], sums(*SKU_AMOUNTS), day_from="end")
        return joins.enrich_sku(table, dims)
    return stamped(joins.enrich_sku(_sku_windows(details, size), dims), day_from="end")


def sku_amounts(details: DataFrame, size: str = WINDOW) -> DataFrame:
    """The same table of a batch without the product's names, for readers that want amounts alone.
    The names are left joins on unique ids, which neither add nor drop a row, but Spark cannot
    know that and would shuffle the table for them."""
    return stamped(_sku_windows(details, size), day_from="end")


def _sku_windows(details: DataFrame, size: str) -> DataFrame:
    rows = state.delta_sums(sku_deltas(details), SKU_AMOUNTS, SKU_CARRY)
    return grouped(rows, size, ["sku_id"], sums(*SKU_AMOUNTS))
