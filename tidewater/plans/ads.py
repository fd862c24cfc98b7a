"""Reports over the windowed tables. A date (yyyyMMdd) selects one day partition, TODAY that
of the day on which the report is asked for; without one the report covers all days of the
table given."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S


#: Stands for the current day, in the time zone of the session.
TODAY = "today"


def _asked(table: DataFrame, date: str | int) -> str:
    if date != TODAY:
        return str(date)
    return table.sparkSession.sql("SELECT date_format(current_date(), 'yyyyMMdd')").first()[0]


def of_day(table: DataFrame, date: str | int | None) -> DataFrame:
    """One day of a table. On a partitioned table this reads that partition only."""
    return table if date is None else table.where(F.col("cur_date") == _asked(table, date))


def of_iso_day(table: DataFrame, date: str | int | None) -> DataFrame:
    """One day of a table whose day is kept as yyyy-MM-dd."""
    if date is None:
        return table
    d = _asked(table, date)
    return table.where(F.col("cur_date") == f"{d[:4]}-{d[4:6]}-{d[6:]}")


def _total(name: str, source: str | None = None) -> Column:
    return F.sum(source or name).alias(name)


# --- promotions -----------------------------------------------------------------------

def _reduction(sku: DataFrame, date, column: str, amount: str, rate: str) -> DataFrame:
    totals = of_day(sku, date).agg(_total(amount, column),
                                   _total("origin_total_amount", "original_amount"))
    return totals.withColumn(rate, S.ratio(F.col(amount), F.col("origin_total_amount")))


def activity(sku: DataFrame, date=None) -> DataFrame:
    return _reduction(sku, date, "activity_reduce_amount", "activity_reduce_amount",
                      "activity_subsidy_rate")


def coupon(sku: DataFrame, date=None) -> DataFrame:
    return _reduction(sku, date, "coupon_reduce_amount", "coupon_reduce_amount",
                      "coupon_subsidy_rate")


# --- products -------------------------------------------------------------------------

def _orders_and_refunds(sku: DataFrame, refund: DataFrame, date, ids: list[str],
                        names: list[str], merge_names: bool) -> DataFrame:
    """Order amount against refunds per id, keeping ids that have only one of them.
    Names are the order side's; merge_names fills them from the refund side."""
    orders = of_day(sku, date).groupBy(*ids, *names).agg(_total("order_amount"))
    refunds = (of_iso_day(refund, date).groupBy(*ids, *names)
               .agg(_total("refund_count"), F.count_distinct("user_id").alias("refund_uu_count"))
               .withColumnsRenamed({c: f"r_{c}" for c in (*ids, *names)}))
    on = [orders[i] == refunds[f"r_{i}"] for i in ids]
    both = orders.join(refunds, on, "full_outer")
    shown = [(F.coalesce(n, f"r_{n}") if merge_names else F.col(n)).alias(n) for n in names]
    return both.select(*shown, "order_amount", "refund_count", "refund_uu_count")


def trademark(sku: DataFrame, refund: DataFrame, date=None, merge_names=False) -> DataFrame:
    return _orders_and_refunds(sku, refund, date, ["trademark_id"], ["trademark_name"],
                               merge_names)


def category(sku: DataFrame, refund: DataFrame, date=None, merge_names=False) -> DataFrame:
    levels = (1, 2, 3)
    return _orders_and_refunds(sku, refund, date, [f"category{i}_id" for i in levels],
                               [f"category{i}_name" for i in levels], merge_names)


def trademark_amount(sku: DataFrame, date=None) -> DataFrame:
    return (of_day(sku, date).groupBy("trademark_id", "trademark_name")
            .agg(_total("order_amount")).drop("trademark_id"))


def spu_amount(sku: DataFrame, date=None) -> DataFrame:
    return (of_day(sku, date).groupBy("spu_id", "spu_name")
            .agg(_total("order_amount")).drop("spu_id"))


# --- trade ----------------------------------------------------------------------------

def total_amount(province: DataFrame, date=None) -> DataFrame:
    return of_day(province, date).agg(_total("order_total_amount", "order_amount"))


def _labelled(rows: DataFrame, key: str, name: str, measures: dict[str, Column]) -> DataFrame:
    """Totals of one table, one labelled row each, from one pass over it."""
    labels = list(measures)
    totals = rows.agg(*[m.alias(f"m{i}") for i, m in enumerate(measures.values())])
    pairs = F.array(*[F.struct(F.lit(label).alias(key), F.col(f"m{i}").alias(name))
                      for i, label in enumerate(labels)])
    return totals.select(F.inline(pairs))


def _stack(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


# Labels of the trade report.
ORDERS, ORDERING_USERS, REFUNDS, REFUNDING_USERS = "订单数", "下单人数", "退单数", "退单人数"


def trade_stats(province: DataFrame, order_users: DataFrame, refund: DataFrame,
                date=None) -> DataFrame:
    return _stack(
        _labelled(of_day(province, date), "type", "value", {ORDERS: F.sum("order_count")}),
        _labelled(of_day(order_users, date), "type", "value",
                  {ORDERING_USERS: F.sum("order_unique_user_count")}),
        _labelled(of_iso_day(refund, date), "type", "value",
                  {REFUNDS: F.sum("refund_count"),
                   REFUNDING_USERS: F.count_distinct("user_id")}))


def province_count(province: DataFrame, date=None) -> DataFrame:
    return (of_day(province, date).groupBy("province_id", "province_name")
            .agg(_total("order_count")).drop("province_id"))


def province_amount(province: DataFrame, date=None) -> DataFrame:
    return (of_day(province, date).groupBy("province_id", "province_name")
            .agg(_total("order_amount")).drop("province_id"))


# --- traffic --------------------------------------------------------------------------

def _by_channel(traffic: DataFrame, date, value: Column, name: str) -> DataFrame:
    return (of_day(traffic, date).groupBy("ch").agg(value.alias(name))
            .orderBy(F.desc(name), "ch"))


def channel_uv(traffic: DataFrame, date=None) -> DataFrame:
    return _by_channel(traffic, date, F.sum("uv_ct"), "uv_ct")


def channel_sv(traffic: DataFrame, date=None) -> DataFrame:
    return _by_channel(traffic, date, F.sum("sv_ct"), "sv_ct")


def channel_pv_per_session(traffic: DataFrame, date=None) -> DataFrame:
    return _by_channel(traffic, date, S.ratio(F.sum("pv_ct"), F.sum("sv_ct")), "pv_per_session")


def channel_dur_per_session(traffic: DataFrame, date=None) -> DataFrame:
    return _by_channel(traffic, date, S.ratio(F.sum("dur_sum"), F.sum("sv_ct")),
                       "dur_per_session")


def channel_bounce(traffic: DataFrame, date=None) -> DataFrame:
    return _by_channel(traffic, date, S.ratio(F.sum("uj_ct"), F.sum("sv_ct")), "uj_rate")


def keywords(keyword: DataFrame, date=None) -> DataFrame:
    score = F.sum(F.col("keyword_count") * S.keyword_weight(F.col("source")))
    return (of_day(keyword, date).groupBy("keyword").agg(score.alias("keyword_score"))
            .orderBy(F.desc("keyword_score"), "keyword"))


def visitors_per_hour(traffic: DataFrame, date=None, fill: bool = True) -> DataFrame:
    """Visitors, views and new visitors per hour; with fill all 24 hours, as labels."""
    hour = F.hour(F.to_timestamp("stt", S.DATETIME))
    per_hour = (of_day(traffic, date).withColumn("hr", hour).groupBy("hr").agg(
        _total("uv_ct"), _total("pv_ct"),
        F.sum(F.when(F.col("is_new") == "1", F.col("uv_ct")).otherwise(0)).alias("new_uv_ct")))
    if not fill:
        return per_hour
    hours = traffic.sparkSession.range(24).select(F.col("id").cast("int").alias("hr"))
    return hours.join(per_hour, "hr", "left").select(
        F.lpad(F.col("hr").cast("string"), 2, "0").alias("hr"),
        *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("uv_ct", "pv_ct", "new_uv_ct")])


def visitor_types(traffic: DataFrame, date=None) -> DataFrame:
    """Sums per new-visitor flag with bounce rate, seconds and pages per session."""
    names = ("uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum")
    sv = F.col("sv_ct")
    return (of_day(traffic, date).groupBy("is_new").agg(*[_total(n) for n in names])
            .select("is_new", *names,
                    S.guarded_ratio(F.col("uj_ct"), sv).alias("uj_rate"),
                    (S.guarded_ratio(F.col("dur_sum"), sv) / 1000).alias("avg_dur_sum"),
                    S.guarded_ratio(F.col("pv_ct"), sv).alias("avg_pv_ct")))


def visitor_type_table(traffic: DataFrame, date=None) -> DataFrame:
    """The same as a table of five measures by new and old visitors; a type that did
    not occur shows 0."""
    measures = {"uv_ct": "uv_ct", "pv_ct": "pv_ct", "uj_rate": "uj_rate",
                "avg_dur_sum": "avg_dur_sum", "avg_pv_ct": "avg_pv_ct"}
    rows = visitor_types(traffic, date).select(
        F.when(F.col("is_new") == "1", "new_visitor").otherwise("old_visitor").alias("kind"),
        *[F.col(c).cast("double").alias(c) for c in measures])
    tall = rows.unpivot("kind", list(measures), "type", "value")
    return (tall.groupBy("type").pivot("kind", ["new_visitor", "old_visitor"])
            .agg(F.sum("value")).fillna(0.0))


# --- users ----------------------------------------------------------------------------

def user_change(login: DataFrame, register: DataFrame, date=None) -> DataFrame:
    return _stack(
        _labelled(of_day(login, date), "type", "user_ct",
                  {"backCt": F.sum("back_ct"), "activeUserCt": F.sum("uu_ct")}),
        _labelled(of_day(register, date), "type", "user_ct",
                  {"newUserCt": F.sum("register_ct")}))


def uv_by_page(home_detail: DataFrame, cart: DataFrame, order: DataFrame, payment: DataFrame,
               date=None) -> DataFrame:
    def part(table, **measures):
        return _labelled(of_day(table, date), "page_id", "uv_ct",
                         {label: F.sum(c) for label, c in measures.items()})
    return _stack(part(home_detail, home="home_uv_ct", good_detail="good_detail_uv_ct"),
                  part(cart, cart="cart_add_uu_ct"),
                  part(order, trade="order_unique_user_count"),
                  part(payment, payment="payment_suc_unique_user_count"))


def trade_users(order: DataFrame, payment: DataFrame, date=None) -> DataFrame:
    return _stack(
        _labelled(of_day(order, date), "trade_type", "user_ct",
                  {"order": F.sum("order_new_user_count")}),
        _labelled(of_day(payment, date), "trade_type", "user_ct",
                  {"payment": F.sum("payment_suc_new_user_count")}))
