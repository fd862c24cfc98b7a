"""Fact tables from the change log and the behaviour log.

Every function takes and returns DataFrames and works on batch and stream. On a
stream the joins get time bounds, which replace idle-state expiry; a batch holds the
whole input, so there the key alone decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import changelog, etl, joins, state

LATENESS = "3 seconds"
WITHIN = "5 seconds"
PAY_BEFORE, PAY_AFTER = "30 minutes", "5 seconds"
CANCEL_WITHIN = "1805 seconds"


def _table(log: DataFrame, database: str, table: str, kind: str, where: Column | None,
           prefix: str, *keys: str, **renamed: str) -> DataFrame:
    """Payload columns of one table's changes, its times under a prefix."""
    rows = etl.table_changes(log, database, table, kind)
    if where is not None:
        rows = rows.where(where)
    rows = etl.pick(rows, *keys, **renamed)
    if "et" not in rows.columns:
        rows = rows.withColumn("et", S.event_time_seconds(F.col("ts")))
    if rows.isStreaming:
        rows = rows.withWatermark("et", LATENESS)
    return rows.withColumnsRenamed({"ts": f"{prefix}ts", "et": f"{prefix}et"})


def _near(left: DataFrame, on: Column, left_time: str, right_time: str,
          before: str = WITHIN, after: str = WITHIN) -> Column:
    """The join condition, on a stream with the right time near the left one."""
    if not left.isStreaming:
        return on
    lt, rt = F.col(left_time), F.col(right_time)
    return (on & (rt >= lt - F.expr(f"interval {before}"))
            & (rt <= lt + F.expr(f"interval {after}")))


# --- behaviour log ---------------------------------------------------------------

def base_log(log: DataFrame) -> DataFrame:
    """Behaviour records with the new-visitor flag repaired."""
    if log.isStreaming:
        from ..streaming.state import repair_new_visitor
        return repair_new_visitor(log)
    return state.repair_new_visitor(log)


def start(log: DataFrame) -> DataFrame:
    """Records with a start part, whole."""
    return log.where(F.col("start").isNotNull())


def display(log: DataFrame) -> DataFrame:
    return etl.explode_merged(log, "displays", parent_ts=True)


def action(log: DataFrame) -> DataFrame:
    return etl.explode_merged(log, "actions", parent_ts=False)


def err(log: DataFrame) -> DataFrame:
    """Records with an error part, without the arrays."""
    return log.where(F.col("err").isNotNull()).drop("displays", "actions")


def page(log: DataFrame) -> DataFrame:
    """Records with a page part, without arrays and error."""
    return log.where(F.col("page").isNotNull()).drop("displays", "actions", "err")


TRAFFIC_LOGS = {"start": start, "display": display, "action": action, "err": err, "page": page}


# --- change log --------------------------------------------------------------------

def comment(log: DataFrame, dictionary: DataFrame, database: str) -> DataFrame:
    rows = etl.pick(etl.table_changes(log, database, "comment_info", "insert"),
                    "id", "user_id", "sku_id", "appraise", "comment_txt")
    named = joins.lookup(rows, dictionary, "appraise", "appraise_name")
    return named.select("id", "user_id", "sku_id", "appraise", "appraise_name",
                        "comment_txt", "ts")


def cart_add(log: DataFrame, database: str) -> DataFrame:
    """Cart inserts with their quantity, and updates by how much they raised it."""
    new = F.col("data")["sku_num"].try_cast("int")
    old = F.col("old")["sku_num"].try_cast("int")
    rows = log.where((F.col("database") == database) & (F.col("table") == "cart_info"))
    rows = rows.where((F.col("type") == "insert") | ((F.col("type") == "update") & (new > old)))
    return rows.select(
        F.col("data")["id"].alias("id"),
        F.col("data")["user_id"].alias("user_id"),
        F.col("data")["sku_id"].alias("sku_id"),
        F.when(F.col("type") == "insert", new).otherwise(new - old).alias("sku_num"),
        "ts")


def _detail_parts(log: DataFrame, database: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Order details, orders, and the activities and coupons of details."""
    od = _table(log, database, "order_detail", "insert", None, "od_", "id", "order_id",
                "sku_id", "sku_name", "create_time", "sku_num", "order_price",
                "split_total_amount", "split_activity_amount", "split_coupon_amount")
    oi = _table(log, database, "order_info", "insert", None, "oi_",
                "user_id", "province_id", oi_id="id")
    act = _table(log, database, "order_detail_activity", "insert", None, "act_",
                 "activity_id", "activity_rule_id", act_detail="order_detail_id")
    cou = _table(log, database, "order_detail_coupon", "insert", None, "cou_",
                 "coupon_id", cou_detail="order_detail_id")
    return od, oi, act, cou


def _with_order(od: DataFrame, oi: DataFrame) -> DataFrame:
    return od.join(oi, _near(od, F.col("order_id") == F.col("oi_id"), "od_et", "oi_et"))


def _promotions(od: DataFrame, act: DataFrame, cou: DataFrame) -> DataFrame:
    """Activities and coupons with the order of their detail. Only ids move for it, and the details
    themselves can stay where their order is."""
    pairs = od.select(F.col("id").alias("promoted"), F.col("order_id").alias("promoted_order"))
    pairs = pairs.where(F.col("promoted").isNotNull() & F.col("promoted_order").isNotNull())
    pairs = pairs.repartition("promoted").distinct()
    found = (pairs.join(act.drop("act_ts", "act_et"), F.col("promoted") == F.col("act_detail"), "left")
             .join(cou.drop("cou_ts", "cou_et"), F.col("promoted") == F.col("cou_detail"), "left"))
    return found.where(F.col("act_detail").isNotNull() | F.col("cou_detail").isNotNull())


def _detail_facts(rows: DataFrame, *more: str) -> DataFrame:
    return rows.select(
        "id", "order_id", "user_id", "sku_id", "sku_name", "province_id", "activity_id",
        "activity_rule_id", "coupon_id", S.date_id(F.col("create_time")).alias("date_id"),
        "create_time", "sku_num",
        S.line_amount(F.col("sku_num"), F.col("order_price")).alias("split_original_amount"),
        "split_activity_amount", "split_coupon_amount", "split_total_amount",
        F.col("od_ts").alias("ts"), *more)


def order_detail(log: DataFrame, database: str, by_order: bool = False) -> DataFrame:
    """Order details with their order, and activity and coupon where there is one. With `by_order` a
    batch leaves the details dealt by order and reads them twice, the second time for their ids."""
    od, oi, act, cou = _detail_parts(log, database)
    rows = _with_order(od, oi)
    if by_order and not rows.isStreaming:
        return _detail_facts(rows.join(
            _promotions(od, act, cou),
            (F.col("order_id") == F.col("promoted_order")) & (F.col("id") == F.col("promoted")), "left"))
    rows = rows.join(act, _near(rows, F.col("id") == F.col("act_detail"), "od_et", "act_et"),
                     "left")
    rows = rows.join(cou, _near(rows, F.col("id") == F.col("cou_detail"), "od_et", "cou_et"),
                     "left")
    return _detail_facts(rows)


def order_detail_early(log: DataFrame, database: str, ttl: str | None = "5 seconds") -> DataFrame:
    """The same on a stream without waiting: a detail comes with its order at once, and again
    when its activity or coupon arrives. Kept by id, the last in the order of ts and _version
    (DETAIL_KEYS, DETAIL_ORDER), the rows become the table that order_detail gives."""
    from ..streaming.live import early_left
    od, oi, act, cou = _detail_parts(log, database)
    found = early_left(_with_order(od, oi).drop("oi_id", "oi_ts", "oi_et"), "id", [
        (act.select("act_detail", "activity_id", "activity_rule_id"), "act_detail"),
        (cou.select("cou_detail", "coupon_id"), "cou_detail")], ttl)
    return _detail_facts(found, "_version")


DETAIL_KEYS, DETAIL_ORDER = ["id"], ["ts", "_version"]


def timed(facts: DataFrame, name: str) -> DataFrame:
    """Facts with the event time of ts under the given name, watermarked on a stream."""
    timed = facts.withColumn(name, S.event_time_seconds(F.col("ts")))
    return timed.withWatermark(name, LATENESS) if timed.isStreaming else timed


ORDER_COLUMNS = ("order_id", "user_id", "sku_id", "sku_name", "province_id", "activity_id",
                 "activity_rule_id", "coupon_id")
SPLITS = ("split_original_amount", "split_activity_amount", "split_coupon_amount")


def order_cancel(log: DataFrame, details: DataFrame, database: str) -> DataFrame:
    """Details of cancelled orders, at the time of cancelling."""
    od = timed(details, "od_et").drop("ts", "date_id", "create_time")
    oc = _table(log, database, "order_info", "update",
                etl.moved("order_status", etl.ORDER_PLACED, etl.ORDER_CANCELLED), "oc_",
                cancelled="id", cancel_time="operate_time")
    on = _near(od, F.col("order_id") == F.col("cancelled"), "oc_et", "od_et",
               CANCEL_WITHIN, WITHIN)
    return od.join(oc, on).select(
        "id", *ORDER_COLUMNS, S.date_id(F.col("cancel_time")).alias("date_id"), "cancel_time",
        "sku_num", *SPLITS, "split_total_amount", F.col("oc_ts").alias("ts"))


def payments(log: DataFrame, database: str) -> DataFrame:
    """Payments that became successful."""
    return _table(log, database, "payment_info", "update",
                  etl.became("payment_status", etl.PAID), "pi_",
                  "payment_type", "callback_time", paid_order="order_id")


def order_payment(log: DataFrame, details: DataFrame, dictionary: DataFrame, database: str,
                  before: str = PAY_BEFORE, after: str = PAY_AFTER) -> DataFrame:
    """Details of paid orders: ordered within half an hour before the payment."""
    od = timed(details, "od_et").drop("ts")
    rows = joins.interval(payments(log, database), od, F.col("paid_order") == F.col("order_id"),
                          "pi_et", "od_et", before, after)
    rows = joins.lookup(rows, dictionary, "payment_type", "payment_type_name")
    return rows.select(
        F.col("id").alias("order_detail_id"), *ORDER_COLUMNS,
        F.col("payment_type").alias("payment_type_code"), "payment_type_name",
        "callback_time", "sku_num", *SPLITS,
        F.col("split_total_amount").alias("split_payment_amount"), F.col("pi_ts").alias("ts"))


def order_refund(log: DataFrame, dictionary: DataFrame, database: str) -> DataFrame:
    """Refund requests of orders that were set to refund."""
    ri = _table(log, database, "order_refund_info", "insert", None, "ri_", "id", "user_id",
                "order_id", "sku_id", "refund_type", "refund_num", "refund_amount",
                "refund_reason_type", "refund_reason_txt", "create_time")
    oi = _table(log, database, "order_info", "update",
                etl.became("order_status", etl.ORDER_REFUND_ASKED), "oi_",
                "province_id", oi_id="id")
    rows = ri.join(oi, _near(ri, F.col("order_id") == F.col("oi_id"), "ri_et", "oi_et"))
    rows = joins.lookup(rows, dictionary, "refund_type", "refund_type_name")
    rows = joins.lookup(rows, dictionary, "refund_reason_type", "refund_reason_type_name")
    return rows.select(
        "id", "user_id", "order_id", "sku_id", "province_id",
        S.date_id(F.col("create_time")).alias("date_id"), "create_time",
        F.col("refund_type").alias("refund_type_code"), "refund_type_name",
        F.col("refund_reason_type").alias("refund_reason_type_code"),
        "refund_reason_type_name", "refund_reason_txt", "refund_num", "refund_amount",
        F.col("ri_ts").alias("ts"))


def refund_payment(log: DataFrame, dictionary: DataFrame, database: str) -> DataFrame:
    """Refunds that were paid out, with the request's quantity and the order's user."""
    rp = _table(log, database, "refund_payment", "update",
                etl.became("refund_status", etl.REFUND_PAID), "rp_", "id", "order_id",
                "sku_id", "payment_type", "callback_time", "total_amount")
    ri = _table(log, database, "order_refund_info", "update",
                etl.became("refund_status", etl.REFUND_FINISHED), "ri_",
                "refund_num", ri_order="order_id", ri_sku="sku_id")
    oi = _table(log, database, "order_info", "update",
                etl.became("order_status", etl.ORDER_REFUND_DONE), "oi_",
                "user_id", "province_id", oi_id="id")
    same = (F.col("order_id") == F.col("ri_order")) & (F.col("sku_id") == F.col("ri_sku"))
    rows = rp.join(ri, _near(rp, same, "rp_et", "ri_et"))
    rows = rows.join(oi, _near(rp, F.col("order_id") == F.col("oi_id"), "rp_et", "oi_et"))
    rows = joins.lookup(rows, dictionary, "payment_type", "payment_type_name")
    return rows.select(
        "id", "user_id", "order_id", "sku_id", "province_id",
        F.col("payment_type").alias("payment_type_code"), "payment_type_name",
        S.date_id(F.col("callback_time")).alias("date_id"), "callback_time", "refund_num",
        F.col("total_amount").alias("refund_amount"), F.col("rp_ts").alias("ts"))


def routed_facts(log: DataFrame, config: DataFrame, database: str,
                 preload: DataFrame | None = None) -> DataFrame:
    """Simple facts whose target and columns a configuration table gives. A streaming
    configuration is its changes, which overrule what was preloaded."""
    return changelog.route_facts(etl.changes(log, database, etl.FACT_CHANGE_TYPES), config, preload)
