"""Windowed tables: the stream gives what the batch gives, on closed windows."""

import pytest
from pyspark.sql import functions as F

from streams import Feed, run, same
from tidewater import bindings as B
from tidewater.plans import dwd, dws

SF = "/root/testdata/sf0.001"
FUTURE = 4_102_444_800  # 2100-01-01; rows from then on only close the windows before
CLOSED = "stt < '2099'"


def later(df, seconds):
    """One copy of a row at a far time, that closes all windows before it."""
    one = df.limit(1)
    if "et" in df.columns:  # page records: milliseconds
        ms = (FUTURE + seconds) * 1000
        return (one.withColumn("ts", F.lit(ms).cast("long"))
                .withColumn("et", F.timestamp_millis(F.lit(ms))))
    return one.withColumn("ts", F.lit(FUTURE + seconds).cast("long"))


#: Micro-batches that a table is fed in.
BATCHES = 3


def feed(spark, folder, df, order, extra=None, batches=BATCHES):
    f = Feed(spark, folder).put(df, order, batches)
    for i in (0, 400 * 86400):
        end = later(df, i)
        f.put(extra(end, i) if extra else end)
    return f.stream()


@pytest.fixture(scope="module")
def pages(spark):
    return B.page_log(spark, SF)


@pytest.fixture(scope="module")
def details(spark):
    return B.order_detail_facts(spark, SF)


def page_end(df, i):
    """Make the closing page record pass every filter, for a user and session of its own."""
    common = F.col("common")
    for k in ("mid", "uid", "sid"):
        common = common.withField(k, F.lit(f"end{i}"))
    page = (F.col("page").withField("page_id", F.lit("home"))
            .withField("last_page_id", F.lit("home")).withField("item_type", F.lit("keyword"))
            .withField("item", F.lit("end")))
    return df.withColumn("common", common).withColumn("page", page)


def login_end(df, i):
    end = page_end(df, i)
    return end.withColumn("page", F.col("page").withField("last_page_id", F.lit("login")))


def test_traffic(spark, tmp_path, pages):
    stream = feed(spark, tmp_path / "in", pages, ["ts", "seq"], page_end)
    out = run(dws.traffic(stream, "1 day", session_ttl="2 days"), tmp_path)
    batch = dws.traffic(pages, "1 day")
    same(out, batch, CLOSED, [c for c in batch.columns if c != "uj_ct"])


def test_bounces(spark, tmp_path, pages):
    stream = feed(spark, tmp_path / "in", pages, ["ts", "seq"], page_end)
    out = run(dws.bounces(stream, "1 day", gap="1 day"), tmp_path)
    keys = ["stt", "edt", "cur_date", *dws.TRAFFIC_KEYS]
    out = out.groupBy(*keys).agg(F.sum("uj_ct").alias("uj_ct"))
    same(out, dws.traffic(pages, "1 day").where("uj_ct > 0"), CLOSED, [*keys, "uj_ct"])


def test_home_detail(spark, tmp_path, pages):
    stream = feed(spark, tmp_path / "in", pages, ["ts", "seq"], page_end)
    same(run(dws.home_detail(stream, "1 day"), tmp_path), dws.home_detail(pages, "1 day"), CLOSED)


def test_keyword(spark, tmp_path, pages):
    stream = feed(spark, tmp_path / "in", pages, ["ts", "seq"], page_end)
    same(run(dws.keyword(stream, "1 day"), tmp_path), dws.keyword(pages, "1 day"), CLOSED)


def test_user_login(spark, tmp_path, pages):
    stream = feed(spark, tmp_path / "in", pages, ["ts", "seq"], login_end)
    same(run(dws.user_login(stream, "1 day", 1), tmp_path), dws.user_login(pages, "1 day", 1),
         CLOSED)


def test_user_register(spark, tmp_path):
    rows = B.registrations(spark, SF)
    f = Feed(spark, tmp_path / "in").put(rows, ["create_time"])
    for i in (0, 1):
        f.put(rows.limit(1).withColumn("create_time", F.lit(str((FUTURE + i * 86400) * 1000))))
    same(run(dws.user_register(f.stream(), "1 hour"), tmp_path),
         dws.user_register(rows, "1 hour"), CLOSED)


def test_cart_users(spark, tmp_path):
    carts = dwd.cart_add(B.order_changes(spark, SF, "cart_info"), B.DATABASE)
    stream = feed(spark, tmp_path / "in", carts, ["ts"])
    same(run(dws.cart_users(stream, "1 day"), tmp_path), dws.cart_users(carts, "1 day"), CLOSED)


def test_order_users(spark, tmp_path, details):
    stream = feed(spark, tmp_path / "in", details, ["ts"])
    same(run(dws.order_users(stream, "30 days"), tmp_path), dws.order_users(details, "30 days"),
         CLOSED)


def test_payment_users(spark, tmp_path, details):
    stream = feed(spark, tmp_path / "in", details, ["ts"])
    same(run(dws.payment_users(stream, "30 days"), tmp_path),
         dws.payment_users(details, "30 days"), CLOSED)


def test_province_order(spark, tmp_path, details):
    provinces = B.provinces(spark, SF)
    order = [*dws.DETAIL_ORDER[:-1], F.col("split_total_amount").cast("double")]
    stream = feed(spark, tmp_path / "in", details, order,
                  lambda end, i: end.withColumn("id", F.lit(f"end{i}")))
    same(run(dws.province_order(stream, provinces, "30 days"), tmp_path),
         dws.province_order(details, provinces, "30 days"), CLOSED)


def test_refund(spark, tmp_path):
    dims = B.dimensions(spark, SF)
    log = B.order_changes(spark, SF, "order_refund_info", "order_info")
    refunds = dwd.order_refund(log, B.dictionary(spark, SF), B.DATABASE)
    stream = feed(spark, tmp_path / "in", refunds, ["ts"])
    same(run(dws.refund(stream, dims, "30 days"), tmp_path), dws.refund(refunds, dims, "30 days"),
         CLOSED)


def test_sku_order(spark, tmp_path, details):
    dims = B.dimensions(spark, SF)
    order = ["ts", "sku_id", *[F.col(c).cast("double") for c in (
        "split_original_amount", "split_activity_amount", "split_coupon_amount",
        "split_total_amount")]]
    stream = feed(spark, tmp_path / "in", details, order,
                  lambda end, i: end.withColumn("id", F.lit(f"end{i}")),
                  batches=1)  # a correction of a closed window would be dropped
    same(run(dws.sku_order(stream, dims, "30 days", delta_ttl="4000 days"), tmp_path),
         dws.sku_order(details, dims, "30 days"), CLOSED)
