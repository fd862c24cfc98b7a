"""What moves between tasks, and what is written."""

import pathlib
import time
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from test_semantics import SF, deltas, expected_deltas, got_deltas, plan
from tidewater import bindings as B
from tidewater import registry, session
from tidewater.plans import dwd, dws
from tidewater.sources import layers


@pytest.fixture
def shuffled(spark):
    """Joins that are too large to broadcast."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for key in keys:
        spark.conf.set(key, "-1")
    yield
    for key in keys:
        spark.conf.unset(key)


def first_plan(df):
    text = plan(df)
    return text.split("+- == Initial Plan ==")[-1]


def test_deltas_are_shuffled_twice(spark):
    data = [("a", 1, "s", Decimal(5)), ("b", 2, "s", Decimal(6))]
    groups, out = deltas(spark, data)
    assert first_plan(groups).count("Exchange hashpartitioning") == 2
    assert got_deltas(out) == expected_deltas(data)


def test_deltas_over_hours(spark):
    """The row before is found inside an hour, in the hour before and days before."""
    data = [("a", t, f"s{t % 3}", Decimal(t % 7)) for t in (0, 10, 3599, 3600, 7200, 7201, 900_000, 900_001)]
    data += [(k, t, "s", Decimal(a)) for k, t, a in (("b", 3600, 1), ("b", 3599, 2), ("c", -1, 3), ("c", 0, 4))]
    assert got_deltas(deltas(spark, data)[1]) == expected_deltas(data)


def test_joins_of_lines_move_no_derived_columns(spark, shuffled):
    above, below = first_plan(B.order_detail_facts(spark, SF)).split("SortMergeJoin", 1)
    assert "concat_ws" in above and "concat_ws" not in below


def test_names_join_moves_windows_and_not_text(spark, shuffled):
    table = dws.sku_order(B.order_detail_facts(spark, SF), B.dimensions(spark, SF), "30 days")
    above, below = first_plan(table).split("SortMergeJoin", 1)
    assert "date_format(" in above and "date_format(" not in below


def test_split_log_is_compressed_and_not_sorted(spark, tmp_path):
    seen, write = [], layers._by_source

    def spy(log):
        seen.append(log.sparkSession.conf.get(layers.OPEN_FILES))
        return write(log)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(layers, "_by_source", spy)
        layers.split_changes(registry.decode.change_log(B.raw_order_changes(spark, SF)), str(tmp_path / "log"))
    assert seen == [str(layers.FOLDERS)] and spark.conf.get(layers.OPEN_FILES, "0") == "0"
    files = list((tmp_path / "log").glob("*/*/*.parquet"))
    assert files and all(".zstd." in f.name for f in files)
    back = layers.changes(spark, str(tmp_path / "log"))
    assert back.count() == B.order_changes(spark, SF).where(F.col("table").isNotNull()).count()


@pytest.mark.parametrize("name", ["ads_activity", "ads_coupon"])
def test_reports_of_amounts_join_no_names(spark, name):
    """They read the product for its price alone, and the table has the same amounts with names."""
    found = registry.QUERIES[name](spark, SF)
    assert "p_retailprice" in plan(found) and "p_brand" not in plan(found) and "p_type" not in plan(found)
    named = dws.sku_order(B.order_detail_facts(spark, SF), B.dimensions(spark, SF), registry.TRADE_WINDOW)
    bare = dws.sku_amounts(B.order_detail_facts(spark, SF), registry.TRADE_WINDOW)
    assert named.select(*bare.columns).exceptAll(bare).isEmpty() and bare.exceptAll(named.select(*bare.columns)).isEmpty()


def test_details_move_once_for_their_order(spark, shuffled):
    """The order, the promotions and the cancelling of an order find the details where they are."""
    text = first_plan(registry.QUERIES["dwd_trade_order_cancel"](spark, SF))
    assert text.count("Exchange hashpartitioning(order_id#") == 1
    assert "Exchange hashpartitioning(promoted_order#" in text


def test_promotions_of_repeated_and_missing_ids(spark, shuffled):
    """The facts are those of joins row by row, also where ids come twice, are null or have two orders."""
    def change(table, **data):
        return ("shop", table, "insert", data, None, 7)
    rows = [change("order_detail", id=i, order_id=o, sku_id=s, sku_num="2", order_price="1.5")
            for i, o, s in (("a", "1", "x"), ("a", "1", "x"), ("a", "2", "y"), ("b", "1", "z"), ("c", "9", "z"),
                            (None, "1", "n"), ("d", None, "n"), ("e", "2", "w"), ("f", "2", "w"))]
    rows += [change("order_info", id=i, user_id=u) for i, u in (("1", "u"), ("1", "v"), ("2", "u"), (None, "n"))]
    rows += [change("order_detail_activity", order_detail_id=i, activity_id=n)
             for i, n in (("a", "p"), ("a", "q"), ("e", "r"), (None, "s"), ("c", "t"))]
    rows += [change("order_detail_coupon", order_detail_id=i, coupon_id=n)
             for i, n in (("a", "k"), ("a", "l"), ("f", "m"), (None, "o"), ("d", "p"))]
    log = spark.createDataFrame(rows, "database string, table string, type string, data map<string,string>, "
                                "old map<string,string>, ts long").repartition(3)
    od, oi, act, cou = dwd._detail_parts(log, "shop")
    plain = (od.join(oi, F.col("order_id") == F.col("oi_id"))
             .join(act, F.col("id") == F.col("act_detail"), "left").join(cou, F.col("id") == F.col("cou_detail"), "left"))
    want = sorted(map(tuple, dwd._detail_facts(plain).collect()), key=repr)
    assert len(want) == 26
    for by_order in (True, False):
        assert sorted(map(tuple, dwd.order_detail(log, "shop", by_order).collect()), key=repr) == want


def test_stored_days_are_not_dealt_and_leave_no_shuffles(spark, tmp_path):
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()

    def shuffles():
        return {f: f.stat().st_size for d in folders for f in pathlib.Path(d.getPath()).glob("*/shuffle_*.data")}
    before, seen = shuffles(), []
    table = (spark.range(0, 4000, 1, 4).groupBy((F.col("id") % 3).alias("k"), (F.col("id") % 2).cast("string").alias("cur_date"))
             .agg(F.sum("id").alias("n")))
    write = layers._open_files
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(layers, "_open_files", lambda s, most=None: seen.append(most) or write(s, most))
        layers.put_days(table, str(tmp_path / "days"))
    assert seen == [layers.OPEN_DAYS]
    for _ in range(100):
        left = sum(n for f, n in shuffles().items() if f not in before)
        if not left:
            break
        time.sleep(0.1)
    assert not left and spark.conf.get(session.CLEANUP, "false") != "true"
    assert layers.days(spark, str(tmp_path / "days"), table.schema).agg(F.sum("n")).first()[0] == sum(range(4000))
