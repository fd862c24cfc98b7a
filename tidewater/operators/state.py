"""Keyed state in batch form.

Rows are taken in event-time order. The order columns given must be a total order
up to equal rows. None of these operators sorts all rows of a key in one task:
first rows are cut to one per key before the shuffle, day sequences are built on one
row per key and day, and the delta correction cuts a key into hours.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import scalars as S


# Copies of one row written by one task when copies are expanded again.
COPY_CHUNK = 1_000_000


def first_rows(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """First row of each key. The rank filter is applied before the shuffle too, so
    a map task sends at most one row per key."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def last_rows(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*[F.desc(o) for o in order])
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def flag_first(df: DataFrame, keys: list[str], order: list[str], row_id: str,
               name: str) -> DataFrame:
    """All rows, with 1 on the first row of each key and 0 elsewhere.

    The first rows are joined back on the row id, which spreads evenly, and not on
    the key, which may not.
    """
    firsts = first_rows(df.select(row_id, *dict.fromkeys([*keys, *order])), keys, order)
    marks = firsts.select(row_id, F.lit(1).cast("long").alias(name))
    return df.join(marks, row_id, "left").withColumn(
        name, F.coalesce(name, F.lit(0).cast("long")))


def repair_new_visitor(log: DataFrame, order: list[str] = ["ts", "seq"]) -> DataFrame:
    """Correct common.is_new by the visitor's stored first day.

    The first record of a visitor fixes the day: its own day if it claims to be new,
    the day before if not. A later record claiming to be new on another day is set
    to '0'. One small row per visitor is joined to all records. The join has the visitor's
    hash as a second key: the side grouped by visitor is then shuffled for the join as
    well, without which Spark could not split a busy visitor's partition at run time.
    """
    seen = log.select(F.col("common.mid").alias("_mid"),
                      F.col("common.is_new").alias("_new"), *order)
    day = F.to_date(F.timestamp_millis("ts"))
    stored = (first_rows(seen.where("_mid is not null"), ["_mid"], order)
              .select("_mid", first_day(F.col("_new"), day).alias("_stored")))
    stored = stored.withColumn("_hash", F.xxhash64("_mid"))
    joined = log.join(stored, (F.col("common.mid") == F.col("_mid"))
                      & (F.xxhash64("common.mid") == F.col("_hash")), "left")
    return joined.withColumn("common", repaired_common()).drop("_mid", "_stored", "_hash")


def first_day(is_new: Column, day: Column) -> Column:
    """The day that a visitor's first record stores."""
    return F.when(is_new == "1", day).otherwise(F.date_sub(day, 1))


def repaired_flag(is_new: Column, day: Column, stored: Column) -> Column:
    """'0' where a claimed new visitor was seen on another day."""
    return F.when((is_new == "1") & (day != stored), F.lit("0")).otherwise(is_new)


def repaired_common() -> Column:
    """common with the flag repaired."""
    today = F.to_date(F.timestamp_millis("ts"))
    return F.col("common").withField("is_new", repaired_flag(F.col("common.is_new"), today, F.col("_stored")))


def day_visits(df: DataFrame, key: str, order: list[str], time: str = "et") -> DataFrame:
    """First row of each key and day, with the key's previous day, null for none."""
    daily = first_rows(df.withColumn("_day", F.to_date(time)), [key, "_day"], order)
    w = Window.partitionBy(key).orderBy("_day")
    return daily.withColumn("_prev_day", F.lag("_day").over(w))


def returning(visits: DataFrame, gap_days: int, time: str = "et") -> DataFrame:
    """uu_ct and back_ct per first visit of a day: back after more than gap_days
    whole days since the start of the last visit day."""
    gap = S.whole_days_between(F.col("_prev_day").cast("timestamp"), F.col(time))
    back = F.col("_prev_day").isNotNull() & (gap > gap_days)
    return (visits.withColumn("uu_ct", F.lit(1).cast("long"))
            .withColumn("back_ct", back.cast("long")))


def unique_and_new(visits: DataFrame, unique: str, new: str) -> DataFrame:
    """1 per first row of a day, and 1 where the key was never seen before."""
    return (visits.withColumn(unique, F.lit(1).cast("long"))
            .withColumn(new, F.col("_prev_day").isNull().cast("long")))


def delta_groups(df: DataFrame, key: str, time: str, order: list[str],
                 amounts: list[str], carry: list[str]) -> DataFrame:
    """Delta correction of repeated rows, equal rows kept as one with a count.

    In order, the first row of a key comes out whole. Every later row comes out as
    its amounts less those of the row before, on the carried columns of the row
    before. Columns: key, amounts, carry, copies, and own, the row's own carried
    columns, on which the copies - 1 further rows of zero amounts belong.

    A key is cut into its hours, and one shuffle by (key, hour) serves the count of equal rows
    and the row before inside an hour. The first row of an hour needs the last row of the
    key's hour before, so the first and last rows of all hours of a key, and only those, meet
    in a second window. The order must start with the time.
    """
    cols = list(dict.fromkeys([key, time, *order, *amounts, *carry]))
    rows = (df.select(*cols, F.floor(F.unix_seconds(time) / 3600).alias("_hour"))
            .repartition(key, "_hour").groupBy(*cols, "_hour").agg(F.count(F.lit(1)).alias("copies")))
    here = F.struct(*amounts, *carry)
    in_hour = Window.partitionBy(key, "_hour").orderBy(*order)
    edge = F.col("_prev").isNull() | F.lead(F.lit(1)).over(in_hour).isNull()
    rows = rows.select("*", F.lag(here).over(in_hour).alias("_prev"))
    rows = rows.withColumn("_hour", F.when(~edge, F.col("_hour")))
    at_edge = Window.partitionBy(key, "_hour").orderBy(*order)
    rows = rows.select("*", F.coalesce("_prev", F.lag(here).over(at_edge)).alias("_p"))
    first = F.col("_p").isNull()
    return rows.select(
        key,
        *[F.when(first, F.col(a)).otherwise(F.col(a) - F.col(f"_p.{a}")).alias(a)
          for a in amounts],
        *[F.when(first, F.col(c)).otherwise(F.col(f"_p.{c}")).alias(c) for c in carry],
        "copies",
        F.struct(*carry).alias("own"))


def _zero(groups: DataFrame, amounts: list[str], carry: list[str], times: Column) -> list[Column]:
    """Zero amounts on a row's own carried columns, due _n times."""
    types = {f.name: f.dataType for f in groups.schema.fields}
    return [*[F.lit(0).cast(types[a]).alias(a) for a in amounts],
            *[F.col(f"own.{c}").alias(c) for c in carry], times.cast("long").alias("_n")]


def _keys(groups: DataFrame, amounts: list[str], carry: list[str]) -> list[str]:
    return [c for c in groups.columns if c not in (*amounts, *carry, "copies", "own")]


def _with_zeros(groups: DataFrame, amounts: list[str], carry: list[str], times: Column) -> DataFrame:
    """The correction row and, for copies, the zero row that is due _n times."""
    changed = F.struct(*amounts, *carry, F.lit(1).cast("long").alias("_n"))
    zero = F.struct(*_zero(groups, amounts, carry, times))
    both = F.when(F.col("copies") > 1, F.array(changed, zero)).otherwise(F.array(changed))
    return groups.select(*_keys(groups, amounts, carry), F.inline(both))


def delta_rows(groups: DataFrame, amounts: list[str], carry: list[str]) -> DataFrame:
    """One row per input row of the delta correction. The copies of a row that has very many
    are written out in chunks by several tasks, and only those are shuffled for it."""
    spare, keys = F.col("copies") - 1, _keys(groups, amounts, carry)
    rows = _with_zeros(groups, amounts, carry, F.when(spare <= COPY_CHUNK, spare))
    out = [c for c in rows.columns if c != "_n"]
    chunk = F.explode(F.sequence(F.lit(0).cast("long"),
                                 F.floor((F.col("_n") - 1) / COPY_CHUNK))).alias("_c")
    many = (groups.where(spare > COPY_CHUNK).select(*keys, *_zero(groups, amounts, carry, spare))
            .select("*", chunk).repartition(*out, "_c"))
    size = F.least(F.lit(COPY_CHUNK).cast("long"), F.col("_n") - F.col("_c") * COPY_CHUNK)
    return _times(rows, F.col("_n"), out).unionByName(_times(many, size, out))


def _times(rows: DataFrame, times: Column, columns: list[str]) -> DataFrame:
    return rows.select(*columns, F.explode(F.sequence(F.lit(1).cast("long"), times))).select(*columns)


def delta_sums(groups: DataFrame, amounts: list[str], carry: list[str]) -> DataFrame:
    """The delta correction for sums: the zero rows of copies are kept once, so that
    their group exists, instead of once per copy."""
    return _with_zeros(groups, amounts, carry, F.lit(1)).select(*amounts, *carry)
