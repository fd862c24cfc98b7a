"""Scalar column functions shared by the plans."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

DATETIME = "yyyy-MM-dd HH:mm:ss"
DATE = "yyyy-MM-dd"
PARTITION_DATE = "yyyyMMdd"

# The product of two of these is exact at scale 4. 18 digits still fit a machine word.
MONEY = T.DecimalType(16, 2)
AMOUNT = T.DecimalType(18, 4)

DAY_MILLIS = 86_400_000


def event_time_millis(ts: Column) -> Column:
    return F.timestamp_millis(ts)


def event_time_seconds(ts: Column) -> Column:
    return F.timestamp_seconds(ts)


def date_id(text: Column) -> Column:
    """Day of a date-time text as yyyy-MM-dd, null where it is not one."""
    return F.date_format(F.try_to_timestamp(text, F.lit(DATETIME)), DATE)


def millis_to_datetime(ms: Column) -> Column:
    return F.date_format(F.timestamp_millis(ms), DATETIME)


def millis_to_date(ms: Column) -> Column:
    return F.date_format(F.timestamp_millis(ms), DATE)


def millis_to_partition(ms: Column) -> Column:
    return F.date_format(F.timestamp_millis(ms), PARTITION_DATE)


def datetime_to_millis(text: Column) -> Column:
    return F.unix_millis(F.try_to_timestamp(text, F.lit(DATETIME)))


def date_to_millis(text: Column) -> Column:
    return F.unix_millis(F.try_to_timestamp(text, F.lit(DATE)))


def line_amount(quantity: Column, price: Column) -> Column:
    """Quantity times unit price, exact, as text; null beyond the range of amounts."""
    product = F.try_multiply(quantity.try_cast(MONEY), price.try_cast(MONEY))
    return product.try_cast(AMOUNT).cast("string")


def amount(text: Column) -> Column:
    return text.try_cast(AMOUNT)


def amount_or_zero(text: Column) -> Column:
    return F.coalesce(amount(text), F.lit(0).cast(AMOUNT))


def whole_days_between(earlier: Column, later: Column) -> Column:
    """Whole days between two timestamps, rounded down."""
    return F.floor((F.unix_millis(later) - F.unix_millis(earlier)) / F.lit(DAY_MILLIS))


def guarded_ratio(numerator: Column, denominator: Column) -> Column:
    """Ratio as double, 0.0 where the denominator is zero."""
    return F.when(denominator == 0, F.lit(0.0)).otherwise(
        numerator.cast("double") / denominator.cast("double"))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Ratio as double, null where the denominator is zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def words(text: Column) -> Column:
    """Distinct lower-case words of a text; null for a null text."""
    parts = F.split(F.lower(text), r"[^\p{L}\p{N}]+")
    return F.array_distinct(F.filter(parts, lambda w: F.length(w) > 0))


# Score of a keyword by where it was used.
KEYWORD_WEIGHT = {"SEARCH": 10, "ORDER": 5, "CART": 2, "CLICK": 1}


def keyword_weight(source: Column) -> Column:
    weight = F.lit(0)
    for name, score in KEYWORD_WEIGHT.items():
        weight = F.when(source == name, score).otherwise(weight)
    return weight
