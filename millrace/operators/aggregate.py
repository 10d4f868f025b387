"""Aggregates by key. All use functions Spark combines before the shuffle, so a key that
holds a large part of the rows costs one partial row per task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F, types as T

from millrace.functions import quoted


# A decimal of up to this many digits is summed as two whole numbers (see ``_exact_sum``).
_SPLIT_SUM_DIGITS = 12
_LOW_BITS = 20


def _decimal_type(df: DataFrame, value: Column) -> T.DecimalType | None:
    data_type = df.select(value).schema[0].dataType
    return data_type if isinstance(data_type, T.DecimalType) else None


def _exact_sum(value: Column, decimal: T.DecimalType) -> Column:
    """The sum of a decimal column, exact in any order of the rows.

    Spark keeps a decimal sum in a buffer too wide for machine arithmetic, which costs most of
    the time of such an aggregate. The number of hundredths (or whatever the scale says) is
    summed instead, its low 20 bits and the rest apart: neither sum overflows below 8 * 10^12
    rows per key, and under ANSI an overflow would stop the job.
    """
    if decimal.precision > _SPLIT_SUM_DIGITS:
        return F.sum(value)
    units = (value * F.lit(10**decimal.scale)).cast("bigint")
    high = F.sum(F.shiftright(units, _LOW_BITS)).cast("decimal(20,0)")
    low = F.sum(units.bitwiseAND(F.lit(2**_LOW_BITS - 1))).cast("decimal(20,0)")
    total = high * F.lit(2**_LOW_BITS) + low
    return total * F.lit(Decimal(1).scaleb(-decimal.scale)) if decimal.scale else total


def totals_by_key(
    df: DataFrame,
    key: str = "customer_id",
    amount: str = "amount",
    counted: str = "order_id",
    amount_type: str | T.DataType | None = None,
) -> DataFrame:
    """Sum, mean and count per key in one pass.

    Decimal amounts are summed as decimals, so the result does not depend on the order of
    the rows. ``amount_type`` (``"decimal(12,2)"``) does the same for amounts stored as
    doubles; without it doubles are summed as doubles. The mean is over rows with an amount,
    the count over rows whose ``counted`` column is not null.
    """
    value = quoted(amount)
    if amount_type is not None:
        value = value.cast(amount_type)
    decimal = _decimal_type(df, value)
    total = (F.sum(value) if decimal is None else _exact_sum(value, decimal)).cast("double")
    return df.groupBy(quoted(key)).agg(
        total.alias("total_spent"),
        F.try_divide(total, F.count(value)).alias("avg_order_amount"),
        F.count(quoted(counted)).alias("order_count"),
    )


_REDUCERS = {"sum": F.sum, "min": F.min, "max": F.max}


def reduce_by_key(
    df: DataFrame, keys: Sequence[str], reductions: Mapping[str, tuple[str, str]]
) -> DataFrame:
    """Reduce the values of each key to one, any number of reductions in one pass.

    ``reductions`` maps a result's name to a column and ``sum``, ``min`` or ``max``.
    """
    return df.groupBy(*[quoted(k) for k in keys]).agg(
        *[_REDUCERS[how](quoted(column)).alias(name) for name, (column, how) in reductions.items()]
    )


def key_counts(df: DataFrame, keys: Sequence[str], alias: str = "n") -> DataFrame:
    return df.groupBy(*[quoted(k) for k in keys]).agg(F.count(F.lit(1)).alias(alias))
