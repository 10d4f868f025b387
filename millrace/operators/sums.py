"""Sums of doubles that have the same bits in any order of the rows.

Adding doubles rounds at every step, so a plain sum depends on how rows are dealt to tasks. Here
every double is cut into whole numbers of 20 bits, one for each bin of 20 powers of two that it reaches into (four
at most). Bins are added up as whole numbers, which is exact in any order, and combined before the shuffle like
any sum. At the end the bins of a key, whose number depends on how far its values' sizes lie apart and not on the
rows, are carried over into one exact number, and this is rounded to a double once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions import quoted

#: Bits of a bin. A whole number of 64 bits holds the sum of a bin of up to 2 ** 43 rows.
BITS = 20
_BASE = 1 << BITS
#: Digits of a double of 53 bits, and bins that the carry of a sum can reach above its own.
_DIGITS, _CARRY = 4, 3


def _power(exponent: Column) -> Column:
    """An exact power of two, for exponents of normal doubles."""
    return F.pow(F.lit(2.0), exponent)


def _scaled(value: Column, exponent: Column) -> Column:
    """The value times a power of two that may lie beyond the doubles, in two exact steps."""
    half = F.floor(exponent / 2)
    return value * _power(half) * _power(exponent - half)


def _digits(rows: DataFrame) -> DataFrame:
    """For a column ``_v`` of values the highest bin of each, ``_bin``, and its whole numbers from there down.

    Zeros, nulls and special values have no bin. Steps are columns of their own, so that no expression is worked out twice.
    """
    plain = (F.abs("_v") < float("inf")) & (F.col("_v") != 0)  # NaN is above infinity
    rows = rows.withColumn("_size", F.when(plain, F.abs("_v")))
    # The logarithm may be off by one at a power of two; the first number is then one bit longer or shorter.
    rows = rows.withColumn("_bin", F.floor(F.log2("_size") / BITS))
    # Twice two digits are whole numbers of a double, and what is left of the first is exact.
    rows = rows.withColumn("_rest", _scaled(F.col("_size"), (1 - F.col("_bin")) * BITS))
    rows = rows.withColumn("_high", F.floor("_rest"))
    rows = rows.withColumn("_rest", F.floor((F.col("_rest") - F.col("_high")) * float(_BASE * _BASE)))
    sign = F.when(F.col("_v") < 0, F.lit(-1)).otherwise(F.lit(1)).cast("bigint")
    numbers = [
        part
        for name in ("_high", "_rest")
        for part in (F.shiftright(name, BITS), F.col(name).bitwiseAND(F.lit(_BASE - 1).cast("bigint")))
    ]
    return rows.withColumns({f"_n{k}": sign * n for k, n in enumerate(numbers)}).drop("_size", "_high", "_rest")


def _carried(bins: Column) -> Column:
    """Whole numbers from the lowest bin up -> (digits below 2 ** 20, what is carried out of the highest)."""
    none = F.struct(F.array().cast("array<bigint>").alias("d"), F.lit(0).cast("bigint").alias("c"))

    def add(state: Column, x: Column) -> Column:
        total = state["c"] + x
        digit = total.bitwiseAND(F.lit(_BASE - 1))
        return F.struct(F.concat(state["d"], F.array(digit)).alias("d"), F.shiftright(total, BITS).alias("c"))

    return F.aggregate(bins, none, add)


def _rounded_total(df: DataFrame, name: str) -> DataFrame:
    """``name``, the double nearest to the exact sum of the bins in the columns ``_bins`` and ``_low``."""
    df = df.withColumn("_carried", _carried(F.col("_bins")))
    negative = F.col("_carried.c") < 0
    turned = _carried(F.transform("_bins", lambda x: -x))
    df = df.withColumn("_d", F.when(negative, turned["d"]).otherwise(F.col("_carried.d")))
    place = F.array_max(F.transform("_d", lambda x, i: F.when(x != 0, i)))
    df = df.withColumn("_top", place)
    digit = lambda k: F.when(F.col("_top") >= k, F.get("_d", F.col("_top") - k)).otherwise(0)
    # 61 to 80 bits, and one more that says whether anything follows: one addition rounds them, as each
    # part is exact.
    below = F.exists(F.slice("_d", 1, F.greatest(F.col("_top") - (_DIGITS - 1), F.lit(0))), lambda x: x != 0)
    high = (digit(0) * _BASE + digit(1)).cast("double") * float(1 << (2 * BITS + 1))
    low = ((digit(2) * _BASE + digit(3)) * 2 + F.when(below, 1).otherwise(0)).cast("double")
    exponent = (F.col("_low") + F.col("_top") - (_DIGITS - 1)) * BITS - 1
    size = _scaled(high + low, exponent)
    total = F.when(F.col("_top").isNull(), F.lit(0.0)).when(negative, -size).otherwise(size)
    return df.withColumn(name, total).drop("_carried", "_d", "_top")


def exact_sums(
    df: DataFrame, keys: Sequence[str], sums: Mapping[str, str], means: Mapping[str, str] | None = None
) -> DataFrame:
    """Sums and means of double columns by key, the same to the last bit for any order and partitioning.

    ``sums`` and ``means`` map a result's name to a column. A sum is the double nearest to the sum of the exact
    values, a mean that sum over the number of values. Nulls are left out; a key without values has a null. As
    usual, a NaN gives NaN, and so do infinities of both signs. A sum of zeros is 0.0, a sum beyond
    the doubles infinite. Null keys form a group.

    A key sends one row for each bin per task, however many rows it has.
    """
    means = means or {}
    columns = list(dict.fromkeys([*sums.values(), *means.values()]))
    if not columns:
        raise ValueError("there is nothing to sum")
    by = [quoted(k) for k in keys]
    parts = [
        F.struct(F.lit(i).alias("_column"), quoted(column).cast("double").alias("_v")) for i, column in enumerate(columns)
    ]
    rows = _digits(df.select(*by, F.explode(F.array(*parts)).alias("_p")).select(*by, "_p.*"))
    special = F.when(F.abs("_v") >= float("inf"), F.col("_v"))
    binned = rows.groupBy(*by, "_column", "_bin").agg(
        *[F.sum(f"_n{k}").alias(f"_n{k}") for k in range(_DIGITS)],
        F.sum(special).alias("_special"),
        F.count("_v").alias("_n"),
    )
    # Neighbouring bins share whole numbers: they are added up bin by bin.
    entries = F.array(*[F.struct((F.col("_bin") - k).alias("bin"), F.col(f"_n{k}").alias("n")) for k in range(_DIGITS)])
    gathered = binned.groupBy(*by, "_column").agg(
        F.flatten(F.collect_list(F.when(F.col("_bin").isNotNull(), entries))).alias("_entries"),
        F.sum("_special").alias("_special"),
        F.sum("_n").alias("_n"),
    )
    low, high = F.array_min("_entries.bin"), F.array_max("_entries.bin")
    gathered = gathered.withColumn("_low", F.coalesce(low, F.lit(0))).withColumn("_high", F.coalesce(high, F.lit(0)))
    in_bin = lambda b: F.aggregate(
        F.filter("_entries", lambda e: e["bin"] == b), F.lit(0).cast("bigint"), lambda s, e: s + e["n"]
    )
    gathered = gathered.withColumn("_bins", F.transform(F.sequence("_low", F.col("_high") + _CARRY), in_bin))
    total = _rounded_total(gathered, "_total").withColumn(
        "_total", F.when(F.col("_n") > 0, F.coalesce("_special", "_total"))
    )
    of = lambda column, value: F.max(F.when(F.col("_column") == columns.index(column), value))
    return total.groupBy(*by).agg(
        *[of(column, F.col("_total")).alias(name) for name, column in sums.items()],
        *[of(column, F.try_divide("_total", "_n")).alias(name) for name, column in means.items()],
    )
