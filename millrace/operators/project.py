"""Column and row operators: all narrow, so they stay in one stage with the scan."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from decimal import Decimal

from pyspark.sql import DataFrame, functions as F, types as T

from millrace.functions import default_now, quoted, run_timestamp


def _holds(kind: T.DataType, value: object) -> bool:
    """Whether a type can hold a value as it is."""
    if isinstance(value, bool):
        return isinstance(kind, T.BooleanType)
    if isinstance(value, str):
        return isinstance(kind, T.StringType)
    if not isinstance(value, (int, float, Decimal)):
        return False
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return True
    exact = Decimal(str(value)) if isinstance(value, float) else Decimal(value)
    if not exact.is_finite():
        return False
    if isinstance(kind, T.DecimalType):
        digits = exact.scaleb(kind.scale)
        return digits == digits.to_integral_value() and abs(digits) < 10**kind.precision
    for whole, bits in ((T.ByteType, 8), (T.ShortType, 16), (T.IntegerType, 32), (T.LongType, 64)):
        if isinstance(kind, whole):
            return exact == exact.to_integral_value() and -(2 ** (bits - 1)) <= exact < 2 ** (bits - 1)
    return False


def fill_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Replace nulls (and NaN in floating columns) by a default per column.

    Spark would turn a number into text to fill a string column, cut a fraction off to fill a
    whole number, and skip a column that does not exist; all of that is refused here.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    filled = {}
    for name, value in defaults.items():
        if name not in types:
            raise ValueError(f"no column {name!r} to fill")
        kind = types[name]
        if not _holds(kind, value):
            raise TypeError(f"{value!r} is no default for {name!r} of type {kind.simpleString()}")
        column = quoted(name)
        if isinstance(kind, (T.FloatType, T.DoubleType)):
            column = F.nanvl(column, F.lit(None).cast(kind))
        default = F.lit(str(value)) if isinstance(kind, T.DecimalType) else F.lit(value)
        filled[name] = F.coalesce(column, default.cast(kind))
    return df.withColumns(filled) if filled else df


def stamp(
    df: DataFrame, column: str = "processed_timestamp", run_ts: datetime | None = None
) -> DataFrame:
    """Add the time of the run. Give ``run_ts`` when several outputs must carry the same one."""
    return df.withColumn(column, run_timestamp(run_ts))


def default_time(df: DataFrame, column: str) -> DataFrame:
    """Fill a missing time with the current one, as a table's column default does on insert."""
    return df.withColumn(column, default_now(quoted(column)))


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename columns; a name the frame does not have is left alone."""
    return df.withColumnsRenamed(dict(names))


def require_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep the rows that have a value in every one of these columns."""
    for name in columns:
        df = df.filter(quoted(name).isNotNull())
    return df


def select_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[quoted(c) for c in columns])


def to_target(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project onto a target's columns, in its order and types.

    A value that does not fit its target type stops the job. That needs ANSI casts; without
    them it would turn into a null or another number, so the setting is checked.
    """
    if df.sparkSession.conf.get("spark.sql.ansi.enabled") != "true":
        raise ValueError("casting to a target needs spark.sql.ansi.enabled=true")
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"the target needs columns the frame lacks: {missing}")
    return df.select(*[quoted(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def with_ones(df: DataFrame, column: str = "n") -> DataFrame:
    """Pair every row with the number one, for a sum by key."""
    return df.withColumn(column, F.lit(1))
