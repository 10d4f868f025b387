"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from millrace.functions import quoted


def _orderable(data_type: T.DataType) -> bool:
    if isinstance(data_type, T.ArrayType):
        return _orderable(data_type.elementType)
    if isinstance(data_type, T.StructType):
        return all(_orderable(f.dataType) for f in data_type.fields)
    return not isinstance(data_type, (T.MapType, T.VariantType, T.CalendarIntervalType))


def _rank(field: T.StructField) -> Column:
    """The column in a form that has an order: a map as its sorted entries."""
    column, kind = quoted(field.name), field.dataType
    if isinstance(kind, T.MapType) and _orderable(kind.keyType) and _orderable(kind.valueType):
        return F.array_sort(F.map_entries(column))
    if not _orderable(kind):
        raise TypeError(f"{field.name!r} of type {kind.simpleString()} cannot decide between rows")
    return column


def dedupe(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] = (),
    keep: str = "first",
) -> DataFrame:
    """Keep one row per key: the first (or last) by ``order_by``, then by all other columns.

    The choice depends on the values alone, so two outputs built from the same input agree
    however it was partitioned. Null keys form one group, nulls sort first. A map counts as its
    sorted entries; columns of other types without an order are refused.

    It is a min (or max) over the row itself, which Spark combines before the shuffle: each
    task sends at most one row per key, however many rows one key holds. The sort it needs is
    on the keys only. A ``row_number`` window gives the same rows but sorts on every column
    twice, and took a third longer on data with a hot key.
    """
    if keep not in ("first", "last"):
        raise ValueError(f"keep must be 'first' or 'last', not {keep!r}")
    missing = [c for c in (*keys, *order_by) if c not in df.columns]
    if missing:
        raise ValueError(f"no such columns: {missing}")
    others = [f for f in df.schema.fields if f.name not in keys]
    if not others:
        return df.dropDuplicates(list(keys))

    leading = [c for c in order_by if c not in keys]
    by_name = {f.name: f for f in others}
    ranked = [by_name[c] for c in leading] + [f for f in others if f.name not in leading]
    ranking = [_rank(f) for f in ranked]
    if all(_orderable(f.dataType) for f in others):
        pick = F.min if keep == "first" else F.max
        row = pick(F.struct(*ranking))
    else:
        pick_by = F.min_by if keep == "first" else F.max_by
        row = pick_by(F.struct(*[quoted(f.name) for f in others]), F.struct(*ranking))

    picked = df.groupBy(*[quoted(k) for k in keys]).agg(row.alias("__row"))
    return picked.select(
        *[
            quoted(c) if c in keys else F.col("__row").getField(c).alias(c)
            for c in df.columns
        ]
    )


def dedupe_any(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keep one row per key, whichever comes first. Use it when the choice does not matter."""
    return df.dropDuplicates(list(keys))
