"""Casts that report every value that does not fit, in place of one error that stops the job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from millrace.functions import quoted

# What can be wrong with a value, as a case says it.
DOES_NOT_FIT = "does_not_fit"
MISSING = "missing"
CHANGED = "changed"

CASES = "_cases"


def _case(field: T.StructField, source: T.DataType, exact: bool) -> Column:
    """The case of a value, or null if it fits."""
    value = quoted(field.name)
    fitted = value.try_cast(field.dataType)
    kind = F.when(value.isNull(), F.lit(None if field.nullable else MISSING)).when(fitted.isNull(), F.lit(DOES_NOT_FIT))
    if exact and not isinstance(source, T.StringType):
        # Also what a cast rounds or cuts off: the value does not come back.
        kind = kind.when(~fitted.try_cast(source).eqNullSafe(value), F.lit(CHANGED))
    return F.when(
        kind.isNotNull(),
        F.struct(
            F.lit(field.name).alias("column"),
            kind.alias("case"),
            F.lit(field.dataType.simpleString()).alias("target"),
            value.cast("string").alias("value"),
        ),
    )


def try_target(
    df: DataFrame, schema: T.StructType, keep: Sequence[str] = (), exact: bool = False
) -> DataFrame:
    """The columns of a target, cast, with an array ``_cases`` of what did not fit in the row.

    A value that its type cannot hold (text that is no number, a number beyond the range) is a null in the target column and
    a case ``does_not_fit``; a null in a column that may have none is a case ``missing``. ``exact`` also reports numbers that
    the cast changes (``changed``), which are cast all the same. ``keep`` are further columns of the frame that stay as they
    are. One pass over the rows, nothing is shuffled, and no value stops the job.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    missing = [f.name for f in schema.fields if f.name not in types]
    if missing:
        raise ValueError(f"the target needs columns the frame lacks: {missing}")
    clash = [k for k in keep if k in schema.names]
    if clash or CASES in [*types, *keep]:
        raise ValueError(f"columns that are in the target already: {clash or [CASES]}")
    cases = F.array_compact(F.array(*[_case(f, types[f.name], exact) for f in schema.fields]))
    cast = [quoted(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields]
    return df.select(*cast, *[quoted(k) for k in keep], cases.alias(CASES))


def fitting(tried: DataFrame) -> DataFrame:
    """The rows of ``try_target`` without a case, ready to be loaded."""
    return tried.filter(F.size(CASES) == 0).drop(CASES)


def cast_cases(tried: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """A row per value of ``try_target`` that did not fit: the ``keep`` columns, ``column``, ``case``, ``target``, ``value``."""
    bad = tried.filter(F.size(CASES) > 0)
    return bad.select(*[quoted(k) for k in keep], F.explode(CASES).alias("_c")).select(*[quoted(k) for k in keep], "_c.*")


def cast_summary(tried: DataFrame) -> DataFrame:
    """``column``, ``case`` and ``failures``: how often each was found."""
    return cast_cases(tried).groupBy("column", "case").agg(F.count("*").alias("failures"))
