"""Reduction of the values of a key by any associative and commutative function."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from millrace.functions import quoted

#: Rows that are folded at a time are at most two to this power.
_BATCH_BITS = 12


def _nullable(kind: T.DataType) -> T.DataType:
    """The same type with nulls allowed inside, as a column of two values may have them."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _nullable(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_nullable(kind.elementType))
    if isinstance(kind, T.MapType):
        return T.MapType(_nullable(kind.keyType), _nullable(kind.valueType))
    return kind


def fold_by_key(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    combine: Callable[[Column, Column], Column],
    name: str = "value",
    rounds: int = 2,
) -> DataFrame:
    """One row per key with its values reduced to one, as ``combine`` gives the column of two.

    ``combine`` must be associative and commutative and give the type of ``value``: products, bit operations,
    the longer of two texts, a merge of structs. Nulls are left out; a key without values has a null. Null keys
    form a group. For sums, extremes and counts ``reduce_by_key`` is faster, as Spark knows these.

    No value waits for all others of its key. In each of ``rounds`` rounds a task orders its rows by key and folds
    runs of 4096 rows, so that a key that has most of the rows leaves one value for each 4096 of them, and these are
    dealt to all tasks anew, by key and run. What is left, a value per 4096 ** ``rounds`` rows of a key and one per task,
    is folded by key.
    """
    kind = _nullable(df.select(quoted(value)).schema[0].dataType)
    by = [f"_k{i}" for i in range(len(keys))]
    rows = df.select(*[quoted(k).alias(b) for k, b in zip(keys, by, strict=True)], quoted(value).cast(kind).alias("_v"))

    def folded(frame: DataFrame, *group: str) -> DataFrame:
        values = frame.groupBy(*group).agg(F.collect_list("_v").alias("_all"))
        rest = F.slice("_all", F.lit(2), F.greatest(F.size("_all") - 1, F.lit(0)))
        one = F.aggregate(rest, F.get("_all", F.lit(0)), lambda a, b: combine(a, b).cast(kind))
        return values.select(*by, one.alias("_v"))

    for _ in range(rounds):
        runs = rows.sortWithinPartitions(*by).withColumn(
            "_run", F.shiftright(F.monotonically_increasing_id(), _BATCH_BITS)
        )
        rows = folded(runs, *by, "_run")
    return folded(rows, *by).select(*[F.col(b).alias(k) for k, b in zip(keys, by, strict=True)], F.col("_v").alias(name))
