"""Small collections held by the program itself."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, types as T


def from_lines(spark: SparkSession, lines: Iterable[str], column: str = "line") -> DataFrame:
    return spark.createDataFrame([(line,) for line in lines], f"`{column}` string")


def from_rows(spark: SparkSession, rows: Iterable[tuple], schema: T.StructType | str) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)
