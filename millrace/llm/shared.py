"""What the operators share: stored intermediate tables, and the package on the executors."""

from __future__ import annotations

import io
import os
import zipfile
from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

import millrace
from millrace import storage
from millrace.session import scratch_path

_SHIPPED: set[str] = set()


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame written once under the shared scratch folder and read back.

    Whatever is derived from it starts from files that all executors see: nothing is computed
    twice, and a lost executor costs single tasks.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Gives the executors' Python this package, once per application.

    The archive lies in the shared scratch folder, from where executors fetch it when they start.
    """
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(millrace.__file__))
    archive = io.BytesIO()
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, files in os.walk(root):
            for name in files:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(root)))
    path = f"{scratch_path(spark, 'package')}/millrace.zip"
    storage.write_bytes(spark, path, archive.getvalue())
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)


#: Rows that are added up at a time are at most two to this power.
_STEP_BITS = 5


def added_up(
    rows: DataFrame, keys: Sequence[str], add: Callable[[pa.Table], pa.Table], schema: str, tasks: int
) -> DataFrame:
    """One row per key from rows that ``tasks`` tasks have given, one a key each, with their numbers as ``task``.

    ``add`` makes one row of the rows of a key, its ``task`` that of any of them. Rows of 32 neighbouring tasks are added up
    first, then those of 32 such groups, and so on, so that what meets in a group does not grow with the number of tasks.
    """
    left = -(-tasks >> _STEP_BITS)
    while left > 1:
        rows = rows.withColumn("task", F.shiftright("task", _STEP_BITS)).groupBy(*keys, "task").applyInArrow(add, schema)
        left = -(-left >> _STEP_BITS)
    return rows.groupBy(*keys).applyInArrow(add, schema)


def fold(key: Column, folds: int) -> Column:
    """The CRC-32 of the id as text, modulo ``folds``. Null ids are in fold 0."""
    return F.coalesce(F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(folds)), F.lit(0)).cast("int")
