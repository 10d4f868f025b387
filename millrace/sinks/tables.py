"""Loads of tables in Spark's catalog.

A load writes a new folder and then points the table at it by one change of the catalog. Readers see
the old rows or the new ones, never a mixture, and a load that fails changes nothing.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession, types as T

from millrace import storage
from millrace.operators.project import to_target

# Fixed value: what a view of a load says before the folder's name.
_SELECT = "SELECT * FROM parquet."


def _shape(schema: T.StructType) -> list[tuple[str, str]]:
    return [(f.name.lower(), f.dataType.simpleString()) for f in schema.fields]


def _write_version(df: DataFrame, location: str) -> str:
    path = f"{location.rstrip('/')}/load_{uuid.uuid4().hex}"
    try:
        df.write.mode("errorifexists").parquet(path)
    except Exception:
        storage.delete(df.sparkSession, path)
        raise
    return path


def _create(df: DataFrame, table: str, path: str, schema: T.StructType) -> None:
    df.sparkSession.catalog.createTable(table, path=path, source="parquet", schema=schema)


def _drop_old_loads(spark: SparkSession, table: str, location: str, keep: int) -> None:
    """Removes all loads but the last ``keep``, and never the one the table points to."""
    if keep < 1:
        raise ValueError("the load that counts must be kept")
    current = _location(spark, table).rsplit("/", 1)[1]
    loads = {n: t for n, t in storage.children(spark, location).items() if n.startswith("load_")}
    newest = sorted(loads, key=lambda n: (n == current, loads[n], n), reverse=True)
    for name in newest[keep:]:
        storage.delete(spark, f"{location.rstrip('/')}/{name}")


def _is_view(spark: SparkSession, table: str) -> bool:
    return spark.catalog.getTable(table).tableType == "VIEW"


def _location(spark: SparkSession, table: str) -> str:
    facts = spark.sql(f"DESCRIBE TABLE EXTENDED {table}")
    if not _is_view(spark, table):
        return facts.filter("col_name = 'Location'").first()["data_type"]
    text = facts.filter("col_name = 'View Text'").first()["data_type"]
    name = text.removeprefix(_SELECT)[1:-1].replace("``", "`")
    return re.sub(r"\\(.)", r"\1", name)


def load_table(
    df: DataFrame, table: str, schema: T.StructType, location: str, keep: int = 2
) -> None:
    """Replace all rows of a table of a fixed schema, creating it if it is absent.

    The frame is projected and cast to ``schema``; a value that does not fit, or a table of
    another shape, stops the load. An empty frame empties the table. ``location`` belongs to the
    table and holds one folder per load; the last ``keep`` stay for queries that read them.
    """
    spark = df.sparkSession
    present = spark.catalog.tableExists(table)
    if present:
        found = _shape(spark.table(table).schema)
        if found != _shape(schema):
            raise ValueError(f"table {table} has the columns {found}, not those of the load")
    path = _write_version(to_target(df, schema), location)
    if present and _is_view(spark, table):
        _point_view(spark, table, path)
    elif present:
        spark.sql(f"ALTER TABLE {table} SET LOCATION {_sql_text(path)}")
        spark.catalog.refreshTable(table)
    else:
        _create(df, table, path, schema)
    _drop_old_loads(spark, table, location, keep)


def replace_table(df: DataFrame, table: str, location: str, keep: int = 2) -> None:
    """Replace a table, schema and all, by a frame.

    The name is a view of the folder of one load. A new load is written whole, and then one change of the
    catalog points the view to it: whoever asks for the name gets the old table or the new one at any moment, and a
    driver that dies leaves one of them. The last ``keep`` loads stay for queries that still read them.

    A plain table of the name (made by ``load_table`` or by others) is turned into a view once, which takes two
    changes; if the second fails the table is put back. Rows cannot be inserted into a view; ``load_table`` takes it.
    """
    spark = df.sparkSession
    path = _write_version(df, location)
    plain = None
    try:
        if spark.catalog.tableExists(table) and not _is_view(spark, table):
            plain = (_location(spark, table), spark.table(table).schema)
            spark.sql(f"DROP TABLE {table}")  # its files stay if it was made with a path
        _point_view(spark, table, path)
    except Exception:
        if plain is not None and not spark.catalog.tableExists(table):
            _create(df, table, *plain)
        storage.delete(spark, path)
        raise
    _drop_old_loads(spark, table, location, keep)


def _point_view(spark: SparkSession, table: str, path: str) -> None:
    """One change of the catalog. (``CREATE OR REPLACE VIEW`` would be two: Spark drops the old view first.)"""
    change = "ALTER" if spark.catalog.tableExists(table) else "CREATE"
    name = storage.literal(path).replace("`", "``")
    spark.sql(f"{change} VIEW {table} AS {_SELECT}`{name}`")


def _sql_text(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
