"""Loads of tables behind JDBC.

Spark writes a staging table over many connections, each committing for itself, and makes the
target in the database's own types. One transaction in the database then swaps the rows in, so the
target is never half loaded. Every name in the SQL is quoted as the database quotes names.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import DataFrame, functions as F, types as T

from millrace.operators.project import to_target
from millrace.sources.tables import JdbcDatabase

ROW_ID = "load_row_id"


def _staged_rows(database: JdbcDatabase, columns: Sequence[str], staging: str) -> str:
    # A task that ran twice wrote its rows twice, under the same row ids.
    names = ", ".join(map(database.quoted, columns))
    row_id = database.quoted(ROW_ID)
    return (
        f"SELECT {names} FROM (SELECT {names}, ROW_NUMBER() OVER "
        f"(PARTITION BY {row_id} ORDER BY {row_id}) AS copy_number "
        f"FROM {database.quoted_table(staging)}) s WHERE copy_number = 1"
    )


def fill_statement(
    database: JdbcDatabase, table: str, staging: str, columns: Sequence[str]
) -> str:
    names = ", ".join(map(database.quoted, columns))
    rows = _staged_rows(database, columns, staging)
    return f"INSERT INTO {database.quoted_table(table)} ({names}) {rows}"


def swap_statements(database: JdbcDatabase, table: str, new: str, old: str | None) -> list[str]:
    """Put a table in the place of another, which is set aside as ``old`` if there is one."""
    name, beside = database.quoted_table(table), database.quoted_table(new)
    aside = database.quoted_table(old) if old else ""
    if database.dialect == "mysql":  # commits each statement, but takes several renames in one
        moves = [f"{name} TO {aside}"] if old else []
        return ["RENAME TABLE " + ", ".join([*moves, f"{beside} TO {name}"])]
    rename = "ALTER TABLE {} RENAME TO {}"
    last = lambda t: database.quoted(t.rsplit(".", 1)[-1])
    moves = [rename.format(name, last(old))] if old else []
    return [*moves, rename.format(beside, last(table))]


def _create_empty(
    df: DataFrame, database: JdbcDatabase, table: str, schema: T.StructType, mode: str
) -> None:
    """Spark makes the table in the types of the database's dialect, and refuses others."""
    empty = df.sparkSession.createDataFrame([], schema)
    options = database.write_options(database.quoted_table(table), 1, 1)
    empty.write.format("jdbc").options(**options).mode(mode).save()


def _stage(
    df: DataFrame, database: JdbcDatabase, staging: str, batch_size: int, connections: int
) -> None:
    numbered = df.withColumn(ROW_ID, F.monotonically_increasing_id())
    options = database.write_options(database.quoted_table(staging), batch_size, connections)
    numbered.write.format("jdbc").options(**options).mode("overwrite").save()


def _run(
    connect: Callable[[], Any],
    statements: Sequence[str],
    counted: str | None = None,
    expected: int | None = None,
) -> None:
    """Statements in one transaction, committed if ``counted`` has as many rows as expected."""
    connection = connect()
    try:
        cursor = connection.cursor()
        for statement in statements:
            cursor.execute(statement)
        if counted is not None:
            cursor.execute(f"SELECT COUNT(*) FROM {counted}")
            arrived = cursor.fetchone()[0]
            if arrived != expected:
                raise RuntimeError(f"{arrived} rows arrived, {expected} were sent")
        connection.commit()
    except Exception:
        connection.rollback()
        raise
    finally:
        connection.close()


def _exists(connect: Callable[[], Any], table: str) -> bool:
    """Asked on a connection of its own: a refused statement can end a transaction."""
    try:
        _run(connect, [f"SELECT 1 FROM {table} WHERE 1 = 0"])
    except Exception:
        return False
    return True


def load_jdbc_table(
    df: DataFrame,
    database: JdbcDatabase,
    table: str,
    schema: T.StructType,
    connect: Callable[[], Any],
    batch_size: int = 10_000,
    connections: int = 32,
) -> int:
    """Replace all rows of a table by a frame, in one transaction; the table is made if absent.

    ``connect`` opens a DB-API connection for the swap. The frame must be read from files, not
    computed, because a task run again must number its rows as it did the first time; the flows
    give their ``load`` such a frame. DELETE, unlike TRUNCATE, can be rolled back everywhere.
    """
    df = to_target(df, schema)
    expected = df.count()
    staging = f"{table}__staging"
    _create_empty(df, database, table, schema, "append")
    _stage(df, database, staging, batch_size, connections)
    name = database.quoted_table(table)
    fill = fill_statement(database, table, staging, df.columns)
    _run(connect, [f"DELETE FROM {name}", fill], name, expected)
    _run(connect, [f"DROP TABLE {database.quoted_table(staging)}"])
    return expected


def replace_jdbc_table(
    df: DataFrame,
    database: JdbcDatabase,
    table: str,
    connect: Callable[[], Any],
    batch_size: int = 10_000,
    connections: int = 32,
) -> int:
    """Replace a table by a frame read from files, with the frame's own columns.

    The new table is filled beside the old one and its rows are counted; only then the names
    are changed, so a load that fails leaves the old table as it was.
    """
    expected = df.count()
    staging, new, old = f"{table}__staging", f"{table}__new", f"{table}__old"
    _create_empty(df, database, new, df.schema, "overwrite")
    _stage(df, database, staging, batch_size, connections)
    _run(connect, [fill_statement(database, new, staging, df.columns)], database.quoted_table(new), expected)
    name, aside = database.quoted_table(table), database.quoted_table(old)
    drop = "DROP TABLE IF EXISTS {}"
    _run(connect, [drop.format(aside)])
    present = _exists(connect, name)
    _run(connect, swap_statements(database, table, new, old if present else None))
    _run(connect, [drop.format(aside), f"DROP TABLE {database.quoted_table(staging)}"])
    return expected
