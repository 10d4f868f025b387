"""Scans of relational tables: those of Spark's catalog, and those behind JDBC."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.functions import quoted
from millrace.operators.project import select_columns


def read_table(spark: SparkSession, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A table of Spark's catalog: all columns, or the ones named."""
    df = spark.table(name)
    return df if columns is None else select_columns(df, columns)


@dataclass(frozen=True)
class JdbcDatabase:
    """Where a database is. The driver jar, user and password come from the caller."""

    url: str
    options: Mapping[str, str] = field(default_factory=dict)

    @property
    def dialect(self) -> str:
        """``mysql`` for MySQL and its kin, ``standard`` for others."""
        return "mysql" if self.url.startswith(("jdbc:mysql:", "jdbc:mariadb:")) else "standard"

    def quoted(self, name: str) -> str:
        """A name as the database quotes it, so that any name stands for itself."""
        mark = "`" if self.dialect == "mysql" else '"'
        return mark + name.replace(mark, mark + mark) + mark

    def quoted_table(self, table: str) -> str:
        """A table's name, its parts at dots quoted each."""
        return ".".join(map(self.quoted, table.split(".")))

    def scan_options(self, fetch_size: int = 10_000) -> dict[str, str]:
        return {**self.options, "url": self.url, "fetchsize": str(fetch_size)}

    def write_options(self, table: str, batch_size: int, connections: int) -> dict[str, str]:
        return {
            **self.options,
            "url": self.url,
            "dbtable": table,
            "batchsize": str(batch_size),
            "numPartitions": str(connections),
        }


def read_jdbc(
    spark: SparkSession,
    database: JdbcDatabase,
    table: str,
    partition_column: str | None = None,
    num_partitions: int = 64,
    predicates: Sequence[str] | None = None,
    equal_ranges: bool = False,
) -> DataFrame:
    """A table behind JDBC; filters and column choices made on it run in the database.

    ``partition_column`` (the primary key) splits the read into ``num_partitions`` ranges
    between its smallest and largest value, asked from the database as one row. Rows
    outside them and null keys belong to the first and last range, so none is lost. Where
    the ids have large gaps, so that a few ranges would hold most rows, ask for ``equal_ranges``: the
    column alone is read once, for bounds between which lie equally many rows, and each task
    then reads its range. Or give ``predicates``, one condition per task that together cover every row once.
    """
    options = database.scan_options()
    name, table = table, database.quoted_table(table)
    if equal_ranges:
        if partition_column is None or predicates is not None:
            raise ValueError("equal ranges need a partition_column, and take no predicates")
        keys = spark.read.format("jdbc").options(**options).option("query", keys_query(database, name, partition_column))
        bounds = equal_bounds(keys.load(), "range_key", num_partitions)
        predicates = range_predicates(database.quoted(partition_column), bounds)
    if predicates is not None:
        properties = {k: v for k, v in options.items() if k != "url"}
        return spark.read.jdbc(
            database.url, table, predicates=list(predicates), properties=properties
        )
    reader = spark.read.format("jdbc").options(**options)
    if partition_column is None:
        return reader.option("dbtable", table).load()
    bounds = (
        spark.read.format("jdbc")
        .options(**options)
        .option("query", bounds_query(database, name, partition_column))
        .load()
        .first()
    )
    if bounds[0] is None:
        return reader.option("dbtable", table).load()
    return reader.options(
        dbtable=table,
        partitionColumn=partition_column,
        lowerBound=str(bounds[0]),
        upperBound=str(bounds[1]),
        numPartitions=str(num_partitions),
    ).load()


def even_predicates(column: str, count: int) -> list[str]:
    """Conditions that deal whole-number ids out evenly, however they are spread.

    ``column`` stands in the SQL as it is given (``JdbcDatabase.quoted``). The database reads the
    table, or an index on the column, once per condition.
    """
    parts = [f"ABS(MOD({column}, {count})) = {i}" for i in range(count)]
    parts[0] = f"({parts[0]} OR {column} IS NULL)"
    return parts


def equal_bounds(keys: DataFrame, column: str, count: int) -> list:
    """Values of a column that cut its rows into ``count`` ranges of nearly equal size, in order, from one pass.

    They come from a quantile sketch of bounded size, whose ranks are off by less than a fiftieth of a range, so
    ranges of a key without repeats are within a tenth of each other. A value that many rows share is in one range; there are fewer
    bounds then. Nulls do not count.
    """
    if count < 2:
        return []
    parts = [i / count for i in range(1, count)]
    found = keys.agg(F.percentile_approx(quoted(column), parts, 50 * count).alias("q")).first()["q"]
    return sorted(set(found or []))


def _sql_value(value: object) -> str:
    if isinstance(value, bool) or not isinstance(value, (int, float, Decimal, date, str)):
        raise TypeError(f"{value!r} is no key to cut at")
    if isinstance(value, datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, date):
        return f"DATE '{value.isoformat()}'"
    return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else str(value)


def range_predicates(column: str, bounds: Sequence[object]) -> list[str]:
    """Conditions that put every row into one of the ranges between the bounds; nulls are in the first.

    ``column`` stands in the SQL as it is given (``JdbcDatabase.quoted``). Where there is an index on it, the
    database reads each range for itself.
    """
    if not bounds:
        return ["1 = 1"]
    values = [_sql_value(b) for b in bounds]
    first = f"({column} < {values[0]} OR {column} IS NULL)"
    between = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(values, values[1:], strict=False)]
    return [first, *between, f"{column} >= {values[-1]}"]


def keys_query(database: JdbcDatabase, table: str, column: str) -> str:
    return f"SELECT {database.quoted(column)} AS range_key FROM {database.quoted_table(table)}"


def bounds_query(database: JdbcDatabase, table: str, column: str) -> str:
    name = database.quoted(column)
    return f"SELECT MIN({name}) AS lo, MAX({name}) AS hi FROM {database.quoted_table(table)}"
