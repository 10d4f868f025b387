import os
import threading
import uuid
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException

from millrace import schemas
from millrace.operators import stamp
from millrace.sinks import jdbc, load_jdbc_table, load_table, replace_jdbc_table, replace_table
from millrace.sinks import tables as catalog_tables
from millrace.sources import (
    JdbcDatabase,
    equal_bounds,
    even_predicates,
    from_rows,
    range_predicates,
    read_jdbc,
    read_table,
    tables,
)

RUN_TS = datetime(2024, 5, 6, 7, 8, 9)
ROWS = [(1, 1, Decimal("100.50"), RUN_TS), (2, 2, Decimal("250.00"), RUN_TS)]
TARGET = schemas.ORDERS_TRANSFORMED


@pytest.fixture
def name():
    return f"t_{uuid.uuid4().hex}"


def test_load_creates_then_replaces(spark, folder, name):
    load_table(from_rows(spark, ROWS, TARGET), name, TARGET, folder)
    assert sorted(map(tuple, read_table(spark, name).collect())) == ROWS
    load_table(from_rows(spark, ROWS[:1], TARGET), name, TARGET, folder)
    assert list(map(tuple, read_table(spark, name).collect())) == ROWS[:1]
    assert read_table(spark, name, ["amount"]).columns == ["amount"]


def test_location_with_a_quote(spark, folder, name):
    for rows in (ROWS, ROWS[:1]):
        load_table(from_rows(spark, rows, TARGET), name, TARGET, f"{folder}/it's")
    assert read_table(spark, name).count() == 1


def test_empty_frame_empties_the_table(spark, folder, name):
    load_table(from_rows(spark, ROWS, TARGET), name, TARGET, folder)
    load_table(from_rows(spark, [], TARGET), name, TARGET, folder)
    assert read_table(spark, name).count() == 0


def test_failed_load_changes_nothing(spark, folder, name):
    load_table(from_rows(spark, ROWS, TARGET), name, TARGET, folder)
    too_big = stamp(spark.sql("select 3000000000 as order_id, 1 as customer_id, 1.0 as amount"))
    with pytest.raises(PySparkException):
        load_table(too_big, name, TARGET, folder)
    assert read_table(spark, name).count() == 2


def test_load_refuses_a_table_of_another_shape(spark, folder, name):
    replace_table(spark.range(3), name, folder)
    with pytest.raises(ValueError, match="columns"):
        load_table(from_rows(spark, ROWS, TARGET), name, TARGET, folder)
    assert read_table(spark, name).count() == 3


def test_old_loads_go(spark, folder, name):
    for i in range(5):
        load_table(from_rows(spark, ROWS[:1], TARGET), name, TARGET, folder, keep=2)
    assert len(os.listdir(folder)) == 2
    for i in range(4):
        replace_table(spark.range(i), name, folder, keep=1)
    assert len(os.listdir(folder)) == 1 and read_table(spark, name).count() == 3
    with pytest.raises(ValueError):
        replace_table(spark.range(1), name, folder, keep=0)


def test_failed_replace_changes_nothing(spark, folder, name, monkeypatch):
    replace_table(spark.range(3), name, folder)
    with pytest.raises(PySparkException):
        replace_table(spark.range(5).selectExpr("1 div (id - id) as x"), name, folder)
    assert read_table(spark, name).count() == 3

    monkeypatch.setattr(catalog_tables, "_point_view", away)
    with pytest.raises(RuntimeError):
        replace_table(spark.range(5).selectExpr("id as other"), name, folder)
    assert read_table(spark, name).columns == ["id"] and read_table(spark, name).count() == 3
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith(name)] == [name]
    assert len([f for f in os.listdir(folder) if f.startswith("load_")]) == 1


def away(*_):
    raise RuntimeError("the catalog is away")


def test_a_plain_table_becomes_a_view_or_stays(spark, folder, name, monkeypatch):
    load_table(from_rows(spark, ROWS, TARGET), name, TARGET, folder)
    with monkeypatch.context() as broken:
        broken.setattr(catalog_tables, "_point_view", away)
        with pytest.raises(RuntimeError):
            replace_table(spark.range(5), name, folder)
    assert sorted(map(tuple, read_table(spark, name).collect())) == ROWS
    replace_table(spark.range(5), name, folder)
    assert read_table(spark, name).count() == 5
    replace_table(from_rows(spark, ROWS[:1], TARGET), name, folder)
    # A load takes the view, if it has the columns.
    load_table(from_rows(spark, ROWS, TARGET), name, TARGET, folder)
    assert sorted(map(tuple, read_table(spark, name).collect())) == ROWS
    load_table(from_rows(spark, [], TARGET), name, TARGET, folder)
    assert read_table(spark, name).count() == 0


def test_replacing_is_one_change_of_the_catalog(spark, folder, name, monkeypatch):
    replace_table(spark.range(3), name, folder)
    said = []
    plain = type(spark).sql
    monkeypatch.setattr(type(spark), "sql", lambda self, query, *a, **b: said.append(query) or plain(self, query, *a, **b))
    replace_table(spark.range(4), name, folder)
    changes = [q for q in said if not q.startswith(("SHOW", "DESCRIBE"))]
    assert len(changes) == 1 and changes[0].startswith(f"ALTER VIEW {name} AS ")


def test_readers_never_miss_the_table(spark, folder, name):
    """A thread asks for the table without a break while it is replaced thirty times."""
    replace_table(spark.range(1), name, folder)
    counts, errors, done = [], [], threading.Event()

    def read():
        while not done.is_set():
            try:
                counts.append(read_table(spark, name).count())
            except Exception as error:
                errors.append(error)

    reader = threading.Thread(target=read)
    reader.start()
    try:
        for i in range(2, 32):
            replace_table(spark.range(i), name, folder, keep=40)
    finally:
        done.set()
        reader.join()
    assert not errors, errors[0]
    assert counts == sorted(counts) and set(counts) <= set(range(1, 32)) and len(counts) > 5


def test_a_query_under_way_reads_the_load_it_began_with(spark, folder, name):
    replace_table(spark.range(3), name, folder)
    before = read_table(spark, name)
    replace_table(spark.range(7).selectExpr("id as other"), name, folder)
    assert before.count() == 3 and read_table(spark, name).columns == ["other"]


@pytest.mark.parametrize("odd", ["it's", "a [1] {b} *", "back\\slash", "tick`"])
def test_folders_with_odd_names(spark, folder, name, odd):
    for n in (2, 3):
        replace_table(spark.range(n), name, f"{folder}/{odd}", keep=1)
    assert read_table(spark, name).count() == 3 and len(os.listdir(f"{folder}/{odd}")) == 1


def test_replace_brings_its_own_columns(spark, folder, name):
    replace_table(from_rows(spark, ROWS, TARGET), name, folder)
    replace_table(spark.range(4).selectExpr("id as `1958`"), name, folder)
    assert read_table(spark, name).columns == ["1958"] and read_table(spark, name).count() == 4


# No database runs in these tests: what would be sent to one is checked instead.


class FakeConnection:
    def __init__(self, inserted, fail_on=None):
        self.log, self.inserted, self.fail_on = [], inserted, fail_on

    def cursor(self):
        return self

    def execute(self, sql):
        if self.fail_on and sql.startswith(self.fail_on):
            raise RuntimeError("database says no")
        self.log.append(sql)

    def fetchone(self):
        return (self.inserted,)

    def commit(self):
        self.log.append("commit")

    def rollback(self):
        self.log.append("rollback")

    def close(self):
        self.log.append("close")


@pytest.fixture
def staged(monkeypatch):
    """What Spark would write to the database."""
    calls = []
    monkeypatch.setattr(jdbc, "_stage", lambda df, *rest: calls.append((df.columns, rest)))
    monkeypatch.setattr(jdbc, "_create_empty", lambda df, *rest: calls.append((df.columns, rest)))
    return calls


ODD = [("January", "int"), ("1958", "int"), ("order", "string"), ('say "a`b"', "double")]


@pytest.fixture
def odd(spark, folder):
    schema = ", ".join(f"`{n.replace('`', '``')}` {t}" for n, t in ODD)
    spark.createDataFrame([(1, 2, "x", 0.5), (3, 4, None, None)], schema).write.parquet(f"{folder}/in")
    return spark.read.parquet(f"{folder}/in")


MYSQL = JdbcDatabase("jdbc:mysql://host/db", {"user": "u", "password": "p"})
OTHER = JdbcDatabase("jdbc:postgresql://host/db")


class Connections:
    """Hands out connections that share a log."""

    def __init__(self, counts, fail_on=None, tables=()):
        self.log, self.counts, self.fail_on, self.tables = [], list(counts), fail_on, tables

    def __call__(self):
        connection = FakeConnection(self.counts[0] if self.counts else 0, self.fail_on)
        connection.log = self.log
        plain = connection.execute

        def execute(sql):
            if sql.startswith("SELECT 1 FROM") and not any(t in sql for t in self.tables):
                raise RuntimeError("no such table")
            plain(sql)

        connection.execute = execute
        return connection


def test_jdbc_load_swaps_in_one_transaction(odd, staged):
    target = odd.schema
    connect = Connections([2])
    assert jdbc.load_jdbc_table(odd, MYSQL, "web.out", target, connect) == 2
    names = '`January`, `1958`, `order`, `say "a``b"`'
    assert connect.log == [
        "DELETE FROM `web`.`out`",
        f"INSERT INTO `web`.`out` ({names}) SELECT {names} FROM (SELECT {names}, ROW_NUMBER() OVER "
        "(PARTITION BY `load_row_id` ORDER BY `load_row_id`) AS copy_number "
        "FROM `web`.`out__staging`) s WHERE copy_number = 1",
        "SELECT COUNT(*) FROM `web`.`out`",
        "commit",
        "close",
        "DROP TABLE `web`.`out__staging`",
        "commit",
        "close",
    ]
    assert staged[0][1][1:] == ("web.out", target, "append")
    assert staged[1][1][1] == "web.out__staging"


def test_jdbc_names_are_quoted_as_the_database_does():
    assert jdbc.fill_statement(OTHER, "t", "s", ["1958"]).startswith(
        'INSERT INTO "t" ("1958") SELECT "1958" FROM (SELECT "1958", ROW_NUMBER()'
    )
    assert OTHER.quoted('a"b') == '"a""b"' and MYSQL.quoted_table("x.y") == "`x`.`y`"


def test_jdbc_load_rolls_back_when_rows_are_missing(odd, staged):
    connect = Connections([1])
    with pytest.raises(RuntimeError, match="1 rows arrived, 2 were sent"):
        load_jdbc_table(odd, OTHER, "t", odd.schema, connect)
    assert connect.log[-2:] == ["rollback", "close"] and "commit" not in connect.log


def test_jdbc_load_rolls_back_on_an_error(odd, staged):
    connect = Connections([2], fail_on="INSERT")
    with pytest.raises(RuntimeError, match="says no"):
        load_jdbc_table(odd, OTHER, "t", odd.schema, connect)
    assert connect.log[-2:] == ["rollback", "close"]


@pytest.mark.parametrize("present", [True, False])
@pytest.mark.parametrize("database", [MYSQL, OTHER])
def test_jdbc_replace_fills_beside_and_renames(odd, staged, database, present):
    connect = Connections([2], tables=[database.quoted("t")] if present else [])
    assert replace_jdbc_table(odd, database, "t", connect) == 2
    q = database.quoted
    statements = [x for x in connect.log if x not in ("commit", "close", "rollback")]
    assert statements[0].startswith(f"INSERT INTO {q('t__new')} ({q('January')}, {q('1958')}, ")
    assert statements[1] == f"SELECT COUNT(*) FROM {q('t__new')}"
    swap = [x for x in statements if "RENAME" in x]
    if database is MYSQL:
        old = "`t` TO `t__old`, " if present else ""
        assert swap == [f"RENAME TABLE {old}`t__new` TO `t`"]
    else:
        old = ['ALTER TABLE "t" RENAME TO "t__old"'] if present else []
        assert swap == [*old, 'ALTER TABLE "t__new" RENAME TO "t"']
    # The old table is touched only after the new one has been counted.
    touched = [i for i, x in enumerate(statements) if f" {q('t')} " in f"{x} " and "RENAME" in x]
    assert min(touched) > 1
    assert staged[0][1][1:] == ("t__new", odd.schema, "overwrite")


def test_jdbc_replace_that_fails_leaves_the_old_table(odd, staged):
    connect = Connections([1], tables=['"t"'])
    with pytest.raises(RuntimeError, match="1 rows arrived"):
        replace_jdbc_table(odd, OTHER, "t", connect)
    assert not [x for x in connect.log if "RENAME" in x or x.startswith("DROP")]


def test_spark_writes_the_target_in_the_types_of_its_dialect(spark):
    """The types that Spark would give a new table, from its own dialects."""
    dialects = spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects
    types = spark._jvm.org.apache.spark.sql.types.DataTypes
    for url, text in ((OTHER.url, "TEXT"), (MYSQL.url, "LONGTEXT")):
        found = dialects.get(url).getJDBCType(types.StringType)
        assert found.isDefined() and found.get().databaseTypeDefinition() == text


def test_a_task_that_runs_again_numbers_its_rows_the_same(spark, folder):
    spark.range(0, 1000, 1, 4).write.parquet(f"{folder}/in")
    numbered = spark.read.parquet(f"{folder}/in").withColumn(
        jdbc.ROW_ID, jdbc.F.monotonically_increasing_id()
    )
    first, again = numbered.collect(), numbered.collect()
    assert sorted(first) == sorted(again)
    assert len({r[jdbc.ROW_ID] for r in first}) == 1000


DB = JdbcDatabase("jdbc:some:db", {"user": "u", "password": "p"})


def test_jdbc_options():
    assert DB.scan_options() == {
        "user": "u", "password": "p", "url": "jdbc:some:db", "fetchsize": "10000",
    }
    assert DB.write_options("t", 5, 2)["numPartitions"] == "2"
    assert tables.bounds_query(MYSQL, "shop.orders", "1958") == (
        "SELECT MIN(`1958`) AS lo, MAX(`1958`) AS hi FROM `shop`.`orders`"
    )


class FakeReader:
    """Stands for ``spark.read``: keeps the options of every load."""

    def __init__(self, bounds):
        self.bounds, self.loads, self.current = bounds, [], {}

    @property
    def read(self):
        self.current = {}
        return self

    def format(self, name):
        reader = FakeReader(self.bounds)
        reader.loads, reader.current = self.loads, {"format": name}
        return reader

    def options(self, **options):
        self.current.update(options)
        return self

    def option(self, key, value):
        self.current[key] = value
        return self

    def load(self):
        self.loads.append(self.current)
        return self

    def first(self):
        return self.bounds


def test_jdbc_read_is_split_over_the_range_of_its_key():
    spark = FakeReader((1, 900))
    read_jdbc(spark, DB, "orders", "order_id", num_partitions=8)
    bounds, scan = spark.loads
    assert bounds["query"].startswith('SELECT MIN("order_id")')
    assert scan["dbtable"] == '"orders"' and scan["partitionColumn"] == "order_id"
    assert (scan["lowerBound"], scan["upperBound"], scan["numPartitions"]) == ("1", "900", "8")


def test_jdbc_read_of_an_empty_table_and_without_a_key():
    spark = FakeReader((None, None))
    read_jdbc(spark, DB, "orders", "order_id")
    assert "partitionColumn" not in spark.loads[-1]
    read_jdbc(spark, DB, "orders")
    assert len(spark.loads) == 3 and spark.loads[-1]["dbtable"] == '"orders"' 


@pytest.mark.parametrize("count", [1, 3, 8])
def test_even_predicates_cover_every_row_once(spark, count):
    ids = spark.range(-1000, 1000).union(spark.sql("select cast(null as bigint)"))
    met = " + ".join(f"int(coalesce({p}, false))" for p in even_predicates("id", count))
    assert ids.selectExpr(f"{met} as n").filter("n <> 1").count() == 0
    sizes = [ids.filter(p).count() for p in even_predicates("id", count)]
    assert sum(sizes) == 2001 and max(sizes) <= 2 * (2001 // count + 1)


def test_equal_ranges_of_keys_with_gaps(spark):
    """Most keys lie in a small part of their range."""
    keys = spark.range(100_000).selectExpr("if(id % 10 = 0, id * 1000000, id) as k")
    bounds = equal_bounds(keys, "k", 16)
    predicates = range_predicates("`k`", bounds)
    sizes = [keys.filter(p).count() for p in predicates]
    assert len(sizes) == 16 and sum(sizes) == 100_000
    assert max(sizes) <= 1.1 * min(sizes)
    nulls = spark.sql("SELECT cast(null as bigint) AS k")
    assert [nulls.filter(p).count() for p in predicates] == [1] + [0] * 15


def test_equal_ranges_of_other_types_and_of_few_keys(spark):
    assert range_predicates("k", [date(2024, 1, 2), date(2024, 2, 1)]) == [
        "(k < DATE '2024-01-02' OR k IS NULL)", "k >= DATE '2024-01-02' AND k < DATE '2024-02-01'", "k >= DATE '2024-02-01'",
    ]
    assert range_predicates("k", [datetime(2024, 1, 2, 3, 4, 5, 6)])[1] == "k >= TIMESTAMP '2024-01-02 03:04:05.000006'"
    assert range_predicates("k", ["it's"])[1] == "k >= 'it''s'"
    with pytest.raises(TypeError):
        range_predicates("k", [True])
    # A value that most rows share cannot be cut; no row is lost or read twice.
    hot = spark.range(1000).selectExpr("if(id % 3 = 0, 7, id) as k")
    predicates = range_predicates("k", equal_bounds(hot, "k", 8))
    assert len(predicates) <= 8 and sum(hot.filter(p).count() for p in predicates) == 1000
    assert range_predicates("k", equal_bounds(hot.limit(0), "k", 8)) == ["1 = 1"]
    assert equal_bounds(hot, "k", 1) == []


@pytest.mark.parametrize("url, quote", [("jdbc:mysql://h/db", "`"), ("jdbc:postgresql://h/db", '"')])
def test_equal_ranges_read_the_key_once(spark, monkeypatch, url, quote):
    """What would be sent to a database: the key alone, then a range per task."""
    asked, keys = [], spark.range(1000).selectExpr("id * id as range_key")

    class Reader:
        def __init__(self):
            self.said = {}

        def format(self, name):
            return self

        def options(self, **options):
            self.said.update(options)
            return self

        def option(self, name, value):
            self.said[name] = value
            return self

        def load(self):
            asked.append(self.said["query"])
            return keys

        def jdbc(self, url, table, predicates, properties):
            asked.append((table, predicates))
            return keys

    monkeypatch.setattr(type(spark), "read", property(lambda _: Reader()))
    read_jdbc(spark, JdbcDatabase(url), "orders", "order", 4, equal_ranges=True)
    key = f"{quote}order{quote}"
    assert asked[0] == f"SELECT {key} AS range_key FROM {quote}orders{quote}"
    table, predicates = asked[1]
    assert table == f"{quote}orders{quote}" and len(predicates) == 4 and predicates[0].startswith(f"({key} < ")
    with pytest.raises(ValueError, match="partition_column"):
        read_jdbc(spark, JdbcDatabase(url), "orders", equal_ranges=True)
