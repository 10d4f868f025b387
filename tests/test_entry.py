"""Every registered query against its SQL, and the shape of its plan."""

import decimal
import glob
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_module

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES = {q.__name__: q for q in entry_module._QUERIES}
ORACLE = {name: sql for name, sql in entry_module.oracle_sql().items() if name in QUERIES}


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        table = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    return connection


def _cell(value):
    if value is None or value is pd.NaT or value != value:
        return None
    if isinstance(value, (float, decimal.Decimal)):
        return float(value)
    return str(value)


def _rows(frame):
    frame = frame[sorted(frame.columns)]
    return sorted((tuple(map(_cell, r)) for r in frame.itertuples(index=False)), key=repr)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, database, name):
    result = QUERIES[name](spark, SF_DIR)
    found, expected = result.toPandas(), database.execute(ORACLE[name]).df()
    assert sorted(found.columns) == sorted(expected.columns)
    assert _rows(found) == _rows(expected)
    assert len(found) > 0
    plan = result._jdf.queryExecution().executedPlan().toString()
    for slow in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "SinglePartition, REPARTITION"):
        assert slow not in plan


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.columns == ["o_custkey", "total_spent", "avg_order_amount", "order_count"]
    assert df.count() > 0


def test_scans_read_only_what_a_query_needs(spark, plan_of):
    plan = plan_of(QUERIES["orders_customer_totals"](spark, SF_DIR))
    assert "o_orderstatus" not in plan and "o_orderpriority" not in plan
    plan = plan_of(QUERIES["document_word_count"](spark, SF_DIR))
    assert "ReadSchema: struct<text:string>" in plan
    plan = plan_of(QUERIES["rename_not_null"](spark, SF_DIR))
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderpriority:string>" in plan
