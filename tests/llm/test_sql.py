"""The registered queries against their SQL, and all of them over whole tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry_module
from millrace.llm.queries import ORACLE_SQL, QUERIES

from .conftest import SF_DIR


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        table = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    return connection


def test_all_operators_and_the_pipeline_are_registered():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 14)]
    assert {*QUERIES, "pipeline"} <= set(entry_module.queries())
    assert set(ORACLE_SQL) <= set(entry_module.oracle_sql())


@pytest.mark.parametrize("name", ORACLE_SQL)
def test_query_matches_sql(corpus, database, name):
    found, expected = QUERIES[name](corpus, SF_DIR).toPandas(), database.execute(ORACLE_SQL[name]).df()
    columns = sorted(expected.columns)
    assert sorted(found.columns) == columns
    rows = [sorted(map(repr, f[columns].itertuples(index=False, name=None))) for f in (found, expected)]
    assert rows[0] == rows[1]
    assert len(found) > 0
