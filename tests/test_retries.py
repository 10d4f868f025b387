"""Tasks that die halfway and run again, as after the loss of an executor."""

import uuid
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark import TaskContext

from millrace import schemas
from millrace.operators import ColumnRule, greater_than, watch
from millrace.plans import publish_events, run_batch_ingest
from millrace.sinks import publish
from millrace.sources import read_parquet, read_published, read_table
from millrace.streaming import decode_events, file_sink

T1 = datetime(2024, 1, 1)


def dying_once(df):
    """The same rows, but every second task fails after its first batch, the first time."""

    def rows(batches):
        context = TaskContext.get()
        for batch in batches:
            yield batch
            if context.attemptNumber() == 0 and context.partitionId() % 2 == 0:
                raise RuntimeError("task lost")

    return df.mapInPandas(rows, df.schema)


@pytest.fixture
def orders(spark):
    rows = [(i % 90, i % 7, Decimal(i + 1), T1) for i in range(100)]
    return dying_once(spark.createDataFrame(rows, schemas.ORDERS).repartition(6))


def test_tasks_do_die(spark, orders):
    def attempts(batches):
        for batch in batches:
            yield batch.assign(customer_id=TaskContext.get().attemptNumber())

    tried = orders.mapInPandas(attempts, orders.schema).collect()
    assert len(tried) == 100 and {r["customer_id"] for r in tried} == {0, 1}


def test_counts_of_a_watch_are_exact(spark, folder, orders):
    rules = [ColumnRule("amount", "float", checks=(greater_than(50),))]
    observed, counts = watch(orders, rules)
    publish(observed, f"{folder}/out")
    assert counts.rows == 100 and read_published(spark, f"{folder}/out").count() == 100
    assert [v.failures for v in counts.violations()] == [50]


def test_batch_ingest_is_whole(spark, folder, orders):
    table = f"t_{uuid.uuid4().hex}"
    result = run_batch_ingest(
        orders, f"{folder}/raw", f"{folder}/processed", table, f"{folder}/table", T1
    )
    assert (result.landed_rows, result.transformed_rows) == (100, 90)
    assert read_table(spark, table).count() == 90
    totals = read_parquet(spark, result.aggregated_path)
    assert sum(r["order_count"] for r in totals.collect()) == 90


def test_messages_are_published_once(spark, folder):
    rows = [(str(i), i, i, float(i)) for i in range(60)]
    events = dying_once(spark.createDataFrame(rows, schemas.SENSOR_EVENT).repartition(6))
    publish_events(events, file_sink(f"{folder}/out"))
    assert decode_events(spark.read.text(f"{folder}/out")).count() == 60
