"""Ids that stay the same whenever a row is read or published again."""

import shutil
import uuid

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from millrace import jobs, schemas
from millrace.functions import EVENT_NAMESPACE, content_id, named_id, position_id
from millrace.plans import publish_events
from millrace.sinks import write_json, write_parquet
from millrace.sources import from_rows, read_event_files, read_parquet
from millrace.streaming import await_published, decode_events, file_sink, shape_events


@settings(max_examples=20, deadline=None)
@given(st.lists(st.text(max_size=30), min_size=1, max_size=20))
def test_named_ids_are_those_of_the_standard(spark, names):
    df = spark.createDataFrame([(n,) for n in names], "n string").select("n", named_id(F.col("n")).alias("id"))
    assert all(r["id"] == str(uuid.uuid5(EVENT_NAMESPACE, r["n"])) for r in df.collect())


def test_named_ids_of_other_namespaces_and_nulls(spark):
    df = spark.createDataFrame([("a",), (None,)], "n string")
    found = [r[0] for r in df.select(named_id(F.col("n"), uuid.NAMESPACE_DNS)).collect()]
    assert found == [str(uuid.uuid5(uuid.NAMESPACE_DNS, "a")), None]


@pytest.fixture
def files(spark, folder):
    """Rows that repeat, in four files of several row groups."""
    df = spark.range(0, 40_000, 1, 4).selectExpr("id % 7 as a", "cast(id % 3 as string) as b")
    df.write.option("parquet.block.size", 16 << 10).parquet(f"{folder}/in")
    return f"{folder}/in"


def ids(spark, path, split, root=""):
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        return sorted(r[0] for r in read_parquet(spark, path).select(position_id(root)).collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_positions_give_the_same_ids_however_files_are_split(spark, files):
    whole, split = ids(spark, files, "128m"), ids(spark, files, "8k")
    assert whole == split and len(set(whole)) == 40_000


def test_a_folder_may_move(spark, files, folder):
    shutil.copytree(files, f"{folder}/moved")
    first, second = (ids(spark, f"{folder}/{n}", "128m", f"{folder}/{n}") for n in ("in", "moved"))
    assert first == second
    assert ids(spark, f"{folder}/moved", "128m") != first


def test_content_ids_do_not_depend_on_place_or_zone(spark, files):
    df = spark.sql("SELECT timestamp'2024-01-01 00:00:00Z' AS t, 0.1D AS d, cast(null as string) AS s")
    zone = spark.conf.get("spark.sql.session.timeZone")
    found = set()
    for name in ("UTC", "Asia/Tokyo"):
        spark.conf.set("spark.sql.session.timeZone", name)
        found |= {r[0] for r in df.select(content_id("t", "d", "s")).collect()}
    spark.conf.set("spark.sql.session.timeZone", zone)
    assert len(found) == 1
    rows = read_parquet(spark, files)
    kinds = lambda x: {r[0] for r in x.select(content_id(F.col("a"), F.col("b"))).distinct().collect()}
    assert kinds(rows) == kinds(rows.repartition(3)) and len(kinds(rows)) == 21


def test_nulls_and_texts_have_ids_of_their_own(spark):
    df = spark.createDataFrame([(None, "x"), ("null", "x"), ("", "x"), ("x", None)], "a string, b string")
    assert df.select(content_id(F.col("a"), F.col("b"))).distinct().count() == 4


def _publish(spark, source, out, checkpoint, per_trigger):
    stream = read_event_files(spark, source, schemas.SENSOR_EVENT, max_files_per_trigger=per_trigger)
    shaped = shape_events(stream, position_id())
    await_published(publish_events(shaped, file_sink(out), checkpoint))
    return sorted(r["event_id"] for r in decode_events(spark.read.text(out)).collect())


def test_a_stream_that_starts_over_publishes_the_same_ids(spark, folder):
    rows = [(None if i % 2 else f"own{i}", i, 1000, 1.0) for i in range(40)]
    write_parquet(from_rows(spark, rows, schemas.SENSOR_EVENT).repartition(4), f"{folder}/in")
    first = _publish(spark, f"{folder}/in", f"{folder}/out1", f"{folder}/c1", 1)
    again = _publish(spark, f"{folder}/in", f"{folder}/out2", f"{folder}/c2", 3)
    assert first == again and len(set(first)) == 40
    assert sum(i.startswith("own") for i in first) == 20


@pytest.mark.parametrize("file_format", ["parquet", "json"])
def test_the_job_names_missing_ids(spark, folder, file_format):
    rows = [(None, i, 1000, 1.0) for i in range(5)]
    write = write_parquet if file_format == "parquet" else write_json
    write(from_rows(spark, rows, schemas.SENSOR_EVENT), f"{folder}/in")
    found = []
    for n in (1, 2):
        jobs.main(
            ["publish-events", f"{folder}/in", "--format", file_format, "--to-files", f"{folder}/out{n}", "--checkpoint", f"{folder}/c{n}"],
            spark,
        )
        found.append(sorted(r["event_id"] for r in decode_events(spark.read.text(f"{folder}/out{n}")).collect()))
    assert found[0] == found[1] and len(set(found[0])) == 5
