import json
import os

import pytest
from pyspark.sql import functions as F

from millrace import jobs, schemas
from millrace.plans import publish_events
from millrace.sources import from_rows, read_event_files, read_in_batches
from millrace.streaming import publish as publish_module
from millrace.streaming import (
    await_published,
    decode_events,
    encode_events,
    file_sink,
    kafka_sink,
    publish_stream,
    sensor_events,
)

EVENTS = [("a", 1704067200, 1000, 20.5), ("b", 1704067201, 9999, None), ("é", None, 4321, 80.0)]


def events(spark, rows=EVENTS):
    return from_rows(spark, rows, schemas.SENSOR_EVENT)


def test_messages_are_json_objects_with_null_fields(spark):
    values = [r["value"] for r in encode_events(events(spark)).collect()]
    assert [json.loads(v) for v in values] == [
        dict(zip(schemas.SENSOR_EVENT.names, row)) for row in EVENTS
    ]


def test_decode_is_the_inverse(spark):
    back = decode_events(encode_events(events(spark)))
    assert back.schema == schemas.SENSOR_EVENT
    assert list(map(tuple, back.collect())) == EVENTS


def test_broken_messages_give_empty_events(spark):
    df = spark.createDataFrame([("{bad",), (None,)], "value string")
    assert list(map(tuple, decode_events(df).collect())) == [(None,) * 4] * 2


def test_events_without_id_get_one(spark):
    df = spark.createDataFrame([("x", 21.005), (None, 30.999)], "id string, v double")
    shaped = sensor_events(df, F.lit(5), F.lit(1000), F.col("v"), F.col("id"))
    first, second = shaped.collect()
    assert first["event_id"] == "x" and len(second["event_id"]) == 36
    assert second["reading_value"] == 31.0
    assert shaped.schema.simpleString() == schemas.SENSOR_EVENT.simpleString()
    random = sensor_events(df, F.lit(5), F.lit(1000), F.col("v"))
    assert random.select("event_id").distinct().count() == 2


def _write(spark, folder, start, end):
    rows = [(str(i), i, 1000 + i, float(i)) for i in range(start, end)]
    events(spark, rows).coalesce(1).write.mode("append").parquet(f"{folder}/in")


def _run(spark, folder, per_trigger=1):
    stream = read_event_files(
        spark, f"{folder}/in", schemas.SENSOR_EVENT, max_files_per_trigger=per_trigger
    )
    return publish_events(stream, file_sink(f"{folder}/out"), f"{folder}/checkpoint")


def test_stream_publishes_all_and_a_restart_goes_on(spark, folder):
    for start in (0, 10, 20, 30):
        _write(spark, folder, start, start + 10)
    query = _run(spark, folder)
    assert await_published(query) == 40
    assert len({p.batchId for p in query.query.recentProgress}) >= 4
    assert await_published(_run(spark, folder)) == 0
    _write(spark, folder, 40, 47)
    assert await_published(_run(spark, folder)) == 7
    published = decode_events(spark.read.text(f"{folder}/out"))
    assert sorted(r["timestamp"] for r in published.collect()) == list(range(47))


def test_micro_batches_bounded_by_bytes(spark, folder):
    for start in (0, 10, 20):
        _write(spark, folder, start, start + 10)
    stream = read_event_files(
        spark, f"{folder}/in", schemas.SENSOR_EVENT, max_bytes_per_trigger=1024
    )
    query = publish_events(stream, file_sink(f"{folder}/out"), f"{folder}/checkpoint")
    assert await_published(query) == 30
    assert len({p.batchId for p in query.query.recentProgress if p.numInputRows}) == 3


def test_the_count_is_exact_after_the_end_and_with_little_progress_kept(spark, folder):
    for start in range(0, 80, 10):
        _write(spark, folder, start, start + 10)
    setting = "spark.sql.streaming.numRecentProgressUpdates"
    spark.conf.set(setting, "3")
    publication = _run(spark, folder)
    publication.query.awaitTermination()
    assert await_published(publication) == 80 == await_published(publication)
    assert spark.read.text(f"{folder}/out").count() == 80


def test_a_batch_that_was_missed_is_an_error(spark, folder, monkeypatch):
    """Progress is not looked at until the end, and only the last entries are there then."""
    for start in range(0, 60, 10):
        _write(spark, folder, start, start + 10)
    monkeypatch.setattr(publish_module.Publication, "_watch", lambda self: None)
    publication = _run(spark, folder)
    publication.query.awaitTermination()
    whole = publication.query

    class Late:
        recentProgress = whole.recentProgress[-3:]
        awaitTermination = whole.awaitTermination

    publication.query = Late()
    with pytest.raises(RuntimeError, match="missed"):
        await_published(publication)


def test_events_are_shaped_before_they_go_out(spark, folder):
    rows = [(None, 1, 1000, 3.14159), ("a", 2, 1001, None), ("b", 3, 1002, 2.5)]
    events(spark, rows).write.parquet(f"{folder}/in")
    args = ["publish-events", f"{folder}/in", "--checkpoint", f"{folder}/c", "--to-files", f"{folder}/out"]
    jobs.main(args, spark)
    found = {r["timestamp"]: r for r in decode_events(spark.read.text(f"{folder}/out")).collect()}
    assert len(found[1]["event_id"]) == 36 and found[1]["reading_value"] == 3.14
    assert found[2]["event_id"] == "a" and found[2]["reading_value"] is None


def test_interval_stream_runs_until_stopped(spark, folder):
    _write(spark, folder, 0, 10)
    stream = read_event_files(spark, f"{folder}/in", schemas.SENSOR_EVENT)
    query = publish_stream(
        encode_events(stream), file_sink(f"{folder}/out"), f"{folder}/checkpoint", "100 milliseconds"
    )
    try:
        query.query.processAllAvailable()
    finally:
        query.stop()
    assert await_published(query) == 10
    assert spark.read.text(f"{folder}/out").count() == 10


def test_batch_publish(spark, folder):
    assert publish_events(events(spark), file_sink(f"{folder}/out")) is None
    assert decode_events(spark.read.text(f"{folder}/out")).count() == 3


def test_a_stream_needs_a_checkpoint(spark, folder):
    _write(spark, folder, 0, 1)
    stream = read_event_files(spark, f"{folder}/in", schemas.SENSOR_EVENT)
    with pytest.raises(ValueError):
        publish_events(stream, file_sink(f"{folder}/out"))


def test_topic_options():
    sink = kafka_sink("broker:9092", "readings")
    assert sink.format == "kafka"
    assert sink.options == {
        "kafka.bootstrap.servers": "broker:9092", "topic": "readings", "kafka.acks": "all",
    }
    with pytest.raises(ValueError):
        kafka_sink("b", "t", acks="2")


def test_batches_of_a_number_of_rows(spark, folder):
    """Stopped after some batches, the stream goes on with the next one."""
    rows = events(spark, [(str(i), i, 1000, 1.0) for i in range(95)]).repartition(3)

    def start(interval=None):
        stream = read_in_batches(rows, f"{folder}/spool [1]", 10)
        return publish_events(stream, file_sink(f"{folder}/out"), f"{folder}/checkpoint", interval)

    first = start("0 seconds")
    while publish_module.last_batch(spark, f"{folder}/checkpoint") < 3:
        assert first.query.isActive
    first.stop()
    before = first.await_batches()
    second = start()
    after = second.await_batches()
    assert len(before) >= 4 and len(after) >= 1 and min(after) == max(before) + 1
    assert max([*before.values(), *after.values()]) <= 10
    assert sum(before.values()) + sum(after.values()) == 95
    published = decode_events(spark.read.text(f"{folder}/out"))
    assert sorted(r["timestamp"] for r in published.collect()) == list(range(95))
    assert start().await_batches() == {}
    with pytest.raises(ValueError):
        read_in_batches(rows, f"{folder}/spool", 0)


def test_a_spool_that_was_cut_off_is_written_anew(spark, folder):
    rows = events(spark, [(str(i), i, 1000, 1.0) for i in range(9)])
    rows.limit(5).write.parquet(f"{folder}/spool")
    (path,) = [f"{folder}/spool/{f}" for f in os.listdir(f"{folder}/spool") if f == "_SUCCESS"]
    os.remove(path)
    publication = publish_events(read_in_batches(rows, f"{folder}/spool", 4), file_sink(f"{folder}/out"), f"{folder}/c")
    assert sum(publication.await_batches().values()) == 9
