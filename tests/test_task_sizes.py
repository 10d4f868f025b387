"""Queries that write a table anew: no task has more of it than a fixed share, and the rows are those of the SQL."""

import glob
import os

import duckdb

import __spark_entry__ as entry_module


def of_sql(name, **tables):
    connection = duckdb.connect()
    for table, path in tables.items():
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}/*.parquet'")
    return sorted(map(repr, connection.execute(entry_module.oracle_sql()[name]).fetchall()))


def test_texts_of_a_language_lie_in_many_parts(spark, folder, monkeypatch):
    text = "repeat(concat('é\"|', chr(10), cast(id * 7919 as string)), 1 + cast(id * 31 % 97 as int))"
    rows = spark.range(3000).selectExpr("if(id % 10 = 0, 'de', 'en') as lang", "id * 13 % 3001 as doc_id", f"{text} as text")
    rows.repartition(5).write.parquet(f"{folder}/documents.parquet")
    monkeypatch.setattr(entry_module, "TASK_BYTES", 60_000)
    sizes, land = {}, entry_module.sinks.land_bytes

    def watched(spark, source, *args, **options):
        files = glob.glob(f"{source}/lang=en/part-*")
        sizes.update({f: os.path.getsize(f) for f in files})
        return land(spark, source, *args, **options)

    monkeypatch.setattr(entry_module.sinks, "land_bytes", watched)
    found = entry_module.landed_bytes_hashes(spark, folder).collect()
    assert sorted(repr(tuple(r)) for r in found) == of_sql("landed_bytes_hashes", documents=f"{folder}/documents.parquet")
    assert len(sizes) > 10 and max(sizes.values()) < 3 * 60_000


def test_ids_are_written_by_as_many_tasks_as_they_need(spark, folder, monkeypatch):
    rows = spark.range(5000).selectExpr("cast(id % 3 as string) as event_type", "id % 101 as user_id", "id % 7 / 2 as value")
    rows.write.parquet(f"{folder}/events.parquet")
    monkeypatch.setattr(entry_module, "TASK_ROWS", 500)
    counts, write = [], entry_module.sinks.write_parquet

    def watched(frame, path):
        write(frame, path)
        for where in (os.path.dirname(frame.inputFiles()[0]), path):
            files = spark.read.parquet(where).groupBy("_metadata.file_name").count().collect()
            counts.append(max(r["count"] for r in files))

    monkeypatch.setattr(entry_module.sinks, "write_parquet", watched)
    found = entry_module.event_ids_stable(spark, folder).collect()
    assert sorted(repr(tuple(r)) for r in found) == of_sql("event_ids_stable", events=f"{folder}/events.parquet")
    assert len(counts) == 4 and max(counts) < 2 * 500
