"""Registered queries, each with the SQL that gives the same rows.

``queries()`` maps a name to ``(spark, sf_dir) -> DataFrame``; ``oracle_sql()`` maps the same
names to SQL over the Parquet tables of that folder. Queries that write first do so under the
session's shared scratch folder, a new path each time, removed when the application ends.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from datetime import datetime, timedelta, timezone
from decimal import Decimal
from importlib.util import find_spec

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from millrace import ledger, schemas, sinks, sources, streaming
from millrace.functions import (
    EVENT_NAMESPACE,
    content_id,
    epoch_seconds_utc,
    event_id,
    named_id,
    position_id,
    run_stamp,
    run_timestamp,
    session_time,
)
from millrace.journal import Journal
from millrace.operators import (
    ORDER_RULES,
    ColumnRule,
    cast_cases,
    cast_summary,
    dedupe,
    dedupe_any,
    default_time,
    exact_sums,
    failure_cases,
    failure_summary,
    fill_defaults,
    fitting,
    fold_by_key,
    greater_than,
    key_counts,
    reduce_by_key,
    rename,
    require_not_null,
    select_columns,
    stage_row_counts,
    stamp,
    to_target,
    totals_by_key,
    try_target,
    validate,
    watch,
    with_ones,
    word_count,
)
from millrace.plans import publish_events, run_batch_ingest, run_csv_etl
from millrace.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

RUN_TS = datetime(2024, 5, 6, 7, 8, 9)
MONEY = "decimal(12,2)"
#: About how much of a table that is written anew goes to a task, in rows or in bytes.
TASK_ROWS, TASK_BYTES = 1_000_000, 64 << 20

LINEITEM_RULES = (
    ColumnRule("l_orderkey", "int"),
    ColumnRule("l_discount", "float", checks=(greater_than(0),)),
    ColumnRule("l_tax", "float", checks=(greater_than(0),)),
)
CUSTOMER_RULES = (
    ColumnRule("c_custkey", "int"),
    ColumnRule("c_acctbal", "float", checks=(greater_than(0),)),
    ColumnRule("c_nationkey", "int", nullable=True),
)
# o_orderpriority is declared a number, o_clerk does not exist: both are schema failures.
BROKEN_SCHEMA_RULES = (
    ColumnRule("o_orderkey", "int"),
    ColumnRule("o_orderpriority", "int", checks=(greater_than(0),)),
    ColumnRule("o_clerk", "string"),
    ColumnRule("o_totalprice", "float", checks=(greater_than(400000),)),
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return sources.read_parquet(spark, f"{sf_dir}/{name}.parquet")


def _new_table(name: str) -> str:
    return f"millrace_{name}_{uuid.uuid4().hex[:12]}"


def _source_orders(spark: SparkSession, sf_dir: str, condition: str = "true") -> DataFrame:
    """The orders table under the names and money type of a relational source."""
    return _table(spark, sf_dir, "orders").filter(condition).select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_totalprice").cast("decimal(10,2)").alias("amount"),
        F.col("o_orderdate").alias("order_date"),
    )


def _plain_amount(df: DataFrame) -> DataFrame:
    """Show the type of the amount beside it: the value itself is compared as a double."""
    return df.withColumn("amount_type", F.typeof("amount")).withColumn(
        "amount", F.col("amount").cast("double")
    )


def _sensor_events(events: DataFrame) -> DataFrame:
    return streaming.sensor_events(
        events, epoch_seconds_utc(F.col("ts")), F.col("user_id"), F.col("value"), F.col("event_id")
    )


# --- transforms and aggregates -------------------------------------------------------------


def orders_customer_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"
    )
    unique = dedupe(orders, ["o_orderkey"], order_by=["o_orderdate"])
    filled = fill_defaults(unique, {"o_totalprice": 0.0})
    return totals_by_key(filled, "o_custkey", "o_totalprice", "o_orderkey", MONEY)


def lineitem_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Discounts of zero are made missing, so that the fill has rows to work on.
    items = _table(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_linenumber", F.expr("nullif(l_discount, 0)").alias("l_discount")
    )
    filled = fill_defaults(items, {"l_discount": 0.0})
    return totals_by_key(filled, "l_suppkey", "l_discount", "l_linenumber", MONEY)


def lineitem_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe(_table(spark, sf_dir, "lineitem"), ["l_orderkey"], order_by=["l_shipdate"])


def events_latest_per_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe(_table(spark, sf_dir, "events"), ["user_id"], order_by=["ts"], keep="last")


def documents_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document per language and length, whole texts with it."""
    return dedupe(_table(spark, sf_dir, "documents"), ["lang", "n_chars"], order_by=["doc_id"])


def document_keys_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many documents of each language differ in length, whichever of them is kept."""
    unique = dedupe_any(_table(spark, sf_dir, "documents"), ["lang", "n_chars"])
    return key_counts(unique, ["lang"])


def lineitem_reduce(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = with_ones(_table(spark, sf_dir, "lineitem"), "one")
    return reduce_by_key(
        items,
        ["l_suppkey"],
        {
            "n": ("one", "sum"),
            "smallest": ("l_quantity", "min"),
            "largest": ("l_quantity", "max"),
        },
    )


def event_type_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return key_counts(_table(spark, sf_dir, "events"), ["event_type"])


def fill_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A double, a decimal and a whole number, each with its own kind of default."""
    items = _table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        F.expr("nullif(l_linenumber, 3)").alias("l_linenumber"),
        F.expr("nullif(l_discount, 0)").alias("l_discount"),
        F.expr("cast(nullif(l_tax, 0) as decimal(4,2))").alias("l_tax"),
    )
    defaults = {"l_discount": 0.0, "l_tax": Decimal("0.55"), "l_linenumber": -1.0}
    return fill_defaults(items, defaults).withColumn("l_tax", F.col("l_tax").cast("double"))


def rename_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders").withColumn(
        "o_orderpriority", F.expr("nullif(o_orderpriority, '5-LOW')")
    )
    renamed = rename(orders, {"o_orderpriority": "priority", "JAN": "January"})
    return select_columns(require_not_null(renamed, ["priority"]), ["priority", "o_orderkey"])


def target_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = stamp(_source_orders(spark, sf_dir), run_ts=RUN_TS)
    return _plain_amount(to_target(orders, schemas.ORDERS_TRANSFORMED))


def stamp_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run time with a zone shows in the session's zone, in paths as in columns."""
    zoned = RUN_TS.replace(tzinfo=timezone(timedelta(hours=-5)))
    run_ts = session_time(spark, zoned)
    orders = stamp(_table(spark, sf_dir, "orders").select("o_orderkey"), run_ts=zoned)
    path = sinks.run_path("", "", run_ts, "").removeprefix("/_")
    return orders.withColumn("run", run_stamp(F.col("processed_timestamp"))).withColumn(
        "path_stamp", F.lit(path)
    )


def stamp_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run time for all rows, not before the last order and not in the future."""
    orders = stamp(_table(spark, sf_dir, "orders").select("o_orderdate"))
    now = F.col("processed_timestamp")
    return orders.agg(
        F.count(now).alias("stamped"),
        (F.min(now) == F.max(now)).alias("one_time"),
        (F.min(now) > F.max(F.col("o_orderdate").cast("timestamp"))).alias("after_orders"),
    )


def default_insert_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with status F lose their date and get the current time instead."""
    orders = _table(spark, sf_dir, "orders").select(
        "o_orderstatus",
        F.expr("case when o_orderstatus <> 'F' then cast(o_orderdate as timestamp) end").alias(
            "placed"
        ),
    )
    filled = default_time(orders, "placed")
    return filled.groupBy("o_orderstatus").agg(
        F.count("placed").alias("n"),
        F.count_if(F.col("placed") > run_timestamp(RUN_TS)).alias("defaulted"),
    )


def assigned_event_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event gets an id of the shape of a random UUID."""
    ids = _table(spark, sf_dir, "events").select("event_type", event_id().alias("id"))
    shape = "^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$"
    return ids.groupBy("event_type").agg(F.count_if(F.col("id").rlike(shape)).alias("n"))


def stage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("customer", "orders", "lineitem", "events", "documents", "conversations")
    return stage_row_counts({n: _table(spark, sf_dir, n) for n in names})


def write_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and broken rules as counted during a write, not by a scan of their own."""
    observed, counts = watch(_table(spark, sf_dir, "lineitem"), LINEITEM_RULES)
    sinks.write_parquet(observed, scratch_path(spark, "observed"))
    found = [("rows", "", counts.rows)]
    found += [(v.column, v.check, v.failures) for v in counts.violations()]
    return sources.from_rows(spark, found, "item string, check string, n bigint")


# --- word counts ---------------------------------------------------------------------------


def document_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_count(_table(spark, sf_dir, "documents"), "text")


def conversation_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_count(_table(spark, sf_dir, "conversations"), "text")


def page_word_count_trimmed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of the lines of raw pages, empty words at the end of a line dropped."""
    pages = _table(spark, sf_dir, "pages")
    lines = pages.select(F.explode(F.split("html", "\n", -1)).alias("line"))
    return word_count(lines, "line", trailing_empty=False)


# --- rules ---------------------------------------------------------------------------------


def validation_failure_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return failure_cases(
        _table(spark, sf_dir, "lineitem"), LINEITEM_RULES, ["l_orderkey", "l_linenumber"]
    )


def validation_failure_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return failure_summary(_table(spark, sf_dir, "lineitem"), LINEITEM_RULES)


def customer_failure_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing and non-positive balances in one pass; a missing nation is allowed."""
    customers = _table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.expr("nullif(c_nationkey, 0)").alias("c_nationkey"),
        F.expr("case when c_mktsegment <> 'BUILDING' then c_acctbal end").alias("c_acctbal"),
    )
    return failure_cases(customers, CUSTOMER_RULES, ["c_custkey"])


def schema_failure_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return failure_summary(_table(spark, sf_dir, "orders"), BROKEN_SCHEMA_RULES)


def validated_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain_amount(validate(_source_orders(spark, sf_dir), ORDER_RULES))


# --- files and tables ----------------------------------------------------------------------


def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, path = _table(spark, sf_dir, "orders"), scratch_path(spark, "csv")
    sinks.write_csv(orders, path)
    return sources.read_csv(spark, path, orders.schema)


def csv_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    sinks.write_csv(_table(spark, sf_dir, "orders"), path)
    text = sources.read_csv(spark, path)
    return text.select(
        F.col("o_orderkey").cast("bigint"),
        F.col("o_totalprice").cast("double"),
        "o_orderpriority",
    )


def csv_text_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts with their line breaks, quotes and blanks."""
    documents, path = _table(spark, sf_dir, "documents"), scratch_path(spark, "csv")
    sinks.write_csv(documents, path, max_records_per_file=100_000)
    return sources.read_csv(spark, path, documents.schema, multi_line=True, keep_empty=True)


def event_csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    events, path = _table(spark, sf_dir, "events"), scratch_path(spark, "csv")
    sinks.write_csv(events, path)
    return sources.read_csv(spark, path, events.schema)


def csv_typed_by_guess(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    sinks.write_csv(_table(spark, sf_dir, "customer"), path)
    return sources.read_csv(spark, path, infer_types=True).withColumn(
        "c_custkey", F.col("c_custkey").cast("bigint")
    )


def raw_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files landed under a run-stamped path and read back with all others there."""
    root, source = scratch_path(spark, "raw"), scratch_path(spark, "source")
    supplier = _table(spark, sf_dir, "supplier")
    sinks.write_csv(supplier, source)
    landed = sinks.land_raw_csv(spark, source, root, "supplier", RUN_TS)
    names = sources.read_csv(spark, f"{root}/*.csv")
    return names.select("s_suppkey", "s_name", F.lit(landed.rsplit("/", 1)[1]).alias("landed_as"))


def _write_csv_parts(orders: DataFrame, folder: str) -> None:
    """Orders as CSV files of two headers: finished ones have their columns the other way round."""
    columns = ["o_orderkey", "o_totalprice", "o_orderpriority"]
    sinks.write_csv(orders.filter("o_orderstatus <> 'F'").select(columns), f"{folder}/open")
    sinks.write_csv(orders.filter("o_orderstatus = 'F'").select(columns[::-1]), f"{folder}/finished")


def raw_landing_mixed_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of two column orders, landed and read back by name."""
    root, source = scratch_path(spark, "raw"), scratch_path(spark, "source")
    _write_csv_parts(_table(spark, sf_dir, "orders"), source)
    landed = sinks.land_raw_csv(spark, f"{source}/*", root, "orders", RUN_TS, mixed_headers=True)
    text = sources.read_csv_by_name(spark, f"{landed}/*")
    return text.select(
        F.col("o_orderkey").cast("bigint"), F.col("o_totalprice").cast("double"), "o_orderpriority"
    )


def parquet_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "parquet")
    sinks.write_parquet(_table(spark, sf_dir, "orders"), path)
    return sources.read_parquet(spark, path)


def partitioned_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "parquet")
    events = _table(spark, sf_dir, "events")
    sinks.write_parquet(events, path, partition_by=["event_type"])
    return sources.read_parquet(spark, path).select(events.columns)


def partitioned_write_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows counted during a partitioned write, above its shuffle."""
    events = _table(spark, sf_dir, "events")
    observed, counts = watch(sinks.by_size(events, "event_type"))
    path = scratch_path(spark, "parquet")
    sinks.write_parquet(observed, path, partition_by=["event_type"])
    written = sources.read_parquet(spark, path).groupBy("event_type").agg(F.count("*").alias("n"))
    return written.withColumn("counted", F.lit(counts.rows).cast("bigint"))


def json_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    events, path = _table(spark, sf_dir, "events"), scratch_path(spark, "json")
    sinks.write_json(events, path)
    return sources.read_json(spark, path, events.schema)


def fixed_key_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published twice under one key: the second dataset replaces the first."""
    key, orders = scratch_path(spark, "published"), _table(spark, sf_dir, "orders")
    sinks.publish(orders.filter("o_orderstatus = 'F'"), key)
    sinks.publish(orders, key)
    return sources.read_published(spark, key)


def table_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loaded twice: the table is created, then its rows are replaced."""
    name, location = _new_table("orders"), scratch_path(spark, "table")
    orders = stamp(_source_orders(spark, sf_dir), run_ts=RUN_TS)
    sinks.load_table(orders.filter("amount > 100000"), name, schemas.ORDERS_TRANSFORMED, location)
    sinks.load_table(orders, name, schemas.ORDERS_TRANSFORMED, location)
    return _plain_amount(sources.read_table(spark, name, ["order_id", "customer_id", "amount"]))


def table_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second frame brings its own columns."""
    name, location = _new_table("replaced"), scratch_path(spark, "table")
    sinks.replace_table(_table(spark, sf_dir, "customer"), name, location)
    sinks.replace_table(_table(spark, sf_dir, "orders"), name, location)
    return sources.read_table(spark, name)


# --- events --------------------------------------------------------------------------------


def event_json_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _sensor_events(_table(spark, sf_dir, "events"))
    return streaming.decode_events(streaming.encode_events(events))


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The JSON text itself. Clicks lose their reading, which must show as null."""
    events = _table(spark, sf_dir, "events").withColumn(
        "value", F.expr("case when event_type <> 'click' then value end")
    )
    messages = streaming.encode_events(_sensor_events(events))
    return messages.select(
        F.get_json_object("value", "$.event_id").alias("event_id"),
        F.get_json_object("value", "$.reading_value").cast("double").alias("reading_value"),
        F.col("value").contains('"reading_value":null').alias("null_kept"),
    )


def _stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = _table(spark, sf_dir, "events").schema
    # As a glob the path may be a folder of files or a single file.
    files = sources.read_event_files(
        spark, f"{sf_dir}/event[s].parquet", schema, max_bytes_per_trigger=100 * 2**30
    )
    return _sensor_events(files)


def event_stream_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, checkpoint = scratch_path(spark, "topic"), scratch_path(spark, "offsets")
    query = publish_events(_stream_events(spark, sf_dir), streaming.file_sink(out), checkpoint)
    streaming.await_published(query)
    return streaming.decode_events(spark.read.text(out))


def event_stream_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many messages a run of many micro-batches published, asked after its end; a second run
    from the checkpoint publishes none."""
    out, checkpoint = scratch_path(spark, "topic"), scratch_path(spark, "offsets")
    source, events = scratch_path(spark, "events"), _table(spark, sf_dir, "events")
    sinks.write_parquet(events.repartition(8), source)
    stream = sources.read_event_files(spark, source, events.schema, max_files_per_trigger=1)
    counts = []
    for run in (1, 2):
        publication = publish_events(_sensor_events(stream), streaming.file_sink(out), checkpoint)
        publication.query.awaitTermination()
        counts.append((run, streaming.await_published(publication)))
    return sources.from_rows(spark, counts, "run int, published bigint")


def event_interval_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream that looks for new events every so often, stopped once it has published all."""
    out, checkpoint = scratch_path(spark, "topic"), scratch_path(spark, "offsets")
    publication = publish_events(
        _stream_events(spark, sf_dir), streaming.file_sink(out), checkpoint, "200 milliseconds"
    )
    try:
        publication.query.processAllAvailable()
    finally:
        publication.stop()
    published = streaming.await_published(publication)
    found = spark.read.text(out).agg(F.count("*").alias("found"))
    return found.withColumn("published", F.lit(published).cast("bigint"))


def event_batch_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "topic")
    publish_events(_sensor_events(_table(spark, sf_dir, "events")), streaming.file_sink(out))
    return streaming.decode_events(spark.read.text(out))


def event_publish_shaped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of the declared columns, some without id or reading, as the job publishes them."""
    events = _table(spark, sf_dir, "events").select(
        F.expr("case when event_id % 3 <> 0 then cast(event_id as string) end").alias("event_id"),
        epoch_seconds_utc(F.col("ts")).alias("timestamp"),
        F.col("user_id").cast("int").alias("device_id"),
        F.expr("case when event_id % 5 <> 0 then value / 7 end").alias("reading_value"),
    )
    source, out = scratch_path(spark, "events"), scratch_path(spark, "topic")
    sinks.write_parquet(events, source)
    stream = sources.read_event_files(spark, source, schemas.SENSOR_EVENT)
    shaped = streaming.shape_events(stream)
    checkpoint = scratch_path(spark, "offsets")
    streaming.await_published(publish_events(shaped, streaming.file_sink(out), checkpoint))
    found = streaming.decode_events(spark.read.text(out))
    return found.groupBy("device_id").agg(
        F.count("event_id").alias("ids"),
        F.count_if(F.col("event_id").rlike("^[0-9]+$")).alias("own_ids"),
        F.count("reading_value").alias("readings"),
        F.count_if(F.col("reading_value") != F.round("reading_value", 2)).alias("long_readings"),
    )


# --- whole flows ---------------------------------------------------------------------------


def _ingest(spark: SparkSession, sf_dir: str, landing_format: str):
    root, table = scratch_path(spark, "ingest"), _new_table("ingested")
    # Every finished order comes twice, the second time a day later and at another price.
    orders = _source_orders(spark, sf_dir)
    finished = _source_orders(spark, sf_dir, "o_orderstatus = 'F'")
    repeats = finished.select(
        "order_id",
        "customer_id",
        (F.col("amount") + 1).cast("decimal(10,2)").alias("amount"),
        (F.col("order_date") + F.expr("interval 1 day")).alias("order_date"),
    )
    return run_batch_ingest(
        repeats.unionByName(orders),
        f"{root}/raw",
        f"{root}/processed",
        table,
        f"{root}/table",
        RUN_TS,
        landing_format,
    )


def batch_ingest_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain_amount(sources.read_table(spark, _ingest(spark, sf_dir, "csv").table))


def batch_ingest_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.read_parquet(spark, _ingest(spark, sf_dir, "parquet").aggregated_path)


def batch_ingest_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = _ingest(spark, sf_dir, "parquet")
    return sources.from_rows(
        spark,
        [("landed", result.landed_rows), ("transformed", result.transformed_rows)],
        "stage string, row_count bigint",
    )


def batch_ingest_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with a text that has line breaks, through a CSV landing of bounded files."""
    root = scratch_path(spark, "ingest")
    orders = _table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_totalprice").cast("decimal(10,2)").alias("amount"),
        F.col("o_orderdate").alias("order_date"),
        F.concat_ws("\n", "o_orderpriority", F.lit(' "a", b'), "o_orderstatus").alias("note"),
    )
    result = run_batch_ingest(orders, f"{root}/raw", f"{root}/processed", run_ts=RUN_TS)
    return sources.read_parquet(spark, result.transformed_path).select("order_id", "note")


def csv_etl_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, table = scratch_path(spark, "etl"), _new_table("etl")
    orders = _table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.expr("nullif(o_orderpriority, '5-LOW')").alias("1958"),
        F.col("o_totalprice").alias("JAN"),
    )
    sinks.write_csv(orders, f"{root}/source")
    run_csv_etl(
        spark,
        f"{root}/source",
        f"{root}/raw",
        f"{root}/transformed",
        "orders",
        table,
        f"{root}/table",
        names={"JAN": "January"},
        not_null=["1958"],
        run_ts=RUN_TS,
        schema=T.StructType(
            [
                T.StructField("o_orderkey", T.LongType()),
                T.StructField("1958", T.StringType()),
                T.StructField("January", T.DoubleType()),
            ]
        ),
    )
    return sources.read_table(spark, table)


def csv_etl_two_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two flows that land under one root keep to their own files."""
    root, found = scratch_path(spark, "etl"), []
    for name, table, key in (("part", "part", "p_partkey"), ("part_s", "supplier", "s_suppkey")):
        target, source = _new_table(name), f"{root}/source_{name}"
        rows = _table(spark, sf_dir, table).select(key)
        sinks.write_csv(rows, source)
        run_csv_etl(
            spark, source, f"{root}/raw", f"{root}/transformed", name, target,
            f"{root}/table_{name}", run_ts=RUN_TS,
        )
        found.append(sources.read_table(spark, target).select(F.lit(name).alias("flow"), F.col(key).alias("id")))
    # The first flow runs again, beside the landings of the second.
    target = _new_table("part")
    run_csv_etl(
        spark, f"{root}/source_part", f"{root}/raw", f"{root}/transformed", "part", target,
        f"{root}/table_again", run_ts=RUN_TS + timedelta(days=1),
    )
    found.append(sources.read_table(spark, target).select(F.lit("both runs").alias("flow"), F.col("p_partkey").alias("id")))
    return found[0].unionAll(found[1]).unionAll(found[2])


def _orders_csv(spark: SparkSession, sf_dir: str, status: str, folder: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == status)
    rows = orders.select("o_orderkey", "o_totalprice", "o_orderpriority")
    sinks.write_csv(rows, folder)
    return rows


def csv_etl_unfinished_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two finished runs of a flow; between them one whose driver died, with all its files but no entry in the ledger."""
    root, table = scratch_path(spark, "etl"), _new_table("etl")
    for day, status in enumerate("FPO"):
        rows = _orders_csv(spark, sf_dir, status, f"{root}/{status}")
        run_ts = RUN_TS + timedelta(days=day)
        if status == "P":
            sinks.write_csv(rows, sinks.run_path(f"{root}/raw", "orders", run_ts))
            continue
        run_csv_etl(
            spark, f"{root}/{status}", f"{root}/raw", f"{root}/transformed", "orders", table, f"{root}/table",
            run_ts=run_ts,
        )
    return sources.read_table(spark, table)


def raw_landing_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the ledger says of three landings, one of them of files of two headers."""
    root, source = scratch_path(spark, "raw"), scratch_path(spark, "source")
    for day, status in enumerate("FOP"):
        rows = _orders_csv(spark, sf_dir, status, f"{source}/{status}/a")
        mixed = status == "P"
        if mixed:
            sinks.write_csv(rows.select(rows.columns[::-1]), f"{source}/{status}/b")
        sinks.land_raw_csv(
            spark, f"{source}/{status}/*", root, "orders", RUN_TS + timedelta(days=day), mixed_headers=mixed
        )
    runs = ledger.finished_runs(spark, root, "orders")
    changed = ledger.changed_files(spark, root, runs).count()
    read = sources.read_finished_runs(spark, root, "orders", by_name=True)
    found = read.agg(F.count("*"), F.count_distinct("o_orderkey")).first()
    rows = [(r.label, r.rows, len(r.columns), r.files > 0 and r.bytes > 0, changed, *found) for r in runs]
    schema = "run string, rows_landed bigint, headers int, has_files boolean, changed_files bigint"
    return sources.from_rows(spark, rows, f"{schema}, rows_read bigint, keys_read bigint")


def table_replace_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replaced by tables of other columns; a query that began before a replacement reads on what it began with."""
    name, location = _new_table("replaced"), scratch_path(spark, "table")
    sinks.load_table(_table(spark, sf_dir, "region"), name, _table(spark, sf_dir, "region").schema, location)
    sinks.replace_table(_table(spark, sf_dir, "customer"), name, location, keep=3)
    before = sources.read_table(spark, name)
    sinks.replace_table(_table(spark, sf_dir, "orders"), name, location, keep=3)
    after = sources.read_table(spark, name)
    key = lambda df, column, seen: df.select(F.lit(seen).alias("seen"), F.col(column).alias("id"))
    return key(before, "c_custkey", "before").unionAll(key(after, "o_orderkey", "after"))


def event_ids_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The id that belongs to each event's type and number."""
    events = _table(spark, sf_dir, "events")
    return events.select("event_id", named_id(F.concat_ws("/", "event_type", "event_id")).alias("named"))


def event_ids_stable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids by position in the files, from two reads that split the files in different ways, and by content."""
    source = scratch_path(spark, "events")
    events = _table(spark, sf_dir, "events").select("event_type", "user_id", "value")
    # As many files and tasks as the rows need: none has more than about TASK_ROWS.
    tasks = max(4, -(-2 * events.count() // TASK_ROWS))
    # Small row groups, so that a file is split; rows that repeat, so that content alone is not enough.
    events.unionAll(events).repartition(tasks).write.mode("overwrite").option("parquet.block.size", 64 << 10).parquet(source)
    split, seen = spark.conf.get("spark.sql.files.maxPartitionBytes"), []
    for size in ("128m", "32k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        path = scratch_path(spark, "ids")
        rows = sources.read_parquet(spark, source)
        with_ids = rows.withColumn("place", position_id()).withColumn("held", content_id(*map(F.col, rows.columns)))
        sinks.write_parquet(with_ids.repartition(tasks - 1 + len(seen)), path)
        seen.append(sources.read_parquet(spark, path))
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    again = seen[1].select("place", F.col("held").alias("held_again"))
    return seen[0].join(again, "place").groupBy("event_type").agg(
        F.count("*").alias("n"),
        F.count_distinct("place").alias("places"),
        F.count_if(F.col("held") == F.col("held_again")).alias("same"),
        F.count_distinct("held").alias("contents"),
    )


def batch_ingest_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A flow whose load fails once: the second start loads what was transformed, and lands nothing again."""
    root, journal = scratch_path(spark, "ingest"), scratch_path(spark, "journal")
    orders, loaded = _source_orders(spark, sf_dir), []

    def load(frame: DataFrame) -> None:
        loaded.append(frame.count())
        if len(loaded) == 1:
            raise ConnectionError("the target is away")

    for start in (1, 2):
        try:
            result = run_batch_ingest(
                orders, f"{root}/raw", f"{root}/processed", load, run_ts=RUN_TS, journal=journal, source_version="1"
            )
        except ConnectionError:
            if start == 2:
                raise
    rows = {"land": result.landed_rows, "transform": result.transformed_rows, "load": loaded[-1]}
    runs = Journal(spark, journal).runs()
    return sources.from_rows(
        spark, [(step, *runs[step], n) for step, n in rows.items()], "step string, begun int, finished int, row_count bigint"
    )


def lineitem_exact_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums and means of doubles, the same to the last bit however the rows are dealt out."""
    items = _table(spark, sf_dir, "lineitem")
    scaled = items.withColumn("weighed", F.col("l_extendedprice") * F.col("l_quantity"))
    return exact_sums(
        scaled.repartition(7), ["l_suppkey"], {"total": "l_extendedprice", "weighed": "weighed"}, {"mean": "l_extendedprice"}
    )


def lineitem_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A product modulo a prime, mixed bits and the first of the longest texts by key; a third of the rows has one key."""
    items = _table(spark, sf_dir, "lineitem").select(
        F.expr("if(l_orderkey % 3 = 0, -1, l_suppkey)").alias("key"),
        (F.col("l_partkey") % 1000 + 1).alias("factor"),
        F.concat_ws("-", "l_shipdate", "l_partkey").alias("text"),
    )
    longest = lambda a, b: F.when(
        (F.length(a) > F.length(b)) | ((F.length(a) == F.length(b)) & (a < b)), a
    ).otherwise(b)
    folds = [
        fold_by_key(items, ["key"], "factor", lambda a, b: (a * b) % F.lit(1_000_003), "product"),
        fold_by_key(items, ["key"], "factor", lambda a, b: a.bitwiseXOR(b), "mixed"),
        fold_by_key(items, ["key"], "text", longest, "longest"),
    ]
    return folds[0].join(folds[1], "key").join(folds[2], "key")


def _ill_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as text, as they come from a file, some cells of which are ill."""
    return _table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("line"),
        F.expr("CASE o_orderkey % 11 WHEN 0 THEN o_orderkey || 'x' WHEN 1 THEN NULL WHEN 2 THEN '3000000000' "
               "ELSE cast(o_orderkey AS string) END").alias("order_id"),
        F.expr("CASE o_orderkey % 7 WHEN 0 THEN 'n/a' WHEN 1 THEN '' WHEN 2 THEN NULL "
               "ELSE cast(cast(o_totalprice AS decimal(10,2)) AS string) END").alias("amount"),
        F.expr("CASE o_orderkey % 5 WHEN 0 THEN '2024-13-45' ELSE cast(cast(o_orderdate AS date) AS string) END").alias("day"),
    )


_ILL_TARGET = T.StructType(
    [
        T.StructField("order_id", T.IntegerType(), False),
        T.StructField("amount", T.DecimalType(10, 2)),
        T.StructField("day", T.DateType()),
    ]
)


def cast_failure_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every cell that does not fit its target, by row."""
    tried = try_target(_ill_orders(spark, sf_dir), _ILL_TARGET, keep=["line"])
    return cast_cases(tried, ["line"])


def cast_failure_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cases per column and kind, and the rows that can be loaded."""
    tried = try_target(_ill_orders(spark, sf_dir), _ILL_TARGET, keep=["line"])
    good = fitting(tried).agg(F.count("*").alias("failures"))
    rows = good.select(F.lit("all").alias("column"), F.lit("fits").alias("case"), "failures")
    return cast_summary(tried).unionAll(rows)


def order_key_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders whose keys have large gaps, read in ranges of nearly equal size."""
    keys = _table(spark, sf_dir, "orders").select(
        F.expr("if(o_orderstatus = 'F', o_orderkey * 1000, o_orderkey)").alias("key"), "o_totalprice"
    )
    predicates = sources.range_predicates("key", sources.equal_bounds(keys, "key", 8))
    number = F.coalesce(*[F.when(F.expr(p), F.lit(i)) for i, p in enumerate(predicates)])
    sizes = keys.groupBy(number.alias("range")).agg(F.count("*").alias("n"), F.sum(F.col("o_totalprice").cast(MONEY)).alias("price"))
    return sizes.agg(
        F.count("*").alias("ranges"),
        F.sum("n").alias("row_count"),
        F.sum("price").cast("double").alias("price"),
        (F.max("n") <= F.min("n") * 1.1).alias("even"),
    )


def event_row_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in micro-batches of a fifth of the rows at most, stopped after some and started again."""
    out, checkpoint, spool = (scratch_path(spark, n) for n in ("topic", "offsets", "spool"))
    events = _sensor_events(_table(spark, sf_dir, "events"))
    most = -(-events.count() // 5)

    def start(interval: str | None = None) -> streaming.Publication:
        stream = sources.read_in_batches(events, spool, most)
        return publish_events(stream, streaming.file_sink(out), checkpoint, interval)

    first = start("0 seconds")
    while first.query.isActive and streaming.last_batch(spark, checkpoint) < 1:
        time.sleep(0.05)
    first.stop()
    before, after = first.await_batches(), start().await_batches()
    sizes = [*before.values(), *after.values()]
    found = streaming.decode_events(spark.read.text(out))
    return found.agg(
        F.count("*").alias("found"),
        F.count_distinct("event_id").alias("distinct_ids"),
        F.lit(sum(sizes)).cast("bigint").alias("published"),
        F.lit(max(sizes) <= most).alias("bounded"),
        F.lit(min(after, default=1 + max(before)) == max(before) + 1 and len(before) > 1).alias("resumed"),
    )


def landed_bytes_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with all the texts of a language, in parts, landed byte for byte in ranges; the digest of each range."""
    source, root = scratch_path(spark, "source"), scratch_path(spark, "raw")
    # The folder is named here as the writer would, so that it does not change the column and sort the rows again.
    folder = F.coalesce(F.nullif("lang", F.lit("")), F.lit("__HIVE_DEFAULT_PARTITION__"))
    documents = _table(spark, sf_dir, "documents").select(
        F.col("lang").alias("named"),
        folder.alias("lang"),
        "doc_id",
        F.monotonically_increasing_id().alias("at"),
        F.concat_ws("|", "doc_id", "text").alias("value"),
    )
    size = documents.agg(F.coalesce(F.sum(F.octet_length("value") + 1), F.lit(0))).first()[0]
    # The lines of a language in order, over as many parts of a file as they need; texts have line ends, quotes and
    # characters of any kind.
    order = ("lang", "named", "doc_id", "at")
    ranged = documents.repartitionByRange(max(1, -(-size // TASK_BYTES)), *order).sortWithinPartitions(*order)
    ranged.select("lang", "value").write.mode("overwrite").partitionBy("lang").text(source)
    sinks.land_bytes(spark, source, root, "texts", RUN_TS, range_bytes=50_000, join_parts=True)
    ranges = sinks.landed_bytes(spark, root, "texts")
    ranges = ranges.withColumn("lang", F.regexp_extract("file", "/lang=([^/]*)$", 1))
    broken = sinks.broken_ranges(ranges).count()
    return ranges.select("lang", "number", "size", "sha256", F.lit(broken).cast("bigint").alias("broken"))


_QUERIES: tuple[Query, ...] = (
    orders_customer_totals,
    lineitem_totals,
    lineitem_dedupe,
    events_latest_per_user,
    documents_dedupe,
    document_keys_any,
    lineitem_reduce,
    event_type_counts,
    fill_default,
    rename_not_null,
    target_projection,
    stamp_run,
    stamp_now,
    default_insert_time,
    assigned_event_ids,
    stage_counts,
    write_row_counts,
    document_word_count,
    conversation_word_count,
    page_word_count_trimmed,
    validation_failure_cases,
    validation_failure_summary,
    customer_failure_cases,
    schema_failure_summary,
    validated_orders,
    csv_round_trip,
    csv_strings,
    csv_text_round_trip,
    event_csv_round_trip,
    csv_typed_by_guess,
    raw_landing,
    raw_landing_mixed_headers,
    parquet_round_trip,
    partitioned_parquet,
    partitioned_write_counts,
    json_round_trip,
    fixed_key_publish,
    table_load,
    table_replace,
    event_json_round_trip,
    event_messages,
    event_stream_publish,
    event_stream_count,
    event_interval_publish,
    event_batch_publish,
    event_publish_shaped,
    batch_ingest_table,
    batch_ingest_totals,
    batch_ingest_counts,
    batch_ingest_text,
    csv_etl_table,
    csv_etl_two_names,
    csv_etl_unfinished_run,
    raw_landing_ledger,
    table_replace_view,
    event_ids_named,
    event_ids_stable,
    batch_ingest_resumed,
    lineitem_exact_sums,
    lineitem_fold,
    cast_failure_cases,
    cast_failure_summary,
    order_key_ranges,
    event_row_batches,
    landed_bytes_hashes,
)


def entry(spark: SparkSession) -> DataFrame:
    return orders_customer_totals(spark, "/root/testdata/sf0.001")


def _corpus_queries() -> tuple[dict[str, Query], dict[str, str]]:
    """Those of the text corpus package, where it is there."""
    if not (find_spec("millrace.llm") and find_spec("millrace.llm.queries")):
        return {}, {}
    from millrace.llm import queries as corpus

    found, sql = dict(corpus.QUERIES), dict(corpus.ORACLE_SQL)
    if find_spec("corpus_pipeline"):
        import corpus_pipeline

        found["pipeline"] = corpus_pipeline.run
        if corpus_pipeline.ORACLE_SQL:
            sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found, sql


def queries() -> dict[str, Query]:
    return {q.__name__: q for q in _QUERIES} | _corpus_queries()[0]


# --- the same in SQL -----------------------------------------------------------------------

_DECODED_EVENTS = """
    SELECT CAST(event_id AS VARCHAR) AS event_id,
           CAST(floor(epoch(ts)) AS BIGINT) AS "timestamp",
           CAST(user_id AS INTEGER) AS device_id,
           round(value, 2) AS reading_value
    FROM events
"""

_INGESTED = """
    WITH source AS (
        SELECT o_orderkey AS order_id, o_custkey AS customer_id,
               CAST(o_totalprice AS DECIMAL(10,2)) AS amount, o_orderdate AS order_date,
               o_orderstatus
        FROM orders
    ), doubled AS (
        SELECT order_id, customer_id, amount, order_date FROM source
        UNION ALL
        SELECT order_id, customer_id, CAST(amount + 1 AS DECIMAL(10,2)),
               order_date + INTERVAL 1 DAY
        FROM source WHERE o_orderstatus = 'F'
    ), ranked AS (
        SELECT *, row_number() OVER (
            PARTITION BY order_id
            ORDER BY order_date NULLS FIRST, customer_id NULLS FIRST, amount NULLS FIRST
        ) AS rn
        FROM doubled
    ), ingested AS (
        SELECT order_id, customer_id, coalesce(amount, 0) AS amount FROM ranked WHERE rn = 1
    )
"""

_ILL_CASES = """
    WITH ill AS (
        SELECT o_orderkey AS line, o_orderkey % 11 AS k, o_orderkey % 7 AS a, o_orderkey % 5 AS d FROM orders
    ), cases AS (
        SELECT line, 'order_id' AS "column", CASE k WHEN 1 THEN 'missing' ELSE 'does_not_fit' END AS "case", 'int' AS target,
               CASE k WHEN 0 THEN line || 'x' WHEN 2 THEN '3000000000' END AS value
        FROM ill WHERE k IN (0, 1, 2)
        UNION ALL
        SELECT line, 'amount', 'does_not_fit', 'decimal(10,2)', CASE a WHEN 0 THEN 'n/a' ELSE '' END FROM ill WHERE a IN (0, 1)
        UNION ALL
        SELECT line, 'day', 'does_not_fit', 'date', '2024-13-45' FROM ill WHERE d = 0
    )
"""


def _totals_sql(source: str, key: str, amount: str, counted: str) -> str:
    return f"""
        SELECT {key},
               CAST(sum(CAST({amount} AS DECIMAL(12,2))) AS DOUBLE) AS total_spent,
               CAST(sum(CAST({amount} AS DECIMAL(12,2))) AS DOUBLE) / count({amount})
                   AS avg_order_amount,
               count({counted}) AS order_count
        FROM {source} GROUP BY {key}
    """


def _word_count_sql(source: str) -> str:
    return f"SELECT word, count(*) AS n FROM ({source}) GROUP BY word"


def oracle_sql() -> dict[str, str]:
    return _library_sql() | _corpus_queries()[1]


def _library_sql() -> dict[str, str]:
    return {
        "orders_customer_totals": _totals_sql(
            """(
                SELECT o_orderkey, o_custkey, coalesce(o_totalprice, 0) AS o_totalprice
                FROM (SELECT *, row_number() OVER (
                          PARTITION BY o_orderkey
                          ORDER BY o_orderdate NULLS FIRST, o_custkey NULLS FIRST,
                                   o_totalprice NULLS FIRST) AS rn
                      FROM orders)
                WHERE rn = 1)""",
            "o_custkey",
            "o_totalprice",
            "o_orderkey",
        ),
        "lineitem_totals": _totals_sql("lineitem", "l_suppkey", "l_discount", "l_linenumber"),
        "lineitem_dedupe": """
            SELECT * EXCLUDE (rn) FROM (
                SELECT *, row_number() OVER (
                    PARTITION BY l_orderkey
                    ORDER BY l_shipdate NULLS FIRST, l_partkey NULLS FIRST,
                             l_suppkey NULLS FIRST, l_linenumber NULLS FIRST,
                             l_quantity NULLS FIRST, l_extendedprice NULLS FIRST,
                             l_discount NULLS FIRST, l_tax NULLS FIRST,
                             l_returnflag NULLS FIRST, l_linestatus NULLS FIRST) AS rn
                FROM lineitem)
            WHERE rn = 1
        """,
        "events_latest_per_user": """
            SELECT * EXCLUDE (rn) FROM (
                SELECT *, row_number() OVER (
                    PARTITION BY user_id
                    ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST,
                             event_type DESC NULLS LAST, value DESC NULLS LAST,
                             props DESC NULLS LAST) AS rn
                FROM events)
            WHERE rn = 1
        """,
        "documents_dedupe": """
            SELECT * EXCLUDE (rn) FROM (
                SELECT *, row_number() OVER (PARTITION BY lang, n_chars ORDER BY doc_id) AS rn
                FROM documents)
            WHERE rn = 1
        """,
        "document_keys_any": """
            SELECT lang, count(*) AS n FROM (SELECT DISTINCT lang, n_chars FROM documents)
            GROUP BY lang
        """,
        "lineitem_reduce": """
            SELECT l_suppkey, count(*) AS n, min(l_quantity) AS smallest,
                   max(l_quantity) AS largest
            FROM lineitem GROUP BY l_suppkey
        """,
        "event_type_counts": "SELECT event_type, count(*) AS n FROM events GROUP BY event_type",
        "fill_default": """
            SELECT l_orderkey, coalesce(nullif(l_linenumber, 3), -1) AS l_linenumber,
                   coalesce(nullif(l_discount, 0), 0.0) AS l_discount,
                   CAST(coalesce(CAST(nullif(l_tax, 0) AS DECIMAL(4,2)), 0.55) AS DOUBLE) AS l_tax
            FROM lineitem
        """,
        "rename_not_null": """
            SELECT o_orderpriority AS priority, o_orderkey FROM orders
            WHERE o_orderpriority <> '5-LOW'
        """,
        "target_projection": """
            SELECT CAST(o_orderkey AS INTEGER) AS order_id,
                   CAST(o_custkey AS INTEGER) AS customer_id,
                   CAST(CAST(o_totalprice AS DECIMAL(10,2)) AS DOUBLE) AS amount,
                   'decimal(10,2)' AS amount_type,
                   TIMESTAMP '2024-05-06 07:08:09' AS processed_timestamp
            FROM orders
        """,
        "stamp_run": """
            SELECT o_orderkey, TIMESTAMP '2024-05-06 12:08:09' AS processed_timestamp,
                   '20240506_120809' AS run, '20240506_120809' AS path_stamp
            FROM orders
        """,
        "stamp_now": """
            SELECT count(*) AS stamped, true AS one_time, true AS after_orders FROM orders
        """,
        "default_insert_time": """
            SELECT o_orderstatus, count(*) AS n,
                   count(*) FILTER (o_orderstatus = 'F'
                                    OR o_orderdate > TIMESTAMP '2024-05-06 07:08:09') AS defaulted
            FROM orders GROUP BY o_orderstatus
        """,
        "assigned_event_ids": "SELECT event_type, count(*) AS n FROM events GROUP BY event_type",
        "stage_counts": """
            SELECT 'customer' AS stage, count(*) AS row_count FROM customer
            UNION ALL SELECT 'orders', count(*) FROM orders
            UNION ALL SELECT 'lineitem', count(*) FROM lineitem
            UNION ALL SELECT 'events', count(*) FROM events
            UNION ALL SELECT 'documents', count(*) FROM documents
            UNION ALL SELECT 'conversations', count(*) FROM conversations
        """,
        "write_row_counts": """
            SELECT 'rows' AS item, '' AS "check", count(*) AS n FROM lineitem
            UNION ALL SELECT 'l_discount', 'greater_than(0)', count(*)
            FROM lineitem WHERE l_discount <= 0
            UNION ALL SELECT 'l_tax', 'greater_than(0)', count(*) FROM lineitem WHERE l_tax <= 0
        """,
        "document_word_count": _word_count_sql(
            "SELECT unnest(string_split(text, ' ')) AS word FROM documents"
        ),
        "conversation_word_count": _word_count_sql(
            "SELECT unnest(string_split(text, ' ')) AS word FROM conversations"
        ),
        "page_word_count_trimmed": _word_count_sql(
            """
            SELECT unnest(string_split(rtrim(line, ' '), ' ')) AS word
            FROM (SELECT unnest(string_split(html, chr(10))) AS line FROM pages)
            WHERE line = '' OR rtrim(line, ' ') <> ''
            """
        ),
        "validation_failure_cases": """
            SELECT l_orderkey, l_linenumber, 'l_discount' AS "column",
                   'greater_than(0)' AS "check", CAST(l_discount AS VARCHAR) AS failure_case
            FROM lineitem WHERE l_discount <= 0
            UNION ALL
            SELECT l_orderkey, l_linenumber, 'l_tax', 'greater_than(0)', CAST(l_tax AS VARCHAR)
            FROM lineitem WHERE l_tax <= 0
        """,
        "validation_failure_summary": """
            SELECT * FROM (
                SELECT 'l_discount' AS "column", 'greater_than(0)' AS "check",
                       count(*) AS failures
                FROM lineitem WHERE l_discount <= 0
                UNION ALL
                SELECT 'l_tax', 'greater_than(0)', count(*) FROM lineitem WHERE l_tax <= 0)
            WHERE failures > 0
        """,
        "customer_failure_cases": """
            SELECT c_custkey, 'c_acctbal' AS "column", 'not_nullable' AS "check",
                   CAST(NULL AS VARCHAR) AS failure_case
            FROM customer WHERE c_mktsegment = 'BUILDING'
            UNION ALL
            SELECT c_custkey, 'c_acctbal', 'greater_than(0)', CAST(c_acctbal AS VARCHAR)
            FROM customer WHERE c_mktsegment <> 'BUILDING' AND c_acctbal <= 0
        """,
        "schema_failure_summary": """
            SELECT 'o_orderpriority' AS "column", 'dtype(''int'')' AS "check",
                   CAST(1 AS BIGINT) AS failures
            UNION ALL SELECT 'o_clerk', 'column_in_dataframe', 1
            UNION ALL SELECT * FROM (
                SELECT 'o_totalprice', 'greater_than(400000)', count(*) AS failures
                FROM orders WHERE o_totalprice <= 400000)
            WHERE failures > 0
        """,
        "validated_orders": """
            SELECT o_orderkey AS order_id, o_custkey AS customer_id,
                   CAST(CAST(o_totalprice AS DECIMAL(10,2)) AS DOUBLE) AS amount,
                   'decimal(10,2)' AS amount_type, o_orderdate AS order_date
            FROM orders
        """,
        "csv_round_trip": "SELECT * FROM orders",
        "csv_strings": "SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders",
        "csv_text_round_trip": "SELECT * FROM documents",
        "event_csv_round_trip": "SELECT * FROM events",
        "csv_typed_by_guess": "SELECT * FROM customer",
        "raw_landing": """
            SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name,
                   'supplier_20240506_070809.csv' AS landed_as
            FROM supplier
        """,
        "raw_landing_mixed_headers": "SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders",
        "parquet_round_trip": "SELECT * FROM orders",
        "partitioned_parquet": "SELECT * FROM events",
        "partitioned_write_counts": """
            SELECT event_type, count(*) AS n, (SELECT count(*) FROM events) AS counted
            FROM events GROUP BY event_type
        """,
        "json_round_trip": "SELECT * FROM events",
        "fixed_key_publish": "SELECT * FROM orders",
        "table_load": """
            SELECT CAST(o_orderkey AS INTEGER) AS order_id,
                   CAST(o_custkey AS INTEGER) AS customer_id,
                   CAST(CAST(o_totalprice AS DECIMAL(10,2)) AS DOUBLE) AS amount,
                   'decimal(10,2)' AS amount_type
            FROM orders
        """,
        "table_replace": "SELECT * FROM orders",
        "event_json_round_trip": _DECODED_EVENTS,
        "event_messages": """
            SELECT CAST(event_id AS VARCHAR) AS event_id,
                   CASE WHEN event_type <> 'click' THEN round(value, 2) END AS reading_value,
                   event_type = 'click' AS null_kept
            FROM events
        """,
        "event_stream_publish": _DECODED_EVENTS,
        "event_stream_count": """
            SELECT CAST(1 AS INTEGER) AS run, count(*) AS published FROM events
            UNION ALL SELECT 2, 0
        """,
        "event_interval_publish": """
            SELECT count(*) AS found, count(*) AS published FROM events
        """,
        "event_batch_publish": _DECODED_EVENTS,
        "event_publish_shaped": """
            SELECT CAST(user_id AS INTEGER) AS device_id, count(*) AS ids,
                   count(*) FILTER (event_id % 3 <> 0) AS own_ids,
                   count(*) FILTER (event_id % 5 <> 0) AS readings,
                   CAST(0 AS BIGINT) AS long_readings
            FROM events GROUP BY user_id
        """,
        "batch_ingest_table": _INGESTED
        + """
            SELECT CAST(order_id AS INTEGER) AS order_id,
                   CAST(customer_id AS INTEGER) AS customer_id,
                   CAST(amount AS DOUBLE) AS amount, 'decimal(10,2)' AS amount_type,
                   TIMESTAMP '2024-05-06 07:08:09' AS processed_timestamp
            FROM ingested
        """,
        "batch_ingest_totals": _INGESTED
        + _totals_sql("ingested", "customer_id", "amount", "order_id"),
        "batch_ingest_counts": """
            SELECT 'landed' AS stage,
                   count(*) + count(*) FILTER (o_orderstatus = 'F') AS row_count
            FROM orders
            UNION ALL SELECT 'transformed', count(DISTINCT o_orderkey) FROM orders
        """,
        "batch_ingest_text": """
            SELECT o_orderkey AS order_id,
                   o_orderpriority || chr(10) || ' "a", b' || chr(10) || o_orderstatus AS note
            FROM orders
        """,
        "csv_etl_two_names": """
            SELECT 'part' AS flow, CAST(p_partkey AS VARCHAR) AS id FROM part
            UNION ALL SELECT 'part_s', CAST(s_suppkey AS VARCHAR) FROM supplier
            UNION ALL SELECT 'both runs', CAST(p_partkey AS VARCHAR) FROM part
            UNION ALL SELECT 'both runs', CAST(p_partkey AS VARCHAR) FROM part
        """,
        "csv_etl_table": """
            SELECT o_orderkey, o_orderpriority AS "1958", o_totalprice AS "January"
            FROM orders WHERE o_orderpriority <> '5-LOW'
        """,
        "csv_etl_unfinished_run": """
            SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_totalprice AS VARCHAR) AS o_totalprice,
                   o_orderpriority
            FROM orders WHERE o_orderstatus IN ('F', 'O')
        """,
        "raw_landing_ledger": """
            WITH runs AS (
                SELECT CASE o_orderstatus WHEN 'F' THEN 6 WHEN 'O' THEN 7 ELSE 8 END AS day,
                       CASE o_orderstatus WHEN 'P' THEN 2 ELSE 1 END AS headers, count(*) AS n
                FROM orders GROUP BY ALL
            )
            SELECT 'orders_2024050' || day || '_070809.csv' AS run, n * headers AS rows_landed, headers,
                   true AS has_files, CAST(0 AS BIGINT) AS changed_files,
                   CAST(sum(n * headers) OVER () AS BIGINT) AS rows_read, CAST(sum(n) OVER () AS BIGINT) AS keys_read
            FROM runs
        """,
        "table_replace_view": """
            SELECT 'before' AS seen, c_custkey AS id FROM customer
            UNION ALL SELECT 'after', o_orderkey FROM orders
        """,
        "event_ids_named": f"""
            WITH named AS (
                SELECT event_id,
                       sha1(from_hex('{EVENT_NAMESPACE.hex}') || encode(event_type || '/' || event_id)) AS h
                FROM events
            )
            SELECT event_id,
                   substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-'
                   || translate(substr(h, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab') || substr(h, 18, 3)
                   || '-' || substr(h, 21, 12) AS named
            FROM events JOIN named USING (event_id)
        """,
        "event_ids_stable": """
            SELECT event_type, 2 * count(*) AS n, 2 * count(*) AS places, 2 * count(*) AS same,
                   count(DISTINCT (user_id, value)) AS contents
            FROM events GROUP BY event_type
        """,
        "batch_ingest_resumed": """
            SELECT step, CAST(begun AS INTEGER) AS begun, CAST(1 AS INTEGER) AS finished,
                   (SELECT count(*) FROM orders) AS row_count
            FROM (VALUES ('land', 1), ('transform', 1), ('load', 2)) AS t(step, begun)
        """,
        # Cents and quantities have few bits: as whole numbers of 2^-60 their sums are exact, and are rounded once.
        "lineitem_exact_sums": """
            WITH scaled AS (
                SELECT l_suppkey, l_extendedprice AS a, l_extendedprice * l_quantity AS b FROM lineitem
            ), whole AS (
                SELECT l_suppkey, count(*) AS n,
                       sum(CAST(a * 1152921504606846976 AS HUGEINT)) AS a, sum(CAST(b * 1152921504606846976 AS HUGEINT)) AS b
                FROM scaled GROUP BY l_suppkey
            ), rounded AS (
                SELECT l_suppkey, n,
                       (CAST(a // 1099511627776 AS DOUBLE) * 1099511627776 + CAST(a % 1099511627776 AS DOUBLE))
                           / 1152921504606846976 AS total,
                       (CAST(b // 1099511627776 AS DOUBLE) * 1099511627776 + CAST(b % 1099511627776 AS DOUBLE))
                           / 1152921504606846976 AS weighed
                FROM whole
            )
            SELECT l_suppkey, total, weighed, total / n AS mean FROM rounded
        """,
        "lineitem_fold": """
            WITH items AS (
                SELECT CASE WHEN l_orderkey % 3 = 0 THEN -1 ELSE l_suppkey END AS key,
                       l_partkey % 1000 + 1 AS factor,
                       strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') || '-' || l_partkey AS text
                FROM lineitem
            )
            SELECT key, list_reduce(list(factor), lambda a, b: (a * b) % 1000003) AS product,
                   bit_xor(factor) AS mixed,
                   list_reduce(list(text), lambda a, b:
                       CASE WHEN len(a) > len(b) OR (len(a) = len(b) AND a < b) THEN a ELSE b END) AS longest
            FROM items GROUP BY key
        """,
        "cast_failure_cases": _ILL_CASES + "SELECT * FROM cases",
        "cast_failure_summary": _ILL_CASES
        + """
            SELECT "column", "case", count(*) AS failures FROM cases GROUP BY ALL
            UNION ALL
            SELECT 'all', 'fits', count(*) FROM orders WHERE o_orderkey NOT IN (SELECT line FROM cases)
        """,
        "order_key_ranges": """
            SELECT CAST(8 AS BIGINT) AS ranges, count(*) AS row_count,
                   CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS price, true AS even
            FROM orders
        """,
        "event_row_batches": """
            SELECT count(*) AS found, count(DISTINCT event_id) AS distinct_ids, count(*) AS published, true AS bounded,
                   true AS resumed
            FROM events
        """,
        "landed_bytes_hashes": """
            WITH files AS (
                SELECT lang, encode(string_agg(doc_id || '|' || coalesce(text, ''), chr(10) ORDER BY doc_id) || chr(10)) AS body
                FROM documents GROUP BY lang
            ), ranges AS (
                SELECT lang, number, array_slice(body, number * 50000 + 1, (number + 1) * 50000) AS part
                FROM (SELECT lang, body, unnest(range((octet_length(body) + 49999) // 50000)) AS number FROM files)
            )
            SELECT lang, number, octet_length(part) AS size, sha256(part) AS sha256, CAST(0 AS BIGINT) AS broken FROM ranges
        """,
    }
