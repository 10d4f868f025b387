"""Orders table -> rules -> landing -> transform -> Parquet -> target table."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, types as T

from millrace import schemas
from millrace.functions import session_time
from millrace.journal import Journal, no_journal
from millrace.operators.aggregate import totals_by_key
from millrace.operators.dedupe import dedupe
from millrace.operators.project import fill_defaults, stamp
from millrace.operators.quality import ORDER_RULES, watch
from millrace.sinks.files import by_size, publish
from millrace.sinks.tables import load_table
from millrace.sources.files import read_csv, read_parquet

# Where the datasets of a run lie below its root folders.
LANDED_ORDERS = "orders/orders"
TRANSFORMED_ORDERS = "orders/orders_transformed.parquet"
AGGREGATED_ORDERS = "orders/orders_aggregated.parquet"


def _has_text(schema: T.StructType) -> bool:
    return any(isinstance(f.dataType, T.StringType) for f in schema.fields)


def _read_landed_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    # Text may hold line breaks; without text columns the files can be split.
    texts = _has_text(schema)
    return read_csv(spark, path, schema, multi_line=texts, keep_empty=texts)


_READ_LANDING = {"csv": _read_landed_csv, "parquet": read_parquet}


@dataclass(frozen=True)
class BatchIngestResult:
    landed_path: str
    transformed_path: str
    aggregated_path: str
    table: str | None
    landed_rows: int
    transformed_rows: int


def transform_orders(orders: DataFrame, run_ts: datetime | None = None) -> DataFrame:
    """Drop repeated orders, then fill missing amounts, then stamp the run."""
    unique = dedupe(orders, ["order_id"], order_by=["order_date"])
    return stamp(fill_defaults(unique, {"amount": 0.0}), run_ts=run_ts)


def run_batch_ingest(
    orders: DataFrame,
    raw_root: str,
    processed_root: str,
    load: Callable[[DataFrame], object] | str | None = None,
    table_location: str | None = None,
    run_ts: datetime | None = None,
    landing_format: str = "csv",
    journal: str | None = None,
    source_version: str | None = None,
) -> BatchIngestResult:
    """Run the whole flow on an orders frame, such as a JDBC or catalog table.

    The source is read once: its rules are counted while it is landed, and only a landing
    without violations takes the place of the last one. Each later step starts from
    files, so no step is computed twice and a lost executor costs single tasks. The totals
    come from the transformed files and so agree with them row for row. Landing, transformed orders
    and totals are datasets at fixed keys (``publish``); the result has the folders of this run.

    ``load`` is the name of a catalog table, with ``table_location`` for its files, or a
    function that takes the transformed frame as read from its files, such as one that calls
    ``load_jdbc_table``. ``landing_format`` is ``csv``, or ``parquet`` for large tables, where
    parsing text again would cost more than the transform. A CSV file with text is read by one
    task, as text may hold line breaks; orders with text are therefore dealt out to files of
    bounded size first.

    ``journal`` is a folder that remembers finished steps. A flow that failed, or whose driver died, is started
    again with the same ``journal`` and ``source_version`` (what the caller calls this state of the source, such as a
    date or a snapshot) and goes on behind the last finished step, with the time of the run it had. Another version runs
    all steps.
    """
    if isinstance(load, str) and table_location is None:
        raise ValueError("a catalog table needs a table_location for its files")
    if journal is not None and source_version is None:
        raise ValueError("a journal needs a source_version that tells one state of the source from another")
    spark = orders.sparkSession
    step = no_journal if journal is None else Journal(spark, journal).step
    now = session_time(spark, run_ts or datetime.now(timezone.utc))
    begun = step("begin", {"source": source_version, "format": landing_format}, lambda: {"run_ts": now.isoformat()})
    run_ts = datetime.fromisoformat(begun["run_ts"])
    raw_root, processed_root = raw_root.rstrip("/"), processed_root.rstrip("/")

    def land() -> dict:
        bounded = landing_format == "csv" and _has_text(orders.schema)
        observed, landing = watch(by_size(orders) if bounded else orders, ORDER_RULES)
        key = f"{raw_root}/{LANDED_ORDERS}.{landing_format}"
        path = publish(observed, key, landing_format, accept=landing.raise_if_broken)
        return {"path": path, "rows": landing.rows}

    landed = step("land", {"source": source_version, "run_ts": begun["run_ts"]}, land, ["path"])
    clean = transform_orders(_READ_LANDING[landing_format](spark, landed["path"], orders.schema), run_ts)

    def transform() -> dict:
        observed, counts = watch(clean)
        path = publish(observed, f"{processed_root}/{TRANSFORMED_ORDERS}")
        return {"path": path, "rows": counts.rows}

    transformed = step("transform", {"landed": landed["path"], "run_ts": begun["run_ts"]}, transform, ["path"])
    read = lambda: read_parquet(spark, transformed["path"], clean.schema)
    aggregated = step(
        "aggregate",
        {"transformed": transformed["path"]},
        lambda: {"path": publish(totals_by_key(read()), f"{processed_root}/{AGGREGATED_ORDERS}")},
        ["path"],
    )

    def load_all() -> dict:
        if callable(load):
            load(read())
        else:
            load_table(read(), load, schemas.ORDERS_TRANSFORMED, table_location)
        return {}

    if load is not None:
        target = load if isinstance(load, str) else getattr(load, "__qualname__", "function")
        step("load", {"transformed": transformed["path"], "target": target}, load_all)

    return BatchIngestResult(
        landed["path"],
        transformed["path"],
        aggregated["path"],
        load if isinstance(load, str) else None,
        landed["rows"],
        transformed["rows"],
    )
