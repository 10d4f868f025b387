"""CSV files -> raw landing -> rename and filter -> CSV -> table of the same columns."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, types as T

from millrace import ledger
from millrace.functions import session_time
from millrace.journal import Journal, no_journal
from millrace.operators.project import rename, require_not_null
from millrace.sinks.files import land_raw_csv, write_run_csv
from millrace.sinks.tables import replace_table
from millrace.sources.files import read_csv, read_runs


@dataclass(frozen=True)
class CsvEtlResult:
    raw_path: str
    transformed_path: str


def clean_csv(df: DataFrame, names: Mapping[str, str], not_null: Sequence[str]) -> DataFrame:
    return require_not_null(rename(df, names), not_null)


def run_csv_etl(
    spark: SparkSession,
    source: str | Sequence[str],
    raw_root: str,
    transformed_root: str,
    name: str,
    load: Callable[[DataFrame], object] | str | None = None,
    table_location: str | None = None,
    names: Mapping[str, str] | None = None,
    not_null: Sequence[str] = (),
    run_ts: datetime | None = None,
    this_run_only: bool = False,
    schema: T.StructType | str | None = None,
    infer_types: bool = False,
    multi_line: bool = False,
    mixed_headers: bool = False,
    journal: str | None = None,
    source_version: str | None = None,
) -> CsvEtlResult:
    """Land the files of ``source``, clean what has been landed, and load the result.

    Like the landing area it keeps, the transform covers the files of all finished runs of this ``name``, as the
    ledger has them; ``this_run_only`` leaves the older ones out. A landing that a killed driver left
    behind is never read. All must have the same header, or the job stops;
    with ``mixed_headers`` cells go by the names in their own files, in every run of the flow. The
    table gets the columns of the cleaned files: as text, or typed by ``schema``, or by
    ``infer_types`` at the price of one more scan. ``load`` is the name of a catalog table, or a
    function that takes the frame as read from its files, such as one that calls
    ``replace_jdbc_table``. Paths are handed on as values and whole folders are read.

    ``journal`` is a folder that remembers finished steps: a flow that failed is started again with the same ``journal``
    and ``source_version`` (what the caller calls this state of the files) and goes on behind the last finished step.
    """
    if isinstance(load, str) and table_location is None:
        raise ValueError("a catalog table needs a table_location for its files")
    if journal is not None and source_version is None:
        raise ValueError("a journal needs a source_version that tells one state of the source from another")
    step = no_journal if journal is None else Journal(spark, journal).step
    now = session_time(spark, run_ts or datetime.now(timezone.utc))
    begun = step("begin", {"source": source_version, "name": name}, lambda: {"run_ts": now.isoformat()})["run_ts"]
    run_ts = datetime.fromisoformat(begun)
    landed = step(
        "land",
        {"source": source_version, "run_ts": begun},
        lambda: {"path": land_raw_csv(spark, source, raw_root, name, run_ts, multi_line, mixed_headers)},
        ["path"],
    )["path"]

    def transform() -> dict:
        runs = ledger.finished_runs(spark, raw_root, name)
        if this_run_only:
            runs = [r for r in runs if r.path == landed]
        # The files of this run were listed as it was entered.
        ledger.check_whole(spark, raw_root, [r for r in runs if r.path != landed])
        raw = read_runs(spark, runs, multi_line, True, mixed_headers)
        cleaned = clean_csv(raw, names or {}, not_null)
        return {"path": write_run_csv(cleaned, transformed_root, f"{name}_transformed", run_ts)}

    transformed = step("transform", {"landed": landed, "run_ts": begun}, transform, ["path"])["path"]

    def load_all() -> dict:
        frame = read_csv(spark, transformed, schema, infer_types, multi_line)
        if callable(load):
            load(frame)
        else:
            replace_table(frame, load, table_location)
        return {}

    if load is not None:
        target = load if isinstance(load, str) else getattr(load, "__qualname__", "function")
        step("load", {"transformed": transformed, "target": target}, load_all)
    return CsvEtlResult(landed, transformed)
