"""Writes of files. Every writer keeps the frame's partitioning: one file or more per task."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, DataFrameWriter, Observation, SparkSession, functions as F

from millrace import ledger, storage
from millrace.functions.scalars import RUN_STAMP_PYTHON, session_time
from millrace.sources.files import CSV_DIALECT, csv_headers, read_csv

# Spark's CSV and JSON writers keep milliseconds and trim blanks unless told otherwise.
TIME_FORMATS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}
CSV_OPTIONS = {
    **CSV_DIALECT,
    **TIME_FORMATS,
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
JSON_OPTIONS = {**TIME_FORMATS, "ignoreNullFields": "false"}
WRITE_OPTIONS: dict[str, Mapping[str, str]] = {
    "csv": CSV_OPTIONS,
    "json": JSON_OPTIONS,
    "parquet": {},
}


def by_size(df: DataFrame, *columns: str) -> DataFrame:
    """The rows dealt out to tasks of about equal size, rows of equal ``columns`` together.

    Adaptive execution splits a value, or a share, with too many bytes and joins small ones. Each
    task writes a file, so files are bounded by the bytes that are shuffled, which are compressed
    (``spark.sql.adaptive.advisoryPartitionSizeInBytes``).
    """
    return df.hint("rebalance", *columns)


def _plan_nodes(df: DataFrame) -> list[str]:
    """What the steps of the frame's plan are called, the last step first."""
    left, names = [df._jdf.queryExecution().analyzed()], []
    while left:
        node = left.pop()
        names.append(node.nodeName())
        left += [node.children().apply(i) for i in range(node.children().size())]
    return names


def _dealt_by_size(df: DataFrame) -> bool:
    """Whether the frame is ``by_size``, or counts on top of it."""
    return [n for n in _plan_nodes(df) if n != "CollectMetrics"][:1] == ["RebalancePartitions"]


def _writer(
    df: DataFrame,
    file_format: str,
    partition_by: Sequence[str] = (),
    max_records_per_file: int | None = None,
) -> DataFrameWriter:
    if partition_by and not _dealt_by_size(df):
        # Else every task would write a file per value. A value with many rows is split again.
        if "CollectMetrics" in _plan_nodes(df):
            raise ValueError(
                "counts below a shuffle can count a task twice: watch(by_size(df, ...)) puts them above it"
            )
        df = by_size(df, *partition_by)
    writer = df.write.format(file_format).options(**WRITE_OPTIONS[file_format]).mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if max_records_per_file is not None:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    return writer


def write_csv(df: DataFrame, path: str, max_records_per_file: int | None = None) -> None:
    """CSV files with a header each, replacing what is at ``path``.

    A null is an empty cell, an empty text a quoted one: ``read_csv`` with ``keep_empty`` gives
    both back. Line breaks are kept inside quotes: such files need ``multi_line``.
    """
    _writer(df, "csv", max_records_per_file=max_records_per_file).save(path)


def write_json(df: DataFrame, path: str, max_records_per_file: int | None = None) -> None:
    """JSON lines, null fields kept, replacing what is at ``path``."""
    _writer(df, "json", max_records_per_file=max_records_per_file).save(path)


def write_parquet(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    max_records_per_file: int | None = None,
) -> None:
    """Parquet files, replacing what is at ``path``; ``partition_by`` lays out folders by value."""
    _writer(df, "parquet", partition_by, max_records_per_file).save(path)


def run_path(root: str, name: str, run_ts: datetime, extension: str = ".csv") -> str:
    """``<root>/<name>_<yyyyMMdd_HHmmss><extension>``, the time as it is given.

    ``session_time`` turns a time with a zone into that of the session, which columns show.
    """
    return f"{root.rstrip('/')}/{name}_{run_ts.strftime(RUN_STAMP_PYTHON)}{extension}"


def write_run_csv(df: DataFrame, root: str, name: str, run_ts: datetime) -> str:
    """Write CSV under a path that carries the time of the run, and return the path.

    Once all is written the run is entered in the ledger below ``root`` (``millrace.ledger``).
    """
    spark = df.sparkSession
    path = run_path(root, name, session_time(spark, run_ts))
    ledger.withdraw(spark, root, name, path)
    counted, rows = _counted(df)
    write_csv(counted, path)
    ledger.enter(spark, root, name, path, rows(), {path: df.columns})
    return path


def _counted(df: DataFrame) -> tuple[DataFrame, Callable[[], int]]:
    """The frame, and how many rows were written of it, known once it has been written."""
    written = Observation()
    return df.observe(written, F.count(F.lit(1)).alias("rows")), lambda: written.get["rows"]


def all_runs(root: str, name: str, extension: str = ".csv") -> str:
    """A glob for what ``run_path`` gives for one name at any time, and for no other name."""
    special = "*?[]{}\\"
    plain = "".join(f"\\{c}" if c in special else c for c in name)
    digit = "[0-9]"
    return f"{root.rstrip('/')}/{plain}_{digit * 8}_{digit * 6}{extension}"


def land_raw_csv(
    spark: SparkSession,
    source: str | Sequence[str],
    root: str,
    name: str,
    run_ts: datetime,
    multi_line: bool = False,
    mixed_headers: bool = False,
) -> str:
    """Copy reachable CSV files under a run-stamped path, every cell kept as its text.

    The copy is made by all tasks at once and a large file is split among them, so each part
    has the header of its own. Returns the path. Once everything is copied the run is entered in the
    ledger below ``root`` (``millrace.ledger``), which ``read_finished_runs`` goes by.

    All files must have one header, and a row with a cell more or less stops the job.
    ``mixed_headers`` lands the files of each header in a folder of its own below the path
    (``header_0``, ``header_1``, ...), to be read by ``read_csv_by_name`` with ``<path>/*``.
    """
    path = run_path(root, name, session_time(spark, run_ts))
    groups = {path: source}
    if mixed_headers:
        files = csv_headers(spark, source).values()
        groups = {f"{path}/header_{i}": group for i, group in enumerate(files)}
    ledger.withdraw(spark, root, name, path)
    storage.delete(spark, path)
    columns, landed = {}, 0
    for target, files in groups.items():
        raw = read_csv(spark, files, multi_line=multi_line, trim=True)
        counted, rows = _counted(raw)
        # In quotes, blanks that belong to a cell survive a reader that trims.
        _writer(counted, "csv").option("quoteAll", True).save(target)
        columns[target], landed = raw.columns, landed + rows()
    ledger.enter(spark, root, name, path, landed, columns)
    return path


def adopt_run(spark: SparkSession, root: str, name: str, path: str, multi_line: bool = False) -> None:
    """Enter a folder of CSV files in the ledger that was written before there was one.

    The folder must have the mark of a finished write (``_SUCCESS``); its rows are counted.
    """
    if not storage.exists(spark, f"{path.rstrip('/')}/_SUCCESS"):
        raise FileNotFoundError(f"the write of {path} has not finished")
    found = read_csv(spark, storage.literal(path), multi_line=multi_line, trim=True)
    ledger.enter(spark, root, name, path, found.count(), {path: found.columns})


def publish(
    df: DataFrame,
    key: str,
    file_format: str = "parquet",
    accept: Callable[[], None] | None = None,
    keep: int = 2,
) -> str:
    """Replace the dataset at a fixed key once the new one is complete.

    The data are written to a folder of their own, and the key is pointed to it last, in the same
    way on every store: a run that fails, or that ``accept`` refuses by an exception, leaves the
    old dataset as it was. Read it with ``read_published``. Returns the folder, whose files never
    change. The last ``keep`` datasets are kept for queries that still read them.
    """
    spark = df.sparkSession
    run = storage.new_run(key)
    try:
        _writer(df, file_format).save(run)
        if not storage.has_part_file(spark, run):
            raise FileNotFoundError(f"no part file was written for {key}")
        if accept is not None:
            accept()
    except Exception:
        storage.delete(spark, run)
        raise
    storage.make_current(spark, key, run, keep)
    return run
