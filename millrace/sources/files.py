"""Scans of files. Types are declared or all text; nothing passes through the driver."""

from __future__ import annotations

import functools
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, DataFrameReader, SparkSession, types as T

from millrace import ledger, storage

# Quotes inside a quoted cell are doubled, as in RFC 4180; Spark's own default is a backslash.
CSV_DIALECT = {"header": "true", "quote": '"', "escape": '"'}
#: Files that the driver has open at a time when it looks for their headers.
_OPEN_FILES = 16


def _csv_reader(
    spark: SparkSession, multi_line: bool, trim: bool, keep_empty: bool
) -> DataFrameReader:
    reader = spark.read.options(**CSV_DIALECT).option("multiLine", multi_line)
    if trim:
        reader = reader.option("ignoreLeadingWhiteSpace", True)
    if keep_empty:
        # Cells without quotes get this value and so become null; a quoted one stays "".
        reader = reader.option("nullValue", "\0")
    return reader


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | str | None = None,
    infer_types: bool = False,
    multi_line: bool = False,
    trim: bool = False,
    keep_empty: bool = False,
) -> DataFrame:
    """Read CSV files with a header row.

    All files must have the same header, and every row as many cells: a file with another header,
    a row with a cell more or less, and a cell that does not fit its type stop the job. With a
    schema the header must name its columns. Without one every column is text, under the names
    in the first file. ``infer_types`` guesses types instead, at the price of reading all data
    twice. Files whose headers differ are for ``read_csv_by_name``.

    ``multi_line`` allows line breaks inside cells. Spark then reads each file in one task, so
    it is off unless asked for. ``trim`` drops blanks before a cell, which is needed for files
    that put a blank between comma and quote (``"A", "1958"``).

    An empty cell is a null, in quotes or not. ``keep_empty`` reads one in quotes as an empty
    text, which is how ``write_csv`` writes it.
    """
    paths = path if isinstance(path, str) else list(path)
    options = (spark, multi_line, trim, keep_empty)
    if schema is None:
        found = _csv_reader(*options).option("inferSchema", infer_types).csv(paths).schema
        if not found.fields:
            return spark.createDataFrame([], found)
        schema = found
    reader = _csv_reader(*options).schema(schema)
    return reader.option("mode", "FAILFAST").option("enforceSchema", False).csv(paths)


def csv_headers(spark: SparkSession, path: str | Sequence[str]) -> dict[str, list[str]]:
    """The files of each different header line; files without a line have none.

    The driver opens the files, several at a time, and reads the first line of each and no more. The list
    of files is one that Spark itself keeps there.
    """
    listed = spark.read.text(path if isinstance(path, str) else list(path)).inputFiles()
    to_path = lambda uri: spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri)).toString()
    names = sorted(map(to_path, listed))
    with ThreadPoolExecutor(_OPEN_FILES) as pool:
        lines = list(pool.map(lambda name: storage.first_line(spark, name), names))
    files: dict[str, list[str]] = {}
    for name, line in zip(names, lines, strict=True):
        if line is None:
            continue
        if line.count('"') % 2:
            raise ValueError(f"the header of {name} has a line break in a name")
        files.setdefault(line, []).append(storage.literal(name))
    return files


def read_csv_by_name(
    spark: SparkSession, path: str | Sequence[str], multi_line: bool = False, trim: bool = False,
    keep_empty: bool = False,
) -> DataFrame:
    """CSV files of any headers as text, each cell under the name that its own file gives it.

    Files of one header are read together; columns that some files lack are null there.
    """
    groups = [
        read_csv(spark, files, None, False, multi_line, trim, keep_empty)
        for files in csv_headers(spark, path).values()
    ]
    if not groups:
        raise ValueError(f"no CSV files with a header at {path}")
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), groups)


def read_finished_runs(
    spark: SparkSession, root: str, name: str, multi_line: bool = False, trim: bool = False, by_name: bool = False,
) -> DataFrame:
    """The CSV files of all finished runs of one name, as text.

    Runs go by the ledger (``millrace.ledger``): what a run that did not finish has left is never read, and it is an error if
    files of a finished one have come, gone or changed in size. All must have the same columns in the same
    order; ``by_name`` puts each cell under the name that its own file gives it. No file is opened for its header, as
    the ledger has it.
    """
    runs = ledger.finished_runs(spark, root, name)
    if not runs:
        raise FileNotFoundError(f"no run of {name} at {root} has finished")
    ledger.check_whole(spark, root, runs)
    return read_runs(spark, runs, multi_line, trim, by_name)


def read_runs(
    spark: SparkSession, runs: Sequence[ledger.Run], multi_line: bool = False, trim: bool = False, by_name: bool = False,
) -> DataFrame:
    """The CSV files of these runs of the ledger, as text."""
    groups: dict[tuple[str, ...], list[str]] = {}
    for run in runs:
        for path, columns in run.columns.items():
            groups.setdefault(tuple(columns), []).append(storage.literal(path))
    if len(groups) > 1 and not by_name:
        raise ValueError(f"runs of {runs[0].name} have other columns each: {sorted(groups)}")
    frames = [
        read_csv(spark, paths, T.StructType([T.StructField(c, T.StringType()) for c in columns]), False, multi_line, trim)
        for columns, paths in groups.items()
    ]
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_published(
    spark: SparkSession, key: str, schema: T.StructType | None = None, file_format: str = "parquet"
) -> DataFrame:
    """The dataset that counts at a fixed key, as ``publish`` left it."""
    run = storage.current_run(spark, key)
    if run is None:
        raise FileNotFoundError(f"nothing has been published at {key}")
    if file_format == "csv":
        return read_csv(spark, run, schema, multi_line=True, keep_empty=True)
    if file_format == "json":
        return read_json(spark, run, schema)
    return read_parquet(spark, run, schema)


def read_json(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Read JSON lines with a declared schema; a line that is no JSON stops the job."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_in_batches(df: DataFrame, spool: str, rows: int) -> DataFrame:
    """A stream of a frame's rows in micro-batches of at most ``rows``.

    The rows are first written to the folder ``spool``, in files of at most that many, unless an earlier start has
    finished that; each micro-batch then takes one file. The checkpoint says which files are done, so a
    restart goes on with the next batch and a batch that runs again has the same rows. Spooling writes the data once more:
    where batches may be bounded by files or bytes, ``read_event_files`` needs none of it.
    """
    if rows < 1:
        raise ValueError("a batch has a row at least")
    spark = df.sparkSession
    if not storage.exists(spark, f"{spool.rstrip('/')}/_SUCCESS"):
        df.write.mode("overwrite").option("maxRecordsPerFile", rows).parquet(spool)
    return read_event_files(spark, storage.literal(spool), df.schema, max_files_per_trigger=1)


def read_event_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    file_format: str = "parquet",
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: int | None = None,
) -> DataFrame:
    """A stream of the files under ``path``, a folder or a glob.

    A micro-batch takes all files that are new unless one of the bounds is given; what a
    restart has to do again is at most one micro-batch.
    """
    reader = spark.readStream.schema(schema).format(file_format)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if max_bytes_per_trigger is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    return reader.load(path)
