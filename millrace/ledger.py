"""A ledger of finished runs. Readers go by it, not by what lies in a folder.

A run that writes under a path of its own is entered once all of it is there: first a table of its files
with their sizes, then a record of its rows and columns, and last an empty file that makes both count. Making an empty
file is atomic on every kind of store, so a run is in the ledger or not. What a driver that died
has left behind is not, whatever it looks like, and neither is a file that comes into a run's folder later.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass
from urllib.parse import quote

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from millrace import storage

# Where the ledger lies below a root, and what its files end with.
FOLDER = "_finished"
FILES, RECORD, DONE = ".files", ".json", ".done"


@dataclass(frozen=True)
class Run:
    """A finished run: its folders of files, each with its columns, and what it wrote."""

    name: str
    path: str
    columns: Mapping[str, Sequence[str]]
    rows: int
    files: int
    bytes: int

    @property
    def label(self) -> str:
        return self.path.rstrip("/").rsplit("/", 1)[1]


def _entries(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{FOLDER}/{quote(name, safe='')}"


def _listing(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``file`` and ``bytes`` of all data files below some folders; their contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    files = reader.load([storage.literal(p) for p in paths])
    return files.select(F.col("path").alias("file"), F.col("length").alias("bytes"))


def enter(
    spark: SparkSession, root: str, name: str, path: str, rows: int, columns: Mapping[str, Sequence[str]]
) -> Run:
    """Enters a run of ``name`` that is complete at ``path``. ``columns`` are those of each of its folders."""
    entry = f"{_entries(root, name)}/{path.rstrip('/').rsplit('/', 1)[1]}"
    if storage.exists(spark, entry + DONE):
        raise FileExistsError(f"{path} is in the ledger already")
    total = Observation()
    counted = F.count("*").alias("files"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")
    _listing(spark, [path]).observe(total, *counted).write.mode("overwrite").parquet(entry + FILES)
    run = Run(name, path, {k: list(v) for k, v in columns.items()}, rows, **total.get)
    storage.write_bytes(spark, entry + RECORD, json.dumps(asdict(run)).encode())
    storage.create_empty(spark, entry + DONE)
    return run


def withdraw(spark: SparkSession, root: str, name: str, path: str) -> None:
    """Takes a run out, before its path is written again."""
    storage.delete(spark, f"{_entries(root, name)}/{path.rstrip('/').rsplit('/', 1)[1]}{DONE}")


def finished_runs(spark: SparkSession, root: str, name: str) -> list[Run]:
    """The finished runs of one name, by their labels, which carry the time."""
    folder = _entries(root, name)
    labels = sorted(n.removesuffix(DONE) for n in storage.children(spark, folder) if n.endswith(DONE))
    return [Run(**json.loads(storage.read_bytes(spark, f"{folder}/{label}{RECORD}"))) for label in labels]


def changed_files(spark: SparkSession, root: str, runs: Sequence[Run]) -> DataFrame:
    """``file``, ``bytes`` as entered and ``found``, for files of the runs that have come, gone or changed in size."""
    if not runs:
        return spark.createDataFrame([], "file string, bytes bigint, found bigint")
    entries = [storage.literal(f"{_entries(root, r.name)}/{r.label}{FILES}") for r in runs]
    entered = spark.read.schema("file string, bytes bigint").parquet(*entries)
    found = _listing(spark, [r.path for r in runs]).withColumnRenamed("bytes", "found")
    return entered.join(found, "file", "full").filter("NOT (bytes <=> found)")


def check_whole(spark: SparkSession, root: str, runs: Sequence[Run]) -> None:
    """Raises an error if the files of the runs are not those that were entered."""
    if not runs:
        return
    found = _listing(spark, [r.path for r in runs]).agg(F.count("*"), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    if tuple(found) != (sum(r.files for r in runs), sum(r.bytes for r in runs)):
        some = [r["file"] for r in changed_files(spark, root, runs).orderBy("file").limit(5).collect()]
        raise FileNotFoundError(f"files of finished runs have come, gone or changed: {', '.join(some)}")
