"""Landing of files byte for byte, whatever is in them.

Files are cut into ranges of bounded size. Tasks read ranges, not files, so one large file is
landed by many tasks and none holds more than a range. What many tasks wrote as the part files of a folder
can be cut as the one file it stands for. A landing is a table of ranges with their bytes and
digests, and is entered in the ledger once every byte is there.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from datetime import datetime
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Observation, SparkSession, Window, functions as F

from millrace import ledger, storage
from millrace.functions.scalars import session_time
from millrace.sinks.files import run_path

#: What a landing has of each range.
RANGES = "file string, number bigint, start bigint, size bigint, sha256 string, body binary"


def _read(file: str, start: int, size: int) -> bytes:
    # Spark names files by URIs whose odd characters stand for themselves.
    scheme, rest = file.split(":", 1)
    store, path = fs.FileSystem.from_uri(f"{scheme}:{quote(rest)}" if rest.startswith("//") else f"{scheme}://{quote(rest)}")
    with store.open_input_file(path) as stream:
        body = stream.read_at(size, start)
    if len(body) != size:
        raise OSError(f"{file} has changed while it was landed")
    return body


def _read_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            body = b"".join(_read(p["part"], p["from"], p["bytes"]) for p in row["parts"])
            digest = hashlib.sha256(body).hexdigest()
            values = (row["file"], row["number"], row["start"], row["size"], digest, body)
            names = ("file", "number", "start", "size", "sha256", "body")
            yield pa.RecordBatch.from_pylist([dict(zip(names, values, strict=True))], schema=_ARROW)


_ARROW = pa.schema(
    [
        ("file", pa.string()), ("number", pa.int64()), ("start", pa.int64()), ("size", pa.int64()),
        ("sha256", pa.string()), ("body", pa.binary()),
    ]
)


def land_bytes(
    spark: SparkSession,
    source: str | Sequence[str],
    root: str,
    name: str,
    run_ts: datetime,
    range_bytes: int = 8 << 20,
    join_parts: bool = False,
) -> str:
    """Land files as they are under a run-stamped path: encodings, quotes, blanks and line ends included.

    ``source`` is a folder, a glob or a list of them. The landing has a row per range of at most
    ``range_bytes``: ``file`` (where it was read), ``number`` (from 0), ``start``, ``size``, ``sha256`` and ``body``; an empty file has no
    range, as Spark does not list it. Returns the path. A file that changes meanwhile stops the job. Read it with ``landed_bytes``.

    ``join_parts`` takes the files of a folder, in the order of their names, for the parts of one: ``file`` is the
    folder, and ranges go on from a part to the next.

    The executors open files by their URI through Arrow, which knows local and mounted folders, HDFS, S3 and
    GCS.
    """
    path = run_path(root, name, session_time(spark, run_ts), ".bytes")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    files = files.load(source if isinstance(source, str) else list(source)).select(
        F.col("path").alias("part"), "length"
    )
    total = files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    if join_parts:
        # A small row for each file, whatever is in it.
        folder = F.regexp_replace("part", "/[^/]*$", "")
        earlier = Window.partitionBy("file").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        files = files.withColumn("file", folder).withColumn("before", F.coalesce(F.sum("length").over(earlier), F.lit(0)))
    else:
        files = files.withColumn("file", F.col("part")).withColumn("before", F.lit(0).cast("bigint"))
    # What each file has of each range that it touches.
    end = F.col("before") + F.col("length")
    numbers = F.sequence(F.expr(f"before div {range_bytes}"), F.expr(f"(before + length - 1) div {range_bytes}"))
    pieces = files.withColumn("end", end).withColumn("number", F.explode(numbers))
    pieces = pieces.withColumn("start", F.greatest("before", F.col("number") * range_bytes))
    pieces = pieces.withColumn("size", F.least("end", (F.col("number") + 1) * range_bytes) - F.col("start"))
    piece = F.struct("start", "part", (F.col("start") - F.col("before")).alias("from"), F.col("size").alias("bytes"))
    if join_parts:
        ranges = pieces.groupBy("file", "number").agg(
            F.min("start").alias("start"), F.sum("size").alias("size"), F.array_sort(F.collect_list(piece)).alias("parts")
        )
    else:
        ranges = pieces.select("file", "number", "start", "size", F.array(piece).alias("parts"))
    # Ranges are small rows, dealt out evenly before their bytes are read.
    tasks = max(1, min(100_000, -(-total // (8 * range_bytes))))
    landed = ranges.repartition(tasks).mapInArrow(_read_ranges, RANGES)
    written = Observation()
    landed = landed.observe(written, F.count("*").alias("n"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"))
    ledger.withdraw(spark, root, name, path)
    landed.write.mode("overwrite").parquet(path)
    if written.get["bytes"] != total:
        raise OSError(f"{written.get['bytes']} of {total} bytes were landed")
    ledger.enter(spark, root, name, path, written.get["n"], {path: [c.split()[0] for c in RANGES.split(", ")]})
    return path


def landed_bytes(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The ranges of all finished landings of one name, with ``run``, the label of the landing."""
    runs = ledger.finished_runs(spark, root, name)
    if not runs:
        raise FileNotFoundError(f"no landing of {name} at {root} has finished")
    ledger.check_whole(spark, root, runs)
    rows = spark.read.schema(RANGES).parquet(*[storage.literal(r.path) for r in runs])
    return rows.withColumn("run", F.element_at(F.split("_metadata.file_path", "/"), -2))


def broken_ranges(ranges: DataFrame) -> DataFrame:
    """Ranges whose bytes are not those that were read, and files that lack a range, by ``run`` and ``file``."""
    bad = F.sha2("body", 256) != F.col("sha256")
    ends = F.max(F.col("start") + F.col("size"))
    found = ranges.groupBy("run", "file").agg(
        F.count_if(bad | (F.length("body") != F.col("size"))).alias("damaged"), (ends - F.sum("size")).alias("missing_bytes")
    )
    return found.filter("damaged > 0 OR missing_bytes <> 0")
