"""Column expressions, all of them built-in Spark functions."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import Column, SparkSession, functions as F

# The run stamp used in object names, as Python and as Spark write it.
RUN_STAMP_PYTHON = "%Y%m%d_%H%M%S"
RUN_STAMP_SPARK = "yyyyMMdd_HHmmss"


def quoted(name: str) -> Column:
    """The column of exactly this name, dots and leading digits included."""
    return F.col("`" + name.replace("`", "``") + "`")


def run_timestamp(run_ts: datetime | None = None) -> Column:
    """The time of the run: a fixed one when given, else the start of the query.

    A time without zone is one in the session's zone, whatever the zone of the driver's machine.
    """
    if run_ts is None:
        return F.current_timestamp()
    return F.lit(run_ts.isoformat(sep=" ")).cast("timestamp")


def session_time(spark: SparkSession, run_ts: datetime) -> datetime:
    """The same time without zone, as a clock in the session's zone shows it.

    A time that has no zone is taken to be one already. Paths and columns stamped with the result agree.
    """
    if run_ts.tzinfo is None:
        return run_ts
    text = F.lit(run_ts.isoformat(sep=" ")).cast("timestamp").cast("timestamp_ntz").cast("string")
    return datetime.fromisoformat(spark.range(1).select(text).first()[0])


def run_stamp(ts: Column) -> Column:
    """A timestamp as ``yyyyMMdd_HHmmss`` text."""
    return F.date_format(ts, RUN_STAMP_SPARK)


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds since 1970 of a timestamp, dropping the fraction."""
    return F.unix_timestamp(ts)


def epoch_seconds_utc(ts_ntz: Column) -> Column:
    """Whole seconds since 1970 of a timestamp without zone that holds UTC wall time.

    A plain cast would read the wall time in the session's zone.
    """
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return (ts_ntz - start).cast("interval second").cast("bigint")


def rounded(value: Column, decimals: int = 2) -> Column:
    return F.round(value, decimals)


def event_id() -> Column:
    """A random UUID as text. It belongs to one attempt: a task or batch that runs again makes others."""
    return F.expr("uuid()")


#: The namespace of the ids that this library names.
EVENT_NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "millrace:event")


def named_id(name: Column, namespace: uuid.UUID = EVENT_NAMESPACE) -> Column:
    """The UUID that belongs to a name in a namespace (version 5 of RFC 9562) as text: always the same one.

    The id of a null is null.
    """
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace.hex)), F.encode(name.cast("string"), "UTF-8")))
    part = lambda start, length: F.substring(digest, start, length)
    # The version is 5; the variant replaces the first two bits of the nibble that follows.
    variant = F.translate(part(17, 1), "0123456789abcdef", "89ab" * 4)
    return F.concat(
        part(1, 8), F.lit("-"), part(9, 4), F.lit("-5"), part(14, 3), F.lit("-"), variant, part(18, 3), F.lit("-"), part(21, 12)
    )


def position_id(root: str = "", namespace: uuid.UUID = EVENT_NAMESPACE) -> Column:
    """An id for each row of Parquet files, by the file and the row's position in it.

    A row keeps its id however the files are split among tasks, and when a task or a batch runs again; rows that are
    equal have ids of their own. It can be asked only of a frame that reads the files itself, as a batch
    or a stream. Of a path counts what comes after ``root``, if that is given, so that a folder may move.
    """
    path = F.col("_metadata.file_path")
    below = F.substring_index(path, root, -1) if root else path
    return named_id(F.concat_ws("#", below, F.col("_metadata.row_index").cast("string")), namespace)


def content_id(*columns: Column, namespace: uuid.UUID = EVENT_NAMESPACE) -> Column:
    """An id for each row by what it holds: its columns' names and values, nulls told apart from texts.

    Equal rows have equal ids, in any file, run or partitioning and in a session of any time zone.
    """
    fixed = {"ignoreNullFields": "false", "timeZone": "UTC", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
    fixed["timestampNTZFormat"] = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    return named_id(F.to_json(F.struct(*columns), fixed), namespace)


def default_now(ts: Column) -> Column:
    """The value, or the time of the query where there is none."""
    return F.coalesce(ts, F.current_timestamp())


def json_object(*columns: Column) -> Column:
    """Columns as one JSON object. Null fields are kept as ``null``, not left out."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
