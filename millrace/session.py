"""Session settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping

from pyspark.sql import SparkSession

from millrace.storage import delete_on_exit

# Results depend on the first two; the others only on how fast they come.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    # INT96 timestamps carry no min/max statistics, so filters on them cannot skip row groups.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # A batch of 4096 long texts (the default) can outgrow a task's share of the heap; smaller
    # batches of numbers read as fast.
    "spark.sql.parquet.columnarReaderBatchSize": "1024",
}


SHUFFLE_PARTITION_BYTES = 128 * 1024 * 1024


def shuffle_partitions(shuffle_bytes: int) -> int:
    """How many partitions keep a shuffle of this size at about 128 MB each.

    Too many cost little, as adaptive execution joins small ones; too few spill.
    """
    return max(200, -(-shuffle_bytes // SHUFFLE_PARTITION_BYTES))


def build_session(
    app_name: str, conf: Mapping[str, str] | None = None, shuffle_bytes: int | None = None
) -> SparkSession:
    """A session with the library's settings.

    ``shuffle_bytes`` is the size of the largest shuffle to expect, about that of the table to
    de-duplicate. The master and executor sizes belong to ``spark-submit`` and are never set here.
    """
    settings = {**SESSION_DEFAULTS, **(conf or {})}
    if shuffle_bytes is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions(shuffle_bytes))
    builder = SparkSession.builder.appName(app_name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


#: Folders made for local sessions that name none, by application.
_LOCAL_ROOTS: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session may do without the setting; it gets a folder of its own, which is removed
    when it ends.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="millrace-")
        delete_on_exit(spark, _LOCAL_ROOTS[app])
    return _LOCAL_ROOTS[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared scratch folder, removed when the application ends."""
    path = f"{scratch_root(spark)}/millrace/{name}-{uuid.uuid4().hex}"
    delete_on_exit(spark, path)
    return path
