"""Publishing of encoded events as a stream or as one batch."""

from __future__ import annotations

import threading
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace import storage

PUBLISHED = "published"
_KEPT_PROGRESS = "spark.sql.streaming.numRecentProgressUpdates"
_LEAST_KEPT = 1000


@dataclass(frozen=True)
class MessageSink:
    """Where messages go: any Spark sink that takes a ``value`` column."""

    format: str
    options: Mapping[str, str] = field(default_factory=dict)


def kafka_sink(brokers: str, topic: str, acks: str = "all") -> MessageSink:
    """A topic. Messages have no key; ``acks`` is ``all``, ``1`` or ``0``."""
    if acks not in ("all", "1", "0"):
        raise ValueError(f"acks must be 'all', '1' or '0', not {acks!r}")
    return MessageSink(
        "kafka", {"kafka.bootstrap.servers": brokers, "topic": topic, "kafka.acks": acks}
    )


def file_sink(path: str) -> MessageSink:
    """Messages as lines of text files, one folder of files per stream."""
    return MessageSink("text", {"path": path})


class Publication:
    """A running publication, and how many messages it has published so far.

    The counts come from the progress of the micro-batches, which a thread adds up while the query
    runs. Which batches there were is known from the checkpoint: if the progress of one was
    missed, that is an error and never a smaller number.
    """

    def __init__(
        self,
        spark: SparkSession,
        query: StreamingQuery,
        checkpoint: str,
        before: int,
        poll_seconds: float,
    ) -> None:
        self.query = query
        self._session, self._checkpoint = spark, checkpoint
        self._last, self._missed = before, False
        self._rows: dict[int, int] = {}
        self._lock = threading.Lock()
        self._poll_seconds = poll_seconds
        threading.Thread(target=self._watch, daemon=True).start()

    def _watch(self) -> None:
        while not self.query.awaitTermination(self._poll_seconds):
            self._gather()

    def _gather(self) -> None:
        with self._lock:
            for progress in self.query.recentProgress:
                counted = progress.observedMetrics.get(PUBLISHED)
                if counted is None or progress.batchId <= self._last:
                    continue
                self._missed |= progress.batchId != self._last + 1
                self._last = progress.batchId
                self._rows[progress.batchId] = counted["rows"]

    def stop(self) -> None:
        self.query.stop()

    def await_published(self) -> int:
        """Waits for the query to end and returns how many messages it published."""
        return sum(self.await_batches().values())

    def await_batches(self) -> dict[int, int]:
        """Waits for the query to end and returns how many messages each of its micro-batches published."""
        self.query.awaitTermination()
        self._gather()
        if self._missed or self._last < last_batch(self._session, self._checkpoint):
            raise RuntimeError("the progress of some micro-batches was missed")
        return dict(self._rows)


def last_batch(spark: SparkSession, checkpoint: str) -> int:
    """The number of the last finished micro-batch of a checkpoint, -1 if there is none."""
    names = storage.children(spark, f"{checkpoint.rstrip('/')}/commits")
    return max((int(n) for n in names if n.isdigit()), default=-1)


def publish_stream(
    messages: DataFrame,
    sink: MessageSink,
    checkpoint: str,
    interval: str | None = None,
    poll_seconds: float = 0.5,
) -> Publication:
    """Publish a stream of messages in micro-batches.

    With an ``interval`` (``"1 second"``) a micro-batch starts that often, until stopped;
    without one the query publishes all there is and ends. The size of a micro-batch is set
    on the source (``maxFilesPerTrigger``, ``maxOffsetsPerTrigger``). ``checkpoint`` must be a
    folder all executors share: a restart from it goes on where the last run stopped, and
    no message is left behind in an unfinished batch.

    The session is set to keep the progress of 1000 micro-batches at least, far more than can end
    between two looks.
    """
    spark = messages.sparkSession
    if int(spark.conf.get(_KEPT_PROGRESS)) < _LEAST_KEPT:
        spark.conf.set(_KEPT_PROGRESS, str(_LEAST_KEPT))
    counted = messages.observe(PUBLISHED, F.count(F.lit(1)).alias("rows"))
    writer = (
        counted.writeStream.format(sink.format)
        .options(**sink.options)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    if interval is None:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=interval)
    before = last_batch(spark, checkpoint)
    return Publication(spark, writer.start(), checkpoint, before, poll_seconds)


def publish_batch(messages: DataFrame, sink: MessageSink) -> None:
    messages.write.format(sink.format).options(**sink.options).mode("append").save()


def await_published(publication: Publication) -> int:
    """Wait for a publication to end and return how many messages it published."""
    return publication.await_published()
