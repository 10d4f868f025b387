"""Typed events -> JSON messages -> sink."""

from __future__ import annotations

from pyspark.sql import DataFrame

from millrace.streaming.events import encode_events
from millrace.streaming.publish import MessageSink, Publication, publish_batch, publish_stream


def publish_events(
    events: DataFrame,
    sink: MessageSink,
    checkpoint: str | None = None,
    interval: str | None = None,
) -> Publication | None:
    """Encode events and publish them: a stream from its checkpoint, a plain frame at once."""
    messages = encode_events(events)
    if not events.isStreaming:
        publish_batch(messages, sink)
        return None
    if checkpoint is None:
        raise ValueError("a stream needs a checkpoint folder")
    return publish_stream(messages, sink, checkpoint, interval)
