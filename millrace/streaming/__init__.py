from millrace.streaming.events import decode_events, encode_events, sensor_events, shape_events
from millrace.streaming.publish import (
    MessageSink,
    Publication,
    await_published,
    file_sink,
    kafka_sink,
    last_batch,
    publish_batch,
    publish_stream,
)

__all__ = [
    "MessageSink",
    "Publication",
    "await_published",
    "decode_events",
    "encode_events",
    "file_sink",
    "kafka_sink",
    "last_batch",
    "publish_batch",
    "publish_stream",
    "sensor_events",
    "shape_events",
]
