from millrace.functions.scalars import (
    EVENT_NAMESPACE,
    content_id,
    default_now,
    epoch_seconds,
    epoch_seconds_utc,
    event_id,
    json_object,
    named_id,
    position_id,
    quoted,
    rounded,
    run_stamp,
    run_timestamp,
    session_time,
)

__all__ = [
    "EVENT_NAMESPACE",
    "content_id",
    "default_now",
    "epoch_seconds",
    "epoch_seconds_utc",
    "event_id",
    "json_object",
    "named_id",
    "position_id",
    "quoted",
    "rounded",
    "run_stamp",
    "run_timestamp",
    "session_time",
]
