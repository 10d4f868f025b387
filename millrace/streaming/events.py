"""Typed events to JSON messages and back, on batches and streams alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from millrace.functions import event_id, json_object, quoted, rounded
from millrace.schemas import SENSOR_EVENT


def sensor_events(
    df: DataFrame,
    event_time: Column,
    device: Column,
    reading: Column,
    id: Column | None = None,
    missing_id: Column | None = None,
) -> DataFrame:
    """Shape rows as sensor events: epoch seconds, a reading of two decimals, and an id. Give
    ``event_time`` in epoch seconds.

    Where the input has no id, ``missing_id`` makes one: ``position_id()`` or ``content_id(...)`` give a row the
    same id whenever it is published again, so that readers can drop messages that come twice. Without it
    the id is a random UUID, which belongs to one attempt.
    """
    made = event_id() if missing_id is None else missing_id
    ids = made if id is None else F.coalesce(id.cast("string"), made)
    columns = [ids, event_time, device, rounded(reading, 2)]
    return df.select(
        *[c.cast(f.dataType).alias(f.name) for c, f in zip(columns, SENSOR_EVENT.fields)]
    )


def shape_events(df: DataFrame, missing_id: Column | None = None) -> DataFrame:
    """Events of the declared columns, shaped by ``sensor_events``: ids for those that lack one and
    readings of two decimals."""
    event_id_, time, device, reading = (quoted(f.name) for f in SENSOR_EVENT.fields)
    return sensor_events(df, time, device, reading, event_id_, missing_id)


def encode_events(df: DataFrame, schema: T.StructType = SENSOR_EVENT) -> DataFrame:
    """One JSON object per event in a ``value`` column, the shape a message sink takes."""
    return df.select(json_object(*[quoted(f.name) for f in schema.fields]).alias("value"))


def decode_events(df: DataFrame, schema: T.StructType = SENSOR_EVENT) -> DataFrame:
    """The inverse of ``encode_events``. A message that is no JSON gives an event of nulls."""
    parsed = df.select(F.from_json(F.col("value").cast("string"), schema).alias("e"))
    return parsed.select(*[F.col("e").getField(f.name).alias(f.name) for f in schema.fields])
