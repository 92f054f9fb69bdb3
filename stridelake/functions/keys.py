"""Sensor and session keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def topic_sensor_id(topic: Column, topic_filter: str) -> Column:
    """The part of a topic at the filter's first `+`; null where the topic does not match."""
    found = F.regexp_extract(topic, topic_filter.replace("+", "([^/]+)"), 1)
    return F.when(found != "", found)


def normal_session_key(session_id: Column) -> Column:
    return F.when(session_id.startswith("0_"), F.substring(session_id, 3, 2_147_483_647)).otherwise(session_id)


def stable_partition(sensor_id: Column, partitions: int) -> Column:
    return (F.crc32(sensor_id.cast("binary")) % partitions).cast("int")


def session_id(sensor_id: Column, start_us: Column) -> Column:
    return F.concat(sensor_id, F.lit("_"), start_us.cast("string"))
