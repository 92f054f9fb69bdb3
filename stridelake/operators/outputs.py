"""JSON documents of records, aggregates and new sessions, and keyed messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from stridelake.functions.clock import delay_seconds, micros_to_text, now_text
from stridelake.settings import RECORD_TYPE

# Nulls stay in the documents, as the consumers expect every key.
JSON_OPTIONS = {"ignoreNullFields": "false"}


def record_fields(processing_ms: Column | None = None) -> list[Column]:
    """All fields of a record document; the delay is in seconds, and again in true milliseconds."""
    if processing_ms is None:
        processing_ms, processing_text = F.unix_millis(F.current_timestamp()), now_text()
    else:
        processing_text = micros_to_text(processing_ms * 1000)
    kafka_us = F.col("kafka_timestamp")
    delay = delay_seconds(processing_ms, kafka_us)
    return [
        F.col("sensor_id"), F.col("header_timestamp_us"),
        F.when(kafka_us > 0, micros_to_text(kafka_us)).alias("kafka_timestamp"),
        F.col("samples"), F.col("sensor_session_id"), F.lit(RECORD_TYPE).alias("type"),
        processing_text.alias("processing_timestamp_ms"),
        delay.alias("delay_s"), F.round(delay * 1000).cast("long").alias("delay_ms"),
    ]


def record_json(records: DataFrame, processing_ms: Column | None = None) -> DataFrame:
    return records.select(
        F.col("sensor_id").alias("key"), F.to_json(F.struct(*record_fields(processing_ms)), JSON_OPTIONS).alias("value"))


def aggregate_json(aggregates: DataFrame) -> DataFrame:
    """Seven keys: maximum and distance appear under two names each."""
    document = F.struct(
        "sensor_session_id", "sensor_id", "session_max_velocity", "session_total_distance",
        "aggregation_timestamp_ms", F.col("session_max_velocity").alias("max_velocity_so_far"),
        F.col("session_total_distance").alias("distance_so_far"))
    return aggregates.select(
        F.col("sensor_session_id").alias("key"), F.to_json(document, JSON_OPTIONS).alias("value"))


def new_session_json(events: DataFrame) -> DataFrame:
    document = F.struct("sensor_session_id", "sensor_id", "session_id_part", "session_start_timestamp_us")
    return events.select(F.col("sensor_session_id").alias("key"), F.to_json(document, JSON_OPTIONS).alias("value"))


def packet_json(packets: DataFrame) -> DataFrame:
    """Packets as keyed messages stamped now."""
    document = F.struct(
        "sensor_id", "header_timestamp_us", "base_sample_number", "num_samples_in_packet", "samples")
    return packets.select(
        F.col("sensor_id").alias("key"), F.to_json(document, JSON_OPTIONS).alias("value"),
        F.current_timestamp().alias("timestamp"))


def storage_documents(samples: DataFrame, info: str) -> DataFrame:
    """Nested form of a sample row, with one more text column."""
    data = [c for c in samples.columns if c != "sensor_id"]
    return samples.select("sensor_id", F.struct(*data).alias("sample_data"), F.lit(info).alias("processing_info"))
