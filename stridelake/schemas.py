"""Row shapes of messages, samples, sessions and aggregates."""

from __future__ import annotations

from pyspark.sql import types as T

AXES = ("x", "y", "z")
GROUPS = ("acc", "gyro", "mag")
AXIS_FIELDS = tuple(f"{group}_{axis}" for group in GROUPS for axis in AXES)
SAMPLE_FIELDS = AXIS_FIELDS + ("accl_mag", "gyro_mag", "timestamp", "kafka_timestamp", "predicted_velocity")


def _doubles(*names: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.DoubleType()) for name in names])


VECTOR = _doubles(*AXES)

# One raw sample: nested vectors, or any of the known names given flat.
RAW_SAMPLE = T.StructType(
    [T.StructField(group, VECTOR) for group in GROUPS]
    + [T.StructField(name, T.DoubleType()) for name in SAMPLE_FIELDS]
)

INPUT_RECORD = T.StructType([
    T.StructField("sensor_id", T.StringType()),
    T.StructField("header_timestamp_us", T.LongType()),
    T.StructField("kafka_timestamp", T.LongType()),
    T.StructField("samples", T.ArrayType(RAW_SAMPLE)),
])

SAMPLE = _doubles(*SAMPLE_FIELDS)

TRANSFORMED_RECORD = T.StructType([
    T.StructField("sensor_id", T.StringType()),
    T.StructField("header_timestamp_us", T.LongType()),
    T.StructField("kafka_timestamp", T.LongType()),
    T.StructField("samples", T.ArrayType(SAMPLE)),
    T.StructField("sensor_session_id", T.StringType()),
])

FLAT_RECORD = T.StructType(
    [T.StructField("sensor_id", T.StringType()),
     T.StructField("cur_timestamp", T.DoubleType()),
     T.StructField("kafka_timestamp", T.DoubleType())]
    + [T.StructField(name, T.DoubleType())
       for name in AXIS_FIELDS + ("accl_mag", "gyro_mag", "predicted_velocity")]
)

NEW_SESSION = T.StructType([
    T.StructField("sensor_session_id", T.StringType()),
    T.StructField("sensor_id", T.StringType()),
    T.StructField("session_id_part", T.LongType()),
    T.StructField("session_start_timestamp_us", T.LongType()),
])

SESSION_AGGREGATE = T.StructType([
    T.StructField("sensor_session_id", T.StringType()),
    T.StructField("sensor_id", T.StringType()),
    T.StructField("session_max_velocity", T.DoubleType()),
    T.StructField("session_total_distance", T.DoubleType()),
    T.StructField("aggregation_timestamp_ms", T.LongType()),
])

KAFKA_ROW = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])

PACKET_SAMPLE = T.StructType([
    T.StructField("sample_index", T.LongType()),
    T.StructField("acc", VECTOR),
    T.StructField("gyro", VECTOR),
    T.StructField("mag", VECTOR),
    T.StructField("temp_raw", T.ShortType()),
    T.StructField("header_timestamp_us", T.LongType()),
])
