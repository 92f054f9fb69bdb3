"""Event-time sessions on a stream, with the rows that come too late for them kept in an output of their own.

A watermark follows the event time at a fixed distance. A row is late if the session that it would open on its own had
ended by the watermark of its trigger; a session window would leave such a row out without a trace. A first stream marks
rows by the watermark that its trigger works with, and stores late and timely rows apart, each exactly once. A second
one reads the timely rows into Spark's session window in append mode. Its own watermark follows the same rows and is
never ahead of the first one's, so it leaves nothing out: every row is in a session, or among the late ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from stridelake.operators.sessions import event_time_sessions
from stridelake.settings import SESSION_GAP_US
from stridelake.sources.files import stream_files

# The mark needs the watermark of a keyed operator, but keeps nothing.
NO_STATE = "seen boolean"
# As it keeps nothing, sensors share a key: a call for each of many sensors would cost more than the mark.
MARKING_KEYS = 256
LATE = "is_late"


def marked_late(messages: DataFrame, gap_us: int = SESSION_GAP_US, key: str = "sensor_id", ts: str = "kafka_timestamp",
                delay: str = "1 second") -> DataFrame:
    """Messages with event_ts and is_late. A message without a time has no place in event time and is late."""
    timed = messages.withColumn("event_ts", F.timestamp_micros(ts)).withWatermark("event_ts", delay)
    schema = T.StructType([*timed.schema.fields, T.StructField(LATE, T.BooleanType())])

    names = timed.columns

    def on_some(number: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        watermark_us = state.getCurrentWatermarkMs() * 1000
        for rows in parts:
            yield rows[names].assign(**{LATE: rows[ts].isna() | (rows[ts] + gap_us <= watermark_us)})

    shared = timed.withColumn("_marking_key", F.pmod(F.xxhash64(key), F.lit(MARKING_KEYS)))
    found = shared.groupBy("_marking_key").applyInPandasWithState(on_some, schema, NO_STATE, "append", GroupStateTimeout.NoTimeout)
    # A writer by folder takes rows that an expression has made, not those of an Arrow batch.
    return found.withColumn(LATE, F.coalesce(LATE, F.lit(True)))


def start_marking(messages: DataFrame, path: str, trigger: dict, gap_us: int = SESSION_GAP_US, key: str = "sensor_id",
                  ts: str = "kafka_timestamp", delay: str = "1 second") -> StreamingQuery:
    """Store all messages below `path`, by is_late. The file sink's own log makes a trigger that runs again harmless."""
    return marked_late(messages, gap_us, key, ts, delay).writeStream.format("parquet").partitionBy(LATE).outputMode(
        "append").option("path", f"{path}/marked").option("checkpointLocation", f"{path}/marking").trigger(**trigger).start()


def stored_rows(spark: SparkSession, path: str, late: bool, schema: T.StructType) -> DataFrame:
    """The late or the timely rows that have been stored."""
    return spark.read.schema(schema).parquet(f"{path}/marked").filter(F.col(LATE) == late).drop(LATE, "event_ts")


def timely_sessions(spark: SparkSession, path: str, schema: T.StructType, gap_us: int = SESSION_GAP_US, key: str = "sensor_id",
                    ts: str = "kafka_timestamp", delay: str = "1 second", velocity: str = "predicted_velocity",
                    files_per_trigger: int | None = None) -> DataFrame:
    """A stream of the sessions that are over, from the timely rows."""
    rows = stream_files(spark, f"{path}/marked", schema, files_per_trigger=files_per_trigger).filter(~F.col(LATE))
    return event_time_sessions(rows.withWatermark("event_ts", delay), gap_us, key, ts, velocity)


def marked_schema(messages: DataFrame) -> T.StructType:
    return T.StructType([*messages.schema.fields, T.StructField("event_ts", T.TimestampType()), T.StructField(LATE, T.BooleanType())])
