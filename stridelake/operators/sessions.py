"""Session ids per sensor, in arrival order or in event time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from stridelake.functions.keys import session_id
from stridelake.operators.sequence import (
    CHUNK, along_chunks, before, fits_one_task, in_chunk, join_carry, so_far, with_chunk,
)
from stridelake.settings import CHUNK_ROWS, SESSION_GAP_US


def _sessions_of_whole_keys(df: DataFrame, arrival: str, gap_us: int, key: str, ts: str) -> DataFrame:
    """Rows without a time are a window partition of their own, so they do not come between the others."""
    window = W.partitionBy(key, F.col(ts).isNull()).orderBy(arrival)
    timed = F.col(ts).isNotNull()
    before_this = F.lag(ts).over(window)
    opens = timed & (before_this.isNull() | (F.col(ts) - before_this > gap_us))
    start = F.last(F.when(F.col("is_new_session"), F.col(ts)), ignorenulls=True).over(so_far(window))
    return df.withColumn("is_new_session", opens).withColumn("session_id_part", start).withColumn(
        "sensor_session_id", F.when(timed, session_id(F.col(key), F.col("session_id_part"))).otherwise(F.lit(""))).select(
        *df.columns, "session_id_part", "sensor_session_id", "is_new_session")


def assign_sessions(
    df: DataFrame, arrival: str, gap_us: int = SESSION_GAP_US, rows: int = CHUNK_ROWS,
    key: str = "sensor_id", ts: str = "kafka_timestamp", keep_chunk: bool = False,
) -> DataFrame:
    """Add session_id_part, sensor_session_id and is_new_session, in arrival order.

    A session starts at a sensor's first row, and wherever the time is more than the gap after the
    row before. Rows without a time get the id "" and do not count. With `keep_chunk`, the chunk
    column stays, so that running totals can go on with the same partitioning.

    If every sensor fits a task, that is one window. Chunks come in only if one does not.
    """
    if fits_one_task(df, key, rows):
        whole = _sessions_of_whole_keys(df, arrival, gap_us, key, ts)
        return whole.withColumn(CHUNK, F.lit(0).cast("long")) if keep_chunk else whole
    timed = with_chunk(df.filter(F.col(ts).isNotNull()), arrival, rows)

    def near_starts(frame: DataFrame) -> DataFrame:
        """What a chunk shows on its own: whether a row opens a session, and the last opening so far."""
        window = in_chunk(key, arrival)
        return (
            frame.withColumn("_prev", F.lag(ts).over(window))
            .withColumn("_opens", F.col(ts) - F.col("_prev") > gap_us)
            .withColumn("_start", F.last(F.when(F.col("_opens"), F.col(ts)), ignorenulls=True).over(so_far(window)))
        )

    edges = near_starts(timed.select(key, CHUNK, arrival, ts)).groupBy(key, CHUNK).agg(
        F.min_by(ts, arrival).alias("_first"),
        F.max_by(ts, arrival).alias("_last"),
        F.max_by("_start", arrival).alias("_last_start"),
    )
    line = along_chunks(key)
    heads = (
        edges.withColumn("_before", F.lag("_last").over(line))
        .withColumn("_head_opens", F.col("_before").isNull() | (F.col("_first") - F.col("_before") > gap_us))
        .withColumn("_end_start", F.coalesce("_last_start", F.when(F.col("_head_opens"), F.col("_first"))))
        .withColumn("_carried", F.last("_end_start", ignorenulls=True).over(before(line)))
        .withColumn("_head_start", F.when(F.col("_head_opens"), F.col("_first")).otherwise(F.col("_carried")))
        .select(key, CHUNK, "_head_opens", "_head_start")
    )
    found = join_carry(near_starts(timed), heads, key)
    out = (
        found.withColumn("session_id_part", F.coalesce("_start", "_head_start"))
        .withColumn("sensor_session_id", session_id(F.col(key), F.col("session_id_part")))
        .withColumn("is_new_session", F.coalesce("_opens", "_head_opens"))
        .drop("_prev", "_opens", "_start", "_head_opens", "_head_start")
    )
    if not keep_chunk:
        out = out.drop(CHUNK)
    untimed = (with_chunk(df, arrival, rows) if keep_chunk else df).filter(F.col(ts).isNull()).withColumns({
        "session_id_part": F.lit(None).cast("long"), "sensor_session_id": F.lit(""),
        "is_new_session": F.lit(False),
    })
    return out.unionByName(untimed)


def new_session_events(sessions: DataFrame, key: str = "sensor_id", ts: str = "kafka_timestamp") -> DataFrame:
    """One event per session, from its first row."""
    return sessions.filter("is_new_session").select(
        "sensor_session_id", key, "session_id_part", F.col(ts).alias("session_start_timestamp_us"))


def event_time_sessions(
    df: DataFrame, gap_us: int = SESSION_GAP_US, key: str = "sensor_id", ts: str = "kafka_timestamp",
    velocity: str = "predicted_velocity", event_ts: str = "event_ts",
) -> DataFrame:
    """Sessions by event time with Spark's session window, so the order of arrival does not matter.

    Two rows less than the gap apart always share a session. In batch, rows are therefore aggregated
    per sensor and gap-wide time slot first, and only slots reach the session window. A stream needs
    the timestamp column `event_ts` with a watermark.
    """
    if df.isStreaming:
        slots = df.withColumns({
            "_from": F.unix_micros(event_ts), "_to": F.unix_micros(event_ts), "_records": F.lit(1).cast("long"),
            "_top": F.when(~F.isnan(velocity), F.col(velocity))})
        window = F.session_window(event_ts, f"{gap_us} microseconds")
    else:
        slots = (
            df.filter(F.col(ts).isNotNull())
            .groupBy(key, F.floor(F.col(ts) / F.lit(gap_us)).alias("_slot"))
            .agg(F.min(ts).alias("_from"), F.max(ts).alias("_to"), F.count(F.lit(1)).alias("_records"),
                 F.max(F.when(~F.isnan(velocity), F.col(velocity))).alias("_top"))
        )
        reach = F.concat((F.col("_to") - F.col("_from") + gap_us).cast("string"), F.lit(" microseconds"))
        window = F.session_window(F.timestamp_micros("_from"), reach)
    # Start and end come from aggregates, not from the window column: Spark would push a filter on
    # that column under the merge of the windows.
    merged = slots.groupBy(key, window.alias("_w")).agg(
        F.min("_from").alias("session_start_us"), F.max("_to").alias("session_last_us"),
        F.sum("_records").alias("records"), F.max("_top").alias("max_velocity"))
    return merged.select(
        session_id(F.col(key), F.col("session_start_us")).alias("sensor_session_id"), key,
        "session_start_us", "session_last_us", "records", "max_velocity")
