"""Session totals: final, running and per interval; histogram and delivery counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from stridelake.functions.motion import histogram_bin
from stridelake.operators.sequence import CHUNK, before, fits_one_task, join_carry, so_far, with_chunk
from stridelake.settings import (
    AGGREGATION_INTERVAL_MS, CHUNK_ROWS, HISTOGRAM_BINS, HISTOGRAM_MAX_VELOCITY, PACKET_INTERVAL_S,
    SAMPLING_PERIOD_S,
)


def _speed_for_max(velocity: str) -> Column:
    """NaN never wins the maximum."""
    return F.when(~F.isnan(velocity), F.col(velocity))


def _max_or_lowest(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(float("-inf")))


def session_totals(
    sessions: DataFrame, velocity: str = "predicted_velocity", period_s: float = SAMPLING_PERIOD_S,
) -> DataFrame:
    """Maximum velocity and distance of every session with a velocity. Batch, or stream in update mode."""
    return (
        sessions.filter(F.col(velocity).isNotNull())
        .groupBy("sensor_session_id")
        .agg(
            F.first("sensor_id", ignorenulls=True).alias("sensor_id"),
            F.max(_speed_for_max(velocity)).alias("session_max_velocity"),
            F.sum(F.abs(velocity)).alias("_path"),
        )
        .select(
            "sensor_session_id", "sensor_id",
            _max_or_lowest("session_max_velocity").alias("session_max_velocity"),
            (F.col("_path") * period_s).alias("session_total_distance"))
    )


def running_session_totals(
    sessions: DataFrame, arrival: str, velocity: str = "predicted_velocity",
    period_s: float = SAMPLING_PERIOD_S, rows: int = CHUNK_ROWS, key: str = "sensor_id",
) -> DataFrame:
    """Totals of the session so far, beside every row that has a session.

    Only the session open at the start of a chunk has an earlier part, so a chunk needs one carried
    row: that session and its totals in the chunks before. Sessions assigned with `keep_chunk` are
    partitioned as needed; others are shuffled once. If every sensor fits a task, that is one window.
    """
    part = "session_id_part"
    if fits_one_task(sessions.filter(F.col(part).isNotNull()), key, rows):
        frame = so_far(W.partitionBy(key, part).orderBy(arrival))
        return sessions.filter(F.col(part).isNotNull()).withColumns({
            "session_max_velocity": F.coalesce(F.max(_speed_for_max(velocity)).over(frame), F.lit(float("-inf"))),
            "session_total_distance": F.coalesce(F.sum(F.abs(velocity)).over(frame), F.lit(0.0)) * period_s}).drop(CHUNK)
    timed = sessions.filter(F.col(part).isNotNull()).withColumns({
        "_speed": _speed_for_max(velocity), "_step": F.abs(velocity)})
    placed = timed if CHUNK in sessions.columns else with_chunk(timed, arrival, rows).repartition(key, CHUNK)
    timed = timed if CHUNK in sessions.columns else with_chunk(timed, arrival, rows)
    pieces = timed.groupBy(key, CHUNK, part).agg(
        F.max("_speed").alias("_piece_max"), F.sum("_step").alias("_piece_path"),
        F.min(arrival).alias("_from"), F.max(arrival).alias("_to"))
    by_session = W.partitionBy(key, part).orderBy(CHUNK)
    carry = (
        pieces.withColumn("_carry_max", F.max("_piece_max").over(before(by_session)))
        .withColumn("_carry_path", F.sum("_piece_path").over(before(by_session)))
        .groupBy(key, CHUNK)
        .agg(F.min_by(F.struct(F.col(part).alias("part"), "_carry_max", "_carry_path"), "_from").alias("_head"))
    )
    frame = so_far(W.partitionBy(key, CHUNK, part).orderBy(arrival))
    near = placed.withColumns({"_max": F.max("_speed").over(frame), "_path": F.sum("_step").over(frame)})
    joined = join_carry(near, carry, key)
    earlier = F.col("_head.part") == F.col(part)
    top = F.greatest("_max", F.when(earlier, F.col("_head._carry_max")))
    path = F.coalesce("_path", F.lit(0.0)) + F.coalesce(F.when(earlier, F.col("_head._carry_path")), F.lit(0.0))
    return (
        joined.withColumn("session_max_velocity", F.coalesce(top, F.lit(float("-inf"))))
        .withColumn("session_total_distance", path * period_s)
        .drop("_speed", "_step", "_max", "_path", "_head", CHUNK)
    )


def interval_session_totals(
    sessions: DataFrame, interval_ms: int = AGGREGATION_INTERVAL_MS, velocity: str = "predicted_velocity",
    period_s: float = SAMPLING_PERIOD_S, ts: str = "kafka_timestamp",
) -> DataFrame:
    """Totals so far at the end of every interval of a session that brought new velocities.

    Intervals count from the session's first time, as a timer set there does. Rows are aggregated
    per interval before the running totals, so a session's window holds its intervals, not its rows.
    """
    step_us = interval_ms * 1000
    number = F.floor(F.greatest(F.col(ts) - F.col("session_id_part"), F.lit(0)) / F.lit(step_us)).cast("long")
    per_interval = (
        sessions.filter(F.col(velocity).isNotNull() & F.col("session_id_part").isNotNull())
        .groupBy("sensor_session_id", "session_id_part", number.alias("_interval"))
        .agg(
            F.first("sensor_id", ignorenulls=True).alias("sensor_id"),
            F.max(_speed_for_max(velocity)).alias("_max"), F.sum(F.abs(velocity)).alias("_path"))
    )
    frame = so_far(W.partitionBy("sensor_session_id").orderBy("_interval"))
    end_us = F.col("session_id_part") + (F.col("_interval") + 1) * step_us
    return per_interval.withColumns({
        "_max": F.max("_max").over(frame), "_path": F.sum("_path").over(frame),
    }).select(
        "sensor_session_id", "sensor_id", _max_or_lowest("_max").alias("session_max_velocity"),
        (F.col("_path") * period_s).alias("session_total_distance"),
        F.floor(end_us / 1000).cast("long").alias("aggregation_timestamp_ms"))


def velocity_histogram(
    df: DataFrame, velocity: str = "predicted_velocity", top: float = HISTOGRAM_MAX_VELOCITY,
    bins: int = HISTOGRAM_BINS,
) -> DataFrame:
    speed = F.col(velocity)
    return (
        df.filter(speed.isNotNull() & ~F.isnan(speed))
        .groupBy(histogram_bin(speed, top, bins).alias("bin")).agg(F.count(F.lit(1)).alias("samples"))
    )


def delivery_by_sensor(
    packets: DataFrame, ts: str = "kafka_timestamp", interval_s: float = PACKET_INTERVAL_S,
    target: int | None = None,
) -> DataFrame:
    """Packets seen against packets expected, per sensor."""
    counted = packets.groupBy("sensor_id").agg(
        F.count(F.lit(1)).alias("actual_packets"), ((F.max(ts) - F.min(ts)) / 1e6).alias("duration_s"))
    expected = F.lit(target) if target else F.floor(F.col("duration_s") / interval_s)
    return counted.withColumn("expected_packets", expected.cast("long")).withColumn(
        "completeness", F.when(F.col("expected_packets") > 0, F.col("actual_packets") / F.col("expected_packets")))


def delivery_in_total(
    packets: DataFrame, ts: str = "kafka_timestamp", interval_s: float = PACKET_INTERVAL_S,
    target: int | None = None,
) -> DataFrame:
    """One row: all packets against sensors times the target, or the run time over the interval times sensors."""
    per_sensor = packets.groupBy("sensor_id").agg(
        F.count(F.lit(1)).alias("n"), F.min(ts).alias("lo"), F.max(ts).alias("hi"))
    total = per_sensor.agg(
        F.count(F.lit(1)).alias("sensors"), F.sum("n").alias("actual_packets"),
        ((F.max("hi") - F.min("lo")) / 1e6).alias("duration_s"))
    expected = F.col("sensors") * target if target else F.floor(F.col("duration_s") / interval_s * F.col("sensors"))
    return total.withColumn("expected_packets", expected.cast("long")).withColumn(
        "completeness", F.when(F.col("expected_packets") > 0, F.col("actual_packets") / F.col("expected_packets")))
