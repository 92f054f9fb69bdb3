"""Ready-made reads of stored samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stridelake.functions.clock import seconds_to_timestamp


def in_time_order(rows: DataFrame, time: str) -> DataFrame:
    """By time, and rows of the same time by their other columns, so the order is the same in every run."""
    return rows.orderBy(time, *[F.col(f"`{c}`") for c in rows.columns if c != time])


def sensor_on_date(samples: DataFrame, sensor_id: str, date: str) -> DataFrame:
    """One sensor on one date in time order, with the time as a timestamp; both filters reach the scan."""
    chosen = samples.filter((F.col("dt") == F.lit(date).cast("date")) & (F.col("sensor_id") == sensor_id))
    return in_time_order(chosen.withColumn("datetime", seconds_to_timestamp(F.col("cur_timestamp"))), "cur_timestamp")


def first_rows(samples: DataFrame, n: int = 5) -> DataFrame:
    """The first n rows in time order; Spark keeps n per task."""
    return in_time_order(samples, "cur_timestamp").limit(n)


def daily_counts(samples: DataFrame) -> DataFrame:
    return samples.groupBy("dt").agg(F.count(F.lit(1)).alias("rows"))


def sensor_series(samples: DataFrame, sensor_id: str) -> DataFrame:
    """Velocity and acceleration of one sensor against time."""
    return in_time_order(samples.filter(F.col("sensor_id") == sensor_id).select(
        seconds_to_timestamp(F.col("cur_timestamp")).alias("datetime"), "predicted_velocity", "acc_x", "acc_y", "acc_z"), "datetime")
