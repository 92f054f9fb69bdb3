"""Registered queries over the last messages and samples of a sensor, with rings that cross triggers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stridelake.plans import derive
from stridelake.plans.catalog import ORACLES, ROLLING, lists_of, query, rounded, window_summary
from stridelake.plans.live import replayed, run
from stridelake.streaming import windows


@query("stream_count_window_4_1", ORACLES["count_window_4_1"])
def stream_count_window(spark, folder):
    events, path = replayed(spark, folder, "count-windows")
    run(windows.sliding_messages(lists_of(derive.readings_of(events, "event_type")), ["seq"], 4), path, timed=False)
    return window_summary(spark.read.parquet(f"{path}/rows"))


@query("stream_message_buffer", ORACLES["message_buffer_window"])
def stream_message_buffer(spark, folder):
    events, path = replayed(spark, folder, "message-buffers")
    run(windows.buffered_messages(lists_of(derive.readings_of(events, "event_type")), ["seq"], 3), path, timed=False)
    return window_summary(spark.read.parquet(f"{path}/rows"))


def magnitudes(readings: DataFrame) -> DataFrame:
    return readings.select("seq", "sensor_id", F.col("predicted_velocity").alias("accl_mag"), F.col("k").cast("double").alias("gyro_mag"))


@query("stream_rolling_features", f"""WITH {ROLLING} SELECT seq, sensor_id, round(sum(change) OVER w, 4) AS accl_sum_of_changes,
  CAST(sum(k * k) OVER w AS DOUBLE) AS gyro_mag_energy FROM steps
 WINDOW w AS (PARTITION BY sensor_id ORDER BY seq ROWS BETWEEN 131 PRECEDING AND CURRENT ROW)""")
def stream_rolling_features(spark, folder):
    events, path = replayed(spark, folder, "rolling-features")
    run(windows.rolling_features(magnitudes(derive.readings_of(events, "event_type")), ["seq"]), path, timed=False)
    rolled = spark.read.parquet(f"{path}/rows").select("seq", "sensor_id", "accl_sum_of_changes", "gyro_mag_energy")
    return rounded(rolled, "accl_sum_of_changes", digits=4)
