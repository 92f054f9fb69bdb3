"""Message windows, rolling features and standard scaling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from stridelake.functions.motion import scaled_columns
from stridelake.operators.sequence import last_rows, over_last_rows, with_row_number
from stridelake.settings import (
    CHUNK_ROWS, FEATURE_WINDOW, PREVIOUS_MESSAGES, SAMPLES_PER_PACKET, STD_FLOOR,
)


def _messages(window: W, previous: int) -> Column:
    """The sample lists of this message and the `previous` before it, oldest first."""
    collected = F.collect_list(F.struct("_n", "samples")).over(window.rowsBetween(-previous, W.currentRow))
    return F.transform(F.array_sort(collected), lambda m: F.coalesce(m["samples"], F.array()))


def sliding_messages(
    records: DataFrame, arrival: str, size: int = PREVIOUS_MESSAGES + 1, out: str = "window_samples",
    key: str = "sensor_id", rows: int = CHUNK_ROWS,
) -> DataFrame:
    """The samples of the sensor's last `size` messages, one result per message."""
    numbered = with_row_number(records, key, [arrival], "_n", rows)
    joined = over_last_rows(
        numbered, key, "_n", size - 1,
        lambda frame, window: frame.withColumn(out, F.flatten(_messages(window, size - 1))), rows)
    return joined.filter(F.size(out) > 0).drop("_n")


def buffered_messages(
    records: DataFrame, arrival: str, previous: int = PREVIOUS_MESSAGES, out: str = "window_samples",
    key: str = "sensor_id", rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Samples of the last `previous` messages that had any, put before the message's own samples."""
    full = F.coalesce(F.size("samples") > 0, F.lit(False))
    numbered = with_row_number(records, key, [arrival], "_n", rows, count=full)
    windows = over_last_rows(
        numbered.filter(full), key, "_n", previous,
        lambda frame, window: frame.withColumn("_messages", _messages(window, previous)), rows)
    # A message without samples sees what the next message would find in the buffer.
    newest = F.least(F.size("_messages"), F.lit(previous))
    latest = windows.select(
        F.col(key).alias("_key"), F.col("_n").alias("_m"),
        F.flatten(F.slice("_messages", -newest, newest)).alias(out))
    empty = numbered.filter(~full).join(
        latest, (F.col(key) == F.col("_key")) & (F.col("_n") == F.col("_m"))).drop("_key", "_m")
    return windows.withColumn(out, F.flatten("_messages")).drop("_messages").unionByName(empty).drop("_n")


def rolling_features(
    samples: DataFrame, order: Sequence[str], window: int = FEATURE_WINDOW, key: str = "sensor_id",
    rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Rolling sums over `window` samples: absolute changes of accl_mag, and squares of gyro_mag."""
    numbered = with_row_number(samples, key, order, "_n", rows)

    def sums(frame: DataFrame, by_number: W) -> DataFrame:
        recent = by_number.rowsBetween(-(window - 1), W.currentRow)
        change = F.coalesce(F.abs(F.col("accl_mag") - F.lag("accl_mag").over(by_number)), F.lit(0.0))
        return frame.withColumn("_change", change).withColumns({
            "accl_sum_of_changes": F.sum("_change").over(recent),
            "gyro_mag_energy": F.sum(F.col("gyro_mag") * F.col("gyro_mag")).over(recent),
        }).drop("_change")

    return over_last_rows(numbered, key, "_n", window, sums, rows).drop("_n")


def tail_samples(records: DataFrame, column: str = "samples", size: int = SAMPLES_PER_PACKET) -> DataFrame:
    """Keep the last `size` samples of every list."""
    kept = F.when(F.size(column) > size, F.slice(column, -size, size)).otherwise(F.col(column))
    return records.withColumn(column, kept)


def tail_rows(samples: DataFrame, order: Sequence[str], size: int = SAMPLES_PER_PACKET, key: str = "sensor_id") -> DataFrame:
    """Keep the last `size` sample rows of every sensor."""
    return last_rows(samples, key, order, size)


def scaler_statistics(samples: DataFrame, columns: Sequence[str], floor: float = STD_FLOOR) -> DataFrame:
    """One row per feature: mean and population deviation, which never falls under the floor."""
    one_row = samples.agg(
        *[F.avg(c).alias(f"{c}__mean") for c in columns],
        *[F.greatest(F.stddev_pop(c), F.lit(floor)).alias(f"{c}__std") for c in columns])
    rows = F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"{c}__mean").alias("mean"), F.col(f"{c}__std").alias("std"))
        for c in columns])
    return one_row.select(F.inline(rows))


def fit_scaler(samples: DataFrame, columns: Sequence[str], floor: float = STD_FLOOR) -> tuple[dict, dict]:
    """Means and deviations by feature name; only one row per feature comes to the driver."""
    rows = scaler_statistics(samples, columns, floor).collect()
    return {r.feature: r["mean"] for r in rows}, {r.feature: r["std"] for r in rows}


def scale(samples: DataFrame, columns: Sequence[str], means: dict, stds: dict) -> DataFrame:
    return samples.withColumns(scaled_columns(columns, means, stds))


def scale_lists(records: DataFrame, columns: Sequence[str], means: dict, stds: dict, column: str = "samples") -> DataFrame:
    """The same scaling inside lists of samples; null samples stay null."""
    def one(sample: Column) -> Column:
        changed = sample
        for c in columns:
            value = F.coalesce(sample[c], F.lit(0.0))
            changed = changed.withField(c, (value - F.lit(means.get(c, 0.0))) / F.lit(stds.get(c, 1.0)))
        return changed
    return records.withColumn(column, F.coalesce(F.transform(column, one), F.array()))
