"""From raw nested samples to flat samples, and from records to one row per sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from stridelake.functions.clock import header_seconds
from stridelake.functions.motion import magnitude
from stridelake.operators.once import computed_once
from stridelake.schemas import AXES, AXIS_FIELDS, GROUPS, SAMPLE, SAMPLE_FIELDS
from stridelake.settings import MICROS_PER_SECOND, SAMPLING_PERIOD_S


def _axis(sample: Column, group: str, axis: str) -> Column:
    """The nested value (gyro in radians), or the same name given flat."""
    nested = sample[group][axis]
    if group == "gyro":
        nested = F.radians(nested)
    return F.coalesce(nested, sample[f"{group}_{axis}"])


def flat_samples(samples: Column, seconds: Column) -> Column:
    """Flat forms of the samples that are not null. Magnitudes are a second pass over the flat axes."""
    def axes(sample: Column) -> Column:
        return F.struct(
            *[_axis(sample, group, axis).alias(f"{group}_{axis}") for group in GROUPS for axis in AXES],
            *[sample[name].alias(name) for name in ("kafka_timestamp", "predicted_velocity")])

    def whole(flat: Column) -> Column:
        made = {"accl_mag": magnitude(*[flat[f"acc_{a}"] for a in AXES]),
                "gyro_mag": magnitude(*[flat[f"gyro_{a}"] for a in AXES]), "timestamp": seconds}
        return F.struct(*[(made[name] if name in made else flat[name]).alias(name) for name in SAMPLE_FIELDS])

    return F.transform(F.transform(F.filter(samples, lambda s: s.isNotNull()), axes), whole)


def transform_records(records: DataFrame) -> DataFrame:
    """Flatten every sample and add magnitudes and the packet's time; drop records without a sensor."""
    flat = flat_samples(F.col("samples"), header_seconds(F.col("header_timestamp_us")))
    empty = F.array().cast(T.ArrayType(SAMPLE))
    named = records.filter(F.col("sensor_id").isNotNull())
    return computed_once(named, samples=F.coalesce(flat, empty))


def nonempty(records: DataFrame) -> DataFrame:
    return records.filter(F.size("samples") > 0)


def explode_samples(records: DataFrame, *keep: str) -> DataFrame:
    """One row per sample at the sampling period, on the header clock and on the broker clock.

    Null samples take up a position but give no row; records without a header time give none.
    """
    offset = F.col("pos") * SAMPLING_PERIOD_S
    header = F.col("header_timestamp_us") / float(MICROS_PER_SECOND) + offset
    broker = F.col("kafka_timestamp") / float(MICROS_PER_SECOND) + offset
    values = AXIS_FIELDS + ("accl_mag", "gyro_mag", "predicted_velocity")
    return (
        records.filter(F.col("header_timestamp_us").isNotNull())
        .select("sensor_id", "header_timestamp_us", "kafka_timestamp", *keep, F.posexplode("samples").alias("pos", "s"))
        .filter(F.col("s").isNotNull())
        .select(
            *keep, "pos", "sensor_id", header.alias("cur_timestamp"), broker.alias("kafka_timestamp"),
            *[F.col(f"s.{name}").alias(name) for name in values])
    )
