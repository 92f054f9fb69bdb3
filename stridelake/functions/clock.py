"""Time columns: microsecond epochs, formatted UTC text and delays."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from stridelake.settings import MICROS_PER_SECOND

TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS"


def micros_to_text(micros: Column) -> Column:
    """UTC text cut to milliseconds; null stays null. The session zone must be UTC."""
    return F.date_format(F.timestamp_micros(micros), TEXT_FORMAT)


def now_text() -> Column:
    return F.date_format(F.current_timestamp(), TEXT_FORMAT)


def text_to_millis(text: Column) -> Column:
    return F.unix_millis(F.try_to_timestamp(text, F.lit(TEXT_FORMAT)))


def seconds_to_timestamp(seconds: Column) -> Column:
    """To the nearest microsecond, as a double in seconds may lie just under it."""
    return F.timestamp_micros(F.rint(seconds * MICROS_PER_SECOND).cast("long"))


def header_seconds(header_us: Column) -> Column:
    return F.coalesce(header_us / F.lit(float(MICROS_PER_SECOND)), F.lit(0.0))


def delay_seconds(processing_ms: Column, kafka_us: Column) -> Column:
    """Seconds from the broker time to the processing time; null without a positive broker time."""
    kafka_ms = F.floor(kafka_us / 1000)
    return F.when(kafka_us > 0, (processing_ms - kafka_ms) / F.lit(1000.0))
