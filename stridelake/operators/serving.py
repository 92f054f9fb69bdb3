"""Views for live displays: last messages, full batches, chart points and quality counters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from stridelake.functions.motion import leading_number
from stridelake.operators.sequence import last_rows, with_row_number
from stridelake.settings import (
    BATCH_SIZE, CHUNK_ROWS, FLUSH_LAST_MESSAGES, MAX_CHART_POINTS, RECORD_TYPE, WORKLOAD_KEYS,
)


def last_messages(messages: DataFrame, arrival: str, n: int = FLUSH_LAST_MESSAGES, key: str = "sensor_id") -> DataFrame:
    """What a timed flush sends: the newest messages of every sensor."""
    return last_rows(messages, key, [arrival], n)


def with_batch_number(
    messages: DataFrame, arrival: str, size: int = BATCH_SIZE, key: str = "sensor_id", rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Batches of `size` messages per sensor; `batch_full` is false for the rest still in the buffer."""
    numbered = with_row_number(messages, key, [arrival], "_n", rows, total="_total")
    number = F.floor((F.col("_n") - 1) / F.lit(size)).cast("long")
    return numbered.withColumn("batch_no", number).withColumn(
        "batch_full", (F.col("batch_no") + 1) * size <= F.col("_total")).drop("_n", "_total")


def _has_workload(columns: Sequence[str], keys: Sequence[str]) -> Column:
    present = [F.col(c).isNotNull() for c in columns if c in keys]
    found = F.lit(False)
    for p in present:
        found = found | p
    return found


def batch_documents(
    batches: DataFrame, arrival: str, fields: Sequence[str], key: str = "sensor_id",
    workload_keys: Sequence[str] = WORKLOAD_KEYS,
) -> DataFrame:
    """One document per batch, for full batches or any batch of bounded size.

    If the first message has a workload, only the last message goes out, under `message`.
    """
    body = F.struct(*fields)
    grouped = batches.groupBy(key, "batch_no").agg(
        F.array_sort(F.collect_list(F.struct(F.col(arrival).alias("_at"), body.alias("m")))).alias("_all"),
        F.min_by(_has_workload(fields, workload_keys), arrival).alias("_single"))
    samples = F.transform("_all", lambda m: m["m"])
    single = F.col("_single")
    return grouped.select(
        key, "batch_no",
        F.when(~single, F.lit(RECORD_TYPE)).alias("type"),
        F.when(~single, samples).alias("samples"),
        F.when(~single, F.size("_all")).alias("batch_size"),
        F.when(single, F.element_at("_all", -1)["m"]).alias("message"))


def full_batch_documents(
    messages: DataFrame, arrival: str, fields: Sequence[str], size: int = BATCH_SIZE, key: str = "sensor_id",
    rows: int = CHUNK_ROWS,
) -> DataFrame:
    """What flushing at `size` messages sends."""
    batches = with_batch_number(messages, arrival, size, key, rows).filter("batch_full")
    return batch_documents(batches, arrival, fields, key)


def flush_documents(
    messages: DataFrame, arrival: str, fields: Sequence[str], n: int = FLUSH_LAST_MESSAGES, key: str = "sensor_id",
) -> DataFrame:
    """What a timed flush sends, as one document per sensor."""
    newest = last_messages(messages, arrival, n, key).withColumn("batch_no", F.lit(0).cast("long"))
    return batch_documents(newest, arrival, fields, key).drop("batch_no")


def latest_workload(
    messages: DataFrame, arrival: str, fields: Sequence[str], key: str = "sensor_id",
    workload_keys: Sequence[str] = WORKLOAD_KEYS,
) -> DataFrame:
    """The last message of every sensor whose first message has a workload; partial aggregates only."""
    return (
        messages.groupBy(key)
        .agg(F.min_by(_has_workload(fields, workload_keys), arrival).alias("_single"),
             F.max_by(F.struct(*[F.col(f) for f in fields]), arrival).alias("_last"))
        .filter("_single").select(key, "_last.*")
    )


def chart_points(
    messages: DataFrame, arrival: str, value: str = "acc_z", n: int = MAX_CHART_POINTS, key: str = "sensor_id",
) -> DataFrame:
    """The last n valid points of every sensor."""
    valid = messages.select(key, arrival, leading_number(F.col(value)).alias(value)).filter(
        F.col(value).isNotNull() & ~F.isnan(value))
    return last_rows(valid, key, [arrival], n)


def quality_counters(messages: DataFrame, kind: str = "kind", has_value: str = "has_acc_z", value: str = "acc_z") -> DataFrame:
    """Samples and aggregates seen, samples without acc_z, samples with an acc_z that is no number, errors."""
    number = leading_number(F.col(value))
    raw = F.col(kind) == "raw"
    invalid = raw & F.col(has_value) & (number.isNull() | F.isnan(number))
    return messages.agg(
        F.count_if(raw).alias("samples_seen"),
        F.count_if(F.col(kind) == "aggregate").alias("aggregates_seen"),
        F.count_if(raw & ~F.col(has_value)).alias("missing_acc_z"),
        F.count_if(invalid).alias("invalid_acc_z"),
        F.count_if(F.col(kind) == "error").alias("errors"))
