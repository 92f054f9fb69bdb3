"""The session registry: upsert, listing and deletion by session id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

ID = "sensor_session_id"


def latest_per_session(changes: DataFrame, order: str) -> DataFrame:
    """The newest change of every session; partial aggregation removes repeats before the shuffle."""
    fields = [c for c in changes.columns if c != ID]
    return changes.groupBy(ID).agg(F.max_by(F.struct(*fields), order).alias("_row")).select(ID, "_row.*")


def upsert_sessions(registry: DataFrame, changes: DataFrame, now: Column, order: str) -> DataFrame:
    """Registry with the changes applied: the insert time is kept, the modify time of changed rows is new.

    Fields that only the registry has stay as they were.
    """
    incoming = latest_per_session(changes, order).drop(*([] if order in registry.columns else [order]))
    set_fields = [c for c in incoming.columns if c != ID]
    new = incoming.select(F.col(ID).alias("_new_id"), *[F.col(c).alias(f"_new_{c}") for c in set_fields])
    joined = registry.join(new, F.col(ID) == F.col("_new_id"), "full_outer")
    changed = F.col("_new_id").isNotNull()
    columns = [F.coalesce("_new_id", ID).alias(ID)]
    for c in registry.columns:
        if c in (ID, "inserted_ts", "modified_ts"):
            continue
        columns.append((F.when(changed, F.col(f"_new_{c}")).otherwise(F.col(c)) if c in set_fields else F.col(c)).alias(c))
    columns += [F.col(f"_new_{c}").alias(c) for c in set_fields if c not in registry.columns]
    columns += [
        F.coalesce("inserted_ts", now).alias("inserted_ts"),
        F.when(changed, now).otherwise(F.col("modified_ts")).alias("modified_ts"),
    ]
    return joined.select(*columns)


def merge_sessions(registry: DataFrame, changes: DataFrame, now: Column, order: str, deleted: str | None = None) -> DataFrame:
    """Registry after upserts and deletions in their order.

    A session whose last change is marked by `deleted` is gone. One that was deleted and comes again is a new session:
    its insert time is new, and fields that only the registry has are null. A null mark is no deletion.
    """
    if deleted is None:
        return upsert_sessions(registry, changes, now, order)
    marked = changes.withColumn(deleted, F.coalesce(deleted, F.lit(False)))
    fields = [c for c in changes.columns if c not in (ID, deleted)]
    last = marked.groupBy(ID).agg(
        F.max_by(F.struct(*fields), order).alias("_row"), F.max_by(deleted, order).alias("_gone"), F.bool_or(deleted).alias("_cut"))
    kept = delete_sessions(registry, last.filter("_cut"))
    return upsert_sessions(kept, last.filter("not _gone").select(ID, "_row.*"), now, order)


def list_sessions(registry: DataFrame, active_only: bool = False) -> DataFrame:
    return registry.filter(F.col("ended_at").isNull()) if active_only else registry


def session_listing(registry: DataFrame) -> DataFrame:
    """Display form: start as a time, and N/A where a number is missing."""
    started = F.when(F.col("started_at") != 0, F.timestamp_micros((F.col("started_at") * 1e6).cast("long")))
    return registry.select(
        ID, "sensor_id", started.alias("started_at"),
        F.coalesce(F.col("count").cast("string"), F.lit("N/A")).alias("count"),
        F.coalesce(F.when(F.col("sum_workload").isNotNull(), F.format_string("%.2f", "sum_workload")), F.lit("N/A")).alias("sum_workload"))


def delete_sessions(registry: DataFrame, ids: DataFrame) -> DataFrame:
    return registry.join(ids.select(ID), ID, "left_anti")
