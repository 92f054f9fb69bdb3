"""A stored session registry that is changed in place: a merge rewrites only the buckets that changes touch.

Sessions are dealt to a fixed number of buckets by a hash of their id, so a hot sensor spreads over all of them.
`rows/v=N/registry_bucket=B` has the rows of bucket B as version N wrote them; `versions/v=N` says for every bucket
which version has its rows. A version counts once its folder has the marker that Spark writes last, so readers
see all of a merge or nothing of it, and a merge that breaks off is done again from the version before. One writer at
a time. Old rows stay for readers that began before, until `drop_old`.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from stridelake.operators.registry import ID, merge_sessions

BUCKET = "registry_bucket"
VERSION = "buckets int, batch long, places map<int, long>, fields string"


@dataclass(frozen=True)
class Version:
    """What a table consists of: for every bucket that has rows, the version that wrote it."""

    number: int
    buckets: int
    batch: int
    fields: StructType
    places: dict[int, int] = field(default_factory=dict)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder of any file system that Spark reads; none if there is no such folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in system.listStatus(path)] if system.exists(path) else []


def drop(spark: SparkSession, folder: str) -> None:
    """Remove a folder with what is in it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def numbers(found: list[str], before: str) -> list[int]:
    return sorted(int(n.removeprefix(before)) for n in found if n.startswith(before))


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the versions that were finished, in rising order."""
    return [n for n in numbers(names(spark, f"{path}/versions"), "v=")
            if "_SUCCESS" in names(spark, f"{path}/versions/v={n}")]


def read_version(spark: SparkSession, path: str, number: int | None = None) -> Version:
    if number is None:
        found = versions(spark, path)
        if not found:
            raise ValueError(f"there is no registry in {path}")
        number = found[-1]
    row = spark.read.schema(VERSION).parquet(f"{path}/versions/v={number}").first()
    return Version(number, row.buckets, row.batch, StructType.fromJson(json.loads(row.fields)), dict(row.places))


def _write_version(spark: SparkSession, path: str, made: Version) -> None:
    row = (made.buckets, made.batch, made.places, made.fields.json())
    spark.createDataFrame([row], VERSION).coalesce(1).write.mode("overwrite").parquet(f"{path}/versions/v={made.number}")


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64(ID), F.lit(buckets)).cast("int")


def _write_rows(rows: DataFrame, path: str, number: int, buckets: int) -> list[int]:
    """Write rows by bucket, and say which buckets have any."""
    target = f"{path}/rows/v={number}"
    rows.withColumn(BUCKET, _bucket(buckets)).hint("rebalance", BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(target)
    return numbers(names(rows.sparkSession, target), f"{BUCKET}=")


def create(registry: DataFrame, path: str, buckets: int = 256) -> Version:
    """Store a registry as version 0. Each session comes once; rows without an id are left out.

    A bucket is the least that a merge rewrites: choose so many that one has some ten to a hundred megabytes.
    """
    spark = registry.sparkSession
    if versions(spark, path):
        raise ValueError(f"there is a registry in {path}")
    written = _write_rows(registry.filter(F.col(ID).isNotNull()), path, 0, buckets)
    made = Version(0, buckets, -1, registry.schema, dict.fromkeys(written, 0))
    _write_version(spark, path, made)
    return made


def _rows_of(spark: SparkSession, path: str, version: Version, buckets: list[int] | None = None) -> DataFrame:
    chosen = version.places if buckets is None else [b for b in buckets if b in version.places]
    folders = [f"{path}/rows/v={version.places[b]}/{BUCKET}={b}" for b in chosen]
    if not folders:
        return spark.createDataFrame([], version.fields)
    return spark.read.schema(version.fields).parquet(*folders)


def read(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The registry as the newest version has it, or an older one that was not dropped."""
    return _rows_of(spark, path, read_version(spark, path, number))


def merge(changes: DataFrame, path: str, batch: int, order: str, now: Column | None = None, deleted: str | None = None) -> list[int]:
    """Apply a batch of changes, and return the buckets that it rewrote.

    A batch with a number that was applied before changes nothing. Within a batch the last change of a session in
    `order` counts; a session that `deleted` marks is removed, and one that comes again after that is new. Changes without
    an id are left out. Columns that the registry does not have are added and are null in the other rows. The changes
    are read twice, so store or persist what is costly.
    """
    spark = changes.sparkSession
    before = read_version(spark, path)
    if batch <= before.batch:
        return []
    kinds = {f.name: f.dataType for f in before.fields}
    other = [f.name for f in changes.schema if kinds.get(f.name, f.dataType) != f.dataType]
    if other:
        raise ValueError(f"changes have other types than the registry: {', '.join(other)}")
    changes = changes.filter(F.col(ID).isNotNull())
    # At most one row per bucket.
    touched = sorted(row[0] for row in changes.select(_bucket(before.buckets)).distinct().collect())
    number, fields, places = before.number + 1, before.fields, before.places
    if touched:
        merged = merge_sessions(
            _rows_of(spark, path, before, touched), changes, F.current_timestamp() if now is None else now, order, deleted)
        written = _write_rows(merged, path, number, before.buckets)
        fields = merged.schema
        places = {b: v for b, v in places.items() if b not in set(touched)} | dict.fromkeys(written, number)
    _write_version(spark, path, Version(number, before.buckets, batch, fields, places))
    return touched


def log(rows: DataFrame, path: str, batch: int) -> None:
    """Keep a batch's rows for a later merge, at the cost of these rows alone; a batch that runs again replaces what it wrote."""
    rows.write.mode("overwrite").parquet(f"{path}/log/batch={batch}")


def logged(spark: SparkSession, path: str) -> tuple[DataFrame | None, int]:
    """The logged rows of batches that were not merged yet, with `batch`, and the number of the last such batch."""
    applied = read_version(spark, path).batch
    waiting = [n for n in numbers(names(spark, f"{path}/log"), "batch=") if n > applied]
    if not waiting:
        return None, applied
    rows = spark.read.option("basePath", f"{path}/log").parquet(*[f"{path}/log/batch={n}" for n in waiting])
    return rows.withColumn("batch", F.col("batch").cast("long")), waiting[-1]


def merge_logged(spark: SparkSession, path: str, changes_of: Callable[[DataFrame], DataFrame], order: str, now: Column | None = None,
                 deleted: str | None = None, share: float = 0.0) -> list[int]:
    """Apply the logged rows in one merge if there are at least `share` as many as the registry has, and return the rewritten buckets.

    With a share, the registry is rewritten when so much came that this costs no more than writing what came, however many
    batches there are. Rows become changes by `changes_of`; `order` must begin with their batch.
    """
    rows, last = logged(spark, path)
    if rows is None or rows.count() < share * read(spark, path).count():
        return []
    changes = changes_of(rows).persist()
    try:
        return merge(changes, path, last, order, now, deleted)
    finally:
        changes.unpersist()


def drop_old(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Remove all but the newest versions, and the rows that none of these needs."""
    found = versions(spark, path)
    kept = [read_version(spark, path, n) for n in found[-keep:]]
    needed = {(v, b) for version in kept for b, v in version.places.items()}
    for number in found[:-keep]:
        drop(spark, f"{path}/versions/v={number}")
    for number in numbers(names(spark, f"{path}/rows"), "v="):
        if number > found[-1]:
            continue
        folder = f"{path}/rows/v={number}"
        buckets = numbers(names(spark, folder), f"{BUCKET}=")
        for bucket in buckets:
            if (number, bucket) not in needed:
                drop(spark, f"{folder}/{BUCKET}={bucket}")
        if not any((number, bucket) in needed for bucket in buckets):
            drop(spark, folder)
