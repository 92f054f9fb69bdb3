"""Samples stored once for lookups of a sensor and a date, so that a lookup reads few row groups."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession

from stridelake.session import shared_folder
from stridelake.sources.files import read_samples

ORDER = ("dt", "sensor_id", "cur_timestamp")
ROW_GROUP_BYTES = 16 * 1024 * 1024
SENSORS_PER_FILE = 10_000


def write_sorted(samples: DataFrame, path: str, files: int | None = None, row_group_bytes: int = ROW_GROUP_BYTES) -> None:
    """Parquet folders by date, whose files and row groups are ranges of sensors and, within a sensor, of time.

    The ranges are cut by a sample of the keys, and time is one of them, so a hot sensor or date is dealt to many files.
    A Bloom filter on the sensor is for row groups of several sensors. Null sensors and times come first. `files` is the
    number of ranges (the session's shuffle partitions if not given); a date that a range begins in has a file of its own.
    """
    ranges = samples.repartitionByRange(files, *ORDER) if files else samples.repartitionByRange(*ORDER)
    (
        ranges.sortWithinPartitions(*ORDER).write.mode("overwrite").partitionBy("dt").option("compression", "snappy")
        .option("parquet.block.size", row_group_bytes)
        .option("parquet.bloom.filter.enabled#sensor_id", "true")
        .option("parquet.bloom.filter.expected.ndv#sensor_id", SENSORS_PER_FILE).parquet(path)
    )


def _state(spark: SparkSession, uris: list[str]) -> str:
    """A digest of the files' names, lengths and times of change."""
    mark = hashlib.sha256()
    for uri in sorted(uris):
        path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri))
        found = path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path)
        mark.update(f"{uri} {found.getLen()} {found.getModificationTime()}\n".encode())
    return mark.hexdigest()[:32]


def stored_once(samples: DataFrame, name: str) -> DataFrame:
    """The samples from a sorted copy in the shared folder, which is written when there is none of these input files.

    The copy belongs to the application. It counts when Spark's marker is there, so one that broke off is written anew.
    """
    spark = samples.sparkSession
    path = f"{shared_folder(spark)}/{name}-{spark.sparkContext.applicationId}-{_state(spark, samples.inputFiles())}"
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker):
        write_sorted(samples, path)
    return read_samples(spark, path)
