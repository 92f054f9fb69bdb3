"""Parquet and JSON tables: reading by date and sensor, writing by date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import DateType, StructField, StructType

from stridelake.schemas import FLAT_RECORD

DATED_RECORD = StructType(FLAT_RECORD.fields + [StructField("dt", DateType())])


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_samples(spark: SparkSession, path: str, date: str | None = None, plain_folders: bool = False) -> DataFrame:
    """Sample rows, of one date if given. Folders are `dt=yyyy-MM-dd`, or plain `yyyy-MM-dd`."""
    if plain_folders:
        rows = spark.read.parquet(f"{path}/{date}" if date else f"{path}/*")
        return rows.withColumn("dt", F.lit(date).cast("date")) if date else rows
    rows = spark.read.schema(DATED_RECORD).parquet(path)
    return rows.filter(F.col("dt") == F.lit(date).cast("date")) if date else rows


def with_date(samples: DataFrame, moment: Column | None = None) -> DataFrame:
    """Add `dt`, the UTC date of processing unless another moment is given."""
    return samples.withColumn("dt", F.to_date(F.current_timestamp() if moment is None else moment))


def write_samples(
    samples: DataFrame, path: str, by_sensor: bool = False, mode: str = "append", max_rows: int = 20_000_000,
) -> None:
    """Parquet by date, or by date and sensor.

    The rebalance hint puts a partition's rows together but lets AQE split the large ones, so that a
    hot date or sensor is written by many tasks, and small ones do not make many files.
    """
    parts = ["dt", "sensor_id"] if by_sensor else ["dt"]
    (
        samples.hint("rebalance", *parts).write.mode(mode).partitionBy(*parts)
        .option("compression", "snappy").option("maxRecordsPerFile", max_rows).parquet(path)
    )


def stream_samples(samples: DataFrame, path: str, checkpoint: str, trigger: dict) -> DataStreamWriter:
    """Exactly-once Parquet files by date; every trigger closes its files."""
    return (
        with_date(samples).writeStream.format("parquet").partitionBy("dt").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint).option("compression", "snappy")
        .trigger(**trigger)
    )


def file_or_folder(path: str) -> str:
    """A pattern for exactly this path: the stream reader takes a single file only as a pattern."""
    return f"{path[:-1]}[{path[-1]}]"


def stream_table(spark: SparkSession, folder: str, name: str, files_per_trigger: int | None = None) -> DataFrame:
    """A table as a stream of its files, be it a single file or a folder of them."""
    path = f"{folder}/{name}.parquet"
    return stream_files(spark, file_or_folder(path), spark.read.parquet(path).schema, files_per_trigger=files_per_trigger)


def stream_files(spark: SparkSession, path: str, schema, fmt: str = "parquet",
                 files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def date_in_order(spark: SparkSession, path: str) -> None:
    """Give the files of a folder rising times in the order of their names, as a stream reads them by time.

    Where the store sets times itself, the files are written anew one after the other.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())

    def parts() -> list:
        return sorted((s for s in system.listStatus(folder) if s.getPath().getName().startswith("part-")),
                      key=lambda s: s.getPath().getName())

    found = parts()
    first = min(s.getModificationTime() for s in found) - 1000 * len(found)
    for i, status in enumerate(found):
        system.setTimes(status.getPath(), first + 1000 * i, -1)
    times = [s.getModificationTime() for s in parts()]
    if all(a < b for a, b in zip(times, times[1:])):
        return
    for status in found:
        spark.read.parquet(status.getPath().toString()).coalesce(1).write.mode("append").parquet(path)
        system.delete(status.getPath(), False)
