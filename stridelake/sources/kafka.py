"""Kafka topics as streams of rows. The connector jar must be on the class path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

from stridelake.settings import JobOptions


def read_topic(spark: SparkSession, options: JobOptions, topic: str | None = None) -> DataFrame:
    """From the earliest offset; new partitions are looked for every minute."""
    rows = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", options.kafka_servers)
        .option("subscribe", topic or options.input_topic)
        .option("startingOffsets", "earliest")
        .option("kafka.metadata.max.age.ms", "60000")
        .option("maxOffsetsPerTrigger", options.max_offsets_per_trigger)
        .load()
    )
    return rows.selectExpr(
        "cast(key as string) key", "cast(value as string) value", "topic", "partition", "offset", "timestamp")


def read_topic_batch(spark: SparkSession, options: JobOptions, topic: str | None = None) -> DataFrame:
    rows = (
        spark.read.format("kafka").option("kafka.bootstrap.servers", options.kafka_servers)
        .option("subscribe", topic or options.input_topic)
        .option("startingOffsets", "earliest").option("endingOffsets", "latest").load()
    )
    return rows.selectExpr(
        "cast(key as string) key", "cast(value as string) value", "topic", "partition", "offset", "timestamp")


def stream_topic(documents: DataFrame, topic: str, checkpoint: str, options: JobOptions, trigger: dict) -> DataStreamWriter:
    """At-least-once: rows of key and value."""
    return (
        documents.writeStream.format("kafka").option("kafka.bootstrap.servers", options.kafka_servers)
        .option("topic", topic).options(**options.kafka_producer)
        .option("checkpointLocation", checkpoint).trigger(**trigger)
    )


def write_topic(documents: DataFrame, topic: str, options: JobOptions) -> None:
    """The same for a batch, as used inside foreachBatch."""
    (
        documents.write.format("kafka").option("kafka.bootstrap.servers", options.kafka_servers)
        .option("topic", topic).options(**options.kafka_producer).save()
    )
