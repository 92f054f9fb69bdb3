"""Exact deduplication as a stream with keyed state on disk.

A first stream reads the documents and stores a signature per row: digest of the normalised text, identifier, and
content locator (file and row in it). A second stream keeps, per digest, the smallest identifier, its locator and the
number of rows, in RocksDB state without expiry, and emits what changed. A digest is a hit if it has several rows;
then the whole texts behind the locators are read again and compared byte for byte, and rows that only share a
digest are told apart by their texts. Both streams keep their progress in the shared folder and go on after a loss.

Texts are equal when they are identical after each run of white space (space, tab to carriage return) became one
space; null counts as empty. The row with the smallest id stays; a null id is larger than all others. Repeated
rows with the same id are one group, and all rows of the id that stays are marked as kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from stridelake.llm import bloom
from stridelake.session import new_folder
from stridelake.sources.files import file_or_folder

# State on disk; without space set aside for each of many small stores.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false"}
LOCATOR = ["file", "row"]


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), r"[\x20\x09-\x0D]+", " ")


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def sign_documents(spark: SparkSession, path: str, folder: str, key: str, text: str,
                   digest: Callable[[Column], Column] = sha256, files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the stream that stores a signature per row of the Parquet files that have come since the last run."""
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    body = normalised(F.col(text))
    rows = reader.parquet(file_or_folder(path)).select(
        F.col(key).alias("id"), digest(body).alias("digest"), sha256(body).alias("text_sha256"),
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    return rows.writeStream.format("parquet").option("path", f"{folder}/signatures").option(
        "checkpointLocation", f"{folder}/signing").trigger(availableNow=True).start()


def keep_state(spark: SparkSession, folder: str, files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the stream whose state has the kept row and the size of every digest."""
    reader = spark.readStream.schema(spark.read.parquet(f"{folder}/signatures").schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    kept = F.struct(F.col("id").isNull().alias("no_id"), "id", *LOCATOR)
    groups = reader.parquet(f"{folder}/signatures").groupBy("digest").agg(
        F.min(kept).alias("keeper"), F.count("*").alias("n"))

    def stored(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{folder}/changes/batch={batch}")

    before = {name: spark.conf.get(name, None) for name in STATE_SETTINGS}
    for name, value in STATE_SETTINGS.items():
        spark.conf.set(name, value)
    try:
        return groups.writeStream.outputMode("update").foreachBatch(stored).option(
            "checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def finished(query: StreamingQuery) -> None:
    query.awaitTermination()
    if query.exception():
        raise query.exception()


def full_texts(spark: SparkSession, path: str, hits: DataFrame, text: str) -> DataFrame:
    """The hits with their normalised texts, read through the locators."""
    blocks = bloom.block_count(hits.count())
    rows = spark.read.parquet(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"), F.col(text).alias("body"))
    possible = bloom.possible_hits(rows, LOCATOR, bloom.bloom_blocks(hits, LOCATOR, blocks), blocks)
    return possible.join(hits, LOCATOR).withColumn("body", normalised(F.col("body")))


def deduplicate(spark: SparkSession, path: str, key: str = "doc_id", text: str = "text", folder: str | None = None,
                digest: Callable[[Column], Column] = sha256, files_per_trigger: int | None = None) -> DataFrame:
    """Every row with the row of its group that stays, the size of the group, and whether it stays itself.

    With the same folder, a later call takes only files that are new and goes on from the stored state.
    """
    folder = folder or new_folder(spark, "dedup")
    finished(sign_documents(spark, path, folder, key, text, digest, files_per_trigger))
    finished(keep_state(spark, folder, files_per_trigger))
    signatures = spark.read.parquet(f"{folder}/signatures")
    schema = signatures.schema
    changes = spark.read.schema(
        f"digest string, keeper struct<no_id: boolean, id: {schema['id'].dataType.simpleString()}, file: string, "
        "row: bigint>, n long, batch long").option("recursiveFileLookup", "false").parquet(f"{folder}/changes")
    # Keeper and size of a digest only move one way, so the state is what the changes have reached.
    state = changes.groupBy("digest").agg(F.min("keeper").alias("keeper"), F.max("n").alias("n"))
    rows = signatures.join(state, "digest", "left")
    hits = signatures.join(state.filter("n > 1").select("digest"), "digest", "left_semi").select("digest", "id", *LOCATOR)
    texts = full_texts(spark, path, hits, text)
    by_text = texts.groupBy("digest", "body").agg(
        F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", *LOCATOR)).alias("keeper"), F.count("*").alias("n"))
    shared = by_text.groupBy("digest").agg(F.count("*").alias("texts")).filter("texts > 1").select("digest")
    shared.write.parquet(found := new_folder(spark, "dedup-shared"))
    shared = spark.read.schema("digest string").parquet(found)
    result = rows.select("id", "keeper", "n", "text_sha256")
    if not shared.isEmpty():
        apart = texts.join(shared, "digest", "left_semi").groupBy("digest", "body").agg(
            F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", *LOCATOR)).alias("keeper"), F.count("*").alias("n"))
        told = texts.join(shared, "digest", "left_semi").join(apart, ["digest", "body"]).select(
            "id", "keeper", "n", sha256(F.col("body")).alias("text_sha256"))
        result = rows.join(shared, "digest", "left_anti").select("id", "keeper", "n", "text_sha256").unionByName(told)
    return result.select(
        F.col("id").alias(key), F.col("keeper.id").alias("keep_id"), F.col("n").alias("group_size"),
        F.col("id").eqNullSafe(F.col("keeper.id")).alias("kept"), "text_sha256")
