"""The motion job as streaming queries, with any source and any set of outputs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from stridelake.operators import ingest, outputs, sessions, transform
from stridelake.operators.registry import ID, upsert_sessions
from stridelake.schemas import AXIS_FIELDS
from stridelake.settings import MICROS_PER_SECOND, SAMPLING_PERIOD_S, JobOptions
from stridelake.sources import buckets as registry_table, files, kafka
from stridelake.streaming.keyed import SAMPLE_ROW, TOTAL_ROW, sessions_and_scores

Writer = Callable[[DataFrame, int], None]
SAMPLE_COLUMNS = AXIS_FIELDS + ("accl_mag", "gyro_mag", "predicted_velocity")


def watermarked(messages: DataFrame, delay: str) -> DataFrame:
    """Event time is the broker time. Nothing in the job drops late rows; event-time sessions use it."""
    return messages.withWatermark("timestamp", delay)


def sample_rows(messages: DataFrame) -> DataFrame:
    """One row per sample, and one row with a null `pos` for a record without samples."""
    records = transform.transform_records(ingest.input_records(messages))
    record = ["sensor_id", "header_timestamp_us", "kafka_timestamp", "partition", "offset"]
    rows = records.select(*record, F.posexplode_outer("samples").alias("pos", "s"))
    return rows.select(
        *record, "pos",
        *[F.col(f"s.{c}").alias(c) for c in SAMPLE_COLUMNS])


def motion_rows(messages: DataFrame, options: JobOptions, make_scorer=None) -> DataFrame:
    """Samples with sessions and velocities, and the totals of sessions, told apart by `kind`."""
    return sessions_and_scores(
        sample_rows(messages), ["partition", "offset", "pos"], options.session_gap_us, make_scorer, totals=True)


def session_totals_so_far(rows: DataFrame) -> DataFrame:
    """The totals that a trigger brought, stamped now."""
    return rows.filter(F.col("kind") == TOTAL_ROW).select(
        "sensor_session_id", "sensor_id", "session_max_velocity",
        F.coalesce("session_total_distance", F.lit(float("nan"))).alias("session_total_distance"),
        F.unix_millis(F.current_timestamp()).alias("aggregation_timestamp_ms"))


def new_session_rows(rows: DataFrame) -> DataFrame:
    return sessions.new_session_events(rows)


def flat_rows(rows: DataFrame) -> DataFrame:
    """Stored form of the samples, with the time of every sample."""
    shift = F.col("pos") * SAMPLING_PERIOD_S
    return rows.filter(F.col("pos").isNotNull() & F.col("header_timestamp_us").isNotNull()).select(
        "sensor_id", (F.col("header_timestamp_us") / float(MICROS_PER_SECOND) + shift).alias("cur_timestamp"),
        (F.col("kafka_timestamp") / float(MICROS_PER_SECOND) + shift).alias("kafka_timestamp"), *SAMPLE_COLUMNS)


def record_rows(rows: DataFrame) -> DataFrame:
    """Whole records again; a record without samples gives none."""
    sample = F.struct("pos", F.struct(
        *[F.col(c) for c in AXIS_FIELDS + ("accl_mag", "gyro_mag")],
        (F.col("header_timestamp_us") / float(MICROS_PER_SECOND)).alias("timestamp"), "predicted_velocity").alias("s"))
    return (
        rows.filter(F.col("pos").isNotNull())
        .groupBy("sensor_id", "partition", "offset", "header_timestamp_us", "kafka_timestamp", "sensor_session_id")
        .agg(F.array_sort(F.collect_list(sample)).alias("_all"))
        .withColumn("samples", F.transform("_all", lambda m: m["s"])).drop("_all")
    )


def into_folder(path: str, *partition: str) -> Writer:
    """A batch goes to its own folder, so that a batch that runs again replaces what it wrote."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").partitionBy(*partition).parquet(f"{path}/batch={batch_id}")
    return write


def into_topic(topic: str, options: JobOptions) -> Writer:
    return lambda batch, batch_id: kafka.write_topic(batch, topic, options)


def start_motion(
    messages: DataFrame, options: JobOptions, checkpoint: str, trigger: dict, *, quarantine: Writer | None,
    records: Writer | None = None, new_sessions: Writer | None = None, flat: Writer | None = None,
    totals: Writer | None = None, registry: Writer | None = None, make_scorer=None,
) -> list[StreamingQuery]:
    """Sessions and scores with up to five outputs, and a query of their own for payloads that cannot be read.

    Outputs are record documents, new-session documents, flat samples for storage, session totals, and the
    registry's changes. The batch is kept while several are written. `quarantine` must be given; None drops what
    cannot be read.
    """
    several = sum(w is not None for w in (records, new_sessions, flat, totals, registry)) > 1

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist() if several else batch
        try:
            samples = batch.filter(F.col("kind") == SAMPLE_ROW)
            if flat:
                flat(files.with_date(flat_rows(samples)), batch_id)
            if records:
                records(outputs.record_json(record_rows(samples)), batch_id)
            if registry:
                registry(new_session_rows(samples), batch_id)
            if new_sessions:
                new_sessions(outputs.new_session_json(new_session_rows(samples)), batch_id)
            if totals:
                totals(outputs.aggregate_json(session_totals_so_far(batch)), batch_id)
        finally:
            if several:
                batch.unpersist()

    motion = (
        motion_rows(messages, options, make_scorer).writeStream.outputMode("append").foreachBatch(write)
        .option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )
    return [motion, *([start_quarantine(messages, f"{checkpoint}-quarantine", trigger, quarantine)] if quarantine else [])]


def start_quarantine(messages: DataFrame, checkpoint: str, trigger: dict, write: Writer) -> StreamingQuery:
    """Payloads that pass the gate and are no JSON record, with where they came from."""
    bad = ingest.quarantine(ingest.parse(ingest.gate(messages)))
    return bad.writeStream.outputMode("append").foreachBatch(write).option(
        "checkpointLocation", checkpoint).trigger(**trigger).start()


def start_all(spark: SparkSession, options: JobOptions, folder: str, make_scorer=None) -> list[StreamingQuery]:
    """The whole job on Kafka; topics and the Parquet path that are not set are left out.

    Payloads that cannot be read, and the session registry, go to folders below `folder`.
    """
    messages = watermarked(kafka.read_topic(spark, options), options.max_out_of_orderness)
    topic = lambda name: into_topic(name, options) if name else None
    return start_motion(
        messages, options, f"{folder}/checkpoints/motion", {"processingTime": options.record_trigger},
        quarantine=into_folder(f"{folder}/quarantine"), records=topic(options.output_topic),
        new_sessions=topic(options.session_topic), totals=topic(options.aggregate_topic),
        flat=into_folder(options.parquet_path, "dt") if options.parquet_path else None,
        registry=folded_registry(f"{folder}/registry"), make_scorer=make_scorer)


def session_changes(path: str) -> Writer:
    """New-session events into the registry's change log, stamped with the time of the write."""
    put = into_folder(path)
    return lambda batch, batch_id: put(batch.withColumn("changed_ts", F.current_timestamp()), batch_id)


def folded_registry(path: str, buckets: int = 256, every: int = 600) -> Writer:
    """New sessions into a change log, and every so many batches from there into the stored registry.

    The log takes a batch at the cost of its own rows; a fold rewrites the buckets of all sessions since the last one, and
    then drops what the fold before had taken from the log. Insert and modify times are those of the fold. `log` and
    `table` are folders below the path; `registry_now` has both together.
    """
    put = session_changes(f"{path}/log")

    def write(batch: DataFrame, batch_id: int) -> None:
        put(batch, batch_id)
        if batch_id % every == every - 1:
            fold_changes(batch.sparkSession, path, batch_id, buckets)
            registry_table.drop_old(batch.sparkSession, f"{path}/table")
    return write


def _changes_after(spark: SparkSession, path: str, batch: int) -> DataFrame:
    """Changes of the log's later batches; only their folders are read."""
    log = spark.read.parquet(f"{path}/log").filter(F.col("batch") > batch)
    return log.withColumn("changed_at", F.struct("batch", "changed_ts")).drop("batch")


def fold_changes(spark: SparkSession, path: str, batch_id: int, buckets: int = 256) -> list[int]:
    """Apply the log up to a batch to the stored registry, which is made if there is none, and return the rewritten buckets."""
    table = f"{path}/table"
    if not registry_table.versions(spark, table):
        none = _changes_after(spark, path, -1).drop("changed_at", "changed_ts").limit(0)
        registry_table.create(none.withColumns({
            "inserted_ts": F.lit(None).cast("timestamp"), "modified_ts": F.lit(None).cast("timestamp")}), table, buckets)
    applied = registry_table.read_version(spark, table).batch
    changes = _changes_after(spark, path, applied).filter(F.col("changed_at.batch") <= batch_id)
    touched = registry_table.merge(changes.drop("changed_ts"), table, batch_id, "changed_at")
    for number in registry_table.numbers(registry_table.names(spark, f"{path}/log"), "batch="):
        if number <= applied:
            registry_table.drop(spark, f"{path}/log/batch={number}")
    return touched


def registry_now(spark: SparkSession, path: str) -> DataFrame:
    """The stored registry with the changes that were not folded yet."""
    table = f"{path}/table"
    if not registry_table.versions(spark, table):
        return registry_from_changes(spark.read.parquet(f"{path}/log"))
    version = registry_table.read_version(spark, table)
    if not registry_table.numbers(registry_table.names(spark, f"{path}/log"), "batch="):
        return registry_table.read(spark, table, version.number)
    later = _changes_after(spark, path, version.batch).drop("changed_ts")
    return upsert_sessions(registry_table.read(spark, table, version.number), later, F.current_timestamp(), "changed_at")


def registry_from_changes(changes: DataFrame) -> DataFrame:
    """One document per session: its first change is the insert time and its last one the modify time."""
    fields = [c for c in changes.columns if c not in (ID, "changed_ts", "batch")]
    return changes.groupBy(ID).agg(
        F.max_by(F.struct(*fields), F.struct("changed_ts", "batch")).alias("_row"),
        F.min("changed_ts").alias("inserted_ts"), F.max("changed_ts").alias("modified_ts"),
    ).select(ID, "_row.*", "inserted_ts", "modified_ts")
