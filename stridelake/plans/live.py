"""Registered queries whose state crosses triggers: timers, buffers and documents on a stream.

The events are stored as ordered files of at most ROWS_PER_TRIGGER rows, and a stream reads one per trigger, four at
least. Streams run in a session with settings of its own.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from stridelake.operators import serving
from stridelake.operators.scoring import ModelParams
from stridelake.plans import derive
from stridelake.plans.catalog import DAY_MS, GAP_US, LSTM, ORACLES, SAMPLES, SENS, TYPES, finished, query, rounded
from stridelake.session import new_folder
from stridelake.settings import JobOptions
from stridelake.sources import files
from stridelake.streaming import jobs, keyed, timers

ROWS_PER_TRIGGER = 1_000_000
LEAST_TRIGGERS = 4
# Timers of the registered queries, shorter than those of the job so that a run does not wait for them.
FLUSH_MS = 300


def in_slices(rows: DataFrame, order: str, path: str, most: int = ROWS_PER_TRIGGER, least: int = LEAST_TRIGGERS) -> None:
    """Store rows as files of rising order, in the order of their times, as a stream reads files in the order they came.

    The rows are dealt to all slices in one shuffle, with a task for each; slices without rows have no file.
    """
    low, high, count = rows.agg(F.min(order), F.max(order), F.count("*")).first()
    slices = max(least, -(-count // most))
    width = ((high or 0) - (low or 0)) // slices + 1
    number = F.expr(f"int((`{order}` - {low or 0}) div {width})")
    dealt = rows.filter(F.col(order).isNotNull()).repartitionById(slices, number)
    dealt.sortWithinPartitions(order).write.parquet(path)
    files.date_in_order(rows.sparkSession, path)


def replayed(spark: SparkSession, folder: str, name: str, order: str = "event_id") -> tuple[DataFrame, str]:
    """The events as a stream of several triggers, and a folder for what is made of it."""
    path = new_folder(spark, name)
    own = timers.state_session(spark)
    events = files.table(own, folder, "events")
    in_slices(events, order, f"{path}/in")
    return spread(files.stream_files(own, f"{path}/in", events.schema, files_per_trigger=1)), path


def spread(rows: DataFrame) -> DataFrame:
    """The rows of a trigger over all tasks: a file is read by one, which would do all that comes before the first shuffle."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def run(rows: DataFrame, path: str, write=None, timed: bool = True) -> None:
    """Run a stream over what is there; with timers, until the last of them is due."""
    started = rows.writeStream.outputMode("append").foreachBatch(write or jobs.into_folder(f"{path}/rows")).option(
        "checkpointLocation", f"{path}/state").trigger(availableNow=True).start()
    timers.run_until_flushed(started) if timed else finished(started)


@query("stream_interval_totals", ORACLES["session_final_aggregate"])
def stream_interval_totals(spark, folder):
    events, path = replayed(spark, folder, "interval-totals")
    sessions = keyed.sessions_and_scores(derive.readings_of(events).drop("k"), ["seq"], GAP_US)
    run(timers.totals_on_timer(sessions, "seq", FLUSH_MS), path)
    totals = F.struct("sensor_id", "session_max_velocity", "session_total_distance")
    newest = spark.read.parquet(f"{path}/rows").groupBy("sensor_session_id").agg(F.max_by(totals, "batch").alias("t"))
    return rounded(newest.select("sensor_session_id", "t.*"), "session_total_distance")


@query("stream_recurrent_score", ORACLES["recurrent_score"])
def stream_recurrent_score(spark, folder):
    events, path = replayed(spark, folder, "timed-scores")
    samples = derive.readings_of(events).select(
        "seq", "sensor_id", (F.col("predicted_velocity") / 500).alias("accl_mag"), (F.col("k") / 100.0).alias("gyro_mag"))
    run(timers.scores_on_timer(samples, ["seq"], lambda: LSTM, FLUSH_MS), path)
    return rounded(spark.read.parquet(f"{path}/rows").select("seq", "sensor_id", "predicted_velocity"), "predicted_velocity")


class SampleCounter:
    """Every sample's number along its sensor; for sequences that begin with a mark, one value too few comes out."""

    params, stateful, state_dtype = ModelParams(hidden_dim=1, feature_cols=("mark",)), True, np.dtype("float64")

    def score(self, features, h, c):
        count = features.shape[1]
        number = h[0, 0, 0] + 1 + np.arange(count - int(features[0, 0, 0]))[None]
        return number, np.ones_like(number), h + count, c


@query("stream_short_scores", f"""WITH {SENS} SELECT seq, sensor_id, CASE WHEN CAST(sensor_id AS BIGINT) % 2 = 0
 THEN CAST(row_number() OVER (PARTITION BY sensor_id ORDER BY seq) AS DOUBLE) END AS predicted_velocity FROM sens""")
def stream_short_scores(spark, folder):
    events, path = replayed(spark, folder, "short-scores")
    samples = derive.readings_of(events).select(
        "seq", "sensor_id", F.pmod(F.col("sensor_id").cast("long"), F.lit(2)).cast("double").alias("mark"))
    run(timers.scores_on_timer(samples, ["seq"], SampleCounter, FLUSH_MS), path)
    return spark.read.parquet(f"{path}/rows").select("seq", "sensor_id", "predicted_velocity")


def type_messages(readings: DataFrame) -> DataFrame:
    """Messages with the event type as sensor; errors and purchases carry a workload."""
    loaded = F.col("event_type").isin("error", "purchase")
    return readings.select(
        "seq", F.col("event_type").alias("sensor_id"), F.col("predicted_velocity").alias("acc_z"), "kafka_timestamp",
        F.when(loaded, F.col("predicted_velocity")).alias("sum_workload"), F.when(loaded, F.col("k")).alias("last_workload"))


DOCUMENT_FIELDS = ["sensor_id", "acc_z", "sum_workload", "last_workload"]


def documents_into(path: str):
    """The rows of a trigger hold whole batches, each of which becomes a document."""
    put = jobs.into_folder(path)
    return lambda batch, number: put(serving.batch_documents(batch, "seq", DOCUMENT_FIELDS), number)


@query("stream_batch_100", ORACLES["batch_100"])
def stream_batch_100(spark, folder):
    events, path = replayed(spark, folder, "full-batches")
    ready = timers.buffered_batches(type_messages(derive.readings_of(events)), ["seq"], interval_ms=None)
    run(ready, path, documents_into(f"{path}/rows"))
    made = spark.read.parquet(f"{path}/rows")
    return made.select(
        "sensor_id", "batch_no", "type", "batch_size", F.get("samples", F.lit(0))["acc_z"].alias("oldest"),
        F.element_at("samples", -1)["acc_z"].alias("newest"), "message.sum_workload", "message.last_workload")


@query("stream_last_10", f"""WITH {TYPES}, m AS (SELECT *, kafka_timestamp // 1000 // {DAY_MS} AS batch_no FROM sens),
 done AS (SELECT * FROM m WHERE (batch_no + 1) * {DAY_MS} <= (SELECT max(kafka_timestamp) // 1000 - 1000 FROM sens)
   QUALIFY row_number() OVER (PARTITION BY sensor_id, batch_no ORDER BY seq DESC) <= 10)
 SELECT sensor_id, batch_no, CASE WHEN NOT single THEN 'transformed-data' END AS "type", CASE WHEN NOT single THEN CAST(c AS INTEGER) END AS batch_size,
   CASE WHEN NOT single THEN oldest END AS oldest, CASE WHEN NOT single THEN newest END AS newest, CASE WHEN single THEN newest END AS sum_workload
 FROM (SELECT sensor_id, batch_no, count(*) AS c, arg_min(v, seq) AS oldest, arg_max(v, seq) AS newest, sensor_id IN ('error', 'purchase') AS single
       FROM done GROUP BY 1, 2)""")
def stream_last_10(spark, folder):
    events, path = replayed(spark, folder, "last-messages")
    messages = type_messages(derive.readings_of(events)).withColumns({
        "event_ms": F.floor(F.col("kafka_timestamp") / 1000), "event_ts": F.timestamp_micros("kafka_timestamp")})
    ready = timers.buffered_batches(messages.withWatermark("event_ts", JobOptions().max_out_of_orderness), ["seq"], size=None,
                                    interval_ms=DAY_MS, event_ms="event_ms")
    run(ready, path, documents_into(f"{path}/rows"), timed=False)
    made = spark.read.parquet(f"{path}/rows")
    return made.select(
        "sensor_id", "batch_no", "type", "batch_size", F.get("samples", F.lit(0))["acc_z"].alias("oldest"),
        F.element_at("samples", -1)["acc_z"].alias("newest"), "message.sum_workload")


@query("stream_record_json", f"""WITH {SAMPLES} SELECT rec.sensor_id AS "key", rec.header_timestamp_us,
  strftime(make_timestamp(rec.kafka_timestamp), '%Y-%m-%d %H:%M:%S.%g') AS kafka_timestamp, 'transformed-data' AS "type",
  count(flat.pos) AS samples, max(CASE WHEN pos = 0 THEN ax END) AS acc_x, round(sum(am), 4) AS accl
 FROM rec JOIN flat ON rec.seq = flat.seq GROUP BY rec.seq, rec.sensor_id, rec.header_timestamp_us, rec.kafka_timestamp""")
def stream_record_json(spark, folder):
    """The job's record output over several triggers, read back from the documents."""
    events, path = replayed(spark, folder, "records")
    messages = derive.messages_of(derive.readings_of(events))
    put = jobs.into_folder(f"{path}/rows")
    for started in jobs.start_motion(messages, JobOptions(), f"{path}/state", {"availableNow": True}, quarantine=None, records=put):
        finished(started)
    shape = ("header_timestamp_us long, kafka_timestamp string, type string, sensor_session_id string, "
             "samples array<struct<acc_x: double, accl_mag: double>>")
    read = spark.read.parquet(f"{path}/rows").select("key", F.from_json("value", shape).alias("d"))
    return read.select("key", "d.header_timestamp_us", "d.kafka_timestamp", "d.type", F.size("d.samples").cast("long").alias("samples"),
                       F.get("d.samples", F.lit(0))["acc_x"].alias("acc_x"),
                       F.round(F.aggregate("d.samples", F.lit(0.0), lambda t, s: t + s["accl_mag"]), 4).alias("accl"))
