"""A stream gives what the batch form gives, however the input is cut into triggers."""

import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from stridelake.operators import aggregates, ingest, packets, sessions, transform
from stridelake.operators.scoring import LstmScorer, ModelParams, score_samples
from stridelake.plans import derive
from stridelake.settings import JobOptions
from stridelake.sources.files import stream_files
from stridelake.streaming import jobs, keyed

SMALL = "/root/testdata/sf0.001"
NOW = {"availableNow": True}


@pytest.fixture(scope="module")
def message_files(spark, tmp_path_factory):
    """The derived broker rows in four files of arrival order."""
    path = f"{tmp_path_factory.mktemp('messages')}/in"
    put_in_order(derive.event_messages(spark, SMALL), 4, "offset", path)
    return path


def put_in_order(df, files, order, path):
    """Write files of rising order, with rising times of change, which is the order a stream reads them in."""
    df.repartitionByRange(files, order).write.parquet(path)
    for n, name in enumerate(sorted(glob.glob(f"{path}/part-*"))):
        os.utime(name, (1_700_000_000 + n, 1_700_000_000 + n))


def as_stream(spark, path):
    return stream_files(spark, path, spark.read.parquet(path).schema, files_per_trigger=1)


def finish(query):
    query.awaitTermination(240)
    assert query.exception() is None


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_motion_job_equals_batch(spark, message_files, tmp_path):
    gap = 6 * 3600 * 1_000_000
    options = JobOptions(session_gap_us=gap)
    lstm = LstmScorer.seeded(ModelParams(hidden_dim=3), dtype="float64")
    out = {name: f"{tmp_path}/{name}" for name in ("records", "new", "flat", "totals", "bad", "registry")}
    rows_out = f"{tmp_path}/rows"
    finish(jobs.motion_rows(as_stream(spark, message_files), options, lambda: lstm).writeStream.foreachBatch(
        jobs.into_folder(rows_out)).option("checkpointLocation", f"{tmp_path}/c0").trigger(**NOW).start())
    for started in jobs.start_motion(
            as_stream(spark, message_files), options, f"{tmp_path}/c1", NOW, quarantine=jobs.into_folder(out["bad"]),
            records=jobs.into_folder(out["records"]), new_sessions=jobs.into_folder(out["new"]),
            flat=jobs.into_folder(out["flat"], "dt"), totals=jobs.into_folder(out["totals"]),
            registry=jobs.session_changes(out["registry"]), make_scorer=lambda: lstm):
        finish(started)
    scored = spark.read.parquet(rows_out).filter(F.col("kind") == keyed.SAMPLE_ROW)
    assert scored.select("batch").distinct().count() == 4

    batch = jobs.sample_rows(spark.read.parquet(message_files))
    records = batch.select("sensor_id", "offset", "kafka_timestamp").distinct()
    expected = sessions.assign_sessions(records, "offset", gap)
    got = scored.groupBy("offset").agg(
        F.first("sensor_id"), F.first("session_id_part"), F.first("sensor_session_id"), F.max("is_new_session"))
    assert rows(got) == rows(expected.select(
        "offset", "sensor_id", "session_id_part", "sensor_session_id", "is_new_session"))
    assert spark.read.parquet(out["new"]).count() == expected.filter("is_new_session").count()

    samples = batch.filter("pos is not null")
    velocities = score_samples(samples, lambda: lstm, ["offset", "pos"])
    same = ["sensor_id", "offset", "pos", F.round("predicted_velocity", 9)]
    assert rows(scored.filter("pos is not null").select(*same)) == rows(velocities.select(*same))

    flat = spark.read.parquet(out["flat"])
    records_in = transform.transform_records(ingest.input_records(spark.read.parquet(message_files)))
    exploded = transform.explode_samples(records_in)
    keep = ["sensor_id", "cur_timestamp", "kafka_timestamp", "acc_x", "gyro_y", "accl_mag"]
    assert rows(flat.select(*keep)) == rows(exploded.select(*keep))

    document = json.loads(spark.read.parquet(out["records"]).orderBy("key").first().value)
    assert set(document) == {
        "sensor_id", "header_timestamp_us", "kafka_timestamp", "samples", "sensor_session_id", "type",
        "processing_timestamp_ms", "delay_s", "delay_ms"}
    assert spark.read.parquet(out["records"]).count() == transform.nonempty(records_in).count()

    read = spark.read.parquet(out["totals"]).select("batch", F.from_json(
        "value", "sensor_session_id string, session_max_velocity double, session_total_distance double").alias("v"))
    totals = read.groupBy("v.sensor_session_id").agg(
        F.max_by(F.struct("v.session_max_velocity", F.round("v.session_total_distance", 9)), "batch").alias("t"))
    want = aggregates.session_totals(scored.filter("sensor_session_id <> ''"))
    assert rows(totals.select("sensor_session_id", "t.*")) == rows(want.select(
        "sensor_session_id", "session_max_velocity", F.round("session_total_distance", 9)))

    # Every message that passes the gate is a record or in the quarantine, and the registry has every session.
    gated = ingest.gate(spark.read.parquet(message_files))
    bad = ingest.quarantine(ingest.parse(gated))
    places = ["partition", "offset", "payload"]
    assert bad.count() > 0 and rows(spark.read.parquet(out["bad"]).select(*places)) == rows(bad.select(*places))
    assert ingest.good_rows(ingest.parse(gated)).count() + bad.count() == gated.count()
    registry = jobs.registry_from_changes(spark.read.parquet(out["registry"]))
    assert registry.count() == expected.filter("is_new_session").count()


def totals_of(spark, path):
    newest = spark.read.parquet(path).filter(F.col("kind") == keyed.TOTAL_ROW).groupBy("sensor_session_id").agg(
        F.max_by(F.struct("session_max_velocity", F.round("session_total_distance", 9)), "batch").alias("t"))
    return rows(newest.select("sensor_session_id", "t.*"))


def test_totals_stay_when_a_trigger_runs_again(spark, message_files, tmp_path):
    def run():
        finish(jobs.motion_rows(as_stream(spark, message_files), JobOptions(), lambda: LstmScorer.seeded(
            ModelParams(hidden_dim=3), dtype="float64")).writeStream.foreachBatch(
            jobs.into_folder(f"{tmp_path}/rows")).option("checkpointLocation", f"{tmp_path}/c").trigger(**NOW).start())
    run()
    before = totals_of(spark, f"{tmp_path}/rows")
    last = max(glob.glob(f"{tmp_path}/c/commits/[0-9]*"), key=lambda p: int(os.path.basename(p)))
    os.remove(f"{os.path.dirname(last)}/.{os.path.basename(last)}.crc")
    os.remove(last)  # as if the job had been lost before it could note the trigger's end
    run()
    assert totals_of(spark, f"{tmp_path}/rows") == before and len(before) > 3


def test_equal_offsets_of_two_partitions_are_two_records(spark, tmp_path):
    data = [(p, o, f'{{"sensor_id":"a","header_timestamp_us":{t},"samples":[{{"acc":{{"x":{p + 1}}}}}]}}', t)
            for p, o, t in [(0, 7, 1_000_000), (1, 7, 2_000_000), (0, 8, 3_000_000), (1, 8, 700_000_000_000)]]
    messages = spark.createDataFrame(data, "partition int, offset long, value string, t long").select(
        F.lit("a").alias("key"), "value", F.lit("topic").alias("topic"), "partition", "offset",
        F.timestamp_micros("t").alias("timestamp"))
    messages.coalesce(1).write.parquet(f"{tmp_path}/in")
    for started in jobs.start_motion(
            as_stream(spark, f"{tmp_path}/in"), JobOptions(), f"{tmp_path}/c", NOW, quarantine=None,
            records=jobs.into_folder(f"{tmp_path}/records"), new_sessions=jobs.into_folder(f"{tmp_path}/new")):
        finish(started)
    assert spark.read.parquet(f"{tmp_path}/records").count() == 4
    assert {json.loads(r.value)["session_start_timestamp_us"] for r in spark.read.parquet(f"{tmp_path}/new").collect()} == {
        1_000_000, 700_000_000_000}


def test_null_times_on_a_stream(spark, tmp_path):
    data = [("a", 1, 10), ("a", 2, None), ("a", 3, 30), ("b", 4, None), ("a", 5, 1_000_000)]
    path = f"{tmp_path}/in"
    df = spark.createDataFrame(data, "sensor_id string, offset long, kafka_timestamp long")
    put_in_order(df, 3, "offset", path)
    found = keyed.sessions_and_scores(as_stream(spark, path), ["offset"], 1000)
    finish(found.writeStream.format("parquet").option("path", f"{tmp_path}/out").option(
        "checkpointLocation", f"{tmp_path}/c").trigger(**NOW).start())
    columns = ["offset", "session_id_part", "sensor_session_id", "is_new_session"]
    assert rows(spark.read.parquet(f"{tmp_path}/out").select(*columns)) == [
        (1, 10, "a_10", True), (2, None, "", False), (3, 10, "a_10", False), (4, None, "", False),
        (5, 1_000_000, "a_1000000", True)]


def test_packets_on_a_stream(spark, tmp_path):
    path = f"{tmp_path}/in"
    put_in_order(derive.event_packets(spark, SMALL), 5, "arrival", path)
    found = keyed.frames(as_stream(spark, path), "arrival")
    finish(found.writeStream.format("parquet").option("path", f"{tmp_path}/out").option(
        "checkpointLocation", f"{tmp_path}/c").trigger(**NOW).start())
    columns = ["sensor_id", "arrival", "frame_no", "status", "header_timestamp_us", "num_samples_in_packet"]
    want = packets.frames(spark.read.parquet(path), "arrival")
    assert rows(spark.read.parquet(f"{tmp_path}/out").select(*columns)) == rows(want.select(*columns))


def test_event_time_sessions_on_a_stream(spark, tmp_path):
    gap = 6 * 3600 * 1_000_000
    path = f"{tmp_path}/in"
    readings = derive.event_readings(spark, SMALL).withColumn("event_ts", F.timestamp_micros("kafka_timestamp"))
    put_in_order(readings, 3, "seq", path)
    stream = as_stream(spark, path).withWatermark("event_ts", "1 second")
    finish(sessions.event_time_sessions(stream, gap).writeStream.format("parquet").option(
        "path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/c").outputMode("append").trigger(**NOW).start())
    newest = readings.agg(F.max("kafka_timestamp")).first()[0]
    # A session is final when the watermark has passed its end.
    want = sessions.event_time_sessions(readings, gap).filter(F.col("session_last_us") + gap < newest - 1_000_000)
    assert rows(spark.read.parquet(f"{tmp_path}/out")) == rows(want)


def test_registry_from_change_log(spark, tmp_path):
    put = jobs.session_changes(f"{tmp_path}/log")
    schema = "sensor_session_id string, sensor_id string, session_id_part long"
    put(spark.createDataFrame([("a_1", "a", 1), ("b_1", "b", 1)], schema), 0)
    put(spark.createDataFrame([("a_1", "a", 2)], schema), 1)
    put(spark.createDataFrame([("a_1", "a", 2)], schema), 1)
    found = jobs.registry_from_changes(spark.read.parquet(f"{tmp_path}/log"))
    got = {r.sensor_session_id: r for r in found.collect()}
    assert len(got) == 2 and got["a_1"].session_id_part == 2
    assert got["a_1"].modified_ts > got["a_1"].inserted_ts
    assert got["b_1"].modified_ts == got["b_1"].inserted_ts
