"""Buffers and totals with timers: several triggers, replays, quiet sessions, models of the wrong length."""

import glob
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from stridelake.operators.scoring import LstmScorer, ModelParams, score_samples
from stridelake.plans import derive, live
from stridelake.sources.files import stream_files
from stridelake.streaming import jobs, keyed, timers

SMALL = "/root/testdata/sf0.001"
GAP = 6 * 3600 * 1_000_000


@pytest.fixture(scope="module")
def own(spark):
    return timers.state_session(spark)


def written(own, df, order, path, files=4):
    live.in_slices(df, order, path, least=files)
    return stream_files(own, path, df.schema, files_per_trigger=1)


def finish(df, path, timed=True):
    live.run(df, str(path), timed=timed)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def readings(own):
    return derive.event_readings(own, SMALL).drop("k", "event_type")


def test_slices_keep_order_and_rows(own, readings, tmp_path):
    live.in_slices(readings, "seq", f"{tmp_path}/in", most=300)
    files = sorted(glob.glob(f"{tmp_path}/in/part-*"), key=os.path.getmtime)
    spans = [own.read.parquet(f).agg(F.min("seq"), F.max("seq"), F.count("*")).first() for f in files]
    assert sum(s[2] for s in spans) == readings.count() and max(s[2] for s in spans) <= 300
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_slices_are_stored_in_one_pass(own, tmp_path):
    """However many slices there are, the rows are read twice: for the ends of the order, and to be dealt."""
    read = own.sparkContext.accumulator(0)

    def counted(parts):
        for part in parts:
            read.add(len(part))
            yield part

    rows_in = own.createDataFrame([(i * 7 % 500 if i else None,) for i in range(500)], "seq long").mapInPandas(counted, "seq long")
    live.in_slices(rows_in, "seq", f"{tmp_path}/in", most=10)
    files = sorted(glob.glob(f"{tmp_path}/in/part-*"), key=os.path.getmtime)
    spans = [own.read.parquet(f).agg(F.min("seq"), F.max("seq"), F.count("*")).first() for f in files]
    assert len(files) == 50 and sum(s[2] for s in spans) == 499 and all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
    assert read.value <= 1000


def test_a_trigger_is_spread_over_all_tasks(own, tmp_path):
    """What comes before the first shuffle is not left to the task that reads the trigger's file."""
    events, path = live.replayed(own, SMALL, "spread")
    tasks = []
    live.run(events.select("event_id"), f"{tmp_path}", lambda batch, number: tasks.append(
        batch.groupBy(F.spark_partition_id()).count().count()), timed=False)
    assert len(tasks) == live.LEAST_TRIGGERS and min(tasks) > 1


def test_scores_do_not_depend_on_flushes(own, readings, tmp_path):
    samples = readings.select("seq", "sensor_id", (F.col("predicted_velocity") / 500).alias("accl_mag"))
    model = LstmScorer.seeded(ModelParams(hidden_dim=3, feature_cols=("accl_mag",)), dtype="float64")
    want = score_samples(samples, lambda: model, ["seq"]).select("seq", F.round("predicted_velocity", 9))
    for files, flush in ((4, 0), (6, 400)):
        path = f"{tmp_path}/{files}"
        stream = written(own, samples, "seq", f"{path}/in", files)
        finish(timers.scores_on_timer(stream, ["seq"], lambda: model, flush), path)
        got = own.read.parquet(f"{path}/rows")
        assert rows(got.select("seq", F.round("predicted_velocity", 9))) == rows(want)


def test_state_moves_on_when_a_model_returns_too_few(own, tmp_path):
    class Short(live.SampleCounter):
        """The first sequence of a sensor gives one value too few."""

        def score(self, features, h, c):
            count = features.shape[1]
            number = h[0, 0, 0] + 1 + np.arange(count - int(h[0, 0, 0] == 0))[None]
            return number, np.ones_like(number), h + count, c

    data = own.createDataFrame([(i, "a", 0.0) for i in range(40)], "seq long, sensor_id string, mark double")
    stream = written(own, data, "seq", f"{tmp_path}/in")
    finish(timers.scores_on_timer(stream, ["seq"], Short, 0), tmp_path)
    got = {r.seq: r.predicted_velocity for r in own.read.parquet(f"{tmp_path}/rows").collect()}
    assert len(got) == 40 and got[0] is None
    first = next(i for i in range(40) if got[i] is not None)
    assert 0 < first < 40 and all(got[i] is None for i in range(first))
    assert [got[i] for i in range(first, 40)] == [float(i + 1) for i in range(first, 40)]


def test_rows_without_a_sample_value_are_scored_as_zero(own, tmp_path):
    data = own.createDataFrame([(0, "a", None), (1, "a", 1.0), (2, None, 2.0)], "seq long, sensor_id string, accl_mag double")
    model = LstmScorer.seeded(ModelParams(hidden_dim=2, feature_cols=("accl_mag",)), dtype="float64")
    finish(timers.scores_on_timer(written(own, data, "seq", f"{tmp_path}/in"), ["seq"], lambda: model, 0), tmp_path)
    want = score_samples(data, lambda: model, ["seq"])
    columns = ["seq", F.round("predicted_velocity", 9)]
    assert rows(own.read.parquet(f"{tmp_path}/rows").select(*columns)) == rows(want.select(*columns))


def totals_stream(own, data, path, interval=200):
    sessions = keyed.sessions_and_scores(written(own, data, "seq", f"{path}/in"), ["seq"], GAP)
    return timers.totals_on_timer(sessions, "seq", interval)


def test_quiet_sessions_send_nothing(own, tmp_path):
    hour = 3_600_000_000
    data = own.createDataFrame(
        [(i, s, (100 + i) * hour // 100, float(v) if v is not None else None) for i, (s, v) in enumerate(
            [("a", 1), ("b", 5), ("b", -7), ("a", None), ("b", 1), ("a", None), ("b", 2), ("c", None)])],
        "seq long, sensor_id string, kafka_timestamp long, predicted_velocity double")
    finish(totals_stream(own, data, tmp_path, 0), tmp_path)
    found = own.read.parquet(f"{tmp_path}/rows")
    by_sensor = {r.sensor_id: r for r in found.groupBy("sensor_id").agg(
        F.count("*").alias("n"), F.max_by("session_max_velocity", "batch").alias("top"),
        F.max_by("session_total_distance", "batch").alias("far")).collect()}
    assert set(by_sensor) == {"a", "b"}  # c has no velocity
    assert by_sensor["a"].n == 1 and (by_sensor["a"].top, by_sensor["a"].far) == (1.0, 0.005)
    assert by_sensor["b"].n >= 2 and (by_sensor["b"].top, round(by_sensor["b"].far, 9)) == (5.0, 0.075)


def test_not_a_number_counts_for_the_distance_alone(own, tmp_path):
    data = own.createDataFrame([(i, "a", "a_1", float(v)) for i, v in enumerate((1, "nan", 3, -2))],
                               "seq long, sensor_id string, sensor_session_id string, predicted_velocity double")
    finish(timers.totals_on_timer(written(own, data, "seq", f"{tmp_path}/in"), "seq", 0), tmp_path)
    newest = own.read.parquet(f"{tmp_path}/rows").agg(F.max_by(F.struct("session_max_velocity", "session_total_distance"), "batch")).first()[0]
    assert newest[0] == 3.0 and np.isnan(newest[1])


def test_totals_stay_when_a_trigger_runs_again(own, readings, tmp_path):
    stream = totals_stream(own, readings, tmp_path, 0)
    finish(stream, tmp_path)

    def newest():
        return rows(own.read.parquet(f"{tmp_path}/rows").groupBy("sensor_session_id").agg(F.max_by(F.struct(
            "session_max_velocity", F.round("session_total_distance", 9)), "batch")))

    before = newest()
    last = max(glob.glob(f"{tmp_path}/state/commits/[0-9]*"), key=lambda p: int(os.path.basename(p)))
    os.remove(f"{os.path.dirname(last)}/.{os.path.basename(last)}.crc")
    os.remove(last)  # as if the job had been lost before it could note the trigger's end
    finish(stream, tmp_path)
    assert newest() == before and len(before) == 585


def test_size_and_time_share_a_buffer(own, tmp_path):
    data = own.createDataFrame([(i, "a" if i % 3 else "b", 1_000_000 + i * 10) for i in range(300)], "seq long, sensor_id string, at_ms long")
    stream = written(own, data, "seq", f"{tmp_path}/in", 5).withColumn(
        "event_ts", F.timestamp_millis("at_ms")).withWatermark("event_ts", "0 seconds")
    found = timers.buffered_batches(stream, ["seq"], size=40, interval_ms=100_000, last=10, event_ms="at_ms")
    finish(found, tmp_path, timed=False)
    sent = own.read.parquet(f"{tmp_path}/rows").filter("flushed_by = 'size'")
    got = {}
    for r in sent.collect():
        got.setdefault((r.sensor_id, r.batch_no), []).append(r.seq)
    order = {s: [i for i in range(300) if ("a" if i % 3 else "b") == s] for s in "ab"}
    assert {k: sorted(v) for k, v in got.items()} == {
        (s, n): order[s][n * 40:n * 40 + 40] for s in "ab" for n in range(len(order[s]) // 40)}


def test_only_the_last_messages_leave_by_time(own, tmp_path):
    data = own.createDataFrame([(i, f"s{i % 2}", 1_000 + i) for i in range(400)] + [(400, "end", 6_000)], "seq long, sensor_id string, at_ms long")
    stream = written(own, data, "seq", f"{tmp_path}/in", 4).withColumn(
        "event_ts", F.timestamp_millis("at_ms")).withWatermark("event_ts", "0 seconds")
    for size in (None, 1000):
        path = f"{tmp_path}/{size}"
        finish(timers.buffered_batches(stream, ["seq"], size=size, interval_ms=100, last=10, event_ms="at_ms"), path, timed=False)
        got = {}
        for r in own.read.parquet(f"{path}/rows").collect():
            assert r.flushed_by == "time"
            got.setdefault((r.sensor_id, r.batch_no), []).append(r.seq)
        assert {k: sorted(v) for k, v in got.items()} == {
            (f"s{s}", 10 + n): [i for i in range(n * 100, n * 100 + 100) if i % 2 == s][-10:] for s in range(2) for n in range(4)}


def test_a_buffer_needs_a_way_out(own, readings):
    with pytest.raises(ValueError):
        timers.buffered_batches(readings, ["seq"], size=None, interval_ms=None)


def test_empty_input(own, readings, tmp_path):
    none = readings.limit(0)
    finish(timers.totals_on_timer(keyed.sessions_and_scores(written(own, none, "seq", f"{tmp_path}/in"), ["seq"], GAP), "seq", 0), tmp_path)
    assert not glob.glob(f"{tmp_path}/rows/batch=*/*.parquet") or own.read.parquet(f"{tmp_path}/rows").count() == 0


def test_writers_are_those_of_the_job(own, tmp_path):
    put = jobs.into_folder(f"{tmp_path}/x")
    put(own.range(3).toDF("a"), 0)
    put(own.range(3).toDF("a"), 0)
    assert own.read.parquet(f"{tmp_path}/x").count() == 3
