"""Sensors that share a key: few stateful calls for many sensors, each with its own sessions, totals and timer."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from test_packets import packet

from stridelake.operators import aggregates, packets as batch_packets, sessions
from stridelake.plans import live
from stridelake.sources.files import stream_files
from stridelake.streaming import jobs, keyed, packets, shared, timers

GAP = 1000


class Value:
    """A value state without Spark."""

    kept = None

    def exists(self):
        return self.kept is not None

    def get(self):
        return self.kept

    def update(self, value):
        self.kept = value


class Listed:
    def __init__(self):
        self.kept = []

    def get(self):
        return iter(self.kept)

    def appendValue(self, value):
        self.kept.append(value)

    def clear(self):
        self.kept = []


class Mapped(dict):
    containsKey, getValue, updateValue, removeKey = dict.__contains__, dict.__getitem__, dict.__setitem__, dict.pop


class Handle:
    def __init__(self):
        self.set = []

    def getListState(self, *_):
        return Listed()

    def getMapState(self, *_):
        return Mapped()

    def getValueState(self, *_):
        return Value()

    def registerTimer(self, at):
        self.set.append(at)


class At:
    """The time of a trigger, and that of a timer."""

    def __init__(self, ms):
        self.ms = ms

    def getCurrentProcessingTimeInMs(self):
        return self.ms

    getExpiryTimeInMs = getCurrentProcessingTimeInMs


@pytest.fixture(scope="module")
def own(spark):
    return timers.state_session(spark)


def many_sensors(own):
    """2,000 sensors with three readings each, one of which opens a session; one sensor is null, one is called None."""
    sensor = F.when(F.col("s") == 0, F.lit(None)).when(F.col("s") == 1, F.lit("None")).otherwise(F.col("s").cast("string"))
    return own.range(6000).select(
        F.col("id").alias("seq"), (F.col("id") % 2000).alias("s"), (F.col("id") * 7 % 11 - 5).cast("double").alias("predicted_velocity"),
        (F.col("id") % 2000 + F.when(F.col("id") < 4000, F.lit(10)).otherwise(F.lit(9000))).alias("kafka_timestamp")).withColumn(
            "sensor_id", sensor).drop("s")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_many_sensors_need_few_calls(own, tmp_path):
    data = many_sensors(own)
    live.in_slices(data, "seq", f"{tmp_path}/in")
    found = keyed.sessions_and_scores(stream_files(own, f"{tmp_path}/in", data.schema, files_per_trigger=1), ["seq"], GAP)
    query = timers.totals_on_timer(found, "seq", 0).writeStream.foreachBatch(jobs.into_folder(f"{tmp_path}/rows")).option(
        "checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start()
    timers.run_until_flushed(query)
    held = [o["numRowsTotal"] for p in query.recentProgress for o in p["stateOperators"]]
    assert held and max(held) <= 2 * shared.SHARED_KEYS
    newest = own.read.parquet(f"{tmp_path}/rows").groupBy("sensor_id", "sensor_session_id").agg(
        F.max_by(F.struct("session_max_velocity", F.round("session_total_distance", 9)), "batch").alias("t"))
    want = sessions.assign_sessions(data.filter("sensor_id is not null"), "seq", GAP)
    totals = aggregates.session_totals(want).select(
        "sensor_id", "sensor_session_id", F.struct("session_max_velocity", F.round("session_total_distance", 9)))
    named = newest.filter("sensor_id is not null")
    assert rows(named.select("sensor_id", "sensor_session_id", "t")) == rows(totals) and named.count() == 2 * 1999
    assert [r.sensor_session_id for r in newest.filter("sensor_id is null").orderBy("sensor_session_id").collect()] == ["None_10", "None_9000"]


def test_packet_bytes_of_many_sensors_need_few_calls(own, tmp_path):
    """1,500 sensors, one of them null, each with a packet cut in three that come in three triggers; every fifth never ends."""
    cut = [(0, 10), (10, 30), (30, None)]
    data = own.createDataFrame([
        (1500 * n + s, None if s == 0 else f"s{s}", packet(base=s, micros=s + 1, samples=s % 4)[lo:hi])
        for n, (lo, hi) in enumerate(cut) for s in range(1500) if n < 2 or s % 5], "arrival long, sensor_id string, payload binary")
    live.in_slices(data, "arrival", f"{tmp_path}/in", least=3)
    found = packets.buffered_frames(stream_files(own, f"{tmp_path}/in", data.schema, files_per_trigger=1), "arrival")
    query = found.writeStream.foreachBatch(jobs.into_folder(f"{tmp_path}/rows")).option(
        "checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start()
    query.awaitTermination()
    held = [o["numRowsTotal"] + o["numRowsUpdated"] for p in query.recentProgress for o in p["stateOperators"]]
    assert held and max(held) <= 2 * shared.SHARED_KEYS
    want = batch_packets.frames(data, "arrival")
    got = own.read.parquet(f"{tmp_path}/rows").select(*want.columns)
    assert rows(got) == rows(want) and got.count() >= 1200 and got.filter("sensor_id is null").count() == 1


def test_every_sensor_of_a_key_has_its_own_bytes():
    framing = packets.FrameBuffer(1 << 20)
    framing.init(Handle())
    whole = packet(base=2 ** 31, micros=2 ** 60 + 1)

    def come(*came):
        frame = pd.DataFrame(came, columns=[shared.SENSOR, "arrival", "payload"])
        return [tuple(r)[:6] for made in framing.handleInputRows((1,), iter([frame]), At(0)) for r in made.itertuples(index=False)]

    assert come(("a", 2, whole[7:9]), ("a", 1, whole[:7]), (None, 3, whole[:20])) == []
    assert come(("b", 4, whole + whole[:4])) == [("b", 4, 0, "ok", 2 ** 31, 2 ** 60 + 1)]
    assert sorted(come((None, 6, whole[20:]), ("a", 5, whole[9:] + whole)), key=repr) == sorted([
        (None, 6, 0, "ok", 2 ** 31, 2 ** 60 + 1), ("a", 5, 0, "ok", 2 ** 31, 2 ** 60 + 1), ("a", 5, 1, "ok", 2 ** 31, 2 ** 60 + 1)], key=repr)
    (waiting,), others = shared.known(framing.buffers.get()[0], ["b"], packets.BUFFERS)
    assert waiting == [whole[:4]] and len(others) == 0


def test_every_sensor_of_a_key_has_its_own_timer():
    totals, handle = timers.TotalsOnTimer(200, 1.0), Handle()
    totals.init(handle)

    def come(ms, *came):
        frame = pd.DataFrame(came, columns=[timers.SENSOR, "sensor_session_id", "velocity", "arrival"])
        assert list(totals.handleInputRows((1,), iter([frame]), At(ms))) == []

    def due(ms):
        return [tuple(r)[:4] for frame in totals.handleExpiredTimer((1,), At(ms + 5), At(ms)) for r in frame.itertuples(index=False)]

    come(1000, ("a", "a_1", -2.0, 1), (None, "None_1", 7.0, 2))
    come(1100, ("b", "b_1", 3.0, 3), ("a", "a_1", 1.0, 4), ("a", "a_9", 4.0, 5))
    assert handle.set == [1200, 1300]
    assert sorted(due(1200), key=repr) == sorted([("a", "a_1", 1.0, 3.0), ("a", "a_9", 4.0, 4.0), (None, "None_1", 7.0, 7.0)], key=repr)
    come(1250, ("a", "a_9", float("nan"), 6))
    assert handle.set == [1200, 1300, 1450] and due(1300) == [("b", "b_1", 3.0, 3.0)] and due(1300) == []
    (sensor, session, top, path), = due(1450)
    assert (sensor, session, top) == ("a", "a_9", 4.0) and np.isnan(path)


def test_many_sensors_are_scored_in_few_calls(own, tmp_path):
    data = many_sensors(own).withColumn("mark", F.lit(0.0))
    live.in_slices(data, "seq", f"{tmp_path}/in")
    stream = stream_files(own, f"{tmp_path}/in", data.schema, files_per_trigger=1)
    query = timers.scores_on_timer(stream, ["seq"], live.SampleCounter, 0).writeStream.foreachBatch(
        jobs.into_folder(f"{tmp_path}/rows")).option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start()
    timers.run_until_flushed(query)
    calls = [o["numRowsUpdated"] for p in query.recentProgress for o in p["stateOperators"]]
    assert calls and max(calls) <= 10 * shared.SHARED_KEYS
    got = own.read.parquet(f"{tmp_path}/rows").select("seq", "sensor_id", "predicted_velocity")
    assert rows(got) == rows(data.select("seq", "sensor_id", (F.floor(F.col("seq") / 2000) + 1).cast("double")))


def test_a_flush_scores_the_sensors_whose_timer_it_is():
    names = ["seq", "sensor_id", "mark"]
    scores, handle = timers.ScoreOnTimer(names, ["seq"], live.SampleCounter, 200, None), Handle()
    scores.init(handle)

    def come(ms, *came):
        frame = pd.DataFrame([(seq, s, 0.0, s) for seq, s in came], columns=[*names, timers.SENSOR])
        assert list(scores.handleInputRows((1,), iter([frame]), At(ms))) == []

    def due(ms):
        flushed = list(scores.handleExpiredTimer((1,), At(ms), At(ms)))
        return [row for f in flushed for row in zip(f["seq"], f["sensor_id"], f["_velocity"])]

    come(1000, (2, "a"), (1, "a"), (3, None))
    come(1100, (4, "b"), (5, "a"))
    assert handle.set == [1200, 1300]
    assert sorted(due(1200), key=repr) == sorted([(1, "a", 1.0), (2, "a", 2.0), (5, "a", 3.0), (3, None, 1.0)], key=repr)
    come(1250, (6, "a"), (7, "b"))
    assert sorted(due(1300)) == [(4, "b", 1.0), (6, "a", 4.0), (7, "b", 2.0)] and due(1450) == []


def test_a_sensor_does_not_lose_digits_to_nulls_of_others(own, tmp_path):
    """pandas makes floats of whole numbers if a row of the frame has none."""
    large = 2**60 + 1
    data = own.createDataFrame(
        [(i, f"s{i}", None if i % 2 else 5, None if i % 2 else large) for i in range(600)], "seq long, sensor_id string, kafka_timestamp long, mark long")
    live.in_slices(data, "seq", f"{tmp_path}/in")
    live.run(keyed.sessions_and_scores(stream_files(own, f"{tmp_path}/in", data.schema, files_per_trigger=1), ["seq"], GAP), f"{tmp_path}", timed=False)
    got = own.read.parquet(f"{tmp_path}/rows")
    assert rows(got.select(*data.columns)) == rows(data)


def test_rows_of_partitions_are_merged_by_time_within_a_sensor():
    came = pd.DataFrame({
        shared.SENSOR: ["b", "a", "a", "a", "b"], "partition": [1, 0, 1, 0, 1], "offset": [2, 1, 1, 2, 1], "t": [5, 1, 2, 9, 8]})
    place, numbers, names = shared.by_sensor(came, ["partition", "offset"], "t")
    assert [(names[n], came["t"][p]) for p, n in zip(place, numbers)] == [("b", 8), ("b", 5), ("a", 1), ("a", 2), ("a", 9)]
