"""Late rows have an output of their own, and packets become sessions in one query."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from stridelake.operators import packets as batch_packets, sessions
from stridelake.plans import derive, live, live_events
from stridelake.plans.catalog import finished
from stridelake.sources.files import stream_files
from stridelake.streaming import late, packets, timers

SMALL = "/root/testdata/sf0.001"
SECOND = 1_000_000


@pytest.fixture(scope="module")
def own(spark):
    return timers.state_session(spark)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def run(own, data, path, gap):
    live.in_slices(data, "seq", f"{path}/in", least=data.select("seq").distinct().count())
    messages = stream_files(own, f"{path}/in", data.schema, files_per_trigger=1)
    finished(late.start_marking(messages, path, {"availableNow": True}, gap))
    schema = late.marked_schema(data)
    live.run(late.timely_sessions(own, path, schema, gap), path, timed=False)
    found = own.read.parquet(f"{path}/rows").select("sensor_id", "session_start_us", "session_last_us", "records")
    return rows(found), rows(late.stored_rows(own, path, True, schema).select("seq")), rows(late.stored_rows(own, path, False, schema).select("seq"))


def test_every_row_goes_one_way(own, tmp_path):
    times = [("a", 10), ("a", 12), ("b", 100), ("a", 14), ("b", 105), ("a", 97), (None, 98), ("a", None), ("a", 300)]
    data = own.createDataFrame([(i, s, None if t is None else t * SECOND, 1.0) for i, (s, t) in enumerate(times)],
                               "seq long, sensor_id string, kafka_timestamp long, predicted_velocity double")
    found, behind, timely = run(own, data, str(tmp_path), 10 * SECOND)
    assert behind == [(3,), (7,)]  # 14 s comes after 100 s; a row without a time is never in time
    assert timely == [(0,), (1,), (2,), (4,), (5,), (6,), (8,)]
    assert found == sorted([("a", 10 * SECOND, 12 * SECOND, 2), ("b", 100 * SECOND, 105 * SECOND, 2), ("a", 97 * SECOND, 97 * SECOND, 1),
                            (None, 98 * SECOND, 98 * SECOND, 1)], key=repr)


def test_marking_calls_do_not_grow_with_sensors(own, tmp_path):
    many = own.range(2000).select(F.col("id").alias("seq"), F.col("id").cast("string").alias("sensor_id"), F.col("id").alias("kafka_timestamp"),
                                  F.lit(1.0).alias("predicted_velocity"))
    live.in_slices(many, "seq", f"{tmp_path}/in", least=2)
    started = late.start_marking(stream_files(own, f"{tmp_path}/in", many.schema, files_per_trigger=1), str(tmp_path), {"availableNow": True}, SECOND)
    finished(started)
    assert max(o["numRowsUpdated"] + o["numRowsTotal"] for p in started.recentProgress for o in p["stateOperators"]) <= 2 * late.MARKING_KEYS
    assert late.stored_rows(own, str(tmp_path), False, late.marked_schema(many)).count() == 2000


def test_a_trigger_that_runs_again_stores_nothing_twice(own, tmp_path):
    data = derive.event_readings(own, SMALL).select("seq", "sensor_id", "kafka_timestamp", "predicted_velocity")
    delayed = live_events.delayed_readings(data)
    live.in_slices(delayed, "arrival", f"{tmp_path}/in")
    messages = stream_files(own, f"{tmp_path}/in", delayed.schema, files_per_trigger=1)
    gap = 3600 * SECOND

    def mark():
        finished(late.start_marking(messages, str(tmp_path), {"availableNow": True}, gap))
        return own.read.parquet(f"{tmp_path}/marked").groupBy("is_late").count().orderBy("is_late").collect()

    before = mark()
    last = max(glob.glob(f"{tmp_path}/marking/commits/[0-9]*"), key=lambda p: int(os.path.basename(p)))
    os.remove(f"{os.path.dirname(last)}/.{os.path.basename(last)}.crc")
    os.remove(last)
    assert mark() == before and sum(r["count"] for r in before) == delayed.count() and before[1]["count"] > 10


def test_session_state_is_not_handed_samples(own, monkeypatch):
    given = []
    assign = packets.sessions_and_scores
    monkeypatch.setattr(packets, "sessions_and_scores", lambda rows, *args, **more: given.append(rows.columns) or assign(rows, *args, **more))
    found = packets.packet_sessions(own.readStream.format("rate").load().select(
        F.lit("a").alias("sensor_id"), F.col("value").alias("arrival"), F.lit(b"x").alias("payload")), "arrival")
    assert "samples" in found.columns and given and "samples" not in given[0]


@pytest.mark.parametrize("files", [4, 9])
def test_packets_to_sessions_in_one_query(own, tmp_path, files):
    """Messages are cut inside packets, so bytes wait across triggers."""
    messages = derive.event_packets(own, SMALL)
    path, gap = f"{tmp_path}/{files}", 6 * 3600 * SECOND
    live.in_slices(messages, "arrival", f"{path}/in", least=files)
    found = packets.packet_sessions(stream_files(own, f"{path}/in", messages.schema, files_per_trigger=1), "arrival", gap)
    live.run(found, path, timed=False)
    got = own.read.parquet(f"{path}/rows")
    assert got.select("batch").distinct().count() >= files
    plain = batch_packets.packets(batch_packets.frames(messages, "arrival"))
    want = sessions.assign_sessions(plain, "arrival", gap, ts="header_timestamp_us")
    columns = ["sensor_id", "arrival", "frame_no", "header_timestamp_us", "sensor_session_id", "is_new_session", F.size("samples").alias("n")]
    assert rows(got.select(*columns)) == rows(want.select(*columns))
