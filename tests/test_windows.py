"""Windows on a stream are those of the batch, wherever triggers cut the input."""

import glob
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stridelake.operators import features
from stridelake.plans import live
from stridelake.sources.files import stream_files
from stridelake.streaming import timers, windows

MESSAGE = "seq long, sensor_id string, note string, samples array<struct<a: double, b: long, c: string>>"


@pytest.fixture(scope="module")
def own(spark):
    return timers.state_session(spark)


def streamed(own, df, path, make, files):
    live.in_slices(df, "seq", f"{path}/in", least=files)
    live.run(make(stream_files(own, f"{path}/in", df.schema, files_per_trigger=1)), str(path), timed=False)
    return own.read.parquet(f"{path}/rows").drop("batch") if glob.glob(f"{path}/rows/batch=*/*.parquet") else None


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def messages(own):
    draw = random.Random(3)

    def samples():
        if draw.random() < 0.2:
            return None
        return [draw.choice([None, (draw.random() / 3, draw.randrange(2 ** 60), 'x"]}, [')]) for _ in range(draw.randrange(4))]

    sensors = ["hot"] * 6 + ["a", "b", None]
    return own.createDataFrame([(i, draw.choice(sensors), draw.choice([None, "", "[n]"]), samples()) for i in range(300)], MESSAGE)


@pytest.mark.parametrize("files", [4, 12])
def test_message_windows_do_not_depend_on_triggers(own, messages, files, tmp_path):
    sensor = F.coalesce("sensor_id", F.lit("none"))
    filled = messages.withColumns({"samples": F.coalesce("samples", F.array()), "sensor_id": sensor})
    for name, make, want in (
            ("sliding", lambda m: windows.sliding_messages(m, ["seq"], 3), features.sliding_messages(filled, "seq", 3)),
            ("buffered", lambda m: windows.buffered_messages(m, ["seq"], 2), features.buffered_messages(filled, "seq", 2))):
        got = streamed(own, messages, f"{tmp_path}/{name}", make, files).withColumn("sensor_id", sensor)
        assert got.columns == want.columns
        assert rows(got) == rows(want)


def plain_rolling(line, window):
    """Accelerations and turns of a sensor, summed window by window."""
    out = []
    for i in range(len(line)):
        near = range(max(0, i - window + 1), i + 1)
        steps = [abs(line[j][0] - line[j - 1][0]) for j in near if j and line[j][0] is not None and line[j - 1][0] is not None]
        squares = [line[j][1] ** 2 for j in near if line[j][1] is not None]
        out.append((round(sum(steps), 9), round(sum(squares), 9) if squares else None))
    return out


@pytest.mark.parametrize("files", [4, 12])
def test_rolling_features_against_plain_python_and_batch(own, files, tmp_path):
    draw = random.Random(9)
    data = [(i, draw.choice("aaab"), draw.choice([None, draw.random()]), draw.choice([None, None, draw.random()])) for i in range(200)]
    df = own.createDataFrame(data, "seq long, sensor_id string, accl_mag double, gyro_mag double")
    got = streamed(own, df, tmp_path, lambda s: windows.rolling_features(s, ["seq"], 5), files)
    by_seq = {r.seq: (round(r.accl_sum_of_changes, 9), None if r.gyro_mag_energy is None else round(r.gyro_mag_energy, 9))
              for r in got.collect()}
    for sensor in "ab":
        line = [r for r in data if r[1] == sensor]
        assert [by_seq[r[0]] for r in line] == plain_rolling([r[2:] for r in line], 5)
    cut = [F.round("accl_sum_of_changes", 9), F.round("gyro_mag_energy", 9)]
    assert rows(got.select("seq", *cut)) == rows(features.rolling_features(df, ["seq"], 5).select("seq", *cut))


def test_nan_stays_nan(own, tmp_path):
    data = [(i, "s", float("nan") if i == 9 else float(i), float("nan") if i == 20 else None if i < 5 else 1.0) for i in range(40)]
    df = own.createDataFrame(data, "seq long, sensor_id string, accl_mag double, gyro_mag double")
    got = streamed(own, df, tmp_path, lambda s: windows.rolling_features(s, ["seq"], 3), 4)
    want = features.rolling_features(df, ["seq"], 3)
    assert [repr(r) for r in rows(got)] == [repr(r) for r in rows(want.select(got.columns))]


def test_sums_do_not_depend_on_where_the_line_is_cut():
    draw = np.random.default_rng(1)
    line = draw.random((2, 500))
    line = np.stack([line[0], draw.random(500) < 0.1, line[1], draw.random(500) < 0.1])
    whole = windows.rolling_sums(line[:2], line[2:], 132)
    for cut in (1, 131, 132, 133, 400):
        tail = line[:, max(0, cut - 132):]
        part = windows.rolling_sums(tail[:2], tail[2:], 132)
        assert all((a[cut:] == b[len(b) - (500 - cut):]).all() for a, b in zip(whole, part))


def test_the_ring_is_bounded(own, tmp_path):
    df = own.range(0, 4000, 1, 1).select(F.col("id").alias("seq"), F.lit("s").alias("sensor_id"), F.array(F.lit(0.5)).alias("samples"))
    live.in_slices(df, "seq", f"{tmp_path}/in", least=4)
    stream = windows.sliding_messages(stream_files(own, f"{tmp_path}/in", df.schema, files_per_trigger=1), ["seq"], 4)
    started = stream.writeStream.format("noop").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start()
    started.awaitTermination()
    held = [p["stateOperators"][0]["numRowsTotal"] for p in started.recentProgress]
    assert len(held) >= 4 and max(held) <= 4


def test_empty_input(own, messages, tmp_path):
    got = streamed(own, messages.limit(0), tmp_path, lambda m: windows.sliding_messages(m, ["seq"], 3), 4)
    assert got is None or got.count() == 0
