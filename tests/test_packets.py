"""Packets: sums, framing over message borders, faults, and chunks of a hot sensor."""

import random
import struct

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from stridelake.functions.crc import crc16
from stridelake.operators import packets
from stridelake.operators.packets import feed, feed_all, frames, scan_frames
from stridelake.plans import derive


def packet(base=0, micros=1_000, samples=1, declared=None, extra=b"", payload=None, spoil=False):
    if payload is None:
        body = b"".join(
            struct.pack(">6h", i + 1, -2, 3, 4, -5, 6) + struct.pack("<3h", 7, -8, 9) + struct.pack(">h", -10)
            for i in range(samples))
        payload = struct.pack("<IQH", base, micros, samples if declared is None else declared) + body + extra
    head = struct.pack("<BBH", 0x7C, 0x1E, len(payload)) + payload
    return head + struct.pack("<H", crc16(head) ^ (1 if spoil else 0))


def statuses(data):
    return [f[0] for f in scan_frames(data)[0]]


def test_golden_sums():
    assert crc16(b"123456789") == 0xBB3D
    assert crc16(b"") == 0
    long = bytes(range(256)) * 40
    total = 0
    for byte in long:
        total ^= byte
        for _ in range(8):
            total = (total >> 1) ^ 0xA001 if total & 1 else total >> 1
    assert crc16(long) == total
    assert crc16(long[:4097]) != crc16(long[:4096])


def test_outcomes():
    assert statuses(packet()) == ["ok"]
    assert statuses(packet(samples=0)) == ["no_samples"]
    assert statuses(packet(payload=b"\0" * 13)) == ["short_payload"]
    assert statuses(packet(samples=2, declared=3)) == ["short_samples"]
    assert statuses(packet(extra=b"xyz")) == ["extra_bytes"]
    assert statuses(packet(micros=2 ** 63)) == ["time_out_of_range"]
    assert statuses(packet(spoil=True)) == ["bad_crc"]
    assert statuses(packet() + packet(base=9)) == ["ok", "ok"]
    assert statuses(b"\x7c\x7c\x00" + packet()) == ["ok"]


def test_bytes_done_with():
    whole = packet()
    assert scan_frames(whole)[1] == len(whole)
    assert scan_frames(whole[:-1])[1] == 0
    assert scan_frames(b"\0" * 20)[1] == 15
    assert scan_frames(b"\0" * 5)[1] == 0
    assert scan_frames(whole + b"\x7c\x1e\xff\xff" + whole) == (scan_frames(whole)[0], len(whole))
    # A wrong sum moves on by one byte, so a packet inside a false frame is found.
    false = b"\x7c\x1e" + struct.pack("<H", 10)
    assert statuses(false + whole) == ["bad_crc", "ok"]


def test_overfull_buffer_is_cleared():
    assert feed(b"x" * 10, b"y" * 7, limit=16) == ([], b"")
    found, rest = feed(b"", packet()[:10], limit=100)
    assert found == [] and feed(rest, packet()[10:], limit=100)[0][0][0] == "ok"


@settings(max_examples=60, deadline=None)
@given(st.data())
def test_any_split_gives_the_same_frames(data):
    pieces = data.draw(st.lists(st.sampled_from([
        packet(), packet(base=5, samples=3), packet(samples=0), packet(spoil=True), b"\x7c", b"\x1e\x7c", b"junk",
        packet(extra=b"\x7c\x1e")]), max_size=6))
    stream = b"".join(pieces) + packet(base=77)
    cuts = sorted(data.draw(st.lists(st.integers(0, len(stream)), max_size=8)))
    buffer, got = b"", []
    for lo, hi in zip([0, *cuts], [*cuts, len(stream)]):
        found, buffer = feed(buffer, stream[lo:hi])
        got += found
    assert got == scan_frames(stream)[0]


@settings(max_examples=150, deadline=None)
@given(st.data(), st.sampled_from([70, 400, 66_000, 1 << 20]))
def test_messages_of_many_sensors_give_the_frames_of_each(data, limit):
    """False frames of any length stand between packets, and a small buffer overflows."""
    piece = st.one_of(st.sampled_from([
        packet(), packet(base=5, samples=3), packet(samples=0), packet(spoil=True), b"\x7c", b"\x1e\x7c", packet(payload=b"\x7c\x1e\x08\x00" * 9),
        packet(payload=b"short"), packet(samples=2, declared=3), packet(extra=b"\x7c\x1e"), packet(micros=2 ** 63)]),
        st.integers(0, 90).map(lambda n: b"\x7c\x1e" + struct.pack("<H", n)))
    sensors = data.draw(st.integers(1, 4))
    left, held = [b""] * sensors, [b""] * sensors
    for _ in range(2):
        messages, begins, want = [], [], []
        for s in range(sensors):
            stream = b"".join(data.draw(st.lists(piece, max_size=12)))
            cuts = sorted(data.draw(st.lists(st.integers(0, len(stream)), max_size=5)))
            begins.append(len(messages))
            messages += [stream[lo:hi] for lo, hi in zip([0, *cuts], [*cuts, len(stream)])]
            for m in range(begins[-1], len(messages)):
                found, held[s] = feed(held[s], messages[m], limit)
                want += [(m, n, *frame) for n, frame in enumerate(found)]
        got, left = feed_all(left, messages, begins, limit)
        assert sorted(got, key=lambda f: f[:2]) == want and left == held


def random_messages(n, seed):
    """A byte stream of good and faulty packets for a hot sensor and a few others, cut anywhere."""
    rng, out, seq = random.Random(seed), [], 0
    for sensor, share in (("hot", n), ("a", n // 8), ("b", 3)):
        stream = b"".join(rng.choice([
            packet(base=i, micros=i), packet(base=i, samples=2), packet(base=i, spoil=True), b"\x7c\x1e\x40\x00", b"noise"])
            for i in range(share))
        at = 0
        while at < len(stream):
            step = rng.randrange(1, 60)
            out.append((sensor, stream[at:at + step]))
            at += step
    return [(i, s, b) for i, (s, b) in enumerate(out)]


@pytest.mark.parametrize("rows", [1, 4, 25, 10_000])
def test_chunks_of_a_hot_sensor(spark, rows):
    data = random_messages(60, 3)
    buffers, want = {}, []
    for seq, sensor, payload in data:
        found, buffers[sensor] = feed(buffers.get(sensor, b""), payload)
        want += [(sensor, seq, n, f[0], f[1]) for n, f in enumerate(found)]
    df = spark.createDataFrame(data, "seq long, sensor_id string, payload binary").repartition(5)
    got = frames(df, "seq", rows=rows).select("sensor_id", "arrival", "frame_no", "status", "base_sample_number")
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)


def test_decoding_and_scales(spark):
    df = spark.createDataFrame([(1, "a", packet(base=2 ** 32 - 1, micros=500, samples=2)), (2, "a", packet(samples=0))],
                               "seq long, sensor_id string, payload binary")
    full, empty = packets.packets(frames(df, "seq")).orderBy("arrival").collect()
    assert list(empty.samples) == [] and empty.num_samples_in_packet == 0
    first, second = full.samples
    assert first.acc.x == 1 * (0.488 / 1000) and first.acc.y == -2 * (0.488 / 1000)
    assert first.gyro.y == -5 * 0.14 and first.mag.y == -8 * (1.0 / 1711.0) and first.temp_raw == -10
    assert (first.sample_index, second.sample_index) == (2 ** 32 - 1, 0)
    assert (first.header_timestamp_us, second.header_timestamp_us) == (500, 5500)
    assert second.acc.x == 2 * (0.488 / 1000)
    assert {r.status: r.frames for r in packets.status_counts(frames(df, "seq")).collect()} == {"ok": 1, "no_samples": 1}


def test_sums_of_many_values_are_those_of_each():
    from stridelake.functions.crc import BLOCK, crc16, crc16_of_all
    rng = np.random.default_rng(3)
    values = [rng.bytes(n) for n in [0, 0, 1, 2, 3, 17, 17, 40, 80, 81, BLOCK - 1, BLOCK, BLOCK + 1, 3 * BLOCK, *rng.integers(0, 300, 200)]]
    assert crc16_of_all(values).tolist() == [crc16(v) for v in values] and len(crc16_of_all([])) == 0


def test_bytes_become_ten_values_a_sample():
    whole = struct.pack(">6h", 1, -2, 3, 4, -5, 6) + struct.pack("<3h", 7, -8, 9) + struct.pack(">h", -10)
    given = pa.array([b"skipped", whole * 2, None, b"", whole], pa.binary()).slice(1)
    values = [1, -2, 3, 4, -5, 6, 7, -8, 9, -10]
    found = [made.to_pylist() for made in packets.raw_values.func(iter([given, given.slice(1, 1), given.slice(0, 0)]))]
    assert found == [[values * 2, None, [], values], [None], []]


def test_a_packet_without_samples_does_not_need_the_values_of_one(spark):
    """k up to 19 has no samples, 60 and 61 have a payload too short for any number."""
    events = [(1, "a", 5, float("nan"), 12), (2 ** 60, "b", 5, 1.0, 60), (3, "c", 5, None, 45), (4, "d", None, 1.0, 45), (5, "e", 5, 1.0, None)]
    readings = spark.createDataFrame(events, "seq long, sensor_id string, kafka_timestamp long, predicted_velocity double, k int")
    made = derive.packets_of(readings.withColumn("event_type", F.lit("x")))
    assert made.count() == 10 and made.filter("payload is null").count() == 4
    found = frames(made.filter("sensor_id is not null"), "arrival")
    assert {r.sensor_id: r.status for r in found.collect()} == {"a": "no_samples", "b": "short_payload", "c": "short_samples"}
