"""Binary sensor packets: reassembly per sensor, framing, checks, decoding and scaling."""

from __future__ import annotations

import struct
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from stridelake.functions.crc import crc16, crc16_of_all
from stridelake.operators.ordered_state import fold_in_order
from stridelake.schemas import PACKET_SAMPLE
from stridelake.settings import (
    ACC_SCALE, CHUNK_ROWS, GYRO_SCALE, MAG_SCALE, MAX_BUFFER_BYTES, PACKET_COMMAND, PACKET_CRC_BYTES,
    PACKET_DATA_TYPE, PACKET_HEADER_BYTES, PACKET_PAYLOAD_HEAD_BYTES, PACKET_SAMPLE_BYTES, SAMPLE_STEP_US,
)

SYNC = bytes([PACKET_COMMAND, PACKET_DATA_TYPE])
FRAME_BYTES = PACKET_HEADER_BYTES + PACKET_CRC_BYTES
# A buffer that was scanned is shorter than the longest frame.
LONGEST_FRAME = FRAME_BYTES + 0xFFFF
BAD_CRC = ("bad_crc", None, None, None, None)
# Frames of a stream whose sums are looked up together at first, as if all were right.
FRAMES_AHEAD = 64
KEPT_STATUSES = ("ok", "no_samples", "extra_bytes")
# Fixed value: the fields of one sample and their byte order.
SAMPLE_LAYOUT = np.dtype([("acc", ">i2", 3), ("gyro", ">i2", 3), ("mag", "<i2", 3), ("temp", ">i2")])

FRAMES = T.StructType([
    T.StructField("sensor_id", T.StringType()),
    T.StructField("arrival", T.LongType()),
    T.StructField("frame_no", T.IntegerType()),
    T.StructField("status", T.StringType()),
    T.StructField("base_sample_number", T.LongType()),
    T.StructField("header_timestamp_us", T.LongType()),
    T.StructField("num_samples_in_packet", T.IntegerType()),
    T.StructField("body", T.BinaryType()),
])


def read_payload(payload: bytes) -> tuple:
    """(status, base sample, time, samples declared, sample bytes) of a payload whose sum is right."""
    if len(payload) < PACKET_PAYLOAD_HEAD_BYTES:
        return "short_payload", None, None, None, None
    base, micros, declared = struct.unpack_from("<IQH", payload)
    need, have = declared * PACKET_SAMPLE_BYTES, len(payload) - PACKET_PAYLOAD_HEAD_BYTES
    if micros >= 2 ** 63:
        return "time_out_of_range", base, None, declared, None
    if declared == 0:
        return "no_samples", base, micros, declared, b""
    if have < need:
        return "short_samples", base, micros, declared, None
    body = payload[PACKET_PAYLOAD_HEAD_BYTES:PACKET_PAYLOAD_HEAD_BYTES + need]
    return ("extra_bytes" if have > need else "ok"), base, micros, declared, body


def scan_frames(buffer: bytes) -> tuple[list[tuple], int]:
    """All frames in a buffer and the number of bytes done with.

    A frame that is not complete yet stops the scan; one with a wrong sum moves it on by one byte.
    """
    found, at, size = [], 0, len(buffer)
    while True:
        sync = buffer.find(SYNC, at)
        if sync < 0 or sync > size - FRAME_BYTES:
            return found, max(at, size - FRAME_BYTES + 1, 0)
        length = int.from_bytes(buffer[sync + 2:sync + 4], "little")
        end = sync + FRAME_BYTES + length
        if end > size:
            return found, sync
        frame = buffer[sync:end]
        if crc16(frame[:-PACKET_CRC_BYTES]) != int.from_bytes(frame[-PACKET_CRC_BYTES:], "little"):
            found.append(BAD_CRC)
            at = sync + 1
            continue
        found.append(read_payload(frame[PACKET_HEADER_BYTES:-PACKET_CRC_BYTES]))
        at = end


def feed(buffer: bytes, message: bytes, limit: int = MAX_BUFFER_BYTES) -> tuple[list[tuple], bytes]:
    """Add one message to a sensor's buffer; a message that would overfill it empties it and is lost."""
    if len(buffer) + len(message) > limit:
        return [], b""
    buffer += message
    found, done = scan_frames(buffer)
    return found, buffer[done:]


def scan_streams(streams: Sequence[bytes]) -> tuple[list[list[tuple]], list[list[int]], list[int]]:
    """`scan_frames` of many buffers, with the sums of all looked up together: frames, where each ends, and the bytes done with.

    A buffer is followed as if the sums were right, for as many frames as it has had in a row; behind a wrong one it is
    followed anew, and sums that were looked up stay known.
    """
    data = b"".join(streams)
    sizes = np.array([len(s) for s in streams], np.int64)
    tops = np.cumsum(sizes)
    content = np.frombuffer(data, np.uint8)
    sync = np.flatnonzero((content[:-1] == SYNC[0]) & (content[1:] == SYNC[1]))
    top = tops[np.searchsorted(tops, sync, side="right")]
    sync, top = sync[sync <= top - FRAME_BYTES], top[sync <= top - FRAME_BYTES]
    ends = sync + FRAME_BYTES + content[sync + 2] + (content[sync + 3].astype(np.int64) << 8)
    follows, places, past = np.searchsorted(sync, ends).tolist(), np.searchsorted(sync, tops - sizes).tolist(), np.searchsorted(sync, tops).tolist()
    whole, right, sync, ends = (ends <= top).tolist(), [None] * len(sync), sync.tolist(), ends.tolist()
    taken, ahead, left = [[] for _ in streams], [FRAMES_AHEAD] * len(streams), range(len(streams))
    while left:
        paths = []
        for s in left:
            i, path = places[s], []
            while i < past[s] and whole[i] and len(path) < ahead[s]:
                path.append(i)
                i = follows[i]
            if path:
                paths.append((s, path))
        unknown = [i for _, path in paths for i in path if right[i] is None]
        sums = crc16_of_all([data[sync[i]:ends[i] - PACKET_CRC_BYTES] for i in unknown])
        for i, found in zip(unknown, sums.tolist()):
            right[i] = found == int.from_bytes(data[ends[i] - PACKET_CRC_BYTES:ends[i]], "little")
        for s, path in paths:
            wrong = next((n for n, i in enumerate(path) if not right[i]), None)
            taken[s] += path if wrong is None else path[:wrong + 1]
            places[s] = follows[path[-1]] if wrong is None else path[wrong] + 1
            ahead[s] = 2 * (len(path) if wrong is None else wrong + 1)
        left = [s for s, _ in paths]
    frames, stops, done = [], [], []
    for s, (size, low) in enumerate(zip(sizes.tolist(), (tops - sizes).tolist())):
        mine, i = taken[s], places[s]
        frames.append([read_payload(data[sync[f] + PACKET_HEADER_BYTES:ends[f] - PACKET_CRC_BYTES]) if right[f] else BAD_CRC for f in mine])
        stops.append([ends[f] - low for f in mine])
        at = 0 if not mine else (ends[mine[-1]] if right[mine[-1]] else sync[mine[-1]] + 1) - low
        done.append(sync[i] - low if i < past[s] else max(at, size - FRAME_BYTES + 1, 0))
    return frames, stops, done


def feed_all(
    buffers: list[bytes], messages: Sequence[bytes], begins: Sequence[int], limit: int = MAX_BUFFER_BYTES,
) -> tuple[list[tuple], list[bytes]]:
    """`feed` for every message of many sensors: (message, frame number, *frame) of all frames, and the buffers left.

    A sensor's messages lie together in order, from `begins` on. They are scanned as one stream, and a frame belongs to the
    message that ends it; only a sensor that could overfill its buffer is fed message by message.
    """
    made, rest = [], [b""] * len(buffers)
    sizes = np.array([len(m) for m in messages], np.int64)
    together, parts = [], [*zip(begins, [*begins[1:], len(messages)])]
    for sensor, (lo, hi) in enumerate(parts):
        total = len(buffers[sensor]) + int(sizes[lo:hi].sum())
        if min(total, LONGEST_FRAME + int(sizes[lo:hi].max())) <= limit:
            together.append(sensor)
            continue
        buffer = buffers[sensor]
        for m in range(lo, hi):
            found, buffer = feed(buffer, messages[m], limit)
            made += [(m, n, *frame) for n, frame in enumerate(found)]
        rest[sensor] = buffer
    streams = [b"".join([buffers[s], *messages[slice(*parts[s])]]) for s in together]
    for sensor, stream, found, stops, done in zip(together, streams, *scan_streams(streams)):
        lo, hi = parts[sensor]
        reached = len(buffers[sensor]) + np.cumsum(sizes[lo:hi])
        # What a wrong frame held is only looked at when that frame has ended.
        of = lo + np.searchsorted(reached, np.maximum.accumulate(np.array(stops, np.int64)))
        number = np.arange(len(of)) - np.searchsorted(of, of)
        made += [(m, n, *frame) for m, n, frame in zip(of.tolist(), number.tolist(), found)]
        rest[sensor] = stream[done:]
    return made, rest


def _framing(limit: int):
    def step(rows: pd.DataFrame, runs):
        frames, ends = [], []
        sensors, arrivals, payloads = rows["sensor_id"].values, rows["arrival"].values, rows["payload"].values
        for lo, hi, start in runs:
            buffer = start or b""
            for i in range(lo, hi):
                if payloads[i] is None:
                    continue
                found, buffer = feed(buffer, bytes(payloads[i]), limit)
                frames += [(sensors[i], arrivals[i], n, *frame) for n, frame in enumerate(found)]
            ends.append(buffer)
        return frame_rows(frames), ends
    return step


def frame_rows(frames: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(frames, columns=FRAMES.names)
    return out.astype({"base_sample_number": "Int64", "header_timestamp_us": "Int64", "num_samples_in_packet": "Int32"})


def frames(
    messages: DataFrame, arrival: str, limit: int = MAX_BUFFER_BYTES, rows: int = CHUNK_ROWS,
) -> DataFrame:
    """All frames of every sensor's byte stream, from rows of sensor_id, arrival number and payload."""
    ordered = messages.select("sensor_id", F.col(arrival).cast("long").alias("arrival"), "payload")
    return fold_in_order(ordered, "sensor_id", ["arrival"], lambda: _framing(limit), FRAMES, rows)


@F.arrow_udf(T.ArrayType(T.ShortType()))
def raw_values(body: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Ten numbers per sample: acc, gyro and mag axes, and the temperature."""
    for batch in body:
        sizes = pc.fill_null(pc.binary_length(batch), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        samples = np.frombuffer(b"".join(batch.drop_null().to_pylist()), dtype=SAMPLE_LAYOUT)
        parts = [samples["acc"], samples["gyro"], samples["mag"], samples["temp"][:, None]]
        numbers = np.concatenate([p.astype(np.int16) for p in parts], axis=1).ravel()
        offsets = np.concatenate([[0], np.cumsum(sizes // SAMPLE_LAYOUT.itemsize * 10)])
        yield pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(numbers), mask=batch.is_null())


def _vector(raw: Column, at: Column, factor: float) -> Column:
    return F.struct(*[
        (F.get(raw, at + i) * F.lit(factor)).alias(axis) for i, axis in enumerate(("x", "y", "z"))])


def readable(found: DataFrame) -> DataFrame:
    return found.filter(F.col("status").isin(*KEPT_STATUSES))


def packets(found: DataFrame, *keep: str) -> DataFrame:
    """Packets with scaled samples, from the frames that can be read; `keep` names more columns of the frames."""
    raw = F.col("_raw")

    def sample(j: Column) -> Column:
        at = j * 10
        return F.struct(
            F.pmod(F.col("base_sample_number") + j, F.lit(2 ** 32)).alias("sample_index"),
            _vector(raw, at, ACC_SCALE).alias("acc"),
            _vector(raw, at + 3, GYRO_SCALE).alias("gyro"),
            _vector(raw, at + 6, MAG_SCALE).alias("mag"),
            F.get(raw, at + 9).alias("temp_raw"),
            (F.col("header_timestamp_us") + j * SAMPLE_STEP_US).alias("header_timestamp_us"))

    places = F.when(F.col("num_samples_in_packet") > 0, F.sequence(F.lit(0), F.col("num_samples_in_packet") - 1))
    samples = F.coalesce(F.transform(places, sample), F.array().cast(T.ArrayType(PACKET_SAMPLE)))
    return (
        readable(found)
        .withColumn("_raw", raw_values("body"))
        .select("sensor_id", "arrival", "frame_no", "header_timestamp_us", "base_sample_number",
                "num_samples_in_packet", samples.cast(T.ArrayType(PACKET_SAMPLE)).alias("samples"), *keep)
    )


def status_counts(found: DataFrame) -> DataFrame:
    return found.groupBy("status").agg(F.count(F.lit(1)).alias("frames"))
