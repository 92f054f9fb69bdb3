"""Binary packets on a stream: a byte buffer per sensor that other keyed operators can follow in the same query."""

from __future__ import annotations

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from stridelake.operators.packets import FRAMES, feed_all, frame_rows, packets, readable
from stridelake.settings import MAX_BUFFER_BYTES, SESSION_GAP_US
from stridelake.streaming.keyed import sessions_and_scores
from stridelake.streaming.shared import SHARED, by_sensor, edges, kept, known, restored, with_shared_key

BUFFERS = pa.schema([("sensor", pa.string()), ("bytes", pa.binary())])


class FrameBuffer(StatefulProcessor):
    """Bytes of the sensors of a key that do not make a whole frame yet wait for the next trigger."""

    def __init__(self, limit: int):
        self.limit = limit

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.buffers = handle.getValueState("buffers", "bytes binary")

    def handleInputRows(self, key, rows, timerValues):
        came = restored(pd.concat(list(rows), ignore_index=True))
        place, numbers, sensors = by_sensor(came, ["arrival"])
        arrivals, payloads = came["arrival"].take(place).tolist(), came["payload"].take(place)
        (held,), others = known(self.buffers.get()[0] if self.buffers.exists() else None, sensors, BUFFERS)
        begins = edges(numbers).tolist()
        of = numbers[begins].tolist()
        found, left = feed_all([held[s] or b"" for s in of], [bytes(p) for p in payloads], begins, self.limit)
        waiting = [(sensors[s], rest) for s, rest in zip(of, left) if rest]
        self.buffers.update((kept(others, [s for s, _ in waiting], [[rest for _, rest in waiting]]),))
        if found:
            yield frame_rows([(sensors[numbers[m]], arrivals[m], *frame) for m, *frame in found])

    def close(self) -> None:
        pass


def buffered_frames(messages: DataFrame, arrival: str, limit: int = MAX_BUFFER_BYTES) -> DataFrame:
    """Frames of every sensor's byte stream; null payloads bring nothing. Sensors share a key (`shared`), each with its own buffer."""
    rows = messages.filter(F.col("payload").isNotNull()).select(
        "sensor_id", F.col(arrival).cast("long").alias("arrival"), "payload")
    return with_shared_key(rows, "sensor_id").drop("sensor_id").groupBy(SHARED).transformWithStateInPandas(
        FrameBuffer(limit), FRAMES, "append", "none")


def packet_sessions(messages: DataFrame, arrival: str, gap_us: int = SESSION_GAP_US, limit: int = MAX_BUFFER_BYTES) -> DataFrame:
    """Readable packets with their sessions, in one query: bytes to frames, readable frames to sessions, then to samples.

    Both states have a row per sensor. The session's time is that of the packet, its order that of arrival. Samples are
    read last, so that the state is handed their bytes and not nested rows.
    """
    framed = readable(buffered_frames(messages, arrival, limit))
    found = sessions_and_scores(framed, ["arrival", "frame_no"], gap_us, ts="header_timestamp_us")
    return packets(found, "session_id_part", "sensor_session_id", "is_new_session")
