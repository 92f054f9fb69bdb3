"""Buffers and totals per sensor that a timer empties, whatever triggers the input comes in.

Each operator is one stateful processor, keyed by the sensor for buffered messages and by a key that sensors share
(`shared`) for scores and totals. A buffer is a list state of Arrow chunks, one per trigger; what a task holds is the
rows of a key since the last flush. Timers run in processing time; batches by time may also run in event time, where
they do not depend on when the job runs. Every operator hands on each row once, or once per flush what is asked for.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from stridelake.operators.scoring import SCORE_FIELDS, Scorer, score_runs, with_masked_velocity
from stridelake.settings import (
    AGGREGATION_INTERVAL_MS, BATCH_SIZE, FLUSH_INTERVAL_MS, FLUSH_LAST_MESSAGES, INFERENCE_FLUSH_MS, SAMPLING_PERIOD_S,
)
from stridelake.streaming.keyed import _in_order
from stridelake.streaming.shared import (
    SENSOR, SHARED, by_sensor, edges, kept, known, restored, to_bytes, to_table, with_shared_key,
)

CHUNKS = "rows binary"
TOTALS = pa.schema([
    ("sensor", pa.string()), ("sensor_session_id", pa.string()), ("top", pa.float64()), ("path", pa.float64()),
    ("arrival", pa.int64()), ("changed", pa.bool_()), ("due", pa.int64())])
TOTAL_ROWS = "sensor_id string, sensor_session_id string, session_max_velocity double, session_total_distance double, " \
    "aggregation_timestamp_ms long"
WAITING = pa.schema([("sensor", pa.string())])
MODELS = pa.schema([("sensor", pa.string()), ("model", pa.binary())])
# State on disk, for sessions that were built without it.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.session.timeZone": "UTC"}


def state_session(spark: SparkSession) -> SparkSession:
    """A session of the same application with settings of its own, so those of the caller stay as they are."""
    own = spark.newSession()
    for name, value in STATE_SETTINGS.items():
        own.conf.set(name, value)
    own.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    return own


def packed(rows: pd.DataFrame) -> bytes:
    table = pa.Table.from_pandas(rows, preserve_index=False)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def unpacked(chunks: Iterator[tuple]) -> pd.DataFrame | None:
    """The rows of all chunks, in the order they came in; None if there are none."""
    held = [pa.ipc.open_stream(bytes(c[0])).read_all() for c in chunks]
    return pa.concat_tables(held, promote_options="permissive").to_pandas() if held else None


class Flushed(StatefulProcessor):
    """A buffer of rows per key, and timers that say when to look at it."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.buffer = handle.getListState("buffer", CHUNKS)

    def keep(self, rows: pd.DataFrame) -> None:
        self.buffer.appendValue((packed(rows),))

    def held(self) -> pd.DataFrame | None:
        return unpacked(self.buffer.get())

    def close(self) -> None:
        pass


class ScoreOnTimer(Flushed):
    """Every trigger with rows of a sensor sets a timer; any timer gives the sensor's whole buffer to the model as one sequence."""

    def __init__(self, names: list[str], order: list[str], make_scorer: Callable[[], Scorer], flush_ms: int, ts: str | None):
        self.names, self.order, self.make_scorer, self.flush_ms, self.ts = names, order, make_scorer, flush_ms, ts

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.timers = handle.getMapState("timers", "due long", CHUNKS)
        self.models = handle.getValueState("models", CHUNKS)
        self.scorer = self.make_scorer()

    def handleInputRows(self, key, rows, timerValues):
        came = pd.concat(list(rows), ignore_index=True).drop(columns=SHARED, errors="ignore")
        place, _, sensors = by_sensor(restored(came), self.order, self.ts)
        self.keep(came.take(place).reset_index(drop=True))
        due = timerValues.getCurrentProcessingTimeInMs() + self.flush_ms
        self.timers.updateValue((due,), (to_bytes(pa.table([list({*sensors, *self.waiting(due)})], schema=WAITING)),))
        self.handle.registerTimer(due)
        return iter(())

    def waiting(self, due: int) -> list[str | None]:
        """The sensors that have a timer then."""
        at = (due,)
        return to_table(self.timers.getValue(at)[0], WAITING).column(0).to_pylist() if self.timers.containsKey(at) else []

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        due, rows = expiredTimerInfo.getExpiryTimeInMs(), self.held()
        sensors = self.waiting(due)
        self.timers.removeKey((due,))
        if rows is None:
            return
        mine = rows[SENSOR].isin(sensors).to_numpy()
        if not mine.any():
            return
        self.buffer.clear()
        if not mine.all():
            self.keep(rows[~mine])
        rows = restored(rows[mine].reset_index(drop=True))
        place, numbers, sensors = by_sensor(rows, [])
        rows = rows.take(place).reset_index(drop=True)
        cuts = edges(numbers).tolist()
        (before,), others = known(self.models.get()[0] if self.models.exists() else None, sensors, MODELS)
        velocity, movement, scored, ends = score_runs(self.scorer, rows, list(zip(cuts, [*cuts[1:], len(rows)], before)))
        if any(e is not None for e in ends):
            self.models.update((kept(others, sensors, [ends]),))
        yield rows[self.names].assign(_velocity=velocity, _movement=movement, _scored=scored)


def scores_on_timer(samples: DataFrame, order: Sequence[str], make_scorer: Callable[[], Scorer],
                    flush_ms: int = INFERENCE_FLUSH_MS, key: str = "sensor_id", ts: str | None = None) -> DataFrame:
    """Samples with predicted_velocity. A sensor's samples wait, and are scored as one sequence when a timer is due.

    The model's state goes on from flush to flush. If a model returns another number of values than it was given, the
    velocities of that flush stay null and the state still moves on. Order is that of arrival, within a trigger by `order`.
    Sensors share a key (`shared`), but each has timers and a sequence of its own.
    """
    inputs = samples.drop("predicted_velocity")
    schema = T.StructType([*inputs.schema.fields, *SCORE_FIELDS])
    found = with_shared_key(inputs, key).groupBy(SHARED).transformWithStateInPandas(
        ScoreOnTimer(inputs.columns, list(order), make_scorer, flush_ms, ts), schema, "append", "processingTime")
    return with_masked_velocity(found)


class TotalsOnTimer(StatefulProcessor):
    """Totals of sessions of the sensors of a key; a sensor's timer sends those that changed and forgets sessions that are over."""

    def __init__(self, interval_ms: int, period_s: float):
        self.interval_ms, self.period_s = interval_ms, period_s

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.sessions = handle.getValueState("sessions", CHUNKS)

    def held(self) -> pa.Table:
        """A row per session, a sensor's in the order they began; `due` is the sensor's timer, 0 if it has none."""
        return to_table(self.sessions.get()[0] if self.sessions.exists() else None, TOTALS)

    def keep(self, others: pa.Table, mine: pd.DataFrame) -> None:
        """Sensors that nothing came for stay as they are, in Arrow."""
        rows = pa.Table.from_pandas(mine, TOTALS, preserve_index=False, nthreads=1)
        self.sessions.update((to_bytes(pa.concat_tables([others.replace_schema_metadata(), rows.replace_schema_metadata()])),))

    def handleInputRows(self, key, rows, timerValues):
        came = pd.concat(list(rows), ignore_index=True)
        speed = came["velocity"].to_numpy(float, na_value=np.nan)
        new = totals_of_rows(came[SENSOR], came["sensor_session_id"], np.fmax(speed, float("-inf")), np.abs(speed), came["arrival"],
                             np.argsort(came["sensor_session_id"].to_numpy(str), kind="stable"))
        state, due = self.held(), timerValues.getCurrentProcessingTimeInMs() + self.interval_ms
        mine = pc.is_in(state["sensor"], value_set=pa.array(new["sensor"].unique(), pa.string(), from_pandas=True))
        held = state.filter(mine).to_pandas()
        both = pd.concat([held[new.columns], new], ignore_index=True) if len(held) else new
        found = totals_of_rows(*[both[c] for c in new.columns], np.arange(len(both)))
        sensors, _ = pd.factorize(pd.concat([held["sensor"], new["sensor"], found["sensor"]], ignore_index=True), use_na_sentinel=False)
        of_held, of_new, of_found = np.split(sensors, [len(held), len(both)])
        timers = np.zeros(sensors.max() + 1, np.int64)
        timers[of_held] = held["due"].to_numpy(np.int64)
        starts_timer = (timers[of_new] == 0).any()
        timers[of_new] = np.where(timers[of_new] == 0, due, timers[of_new])
        changed = np.zeros(len(found), bool)
        changed[:len(held)] = held["changed"].to_numpy(bool)  # sessions keep their places, new ones follow
        changed[np.unique(both.groupby(["sensor", "sensor_session_id"], dropna=False, sort=False).ngroup().to_numpy()[len(held):])] = True
        self.keep(state.filter(pc.invert(mine)), found.assign(changed=changed, due=timers[of_found]))
        if starts_timer:
            self.handle.registerTimer(due)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        state = self.held()
        mine = pc.equal(state["due"], expiredTimerInfo.getExpiryTimeInMs())
        held = state.filter(mine).to_pandas()
        if not len(held):
            return
        sent = held[held["changed"].to_numpy(bool)]
        # All sessions of a sensor before its newest are over.
        newest = held.sort_values("arrival", ascending=False, kind="stable").drop_duplicates("sensor").assign(changed=False, due=0)
        self.keep(state.filter(pc.invert(mine)), newest)
        yield pd.DataFrame({
            "sensor_id": sent["sensor"].to_numpy(), "sensor_session_id": sent["sensor_session_id"].to_numpy(),
            "session_max_velocity": sent["top"].to_numpy(), "session_total_distance": sent["path"].to_numpy() * self.period_s,
            "aggregation_timestamp_ms": np.full(len(sent), int(timerValues.getCurrentProcessingTimeInMs()))})

    def close(self) -> None:
        pass


def totals_of_rows(sensor: pd.Series, session: pd.Series, top, path, arrival, place: np.ndarray) -> pd.DataFrame:
    """Highest velocity, path and newest arrival of every session, in the order in which `place` has their first rows."""
    rows = pd.DataFrame({"sensor": sensor, "sensor_session_id": session, "top": top, "path": path, "arrival": arrival}).take(place)
    number = rows.groupby(["sensor", "sensor_session_id"], dropna=False, sort=False).ngroup().to_numpy()
    together = np.argsort(number, kind="stable")
    lo = edges(number[together])
    rows = rows.take(together)
    return pd.DataFrame({
        "sensor": rows["sensor"].to_numpy()[lo], "sensor_session_id": rows["sensor_session_id"].to_numpy()[lo],
        "top": np.fmax.reduceat(rows["top"].to_numpy(), lo), "path": np.add.reduceat(rows["path"].to_numpy(), lo),
        "arrival": np.maximum.reduceat(rows["arrival"].to_numpy(np.int64), lo)})


def totals_on_timer(sessions: DataFrame, arrival: str, interval_ms: int = AGGREGATION_INTERVAL_MS,
                    velocity: str = "predicted_velocity", key: str = "sensor_id", period_s: float = SAMPLING_PERIOD_S) -> DataFrame:
    """Totals so far of every session that got velocities, one interval after the first of them came.

    A session without new velocities sends nothing and has no timer. Rows without a session or a velocity do not count.
    The state has the open session of a sensor, and sessions that ended since the last flush. Sensors share a key (`shared`),
    but each has a timer of its own.
    """
    rows = sessions.filter(F.col(velocity).isNotNull() & (F.col("sensor_session_id") != "")).select(
        F.col(key).alias("sensor_id"), "sensor_session_id", F.col(velocity).alias("velocity"),
        F.coalesce(F.col(arrival).cast("long"), F.lit(np.iinfo(np.int64).min)).alias("arrival"))
    found = with_shared_key(rows, "sensor_id").drop("sensor_id").groupBy(SHARED).transformWithStateInPandas(
        TotalsOnTimer(interval_ms, period_s), TOTAL_ROWS, "append", "processingTime")
    return found.select("sensor_session_id", "sensor_id", "session_max_velocity",
                        F.coalesce("session_total_distance", F.lit(float("nan"))).alias("session_total_distance"),
                        "aggregation_timestamp_ms")


class BatchBuffer(Flushed):
    """Messages wait until there are `size` of them, or until a timer sends the last ones."""

    def __init__(self, names: list[str], order: list[str], size: int | None, interval_ms: int | None, last: int,
                 event_ms: str | None):
        self.names, self.order, self.size, self.interval_ms, self.last, self.event_ms = names, order, size, interval_ms, last, event_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.sent = handle.getValueState("sent", "batches long")

    def handleInputRows(self, key, rows, timerValues):
        came = _in_order(rows, self.order)
        if self.interval_ms:
            now = came[self.event_ms].to_numpy(np.int64) if self.event_ms else timerValues.getCurrentProcessingTimeInMs()
            came = came.assign(_due=(now // self.interval_ms + 1) * self.interval_ms)
            for due in np.unique(came["_due"]).tolist():
                self.handle.registerTimer(due)
        if self.size is None:  # only the last messages of an interval are ever sent
            came = came.groupby("_due", sort=False).tail(self.last).reset_index(drop=True)
            self.keep(came)
            return
        sent = self.sent.get()[0] if self.sent.exists() else 0
        before = self.held()
        waiting = came if before is None else pd.concat([before, came], ignore_index=True)
        full = len(waiting) // self.size * self.size
        self.buffer.clear()
        if full < len(waiting):
            self.keep(waiting.iloc[full:].reset_index(drop=True))
        if full:
            self.sent.update((sent + full // self.size,))
            ready = waiting.iloc[:full][self.names]
            yield ready.assign(batch_no=sent + np.arange(full) // self.size, flushed_by="size")

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        due = expiredTimerInfo.getExpiryTimeInMs()
        waiting = self.held()
        if waiting is None:
            return
        ready = waiting[waiting["_due"] <= due]
        rest = waiting[waiting["_due"] > due].reset_index(drop=True)
        self.buffer.clear()
        if len(rest):
            self.keep(rest)
        if len(ready):
            yield ready.tail(self.last)[self.names].assign(batch_no=due // self.interval_ms - 1, flushed_by="time")


def buffered_batches(messages: DataFrame, order: Sequence[str], size: int | None = BATCH_SIZE,
                     interval_ms: int | None = FLUSH_INTERVAL_MS, last: int = FLUSH_LAST_MESSAGES, key: str = "sensor_id",
                     event_ms: str | None = None) -> DataFrame:
    """Messages as they leave the buffer, with the number of their batch and what sent it.

    A buffer of `size` messages goes out whole; every interval, the last messages in the buffer go out and the others are
    dropped from it, as a live display wants. With `event_ms`, a column of milliseconds and a watermark, intervals are
    those of that time, and rows behind the watermark are left out by Spark (see `late`). Batches by size are counted from 0, those by time are numbered by their interval. All rows of a
    batch leave in one trigger.
    """
    if size is None and not interval_ms:
        raise ValueError("give a size or an interval")
    inputs = messages
    schema = T.StructType([*inputs.schema.fields, T.StructField("batch_no", T.LongType()), T.StructField("flushed_by", T.StringType())])
    return inputs.groupBy(key).transformWithStateInPandas(
        BatchBuffer(inputs.columns, list(order), size, interval_ms, last, event_ms), schema, "append",
        "eventTime" if event_ms else "processingTime")


def run_until_flushed(query: StreamingQuery, poll_s: float = 0.1) -> None:
    """Wait until a query over what is available now has read its input and no timer waits, and stop it.

    With timers in processing time, Spark goes on with triggers without data for as long as the query lives.
    """
    waiting: dict[int, int] = {}
    while query.isActive:
        for progress in query.recentProgress:
            metrics = [o.get("customMetrics", {}) for o in progress["stateOperators"]]
            waiting[progress["batchId"]] = sum(
                m.get("numRegisteredTimers", 0) - m.get("numExpiredTimers", 0) - m.get("numDeletedTimers", 0) for m in metrics)
        last = query.lastProgress
        if last and not last["numInputRows"] and not sum(waiting.values()):
            break
        time.sleep(poll_s)
    query.stop()
    if query.exception():
        raise query.exception()
