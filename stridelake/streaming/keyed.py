"""Per-sensor state on streams: sessions, model state and packet buffers.

State travels with the Arrow batches of applyInPandasWithState. Sessions and model state share keys between sensors
(`shared`): a call sees the rows that the sensors of a key have in one trigger, which the source's limit per trigger
bounds, and a small state row of each.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from stridelake.operators.packets import FRAMES, feed, frame_rows
from stridelake.operators.scoring import SCORE_FIELDS, Scorer, score_runs, with_masked_velocity
from stridelake.settings import MAX_BUFFER_BYTES, MOVEMENT_THRESHOLD, SAMPLING_PERIOD_S, SESSION_GAP_US
from stridelake.streaming.shared import SHARED, by_sensor, edges, kept, known, restored, with_shared_key

MOTION_STATE = T.StructType([T.StructField("sensors", T.BinaryType())])
# What the state has of every sensor: time and session start of its last row, the model's state, totals of its open session.
MOTION_SENSORS = pa.schema([
    ("sensor", pa.string()), ("last_us", pa.int64()), ("part", pa.int64()), ("model", pa.binary()), ("top", pa.float64()),
    ("path", pa.float64())])
SAMPLE_ROW, TOTAL_ROW = "sample", "total"
TOTAL_FIELDS = [
    T.StructField("kind", T.StringType()), T.StructField("session_max_velocity", T.DoubleType()),
    T.StructField("session_total_distance", T.DoubleType())]
_EMPTY = {T.LongType: "Int64", T.IntegerType: "Int32", T.DoubleType: "Float64", T.BooleanType: "boolean"}
BUFFER_STATE = T.StructType([T.StructField("buffer", T.BinaryType())])


def _in_order(parts: Iterator[pd.DataFrame], order: Sequence[str], ts: str | None = None) -> pd.DataFrame:
    """The rows in arrival order. Rows of several partitions are merged by time; each keeps its own order."""
    parts = list(parts)
    rows = parts[0] if len(parts) == 1 else pd.concat(parts, ignore_index=True)
    marks = [rows[c].to_numpy() for c in order]
    if any(m.dtype == object for m in marks):
        rows = rows.sort_values(list(order), kind="stable", ignore_index=True)
    else:  # as above, without what sorting a frame costs for a few rows
        place = np.lexsort(marks[::-1])
        if (np.diff(place) < 0).any():
            rows = rows.take(place).reset_index(drop=True)
    if ts and order[0] == "partition" and rows["partition"].nunique() > 1:
        reached = rows.groupby("partition")[ts].cummax().groupby(rows["partition"]).ffill()
        rows = rows.loc[reached.sort_values(kind="stable", na_position="first").index].reset_index(drop=True)
    return rows


def with_columns(rows: pd.DataFrame, new: dict) -> pd.DataFrame:
    """The rows with more columns, added together."""
    return pd.concat([rows, pd.DataFrame(new, index=rows.index)], axis=1)


def session_starts(
    times: np.ndarray, sensors: np.ndarray, last: list[int | None], part: list[int | None], gap_us: int,
) -> tuple[np.ndarray, np.ndarray]:
    """Session start and opening flag of every time. Times of a sensor lie together; `last` and `part` are by sensor."""
    if not len(times):
        return times, np.zeros(0, bool)
    heads = edges(sensors)
    new = np.array([t is None for t in last])[sensors[heads]]
    before = np.concatenate([times[:1], times[:-1]])
    before[heads] = np.where(new, times[heads], np.array([t or 0 for t in last], np.int64)[sensors[heads]])
    opens = times - before > gap_us
    opens[heads] |= new
    starts = np.where(opens, times, np.array([-1 if t is None else t for t in part], np.int64)[sensors])
    known_from = opens.copy()
    known_from[heads] = True
    return starts[np.maximum.accumulate(np.where(known_from, np.arange(len(times)), 0))], opens


def masked(velocity: np.ndarray, movement: np.ndarray) -> np.ndarray:
    """0 where the movement is not probable enough; as the column form does, a NaN there keeps the velocity."""
    return np.where(movement < MOVEMENT_THRESHOLD, 0.0, velocity)


def session_parts(
    velocity: np.ndarray, starts: np.ndarray, sensors: np.ndarray, part: list, top: list, path: list,
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sensor, start, highest velocity and path so far of every session that has velocities here, in order.

    `part`, `top` and `path` are, by sensor, the session that was open before and its totals.
    """
    if not len(velocity):
        return sensors, starts, velocity, velocity
    lo = edges(sensors, starts)
    owner, begun = sensors[lo], starts[lo]
    goes_on = np.r_[True, owner[1:] != owner[:-1]]  # only a sensor's first session can have been open
    goes_on &= np.array([t is not None for t in top])[owner] & (np.array([-1 if p is None else p for p in part], np.int64)[owner] == begun)
    high = np.where(goes_on, np.array([-np.inf if t is None else t for t in top])[owner], -np.inf)
    far = np.where(goes_on, np.array([0.0 if p is None else p for p in path])[owner], 0.0)
    return owner, begun, np.fmax(high, np.fmax.reduceat(velocity, lo)), far + np.add.reduceat(np.abs(velocity), lo)


def sessions_and_scores(
    samples: DataFrame, order: Sequence[str], gap_us: int = SESSION_GAP_US,
    make_scorer: Callable[[], Scorer] | None = None, key: str = "sensor_id", ts: str = "kafka_timestamp",
    totals: bool = False, period_s: float = SAMPLING_PERIOD_S,
) -> DataFrame:
    """Add session columns, and predicted_velocity if there is a scorer, with one shuffle for both.

    Rows are samples; a record without samples may be one row with a null `pos`, which takes part in
    the sessions but is not scored. With `totals`, the state also holds the totals of a sensor's open
    session, and rows of kind "total" follow the samples: every session that got velocities in this
    trigger, with its totals so far.
    """
    inputs = samples.drop("predicted_velocity") if make_scorer else samples
    names = inputs.columns
    added = [T.StructField("session_id_part", T.LongType()), T.StructField("sensor_session_id", T.StringType()),
             T.StructField("is_new_session", T.BooleanType())]
    if make_scorer:
        added += SCORE_FIELDS
    if totals:
        added += TOTAL_FIELDS
    schema = T.StructType([*inputs.schema.fields, *added])

    def on_some(number: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = restored(pd.concat(list(parts), ignore_index=True))
        place, sensors, sensor_names = by_sensor(rows, order, ts)
        rows = rows.take(place).reset_index(drop=True)
        (last, part, model, top, path), others = known(state.get[0] if state.exists else None, sensor_names, MOTION_SENSORS)
        open_part = list(part)
        timed = rows[ts].notna().to_numpy()
        times, owners = rows.loc[timed, ts].to_numpy(np.int64), sensors[timed]
        starts, opens = session_starts(times, owners, last, part, gap_us)
        heads = edges(owners)
        for sensor, end in zip(owners[heads].tolist(), [*heads[1:].tolist(), len(owners)]):
            last[sensor], part[sensor] = int(times[end - 1]), int(starts[end - 1])
        id_part = np.zeros(len(rows), np.int64)
        id_part[timed] = starts
        is_new = np.zeros(len(rows), bool)
        is_new[timed] = opens
        ids = np.full(len(rows), "", dtype=object)
        ids[timed] = [f"{sensor_names[o]}_{s}" for o, s in zip(owners.tolist(), starts.tolist())]
        new = {"session_id_part": pd.arrays.IntegerArray(id_part, ~timed), "sensor_session_id": ids, "is_new_session": is_new}
        if make_scorer:
            velocity, movement, done = np.full(len(rows), np.nan), np.full(len(rows), np.nan), np.zeros(len(rows), bool)
            has_sample = rows["pos"].notna().to_numpy() if "pos" in rows else np.ones(len(rows), bool)
            if has_sample.any():
                samples_in = rows.loc[has_sample].reset_index(drop=True)
                scorer = make_scorer()
                marks = [sensors[has_sample]]
                alone = not scorer.stateful and len(order) > 1  # such a model is given one record at a time
                if alone:
                    for c in order[:-1]:
                        null = samples_in[c].isna().to_numpy()
                        marks += [np.cumsum(null | np.r_[False, null[:-1]]), samples_in[c].fillna(0).to_numpy()]
                cuts = edges(*marks).tolist()
                of = marks[0][cuts].tolist()
                runs = [(lo, hi, None if alone else model[o]) for lo, hi, o in zip(cuts, [*cuts[1:], len(samples_in)], of)]
                found, moves, scored, ends = score_runs(scorer, samples_in, runs)
                velocity[has_sample], movement[has_sample], done[has_sample] = found, moves, scored
                for o, end in zip(of, ends):
                    model[o] = end
            new.update(_velocity=velocity, _movement=movement, _scored=done)
        if not totals:
            nothing = [None] * len(sensor_names)
            state.update((kept(others, sensor_names, (last, part, model, nothing, nothing)),))
            yield with_columns(rows[names], new)
            return
        if make_scorer:
            speed = np.where(done, masked(velocity, movement), np.nan)
            has_speed = done & timed
        else:
            speed = rows["predicted_velocity"].to_numpy(float, na_value=np.nan)
            has_speed = rows["predicted_velocity"].notna().to_numpy() & timed
        found = session_parts(speed[has_speed], id_part[has_speed], sensors[has_speed], open_part, top, path)
        of, begun, tops, paths = [f.tolist() for f in found]
        for sensor in range(len(sensor_names)):
            if part[sensor] != open_part[sensor]:
                top[sensor] = path[sensor] = None
        newest = {sensor: totals_of for sensor, *totals_of in zip(of, begun, tops, paths)}
        for sensor, (start, high, far) in newest.items():
            if start == part[sensor]:
                top[sensor], path[sensor] = high, far
        state.update((kept(others, sensor_names, (last, part, model, top, path)),))
        yield with_columns(rows[names], {**new, "kind": SAMPLE_ROW, "session_max_velocity": np.nan, "session_total_distance": np.nan})
        if of:
            first_rows = np.searchsorted(sensors, np.array(of))
            ends = pd.DataFrame({
                key: rows[key].take(first_rows).to_numpy(), "session_id_part": pd.array(begun, "Int64"),
                "sensor_session_id": [f"{sensor_names[o]}_{s}" for o, s in zip(of, begun)], "kind": TOTAL_ROW,
                "session_max_velocity": tops, "session_total_distance": [p * period_s for p in paths]})
            whole = ends.reindex(columns=schema.names)
            for field in schema.fields:  # empty columns of the samples' types
                if field.name not in ends.columns:
                    whole[field.name] = pd.Series([None] * len(ends), dtype=_EMPTY.get(type(field.dataType), object))
            yield whole

    found = with_shared_key(inputs, key).groupBy(SHARED).applyInPandasWithState(
        on_some, schema, MOTION_STATE, "append", GroupStateTimeout.NoTimeout)
    return with_masked_velocity(found) if make_scorer else found


def frames(messages: DataFrame, arrival: str, limit: int = MAX_BUFFER_BYTES) -> DataFrame:
    """Frames of every sensor's byte stream; unread bytes wait in the state."""
    ordered = messages.filter(F.col("payload").isNotNull()).select(
        "sensor_id", F.col(arrival).cast("long").alias("arrival"), "payload")

    def on_sensor(sensor: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        buffer = state.get[0] if state.exists else b""
        buffer, made = bytes(buffer or b""), []
        rows = _in_order(parts, ["arrival"])
        for at, payload in zip(rows["arrival"], rows["payload"]):
            found, buffer = feed(buffer, bytes(payload), limit)
            made += [(sensor[0], at, n, *frame) for n, frame in enumerate(found)]
        state.update((buffer,))
        yield frame_rows(made)

    return ordered.groupBy("sensor_id").applyInPandasWithState(
        on_sensor, FRAMES, BUFFER_STATE, "append", GroupStateTimeout.NoTimeout)
