"""Windows over the last messages and the last samples of a sensor, whatever triggers they come in.

Each operator is one stateful processor keyed by the sensor. Its state is a ring: the few rows before the next one, and
nothing else, so it does not grow with the stream. A task holds the rows that a sensor has in one trigger, which the
source's limit per trigger bounds. Results are those of `operators.features` over the whole input in the same order.

Rows of a trigger are taken by `order`; triggers follow each other. Null sensors are a sensor of their own. Repeated
rows count as often as they come. An empty input gives no rows.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from stridelake.settings import FEATURE_WINDOW, PREVIOUS_MESSAGES
from stridelake.streaming.keyed import _in_order

# A message's list between the brackets of its JSON form, and the lists of a window put together.
OWN, JOINED = "_own", "_joined"
VALUES = ["_accl", "_no_accl", "_gyro", "_no_gyro"]
CHANGES, ENERGY, KNOWN = "accl_sum_of_changes", "gyro_mag_energy", "_energy_known"
ROLLED = [T.StructField(CHANGES, T.DoubleType()), T.StructField(ENERGY, T.DoubleType()), T.StructField(KNOWN, T.BooleanType())]


def named(parts: Iterator[pd.DataFrame], names: Sequence[str]) -> Iterator[pd.DataFrame]:
    """The parts with their columns' own names: Spark numbers those that are no Python names."""
    return (part.set_axis(names, axis=1) for part in parts)


class MessageRing(StatefulProcessor):
    """The lists of the last messages of a sensor; `full_only` leaves messages without samples out of the ring."""

    def __init__(self, names: list[str], order: list[str], previous: int, full_only: bool):
        self.names, self.order, self.previous, self.full_only = names, order, previous, full_only

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.ring = handle.getListState("ring", "own string")

    def handleInputRows(self, key, rows, timerValues):
        came = _in_order(named(rows, self.names), self.order)
        ring = deque((r[0] for r in self.ring.get()), maxlen=self.previous)
        joined = []
        for own in came[OWN].tolist():
            joined.append(",".join(filter(None, [*ring, own])))
            if own or not self.full_only:
                ring.append(own)
        if ring:
            self.ring.put([(own,) for own in ring])
        yield came[self.names].assign(**{JOINED: joined})

    def close(self) -> None:
        pass


def _over_ring(messages: DataFrame, order: Sequence[str], previous: int, full_only: bool, out: str, key: str) -> DataFrame:
    lists = messages.schema["samples"].dataType
    text = F.coalesce(F.to_json("samples", {"ignoreNullFields": "false"}), F.lit("[]"))
    inputs = messages.withColumn(OWN, F.substring(text, F.lit(2), F.length(text) - 2)).drop("samples")
    schema = T.StructType([*(T.StructField(f.name, f.dataType) for f in inputs.schema.fields), T.StructField(JOINED, T.StringType())])
    found = inputs.groupBy(key).transformWithStateInPandas(
        MessageRing(inputs.columns, list(order), previous, full_only), schema, "append", "none")

    def read(column: str):
        return F.from_json(F.concat(F.lit("["), F.col(column), F.lit("]")), lists)

    kept = found.filter(F.col(JOINED) != "")
    return kept.select(*[read(OWN).alias("samples") if c == "samples" else F.col(c) for c in messages.columns], read(JOINED).alias(out))


def sliding_messages(messages: DataFrame, order: Sequence[str], size: int = PREVIOUS_MESSAGES + 1,
                     out: str = "window_samples", key: str = "sensor_id") -> DataFrame:
    """The samples of the sensor's last `size` messages, one row per message; windows without samples have no row.

    Lists travel as JSON, so a message without a list comes out with an empty one; a NaN in a column beside them comes
    out as null.
    """
    return _over_ring(messages, order, size - 1, False, out, key)


def buffered_messages(messages: DataFrame, order: Sequence[str], previous: int = PREVIOUS_MESSAGES,
                      out: str = "window_samples", key: str = "sensor_id") -> DataFrame:
    """Samples of the last `previous` messages that had any, put before the message's own samples.

    A message without samples sees what is in the buffer; before the first samples of a sensor it has no row.
    """
    return _over_ring(messages, order, previous, True, out, key)


def rolling_sums(accl: np.ndarray, gyro: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per row: absolute changes of `accl` and squares of `gyro` over the last `window` rows, and whether one is known.

    Both arrays have a second line that is 1 where the value is null. Changes from or to a null count as 0; squares of
    nulls are left out. Every window is summed by itself, so results do not depend on where the input is cut.
    """
    steps = np.abs(np.diff(accl[0], prepend=np.nan))
    unknown = accl[1] > 0
    steps[unknown | np.concatenate([[True], unknown[:-1]])] = 0.0
    squares = np.where(gyro[1] > 0, 0.0, gyro[0] * gyro[0])

    def sums(values: np.ndarray) -> np.ndarray:
        padded = np.concatenate([np.zeros(window - 1), values])
        return np.lib.stride_tricks.sliding_window_view(padded, window).sum(axis=1)

    return sums(steps), sums(squares), sums((gyro[1] == 0).astype(float)) > 0


class SampleRing(StatefulProcessor):
    """The last samples of a sensor as two values with their null marks; one more than a window, for its first change."""

    def __init__(self, names: list[str], order: list[str], window: int):
        self.names, self.order, self.window = names, order, window

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.ring = handle.getValueState("ring", "samples binary")

    def handleInputRows(self, key, rows, timerValues):
        came = _in_order(named(rows, self.names), self.order)
        own = np.stack([came[c].to_numpy(float, na_value=np.nan) for c in VALUES])
        before = np.frombuffer(bytes(self.ring.get()[0])).reshape(4, -1) if self.ring.exists() else np.zeros((4, 0))
        line = np.concatenate([before, own], axis=1)
        self.ring.update((np.ascontiguousarray(line[:, -self.window:]).tobytes(),))
        changes, energy, known = (x[before.shape[1]:] for x in rolling_sums(line[:2], line[2:], self.window))
        yield came[self.names].assign(**{CHANGES: changes, ENERGY: energy, KNOWN: known})

    def close(self) -> None:
        pass


def rolling_features(samples: DataFrame, order: Sequence[str], window: int = FEATURE_WINDOW, key: str = "sensor_id") -> DataFrame:
    """Rolling sums over `window` samples: absolute changes of accl_mag, and squares of gyro_mag.

    The energy of a window without a value is null. NaN stays NaN in both values and both sums; in other columns of
    numbers it comes out as null.
    """
    nothing = F.lit(float("nan"))

    def marked(column: str, name: str, null: str) -> dict:
        return {name: F.coalesce(F.col(column).cast("double"), nothing), null: F.col(column).isNull().cast("double")}

    def restored(column: str, name: str, null: str):
        value = F.when(F.col(null) == 0, F.coalesce(name, nothing))
        return value.cast(samples.schema[column].dataType).alias(column)

    kinds = {"accl_mag": ("_accl", "_no_accl"), "gyro_mag": ("_gyro", "_no_gyro")}
    marks = {k: v for column, names in kinds.items() for k, v in marked(column, *names).items()}
    inputs = samples.withColumns(marks).drop(*kinds)
    # A NaN leaves Python as a null, also in columns that had none.
    schema = T.StructType([*(T.StructField(f.name, f.dataType) for f in inputs.schema.fields), *ROLLED])
    found = inputs.groupBy(key).transformWithStateInPandas(
        SampleRing(inputs.columns, list(order), window), schema, "append", "none")
    columns = [restored(c, *kinds[c]) if c in kinds else F.col(c) for c in samples.columns]
    return found.select(*columns, F.coalesce(CHANGES, nothing).alias(CHANGES),
                        F.when(F.col(KNOWN), F.coalesce(ENERGY, nothing)).alias(ENERGY))
