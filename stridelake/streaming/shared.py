"""Sensors that share a key, so that one stateful call works on many of them.

A call costs milliseconds however few rows it gets. Sensors are dealt to a fixed number of keys by a hash; the rows of a
key are sorted by sensor, and what is kept of its sensors is one Arrow table, a row per sensor.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

SHARED_KEYS = 256
# transformWithStateInPandas renames columns that begin with an underscore.
SHARED, SENSOR, MISSING = "shared_key", "shared_key_sensor", "missing_value_of_"


def with_shared_key(rows: DataFrame, key: str) -> DataFrame:
    """The rows with the key that their sensor shares and the sensor's name as text.

    pandas reads a whole number as a float if any row of the frame has a null there, and the rows of a sensor should not
    depend on those of others. So nulls of whole numbers travel as marks; `restored` puts them back.
    """
    longs = [f.name for f in rows.schema if isinstance(f.dataType, T.LongType) and f.nullable]
    return rows.select(
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) if c in longs else F.col(c) for c in rows.columns],
        *[F.col(c).isNull().alias(MISSING + c) for c in longs],
        F.col(key).cast("string").alias(SENSOR), F.pmod(F.xxhash64(key), F.lit(SHARED_KEYS)).alias(SHARED))


def restored(rows: pd.DataFrame) -> pd.DataFrame:
    """Rows with the nulls of whole numbers, without the marks."""
    marks = [c for c in rows.columns if c.startswith(MISSING)]
    nulls = {c[len(MISSING):]: rows[c].to_numpy(bool) for c in marks}
    return rows.drop(columns=marks).assign(**{
        c: pd.arrays.IntegerArray(rows[c].to_numpy(np.int64), at) for c, at in nulls.items() if at.any()})


def by_sensor(rows: pd.DataFrame, order: Sequence[str], ts: str | None = None) -> tuple[np.ndarray, np.ndarray, list[str | None]]:
    """Places that put the rows of each sensor together in arrival order, the sensor's number of each, and the names.

    As in `keyed._in_order`, a sensor's rows of several partitions are merged by time, and each keeps its own order.
    """
    numbers, names = pd.factorize(rows[SENSOR], use_na_sentinel=False)
    marks = [rows[c].to_numpy() for c in order]
    if any(m.dtype == object for m in marks):
        place = rows[list(order)].reset_index(drop=True).assign(_number=numbers).sort_values(["_number", *order]).index.to_numpy()
    else:
        place = np.lexsort([*marks[::-1], numbers])
    numbers = numbers[place]
    if ts and order[0] == "partition":
        came = rows[["partition", ts]].take(place).reset_index(drop=True)
        several = (came["partition"].groupby(numbers).transform("nunique") > 1).to_numpy()
        if several.any():
            one = [pd.Series(numbers), came["partition"]]
            reached = came[ts].groupby(one).cummax().groupby(one).ffill().astype("Int64").fillna(np.iinfo(np.int64).min)
            place = place[np.lexsort((np.where(several, reached.to_numpy(np.int64), 0), numbers))]
    return place, numbers, [n if isinstance(n, str) else None for n in names]


def edges(*marks: np.ndarray) -> np.ndarray:
    """Where a run of rows begins in which no mark changes."""
    changes = np.ones(len(marks[0]), bool)
    if len(changes):
        changes[1:] = False
        for m in marks:
            changes[1:] |= (m[1:] != m[:-1]).astype(bool)
    return np.flatnonzero(changes)


def to_bytes(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def to_table(data: bytes | None, schema: pa.Schema) -> pa.Table:
    return pa.ipc.open_stream(bytes(data)).read_all() if data is not None else schema.empty_table()


def known(data: bytes | None, names: list[str | None], schema: pa.Schema) -> tuple[list[list], pa.Table]:
    """What is kept of these sensors, a list for each column but the name, None where nothing is; and the other sensors."""
    held = to_table(data, schema)
    at = pc.index_in(pa.array(names, pa.string()), value_set=held.column(0).combine_chunks())
    others = np.ones(len(held), bool)
    others[at.drop_null().to_numpy()] = False
    found = held.take(at)
    return [found.column(i).to_pylist() for i in range(1, len(schema))], held.filter(pa.array(others))


def kept(others: pa.Table, names: list[str | None], columns: Sequence[Sequence]) -> bytes:
    """What to keep: the other sensors as they are, and these."""
    return to_bytes(pa.concat_tables([others, pa.table([list(names), *map(list, columns)], schema=others.schema)]))
