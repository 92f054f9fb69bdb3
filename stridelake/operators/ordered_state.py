"""Steps that carry state along a key's rows in arrival order and cannot be written as windows.

Rows are hash-partitioned by key and chunk, sorted, and streamed through Arrow batches, so a task
holds one batch and one state per key, never a whole history. A key with more than `rows` rows is
cut into chunks that run side by side. Their start states come from rounds: each chunk runs from
the end its predecessor had in the round before, until no start changes. That is exact, and it ends
quickly for steps that forget, such as packet framing or a recurrent model. Keys that are still
changing after `rounds` rounds go on as one run from their first chunk that is not settled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from stridelake.operators.sequence import CHUNK, along_chunks, with_row_number
from stridelake.session import checkpointed
from stridelake.settings import CHUNK_ROWS

STATE = "_state"
# (rows of the batch, [(from, to, start state)]) -> (output rows, end states)
Step = Callable[[pd.DataFrame, list[tuple[int, int, bytes | None]]], tuple[pd.DataFrame, list[bytes | None]]]


def _runs(keys: pd.Series, chunks: pd.Series) -> np.ndarray:
    """Row numbers where a new (key, chunk) begins, and the end."""
    changes = (keys.values[1:] != keys.values[:-1]) | (chunks.values[1:] != chunks.values[:-1])
    return np.concatenate([[0], np.flatnonzero(changes) + 1, [len(keys)]])


def _stream(make_step: Callable[[], Step], key: str, want_ends: bool):
    """A function for mapInPandas that follows the state over batch borders."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        step = make_step()
        current, state = None, None

        def end_row() -> pd.DataFrame:
            return pd.DataFrame({key: [current[0]], CHUNK: [current[1]], "_end": [state]})

        for batch in batches:
            if batch.empty:
                continue
            given = batch[STATE].notna().values
            edges = _runs(batch[key], batch[CHUNK])
            runs, ids, at = [], [], 0
            for lo, hi in zip(edges[:-1], edges[1:]):
                this = (batch[key].iat[lo], batch[CHUNK].iat[lo])
                start = state if this == current else None
                if given[lo]:
                    start, lo = batch[STATE].iat[lo], lo + 1
                runs.append((at, at + hi - lo, start))
                ids.append(this)
                at += hi - lo
            rows = batch.loc[~given].drop(columns=STATE).reset_index(drop=True)
            out, ends = step(rows, runs)
            if want_ends:
                for this, end in zip(ids, ends):
                    if current is not None and this != current:
                        yield end_row()
                    current, state = this, end
            else:
                current, state = ids[-1], ends[-1]
                yield out
        if want_ends and current is not None:
            yield end_row()

    return run


def _run(
    df: DataFrame, starts: DataFrame | None, make_step, key: str, order: Sequence[str], schema: T.StructType,
    want_ends: bool = False,
) -> DataFrame:
    rows = df.withColumn(STATE, F.lit(None).cast("binary"))
    if starts is not None:
        rows = rows.unionByName(
            starts.filter(F.col("_start").isNotNull()).select(key, CHUNK, F.col("_start").alias(STATE)),
            allowMissingColumns=True)
    # A fixed number of tasks: the step costs more per byte than AQE assumes when it joins small ones.
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = rows.repartition(tasks, key, CHUNK).sortWithinPartitions(
        key, CHUNK, F.col(STATE).isNull(), *order)
    if want_ends:
        kind = {f.name: f.dataType for f in df.schema}
        schema = T.StructType([
            T.StructField(key, kind[key]), T.StructField(CHUNK, T.LongType()), T.StructField("_end", T.BinaryType())])
    return placed.mapInPandas(_stream(make_step, key, want_ends), schema)


def fold_in_order(
    df: DataFrame, key: str, order: Sequence[str], make_step: Callable[[], Step], schema: T.StructType,
    rows: int = CHUNK_ROWS, rounds: int = 4,
) -> DataFrame:
    """Run a step over every key's rows in the order of `order`, whose first column is the arrival number."""
    whole = F.lit(0).cast("long")
    largest = df.groupBy(key).count().agg(F.max("count")).first()[0] or 0
    if largest <= rows:
        return _run(df.withColumn(CHUNK, whole), None, make_step, key, order, schema)

    numbered = with_row_number(df, key, order, "_n")
    chunked = numbered.withColumn(CHUNK, F.floor((F.col("_n") - 1) / F.lit(rows)).cast("long")).drop("_n")
    # Stored once, as every round reads it again.
    chunked = checkpointed(chunked)
    long_keys = df.groupBy(key).count().filter(F.col("count") > rows).select(key)

    def ends_of(part: DataFrame, starts: DataFrame | None) -> DataFrame:
        return checkpointed(_run(part, starts, make_step, key, order, schema, want_ends=True))

    def starts_from(ends: DataFrame) -> DataFrame:
        return ends.select(key, CHUNK, F.lag("_end").over(along_chunks(key)).alias("_start"))

    ends = ends_of(chunked.join(long_keys, key, "left_semi"), None)
    starts = ends.select(key, CHUNK, F.lit(None).cast("binary").alias("_start"))
    for attempt in range(rounds + 1):
        found = starts_from(ends)
        old = starts.withColumnsRenamed({"_start": "_old"})
        changed = checkpointed(
            found.join(old, [key, CHUNK]).filter(~F.col("_start").eqNullSafe(F.col("_old"))).drop("_old"))
        starts = found
        if changed.isEmpty():
            return _run(chunked, starts, make_step, key, order, schema)
        if attempt < rounds:
            again = ends_of(chunked.join(changed, [key, CHUNK], "left_semi"), changed)
            ends = checkpointed(ends.join(again, [key, CHUNK], "left_anti").unionByName(again))

    # The start of the first chunk that changed is right, as all before it stayed.
    first = changed.groupBy(key).agg(F.min(CHUNK).alias("_first"))
    one_run = chunked.join(first, key, "left").withColumn(CHUNK, F.least(CHUNK, F.coalesce("_first", CHUNK))).drop("_first")
    known = starts.join(first, key, "left").filter(F.col(CHUNK) <= F.coalesce("_first", CHUNK)).drop("_first")
    return _run(one_run, known, make_step, key, order, schema)
