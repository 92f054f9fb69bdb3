"""Ordered scans over the history of a key, however long that history is.

A window over the key alone would put a whole sensor into one task. Here a key's rows are cut into
chunks by arrival number (`arrival div rows`), so a task holds at most `rows` arrivals of a key.
What a chunk needs from earlier ones is a small row per chunk: it is aggregated, carried along the
chunks of the key, and joined back on (key, chunk), where the large side is already partitioned.
The arrival number must be a whole number that is unique within the key, as a Kafka offset is.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from stridelake.settings import CHUNK_ROWS

CHUNK = "_chunk"


def with_chunk(df: DataFrame, arrival: str, rows: int = CHUNK_ROWS) -> DataFrame:
    return df.withColumn(CHUNK, F.expr(f"cast(`{arrival}` as bigint) div {rows}"))


def fits_one_task(df: DataFrame, key: str, rows: int) -> bool:
    """Whether no key has more rows than a task may hold. One narrow read, combined before the shuffle."""
    return (df.groupBy(key).count().agg(F.max("count")).first()[0] or 0) <= rows


def in_chunk(key: str, *order: str) -> W:
    return W.partitionBy(key, CHUNK).orderBy(*order)


def along_chunks(key: str) -> W:
    return W.partitionBy(key).orderBy(CHUNK)


def before(window: W) -> W:
    return window.rowsBetween(W.unboundedPreceding, -1)


def so_far(window: W) -> W:
    return window.rowsBetween(W.unboundedPreceding, W.currentRow)


def join_carry(df: DataFrame, carry: DataFrame, key: str) -> DataFrame:
    """Give every row what was carried into its chunk."""
    carry = carry.withColumnsRenamed({key: "_carry_key", CHUNK: "_carry_chunk"})
    same = (F.col(key) == F.col("_carry_key")) & (F.col(CHUNK) == F.col("_carry_chunk"))
    return df.join(carry, same, "left").drop("_carry_key", "_carry_chunk")


def with_previous(df: DataFrame, key: str, arrival: str, value: str, out: str, rows: int = CHUNK_ROWS) -> DataFrame:
    """The value of the key's previous row; the value itself must not be null."""
    df = with_chunk(df, arrival, rows)
    carry = (
        df.groupBy(key, CHUNK).agg(F.max_by(value, arrival).alias("_last"))
        .select(key, CHUNK, F.lag("_last").over(along_chunks(key)).alias("_carry"))
    )
    near = df.withColumn(out, F.lag(value).over(in_chunk(key, arrival)))
    return join_carry(near, carry, key).withColumn(out, F.coalesce(out, "_carry")).drop("_carry", CHUNK)


def with_row_number(
    df: DataFrame, key: str, order: Sequence[str], out: str, rows: int = CHUNK_ROWS, count: Column | None = None,
    total: str | None = None,
) -> DataFrame:
    """Number a key's rows from 1 in arrival order.

    With `count`, number only the rows where it holds; others get the number of the last one before.
    `total` names a column for the highest number of the key.
    """
    unit = F.lit(1) if count is None else F.when(count, 1).otherwise(0)
    df = with_chunk(df, order[0], rows).withColumn("_unit", unit.cast("long"))
    per_key = W.partitionBy(key)
    carry = df.groupBy(key, CHUNK).agg(F.sum("_unit").alias("_size")).withColumn(
        "_carry", F.coalesce(F.sum("_size").over(before(along_chunks(key))), F.lit(0)))
    if total:
        carry = carry.withColumn(total, F.sum("_size").over(per_key))
    near = df.withColumn(out, F.sum("_unit").over(so_far(in_chunk(key, *order))))
    return (
        join_carry(near, carry.drop("_size"), key)
        .withColumn(out, F.col(out) + F.col("_carry"))
        .drop("_carry", "_unit", CHUNK)
    )


def over_last_rows(
    df: DataFrame, key: str, number: str, back: int, compute: Callable[[DataFrame, W], DataFrame],
    rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Apply `compute(frame, window)`, which may look at the `back` rows before each row.

    `number` is the dense row number of the key. A block of rows also gets copies of the `back`
    rows before it, so that all it needs lies in one block, and the copies go after `compute`.
    """
    rows = max(rows, back)
    place = F.col(number) - 1
    home = F.floor(place / F.lit(rows)).cast("long")
    blocks = F.when(F.pmod(place, F.lit(rows)) >= rows - back, F.array(home, home + 1)).otherwise(F.array(home))
    copied = df.withColumn("_home", home).withColumn("_block", F.explode(blocks))
    done = compute(copied, W.partitionBy(key, "_block").orderBy(number))
    return done.filter(F.col("_block") == F.col("_home")).drop("_home", "_block")


# Up to this many rows per key, Spark cuts each input partition to the limit before the shuffle; -1 switches that off.
EARLY_LIMIT = "spark.sql.optimizer.windowGroupLimitThreshold"


def last_rows(df: DataFrame, key: str, order: Sequence[str], n: int) -> DataFrame:
    """The last n rows of each key."""
    if n > int(df.sparkSession.conf.get(EARLY_LIMIT, "1000")):
        numbered = with_row_number(df, key, order, "_n", total="_of")
        return numbered.filter(F.col("_n") > F.col("_of") - n).drop("_n", "_of")
    newest = W.partitionBy(key).orderBy(*[F.desc(c) for c in order])
    return df.withColumn("_back", F.row_number().over(newest)).filter(F.col("_back") <= n).drop("_back")
