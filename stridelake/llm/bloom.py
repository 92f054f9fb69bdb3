"""A blocked Bloom filter of DataFrame functions: each key sets a bit in every word of one block.

The filter is a table of blocks of bounded size, which is what makes it safe to broadcast. With more keys than fit
it passes more rows, and the exact join behind it stays right.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

WORDS = 8
WORD_BITS = 32
BITS_PER_KEY = 16
# At most 65,536 blocks of 9 longs, under 5 MB.
MAX_BLOCKS = 65_536


def block_count(keys: int) -> int:
    return min(MAX_BLOCKS, max(1, keys * BITS_PER_KEY // (WORDS * WORD_BITS)))


def block_of(key: list[Column], blocks: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(blocks))


def bits_of(key: list[Column]) -> list[Column]:
    """The bit that a key sets in each word of its block."""
    mixed = F.xxhash64(F.lit(7), *key)
    return [F.shiftrightunsigned(mixed, 5 * i).bitwiseAND(F.lit(WORD_BITS - 1)).cast("int") for i in range(WORDS)]


def bloom_blocks(keys: DataFrame, names: list[str], blocks: int) -> DataFrame:
    """The filter of the keys: a row for each block that is not empty."""
    key = [F.col(n) for n in names]
    bits = [F.call_function("shiftleft", F.lit(1).cast("long"), b) for b in bits_of(key)]
    return keys.groupBy(block_of(key, blocks).alias("_block")).agg(
        *[F.bit_or(b).alias(f"_word{i}") for i, b in enumerate(bits)])


def possible_hits(rows: DataFrame, names: list[str], filter_blocks: DataFrame, blocks: int) -> DataFrame:
    """The rows whose key may be listed; no listed key is lost."""
    key = [F.col(n) for n in names]
    probe = rows.withColumn("_block", block_of(key, blocks)).join(F.broadcast(filter_blocks), "_block")
    for i, b in enumerate(bits_of(key)):
        probe = probe.filter(F.call_function("shiftright", F.col(f"_word{i}"), b).bitwiseAND(F.lit(1)) == 1)
    return probe.select(*[F.col(f"`{c}`") for c in rows.columns])
