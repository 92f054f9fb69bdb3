"""CRC-16/ARC of binary columns, a batch of rows at a time."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import functions as F, types as T

BLOCK = 4096


@lru_cache(maxsize=1)
def _contributions() -> np.ndarray:
    """Row k holds what each byte value adds to the sum when k bytes follow it.

    The sum starts at zero and has no final change, so it is the XOR of what its bytes add.
    """
    last = np.arange(256, dtype=np.uint16)
    for _ in range(8):
        last = np.where(last & 1, (last >> 1) ^ 0xA001, last >> 1).astype(np.uint16)
    rows = np.empty((BLOCK, 256), dtype=np.uint16)
    rows[0] = last
    for k in range(1, BLOCK):
        rows[k] = last[rows[k - 1] & 0xFF] ^ (rows[k - 1] >> 8)
    return rows


def crc16(data: bytes) -> int:
    rows = _contributions()
    content = np.frombuffer(data, dtype=np.uint8)
    total = 0
    for start in range(0, len(content), BLOCK):
        block = content[start:start + BLOCK]
        if start:
            # A running sum acts as if it were added to the next two bytes.
            block = block.copy()
            block[0] ^= total & 0xFF
            rest = total >> 8
            if len(block) > 1:
                block[1] ^= rest
                rest = 0
        else:
            rest = 0
        total = int(np.bitwise_xor.reduce(rows[np.arange(len(block) - 1, -1, -1), block])) ^ rest
    return total


# Bytes that one table look-up covers at most.
LOOKUP = 1 << 21


def crc16_of_all(values: list[bytes]) -> np.ndarray:
    """The sums of many values. Values of like lengths share a look-up; zeros before a value change nothing."""
    rows = _contributions()
    lengths = np.array([len(v) for v in values], np.int64)
    out = np.zeros(len(values), np.int64)
    order = np.argsort(lengths, kind="stable")
    at = int(np.searchsorted(lengths[order], 1))
    short = int(np.searchsorted(lengths[order], BLOCK, side="right"))
    while at < short:
        # As many values as fit, the longest at most twice as long as the first.
        end = at + int(np.searchsorted(lengths[order[at:short]], 2 * lengths[order[at]], side="right"))
        end = min(end, at + max(1, LOOKUP // int(lengths[order[end - 1]])))
        group = order[at:end]
        width = int(lengths[group[-1]])
        content = np.frombuffer(b"".join(values[i].rjust(width, b"\0") for i in group.tolist()), np.uint8).reshape(-1, width)
        out[group] = np.bitwise_xor.reduce(rows[np.arange(width - 1, -1, -1), content], axis=1)
        at = end
    for i in order[short:].tolist():
        out[i] = crc16(values[i])
    return out


@F.pandas_udf(T.IntegerType())
def crc16_arc(data: pd.Series) -> pd.Series:
    known = data.notna().to_numpy()
    out = pd.array(np.zeros(len(data), np.int32), dtype="Int32")
    out[known] = crc16_of_all([bytes(v) for v in data[known]]).astype(np.int32)
    out[~known] = pd.NA
    return pd.Series(out)
