"""Texts of Arrow batches as bytes, and files on the shared folder. Everything here runs inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession

# A-Z to a-z, every other byte as it is.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
# Lower-cased, with every byte that is no part of a word replaced by a space. Words hold 0-9, letters and bytes over 127.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def buffers(texts: pa.Array) -> tuple[memoryview, np.ndarray]:
    """The bytes of all texts of an Arrow array and where each begins, with the end of the last; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, places, data = texts.buffers()
    if len(texts) == 0 or places is None:
        return memoryview(b""), np.zeros(1, np.int64)
    offsets = np.frombuffer(places, np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1]
    return memoryview(data or b""), offsets.astype(np.int64)


def raw_texts(texts: pa.Array) -> Iterator[bytes]:
    data, offsets = buffers(texts)
    places = offsets.tolist()
    for start, end in zip(places, places[1:]):
        yield bytes(data[start:end])


def slices(batch: pa.RecordBatch, column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows whose texts take at most so many bytes; a longer text is a run of its own."""
    _, offsets = buffers(batch.column(column))
    row, rows = 0, batch.num_rows
    while row < rows:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + most, side="right")) - 1)
        yield batch.slice(row, min(end, rows) - row)
        row = end


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder with its scheme, as tasks need it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    full = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return "file://" + full[5:] if full.startswith("file:/") and not full.startswith("file://") else full


def store(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)
