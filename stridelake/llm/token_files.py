"""Texts as token ids in binary files, ordered by document id, and read back in parallel.

A file holds the documents of a range of ids in order. It begins with a frequency table that all its blocks share.
The blocks are cut from the ids of the documents one after the other and coded on their own (see `rans`), with
checkpoints inside. An index at the end has place, length and checksums of every block, and the table of documents.
Tasks name their files themselves and return a manifest row per file; only rows of finished tasks reach the written
manifest, so files of lost or repeated tasks are never read.

Every text ends with the end id; null and empty texts hold it alone. Null ids come last, rows with equal ids are
ordered by their ids of tokens. Document ids are whole numbers.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from stridelake.llm import rans
from stridelake.llm.packed import qualified, raw_texts, slices, store
from stridelake.llm.tokens import END_ID, encoder
from stridelake.session import new_folder

# Marks of the format.
MAGIC = b"TOKRANS1"
FILE_TOKENS = 1 << 22
RANGE_BYTES = 48 << 20
SLICE_BYTES = 2 << 20
SIDE_BY_SIDE = 16
MANIFEST = "file string, range int, place int, docs long, tokens long"


class DamagedFile(ValueError):
    pass


def part_bytes(part: rans.Part) -> bytes:
    return struct.pack("<I", len(part.words)) + part.states.astype("<u8").tobytes() + part.words.astype("<u4").tobytes()


def file_bytes(tokens: np.ndarray, keys: np.ndarray, lengths: np.ndarray) -> Iterator[bytes]:
    """The pieces of a file. `keys` is masked where the id is null."""
    counts = np.bincount(tokens, minlength=1)
    share = rans.frequencies(counts)
    coder = rans.Coder(share)
    table = zlib.compress(share.astype("<u4").tobytes())
    yield MAGIC + struct.pack("<II", len(table), zlib.crc32(table)) + table
    at, index = len(MAGIC) + 8 + len(table), []
    whole = len(tokens) // rans.BLOCK * rans.BLOCK
    group = SIDE_BY_SIDE * rans.BLOCK
    runs = [(s, min(s + group, whole), rans.BLOCK) for s in range(0, whole, group)]
    if whole < len(tokens):
        runs.append((whole, len(tokens), -(-(len(tokens) - whole) // rans.LANES) * rans.LANES))
    for start, end, size in runs:
        block = tokens[start:end]
        block = np.concatenate([block, np.repeat(block[:1], -len(block) % size)]).reshape(-1, size)
        for i, parts in enumerate(coder.encode(block)):
            ids = tokens[start + i * size:min(start + (i + 1) * size, end)]
            data = b"".join(map(part_bytes, parts))
            index.append([at, len(data), len(parts), len(ids), zlib.crc32(data), zlib.crc32(ids.astype("<u4").tobytes())])
            at += len(data)
            yield data
    columns = [keys.filled(0).astype("<i8").tobytes(), np.ma.getmaskarray(keys).tobytes(), lengths.astype("<i8").tobytes()]
    foot = zlib.compress(json.dumps({"blocks": index, "docs": len(keys), "tokens": len(tokens)}).encode() + b"\0" + b"".join(columns))
    yield foot + struct.pack("<QI", len(foot), zlib.crc32(foot)) + MAGIC


def read_file(data: bytes, name: str = "file") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens, keys (masked where null) and lengths of a file; every checksum is checked."""
    if data[:8] != MAGIC or data[-8:] != MAGIC:
        raise DamagedFile(f"{name}: no token file")
    size, mark = struct.unpack("<II", data[8:16])
    table = data[16:16 + size]
    length, foot_mark = struct.unpack("<QI", data[-20:-8])
    foot = data[len(data) - 20 - length:-20]
    if zlib.crc32(table) != mark or zlib.crc32(foot) != foot_mark:
        raise DamagedFile(f"{name}: the checksum of table or index differs")
    coder = rans.Coder(np.frombuffer(zlib.decompress(table), "<u4"))
    head, _, columns = zlib.decompress(foot).partition(b"\0")
    index = json.loads(head)
    docs = index["docs"]
    keys = np.ma.array(np.frombuffer(columns[:8 * docs], "<i8"), mask=np.frombuffer(columns[8 * docs:9 * docs], bool))
    lengths = np.frombuffer(columns[9 * docs:], "<i8")
    out, blocks = [], index["blocks"]
    for start in range(0, len(blocks), SIDE_BY_SIDE):
        out += decoded(data, blocks[start:start + SIDE_BY_SIDE], coder, name)
    tokens = np.concatenate(out) if out else np.zeros(0, np.uint32)
    return tokens, keys, lengths


def decoded(data: bytes, blocks: list[list[int]], coder: rans.Coder, name: str) -> list[np.ndarray]:
    """The tokens of some blocks; parts of the same length are decoded side by side."""
    parts: list[tuple[int, rans.Part]] = []
    for number, (at, size, count, ids, mark, _) in enumerate(blocks):
        if zlib.crc32(data[at:at + size]) != mark:
            raise DamagedFile(f"{name}: the checksum of a block differs")
        left = -(-ids // rans.LANES) * rans.LANES
        for _ in range(count):
            words, = struct.unpack_from("<I", data, at)
            states = np.frombuffer(data, "<u8", rans.LANES, at + 4)
            at += 4 + 8 * rans.LANES
            held = min(left, rans.CHECK_STEPS * rans.LANES)
            parts.append((number, rans.Part(states, np.frombuffer(data, "<u4", words, at), held)))
            at, left = at + 4 * words, left - held
    found: list[np.ndarray | None] = [None] * len(parts)
    for length in {p.count for _, p in parts}:
        same = [i for i, (_, p) in enumerate(parts) if p.count == length]
        for i, row in zip(same, coder.decode([parts[i][1] for i in same])):
            found[i] = row
    out = []
    for number, (_, _, _, ids, _, mark) in enumerate(blocks):
        tokens = np.concatenate([row for (n, _), row in zip(parts, found) if n == number])[:ids]
        if zlib.crc32(tokens.astype("<u4").tobytes()) != mark:
            raise DamagedFile(f"{name}: the checksum of a block's tokens differs")
        out.append(tokens)
    return out


def ranges_of(documents: DataFrame, key: str, text: str) -> list[int]:
    """Ids that cut the documents into ranges of about RANGE_BYTES of text."""
    size = documents.agg(F.sum(F.octet_length(text))).first()[0] or 0
    count = int(size // RANGE_BYTES)
    if count < 1:
        return []
    shares = [i / (count + 1) for i in range(1, count + 1)]
    return sorted(set(documents.agg(F.percentile_approx(key, shares, 100 * (count + 1))).first()[0] or []))


def write_tokens(documents: DataFrame, folder: str, key: str = "doc_id", text: str = "text",
                 vocabulary: str | None = None, file_tokens: int = FILE_TOKENS) -> DataFrame:
    """Encode every text, write the files, and return the stored manifest."""
    spark = documents.sparkSession
    target = qualified(spark, folder)
    rows = documents.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("body"))
    cuts = np.array(ranges_of(rows, "key", "body"), np.int64)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(vocabulary)
        end = np.array([END_ID], coder.kind).tobytes()
        for batch in batches:
            for piece in slices(batch, "body", SLICE_BYTES):
                texts = [t.decode("utf-8", "replace") for t in raw_texts(piece.column("body"))]
                keys = piece.column("key")
                known = keys.fill_null(np.iinfo(np.int64).max).to_numpy()
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.searchsorted(cuts, known, side="right"), pa.int32()), keys,
                    pa.array([t + end for t in coder.encode(texts)], pa.binary())], ["range", "key", "ids"])

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = encoder(vocabulary).kind
        system, root = store(target)
        done, held, place, current = [], [], 0, None

        def close() -> None:
            nonlocal held, place
            if not held:
                return
            lengths = np.array([len(t) // kind.itemsize for _, t in held], np.int64)
            keys = np.ma.array([k or 0 for k, _ in held], np.int64, mask=[k is None for k, _ in held])
            tokens = np.frombuffer(b"".join(t for _, t in held), kind)
            name = f"{uuid.uuid4().hex}.tok"
            system.create_dir(root, recursive=True)
            with system.open_output_stream(f"{root}/{name}") as out:
                for data in file_bytes(tokens, keys, lengths):
                    out.write(data)
            done.append((name, current, place, len(held), len(tokens)))
            held, place = [], place + 1

        size = 0
        for batch in batches:
            for number, k, t in zip(batch.column("range").to_pylist(), batch.column("key").to_pylist(), raw_texts(batch.column("ids"))):
                if number != current or size >= file_tokens:
                    close()
                    size, place = 0, place if number == current else 0
                    current = number
                held.append((k, t))
                size += len(t) // kind.itemsize
        close()
        types = (pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array([d[i] for d in done], t) for i, t in enumerate(types)], ["file", "range", "place", "docs", "tokens"])

    ids = rows.mapInArrow(encoded, "range int, key long, ids binary")
    ordered = ids.repartitionById(len(cuts) + 1, F.col("range")).sortWithinPartitions(
        "range", F.col("key").asc_nulls_last(), "ids")
    ordered.mapInArrow(written, MANIFEST).write.parquet(f"{folder}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def read_tokens(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """Every document of the files: id, start (tokens of all documents before it), number and checksum of its ids."""
    source = qualified(spark, folder)
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    before = Window.orderBy("range", "place").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0).cast("long")))
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if with_ids else "")

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = store(source)
        for batch in batches:
            for name, start, count in zip(*(batch.column(c).to_pylist() for c in ("file", "start", "tokens"))):
                with system.open_input_stream(f"{root}/{name}") as stream:
                    tokens, keys, lengths = read_file(stream.read(), name)
                if len(tokens) != count or lengths.sum() != count:
                    raise DamagedFile(f"{name}: {len(tokens)} tokens, {count} were written")
                ends = np.cumsum(lengths)
                data = memoryview(tokens.astype("<u4").tobytes())
                marks = [zlib.crc32(data[4 * (e - n):4 * e]) for e, n in zip(ends.tolist(), lengths.tolist())]
                columns = [pa.array(keys.filled(0), pa.int64(), mask=np.ma.getmaskarray(keys)),
                           pa.array(start + ends - lengths), pa.array(lengths), pa.array(marks, pa.int64())]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(
                        pa.array(np.r_[0, ends].astype(np.int32)), pa.array(tokens.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(columns, schema_names(with_ids))

    return files.select("file", "start", "tokens").repartition(max(1, manifest.count()), "file").mapInArrow(documents, schema)


def schema_names(with_ids: bool) -> list[str]:
    return ["doc_id", "start", "n_tokens", "ids_crc32"] + (["ids"] if with_ids else [])


def encode_and_read(documents: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str | None = None) -> DataFrame:
    spark = documents.sparkSession
    folder = new_folder(spark, "tokens")
    write_tokens(documents, folder, key, text, vocabulary)
    return read_tokens(spark, folder)
