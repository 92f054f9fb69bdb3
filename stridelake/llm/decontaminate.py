"""Benchmark passages in training documents, found with a positional inverted index.

Words are 0-9, a-z and bytes over 127 after A-Z is lower-cased. A window is `width` consecutive words of an item; an
item of fewer words, but not none, is one window. The documents are indexed in segments of bounded size: for each
term of the benchmark, its places in the segment in order. Segments are stored in the shared folder. A window is
looked up from its rarest term over all documents: the places of its terms, each less its place in the window, are
intersected from the rarest to the most frequent. What is left is where the whole window stands. With `slop`, every
window is also looked for with each word at most so many places off; items of such windows are near.

The documents are indexed once, for the terms of the whole benchmark; its vocabulary is held by the driver and the tasks.
A benchmark of more than SLICE_BYTES is looked up in slices, so the windows that a task holds at a time are bounded. The
slices read the same stored segments, so their results are merged by segment and row, whatever executors do.
Null texts have no words. Repeated documents keep a row each, repeated items count once, a null item id is an
empty text. Long documents are a segment of their own.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructType

from stridelake.llm.packed import WORD_BYTES, raw_texts, slices
from stridelake.session import new_folder

WIDTH = 10
SEGMENT_BYTES = 8 << 20
SLICE_BYTES = 2 << 20
# Places left free between documents, so that no window reaches from one into the next.
GAP = 8


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


def windows_of(words: list[bytes], width: int) -> list[tuple[bytes, ...]]:
    return [tuple(words[i:i + width]) for i in range(max(1, len(words) - width + 1))] if words else []


def segment(texts: list[bytes], terms: dict[bytes, int]) -> dict:
    """Places of the terms in some documents. A document's words follow each other from its offset on."""
    counts, found, offset, offsets = [], [], 0, []
    for text in texts:
        words = words_of(text)
        ids = np.array([terms.get(w, -1) for w in words], np.int32)
        held = np.flatnonzero(ids >= 0)
        found.append((ids[held], held + offset))
        counts.append(len(words))
        offsets.append(offset)
        offset += len(words) + GAP
    ids, places = (np.concatenate(x) for x in zip(*found))
    order = np.argsort(ids, kind="stable")
    present, sizes = np.unique(ids, return_counts=True)
    # Differences are small and compress well.
    steps = np.diff(places[order].astype(np.uint32), prepend=np.uint32(0)).astype(np.uint32)
    return {"n_words": counts, "offsets": offsets, "terms": present, "sizes": sizes, "steps": steps.tobytes()}


def index_documents(documents: DataFrame, terms: list[bytes], key: str, text: str) -> DataFrame:
    """One row per segment: the documents in it and the places of the terms."""
    rows = documents.select(F.col(key).alias("key"), F.col(text).cast("string").alias("body"))
    schema = StructType().add("segment", StringType()).add("keys", ArrayType(rows.schema["key"].dataType)).add(
        "n_words", ArrayType(LongType())).add("offsets", ArrayType(LongType())).add("terms", ArrayType(IntegerType())).add(
        "sizes", ArrayType(LongType())).add("steps", BinaryType())

    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = {t: i for i, t in enumerate(terms)}
        part, count = TaskContext.get().partitionId(), 0
        for batch in batches:
            for piece in slices(batch, "body", SEGMENT_BYTES):
                found = segment(list(raw_texts(piece.column("body"))), numbers)
                keys = piece.column("key")
                ends = pa.array([0, len(keys)], pa.int32())
                yield pa.RecordBatch.from_arrays([
                    pa.array([f"{part}-{count}"]), pa.ListArray.from_arrays(ends, keys),
                    pa.array([found["n_words"]], pa.list_(pa.int64())), pa.array([found["offsets"]], pa.list_(pa.int64())),
                    pa.array([found["terms"]], pa.list_(pa.int32())), pa.array([found["sizes"]], pa.list_(pa.int64())),
                    pa.array([found["steps"]], pa.binary())], schema.names)
                count += 1

    return rows.mapInArrow(indexed, schema)


class Postings:
    def __init__(self, terms: np.ndarray, sizes: np.ndarray, steps: bytes):
        places = np.cumsum(np.frombuffer(steps, np.uint32), dtype=np.uint32).astype(np.int64)
        ends = np.cumsum(sizes)
        self.lists = {int(t): places[e - n:e] for t, e, n in zip(terms, ends, sizes)}

    def starts(self, lookups: list[tuple[int, int]], slop: int = 0) -> np.ndarray:
        """Where a window begins. `lookups` has terms with their place in the window, the rarest first."""
        term, place = lookups[0]
        found = self.lists.get(term)
        if found is None:
            return np.zeros(0, np.int64)
        found = found - place
        for term, place in lookups[1:]:
            others = self.lists.get(term)
            if others is None or not len(found):
                return np.zeros(0, np.int64)
            wanted = found + place
            at = np.searchsorted(others, wanted)
            right = others[np.minimum(at, len(others) - 1)]
            if not slop:
                found = found[right == wanted]
            else:
                left = others[np.maximum(at - 1, 0)]
                found = found[np.minimum(np.abs(right - wanted), np.abs(left - wanted)) <= slop]
        return found[found >= 0]


def look_up(segments: DataFrame, windows: list[tuple[list[tuple[int, int]], list[int]]], items: list[str],
            slop: int) -> DataFrame:
    """Every document with the runs of words that windows cover, the items found, and the items that are near.

    A window has its lookups and the numbers of the items that hold it.
    """
    key_type = segments.schema["keys"].dataType.elementType
    schema = StructType().add("segment", StringType()).add("row", LongType()).add("key", key_type).add(
        "n_words", LongType()).add("run_starts", ArrayType(LongType())).add("run_ends", ArrayType(LongType())).add(
        "items", ArrayType(StringType())).add("near_items", ArrayType(StringType()))
    shared = segments.sparkSession.sparkContext.broadcast((windows, items))

    def looked_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows, items = shared.value
        for batch in batches:
            for i in range(batch.num_rows):
                name, keys, counts, offsets, terms, sizes, steps = (batch.column(n)[i] for n in segments_names)
                counts, offsets, terms, sizes = (x.values.to_numpy() for x in (counts, offsets, terms, sizes))
                postings = Postings(terms, sizes, steps.as_py())
                change = np.zeros(int(offsets[-1] + counts[-1]) + GAP + 1, np.int64)
                exact, near = set(), set()
                for lookups, holders in windows:
                    found = postings.starts(lookups)
                    if len(found):
                        np.add.at(change, found, 1)
                        np.add.at(change, found + len(lookups), -1)
                        for d in np.unique(np.searchsorted(offsets, found, side="right") - 1).tolist():
                            exact.update((d, h) for h in holders)
                    if slop:
                        found = postings.starts(lookups, slop)
                        for d in np.unique(np.searchsorted(offsets, found, side="right") - 1).tolist():
                            near.update((d, h) for h in holders)
                hit = np.cumsum(change) > 0
                edges = np.diff(hit.astype(np.int8), prepend=0)
                begin, end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
                owner = np.searchsorted(offsets, begin, side="right") - 1
                bounds = np.searchsorted(owner, np.arange(len(counts) + 1)).astype(np.int32)
                runs = [pa.ListArray.from_arrays(pa.array(bounds), pa.array(x - offsets[owner])) for x in (begin, end)]
                names = []
                for pairs in (exact, near):
                    by_doc = [set() for _ in range(len(counts))]
                    for d, h in pairs:
                        by_doc[d].add(items[h])
                    names.append(pa.array([sorted(x) for x in by_doc], pa.list_(pa.string())))
                rows = len(counts)
                yield pa.RecordBatch.from_arrays([
                    pa.array([name.as_py()] * rows), pa.array(np.arange(rows)), keys.values, pa.array(counts), *runs, *names],
                    schema.names)

    segments_names = ["segment", "keys", "n_words", "offsets", "terms", "sizes", "steps"]
    return segments.select(*segments_names).mapInArrow(looked_up, schema)


def benchmark_slices(benchmark: DataFrame, key: str, text: str, most: int) -> Iterator[list[tuple[str, bytes]]]:
    """The items in runs of about `most` bytes at most, dealt by a hash of the text."""
    items = benchmark.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("item"), F.col(text).cast("string").alias("body"))
    size = items.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    count = int(size // most) + 1
    for i in range(count):
        rows = items.filter((F.pmod(F.xxhash64("item", "body"), F.lit(count)) == i) & F.col("body").isNotNull())
        yield [(r.item, r.body.encode()) for r in rows.toLocalIterator()]


def find_passages(documents: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
                  item_key: str = "item_id", item_text: str = "text", width: int = WIDTH, slop: int = 0,
                  slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """Every document with its words, the runs of words that windows cover, and the items found.

    Columns: key, n_words, run_starts and run_ends (places of words, ends excluded), items, near_items.
    """
    if not 0 <= slop < GAP:
        raise ValueError(f"slop must be less than {GAP}")
    def parts() -> Iterator[list[tuple[str, bytes]]]:
        return benchmark_slices(benchmark, item_key, item_text, slice_bytes)

    terms = sorted({w for found in parts() for _, body in found for w in words_of(body)})
    folder = new_folder(documents.sparkSession, "postings")
    index_documents(documents, terms, key, text).write.option("compression", "zstd").parquet(folder)
    segments = documents.sparkSession.read.parquet(folder)
    ids = {t: i for i, t in enumerate(terms)}
    counts = Counter({r.term: r.n for r in segments.select(F.explode(F.arrays_zip("terms", "sizes")).alias("t")).groupBy(
        F.col("t.terms").alias("term")).agg(F.sum("t.sizes").alias("n")).collect()})
    passes = [_one_slice(segments, found, ids, counts, width, slop) for found in parts()]
    result = passes[0]
    if len(passes) > 1:
        for other in passes[1:]:
            result = result.unionByName(other)
        result = result.groupBy("segment", "row").agg(
            F.first("key").alias("key"), F.first("n_words").alias("n_words"),
            F.flatten(F.collect_list(F.arrays_zip("run_starts", "run_ends"))).alias("runs"),
            F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
            F.array_distinct(F.flatten(F.collect_list("near_items"))).alias("near_items"))
        joined = F.aggregate(
            F.array_sort("runs"), F.expr("cast(array() as array<struct<run_starts: bigint, run_ends: bigint>>)"), merge_run)
        result = result.withColumn("runs", joined).select(
            "segment", "row", "key", "n_words", F.col("runs.run_starts").alias("run_starts"),
            F.col("runs.run_ends").alias("run_ends"), F.array_sort("items").alias("items"),
            F.array_sort("near_items").alias("near_items"))
    return result.select(F.col("key").alias(key), "n_words", "run_starts", "run_ends", "items", "near_items")


def merge_run(runs, run):
    """Runs in order, with one more that begins at or after the last of them begins."""
    last = F.try_element_at(runs, F.lit(-1))
    meets = (F.size(runs) > 0) & (run["run_starts"] <= last["run_ends"])
    longer = F.struct(last["run_starts"].alias("run_starts"), F.greatest(last["run_ends"], run["run_ends"]).alias("run_ends"))
    return F.when(meets, F.concat(F.slice(runs, 1, F.size(runs) - 1), F.array(longer))).otherwise(F.concat(runs, F.array(run)))


def _one_slice(segments: DataFrame, found: list[tuple[str, bytes]], ids: dict[bytes, int], counts: Counter, width: int,
               slop: int) -> DataFrame:
    items = sorted({item for item, _ in found})
    number = {item: i for i, item in enumerate(items)}
    holders: dict[tuple[bytes, ...], set[int]] = {}
    for item, body in found:
        for window in windows_of(words_of(body), width):
            holders.setdefault(window, set()).add(number[item])
    plan = []
    for window, numbers in holders.items():
        lookups = sorted(((ids[w], place) for place, w in enumerate(window)), key=lambda x: (counts[x[0]], x))
        if counts[lookups[0][0]]:
            plan.append((lookups, sorted(numbers)))
    return look_up(segments, plan, items, slop)


def joined_digest(items):
    return F.sha2(F.array_join(F.array_sort(items), ",").cast("binary"), 256)


def hit_words():
    return F.aggregate(F.arrays_zip("run_starts", "run_ends"), F.lit(0).cast("long"),
                       lambda total, r: total + r["run_ends"] - r["run_starts"])
