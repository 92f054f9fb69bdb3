"""Quality of whole texts by a vote of their nearest labelled neighbours in a latent-semantic space.

A text's terms are its hashed words and its shape: runs of letters, digits and each kind of punctuation, three at a
time, and words that repeat the word before. Weights are log counts times inverse document frequency. The largest
singular directions of a bounded sample of labelled texts span the space; its labelled vectors are broadcast, which is
safe as their number is a parameter. Every text is compared with all of them by cosine, in blocks, and the labels of
the nearest are weighted by similarity. Only the text is an input of a score.

Null texts count as empty; a text without terms gets the share of label 1 among all usable labels. Labels that
are null or come from rows that are held out are not used; without usable labels every score is 0.5. Repeated rows
get equal scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructType

from stridelake.llm.names import free_name
from stridelake.llm.packed import LOWER, WORD_BYTES, buffers, slices

# The sample that is labelled vectors: so many texts of each label at most, the same share of any input of that size.
EXAMPLES = 1024
DIRECTIONS = 48
NEIGHBOURS = 15
SHARPNESS = 8.0
WORD_TERMS = 2048
SHAPE_TERMS = 4096
WORD_WEIGHT = 0.3
TERMS = SHAPE_TERMS + 2 + WORD_TERMS
PARTS = (
    (slice(0, SHAPE_TERMS), 1.0), (slice(SHAPE_TERMS, SHAPE_TERMS + 2), 0.7), (slice(SHAPE_TERMS + 2, TERMS), WORD_WEIGHT))
SLICE_BYTES = 2 << 20
BLOCK_ROWS = 512


def _classes() -> np.ndarray:
    """The shape class of every byte, 0 to 15."""
    kinds = np.full(256, 15, np.uint8)
    kinds[128:] = kinds[ord("a"):ord("z") + 1] = 1
    kinds[ord("A"):ord("Z") + 1] = 2
    kinds[ord("0"):ord("9") + 1] = 3
    for kind, chars in enumerate((" \t", "\n\r", ".", ",;:", "!", "?", "|", "*#", "&%$", "'\"", "()[]{}<>"), 4):
        kinds[[ord(c) for c in chars]] = kind
    kinds[195] = 1
    return kinds


CLASSES = _classes()
LOWERED = np.frombuffer(LOWER, np.uint8)
IN_WORD = np.frombuffer(WORD_BYTES, np.uint8) != 32
BASE = 0x9E3779B97F4A7C15 | 1


def _powers(count: int, base: int) -> np.ndarray:
    """base^0 .. base^(count-1) modulo 2^64."""
    out = np.ones(1, np.uint64)
    while len(out) < count:
        out = np.concatenate([out, out * np.uint64(pow(base, len(out), 1 << 64))])
    return out[:count]


def term_counts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, terms and counts of the texts that lie in data from offset to offset."""
    size = len(data)
    if not size:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.zeros(size, bool)
    first[offsets[:-1][offsets[:-1] < size]] = True
    kinds = CLASSES[data]
    change = first.copy()
    change[1:] |= kinds[1:] != kinds[:-1]
    at = np.flatnonzero(change)
    shape, owner = kinds[at].astype(np.int64), np.searchsorted(offsets, at, side="right") - 1
    same = owner[2:] == owner[:-2]
    triple = (shape[:-2] * 256 + shape[1:-1] * 16 + shape[2:])[same]
    keys = [owner[:-2][same] * TERMS + triple]
    # Words as hashes: differences of one running sum, with the power of their place divided out.
    low = LOWERED[data]
    inside = IN_WORD[data]
    begins = inside & (np.r_[True, ~inside[:-1]] | first)
    ends = inside & np.r_[~inside[1:] | first[1:], True]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends)
    if len(start):
        total = np.cumsum(low.astype(np.uint64) * _powers(size, BASE))
        before = np.where(start > 0, total[start - 1], np.uint64(0))
        word = (total[end] - before) * _powers(size, pow(BASE, -1, 1 << 64))[start]
        word ^= word >> np.uint64(29)
        word *= np.uint64(0xBF58476D1CE4E5B9)
        owner = np.searchsorted(offsets, start, side="right") - 1
        keys.append(owner * TERMS + SHAPE_TERMS + 2 + (word >> np.uint64(40)).astype(np.int64) % WORD_TERMS)
        pair = owner[1:] == owner[:-1]
        again = np.where(word[1:] == word[:-1], 0, 1)
        keys.append((owner[1:] * TERMS + SHAPE_TERMS + again)[pair])
    found, count = np.unique(np.concatenate(keys), return_counts=True)
    return found // TERMS, found % TERMS, count


def weighted(rows: int, row: np.ndarray, term: np.ndarray, count: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Dense term vectors of unit length; shape, repetition and words are brought to a length of their own first."""
    out = np.zeros((rows, TERMS), np.float32)
    out[row, term] = np.log1p(count) * np.where((term >= SHAPE_TERMS) & (term < SHAPE_TERMS + 2), 1, idf[term])
    for part, weight in PARTS:
        length = np.linalg.norm(out[:, part], axis=1, keepdims=True)
        out[:, part] *= weight / np.where(length > 0, length, 1)
    return out


@dataclass
class Model:
    idf: np.ndarray
    directions: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float

    def score(self, rows: int, row: np.ndarray, term: np.ndarray, count: np.ndarray) -> np.ndarray:
        if not len(self.labels):
            return np.full(rows, self.prior)
        near = unit(weighted(rows, row, term, count, self.idf) @ self.directions) @ self.vectors.T
        k = min(NEIGHBOURS, near.shape[1])
        best = np.argpartition(-near, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(near, best, axis=1), 0).astype(np.float64) ** SHARPNESS
        total = weight.sum(axis=1)
        return np.clip((weight * self.labels[best] @ np.ones(k) + 1e-9 * self.prior) / (total + 1e-9), 0.0, 1.0)


def unit(vectors: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(vectors, axis=1, keepdims=True)
    return vectors / np.where(length > 1e-9, length, 1)


def fit(texts: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, prior: float) -> Model:
    """The space and the labelled vectors. Each text comes as its terms and their counts."""
    row = np.repeat(np.arange(len(texts)), [len(t) for t, _ in texts])
    term = np.concatenate([t for t, _ in texts] or [np.zeros(0, np.int64)]).astype(np.int64)
    count = np.concatenate([c for _, c in texts] or [np.zeros(0, np.int64)])
    idf = np.log((1 + len(texts)) / (1 + np.bincount(term, minlength=TERMS))).astype(np.float32) + np.float32(0.1)
    if not len(texts):
        return Model(idf, np.zeros((TERMS, 1), np.float32), np.zeros((0, 1), np.float32), labels, prior)
    matrix = weighted(len(texts), row, term, count, idf)
    # The right singular vectors, from the products of the texts with each other.
    values, left = np.linalg.eigh(matrix @ matrix.T)
    held = np.argsort(-values)[:DIRECTIONS]
    held = held[values[held] > 1e-6]
    directions = (matrix.T @ left[:, held]) / np.sqrt(values[held])
    return Model(idf, directions.astype(np.float32), unit(matrix @ directions), labels, prior)


def is_held_out(key: Column) -> Column:
    return F.crc32(key.cast("string")) % 3 == 1


def blocks_of(batch: pa.RecordBatch, column: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    for piece in slices(batch, column, SLICE_BYTES):
        for at in range(0, piece.num_rows, BLOCK_ROWS):
            block = piece.slice(at, BLOCK_ROWS)
            data, offsets = buffers(block.column(column))
            held = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]]
            yield block, *term_counts(held, offsets - offsets[0])


def examples(documents: DataFrame, labels: DataFrame, key: str, text: str, label: str, most: int) -> DataFrame:
    """Terms and counts of labelled texts that are not held out: the `most` of each label with the smallest hash."""
    usable = labels.filter(labels[label].isin(0, 1) & labels[key].isNotNull() & ~is_held_out(labels[key])).select(
        labels[key].alias("key"), labels[label].cast("int").alias("label"))
    chosen = [usable.filter(F.col("label") == v).groupBy("key").agg(F.max("label").alias("label")).orderBy(
        F.xxhash64(F.col("key").cast("string")), "key").limit(most) for v in (0, 1)]
    rows = documents.select(documents[key].alias("key"), documents[text].cast("string").alias("body")).join(
        F.broadcast(chosen[0].unionByName(chosen[1])), "key")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, row, term, count in blocks_of(batch, "body"):
                bounds = pa.array(np.searchsorted(row, np.arange(block.num_rows + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays([
                    block.column("key"), block.column("label"), pa.ListArray.from_arrays(bounds, pa.array(term, pa.int32())),
                    pa.ListArray.from_arrays(bounds, pa.array(count, pa.int32()))], ["key", "label", "terms", "counts"])

    schema = StructType([rows.schema["key"], rows.schema["label"]]).add(
        "terms", ArrayType(IntegerType())).add("counts", ArrayType(IntegerType()))
    return rows.mapInArrow(counted, schema)


def train(documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
          most: int = EXAMPLES) -> Model:
    usable = labels.filter(labels[label].isin(0, 1) & ~is_held_out(labels[key]))
    prior = usable.agg(F.avg(labels[label].cast("double"))).first()[0]
    found = examples(documents, labels, key, text, label, most).toArrow().sort_by([("key", "ascending"), ("label", "ascending")])
    texts = [(np.array(t, np.int64), np.array(c, np.int64)) for t, c in zip(
        found.column("terms").to_pylist(), found.column("counts").to_pylist())]
    return fit(texts, found.column("label").to_numpy().astype(np.float64), 0.5 if prior is None else prior)


def score(documents: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None,
          name: str = "score") -> DataFrame:
    """Every row with its score from 0 to 1; `keep` names the columns that stay, all by default."""
    source = free_name(documents, "scored_text")
    kept = [c for c in (documents.columns if keep is None else keep) if c != name]
    rows = documents.select(*[documents[c] for c in kept], documents[text].cast("string").alias(source))
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, row, term, count in blocks_of(batch, source):
                found = shared.value.score(block.num_rows, row, term, count)
                yield pa.RecordBatch.from_arrays([*(block.column(c) for c in kept), pa.array(found)], [*kept, name])

    return rows.mapInArrow(scored, StructType(rows.schema.fields[:-1]).add(name, "double"))
