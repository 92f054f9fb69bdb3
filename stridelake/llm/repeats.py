"""Long passages that stand elsewhere too, by suffix arrays over routed passages.

A text is taken as bytes. Each window of `width` bytes has an anchor, the smallest hash of its runs of ANCHOR bytes;
equal windows have equal anchors. Consecutive windows with the same anchor are one passage. A passage whose anchor has
no other, and stands in it once, cannot repeat. The passages of the others are read, equal ones are one entry with the earliest place, and entries with
the same anchor meet in one task, which sorts the suffixes of many anchors at a time (see `suffixes`): windows with a
common prefix of `width` bytes are the same string, all but the earliest of them are repeats.

An anchor with more than HOT windows is split by where the anchor stands in a window, which equal windows have in common:
its passages are cut into runs of windows with near places, shorter texts of which many are equal. Equal ones are one
entry again before anything is sorted, so a passage that stands in very many texts is sorted once. Where even one place
for each group is not enough, the runs are single windows, and the different ones are dealt out by their content.

Every byte of a repeat is removed; repeats are judged on the input. A place is earlier if it has the smaller document
id, or is in the same document and starts earlier. Null texts are empty; a null id is larger than all others. Rows
with equal ids are ordered by a hash of their text, and rows that are equal in both count as one document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from xxhash import xxh64_intdigest
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BooleanType, LongType, StructType

from stridelake.llm import bloom
from stridelake.llm.components import stored
from stridelake.llm.packed import buffers, raw_texts, slices
from stridelake.llm.suffixes import later_windows

WIDTH = 100
ANCHOR = 24
# Windows of an anchor that are sorted in one group at most; beyond, its passages are cut.
HOT = 50_000
# Longer passages are cut into pieces of so many windows. Texts that repeat themselves give equal pieces, whose number
# has many divisors so that it is a multiple of most short periods.
PIECE = 840
SLICE_BYTES = 1 << 20
# Suffixes of so many bytes are sorted at a time, as keys that fit a processor's cache sort several times faster.
SORT_BYTES = 1 << 18
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
PLACE = ["no_id", "id", "mark"]


class Powers:
    """Powers of a number modulo 2^64, as many as were asked for."""

    def __init__(self, base: int):
        self.base, self.held = base, np.ones(1, np.uint64)

    def to(self, count: int) -> np.ndarray:
        while len(self.held) < count:
            self.held = np.concatenate([self.held, self.held * np.uint64(pow(self.base, len(self.held), 1 << 64))])
        return self.held[:count]


UP, DOWN = Powers(BASE), Powers(INVERSE)


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(29))


def running_sums(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What gives the hash of any run of bytes: a difference of sums, with the power of its place divided out."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * UP.to(len(data)))])
    return total, DOWN.to(len(data) + 1)


def run_hashes(total: np.ndarray, down: np.ndarray, anchor: int) -> np.ndarray:
    """The hash of every run of `anchor` bytes."""
    return mixed((total[anchor:] - total[:-anchor]) * down[:len(total) - anchor])


def passages(data: np.ndarray, offsets: np.ndarray, width: int, anchor: int) -> tuple[np.ndarray, ...]:
    """Passages of the texts that lie in data.

    Gives text number, place in it, windows, anchor, hash of the passage, and whether it may repeat itself.
    """
    nothing = (*(np.zeros(0, np.int64) for _ in range(5)), np.zeros(0, bool))
    size = len(data)
    if size < width:
        return nothing
    total, down = running_sums(data)
    least = run_hashes(total, down, anchor)
    runs = least
    # Minimum over width - anchor + 1 runs, by doubling.
    span, reach = width - anchor + 1, 1
    while 2 * reach <= span:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    if span > reach:
        least = np.minimum(least[:-(span - reach)], least[span - reach:])
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:len(least)]
    whole = np.arange(len(least)) + width <= offsets[text + 1]
    joined = np.zeros(len(least), bool)
    joined[1:] = (least[1:] == least[:-1]) & (text[1:] == text[:-1]) & whole[1:] & whole[:-1]
    start = np.flatnonzero(whole & ~joined)
    if not len(start):
        return nothing
    end = np.flatnonzero(whole & ~np.r_[joined[1:], False])
    # A passage repeats itself only if its anchor starts one of its windows and, further on, ends one.
    leading = np.flatnonzero(runs[:len(least)] == least)
    ending = np.flatnonzero(runs[span - 1:] == least)
    first, last = np.searchsorted(leading, start), np.searchsorted(ending, end, side="right") - 1
    inner = (first < len(leading)) & (last >= 0)
    inner[inner] = (leading[first[inner]] <= end[inner]) & (ending[last[inner]] >= start[inner]) & (
        leading[first[inner]] < ending[last[inner]] + span - 1)
    pieces = -(-(end - start + 1) // PIECE)
    number = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    start, end, inner = (np.repeat(x, pieces) for x in (start, end, inner))
    start = start + number * PIECE
    windows = np.minimum(end - start + 1, PIECE)
    content = mixed((total[start + windows + width - 1] - total[start]) * down[start] + windows.astype(np.uint64))
    return (text[start], start - offsets[text[start]], windows, least[start].view(np.int64), content.view(np.int64), inner)


def identified(documents: DataFrame, key: str, text: str) -> DataFrame:
    body = F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")
    return documents.select(
        F.col(key).isNull().alias("no_id"), F.coalesce(F.col(key).cast("long"), F.lit(0).cast("long")).alias("id"),
        F.xxhash64(body).alias("mark"), body.alias("body"))


def anchors(texts: DataFrame, width: int, anchor: int) -> DataFrame:
    """A row for each passage: the document, place, windows and anchor."""
    schema = StructType([texts.schema[c] for c in PLACE])
    for name in ("place", "windows", "anchor"):
        schema = schema.add(name, LongType())
    schema = schema.add("inner", BooleanType())

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "body", SLICE_BYTES):
                data, offsets = buffers(piece.column("body"))
                held = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]]
                owner, place, windows, least, _, inner = passages(held, offsets - offsets[0], width, anchor)
                owner = pa.array(owner)
                yield pa.RecordBatch.from_arrays(
                    [*(piece.column(c).take(owner) for c in PLACE), *map(pa.array, (place, windows, least, inner))],
                    schema.names)

    return texts.select(*PLACE, "body").mapInArrow(found, schema)


def routed(texts: DataFrame, wanted: DataFrame, width: int, anchor: int) -> DataFrame:
    """The wanted passages with their bytes and hash. `wanted` has, by document, the places of passages."""
    joined = texts.join(wanted.groupBy(*PLACE).agg(F.collect_list("place").alias("places")), PLACE)
    schema = StructType([joined.schema[c] for c in PLACE])
    for name, kind in (("place", "long"), ("windows", "long"), ("anchor", "long"), ("content", "long"), ("inner", "boolean"),
                       ("passage", "binary")):
        schema = schema.add(name, kind)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "body", SLICE_BYTES):
                data, offsets = buffers(piece.column("body"))
                first, offsets = offsets[0], offsets - offsets[0]
                held = np.frombuffer(data, np.uint8)[first:first + offsets[-1]]
                owner, place, windows, least, content, inner = passages(held, offsets, width, anchor)
                lists = piece.column("places")
                asked = np.repeat(offsets[:-1], lists.value_lengths().to_numpy()) + lists.flatten().to_numpy()
                kept = np.isin(offsets[owner] + place, asked)
                owner, place, windows, least, content, inner = (x[kept] for x in (owner, place, windows, least, content, inner))
                at = offsets[owner] + place
                raw = held.tobytes()
                bodies = [raw[s:s + n] for s, n in zip(at.tolist(), (windows + width - 1).tolist())]
                owner = pa.array(owner)
                yield pa.RecordBatch.from_arrays([
                    *(piece.column(c).take(owner) for c in PLACE), *map(pa.array, (place, windows, least, content, inner)),
                    pa.array(bodies, pa.binary())], schema.names)

    return joined.select(*PLACE, "body", "places").mapInArrow(read, schema)


def repeats_of(entries: DataFrame, width: int) -> DataFrame:
    """Runs of later windows, as bytes start to end of the document of each entry.

    `entries` has the group, whether the passage may repeat itself, its earliest place, its windows and bytes. Groups
    are sorted in tasks, many at a time; a group is never cut. A group of one entry is left out if it cannot repeat itself.
    """
    schema = StructType([entries.schema[c] for c in PLACE]).add("start", LongType()).add("end", LongType())

    def sorted_(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(rows).combine_chunks()
        order = np.lexsort([table.column(c).to_numpy() for c in ("place", "mark", "id", "no_id")])
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        bodies = table.column("passage").combine_chunks()
        windows = table.column("windows").to_numpy()
        owner, place = later_windows(list(raw_texts(bodies)), windows, rank, width)
        by_place = np.lexsort((place, owner))
        owner, place = owner[by_place], place[by_place]
        first = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (place[1:] != place[:-1] + 1)][:len(owner)])
        last = np.r_[first[1:], len(owner)][:len(first)] - 1
        base = table.column("place").to_numpy()[owner[first]]
        found = pa.array(owner[first])
        return pa.RecordBatch.from_arrays([
            *(table.column(c).combine_chunks().take(found) for c in PLACE),
            pa.array(base + place[first]), pa.array(base + place[last] + width)], schema.names)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, last = [], 0, None
        for batch in batches:
            numbers = batch.column("group").to_numpy()
            if not len(numbers):
                continue
            lengths = np.diff(np.r_[np.flatnonzero(np.r_[True, numbers[1:] != numbers[:-1]]), len(numbers)])
            alone = lengths == 1
            alone[[0, -1]] = False  # the first and last group may have rows in other batches
            kept = ~np.repeat(alone, lengths) | batch.column("inner").to_numpy(zero_copy_only=False)
            batch, numbers = batch.filter(pa.array(kept)), numbers[kept]
            total = buffers(batch.column("passage"))[1]
            begins = np.flatnonzero(np.r_[numbers[0] != last, numbers[1:] != numbers[:-1]])
            at = 0
            while True:  # cut where a group begins, once there is enough to sort
                next_ = int(np.searchsorted(total[begins], total[at] + SORT_BYTES - size))
                if next_ == len(begins):
                    break
                cut = int(begins[next_])
                if cut > at:
                    held.append(batch.slice(at, cut - at))
                if held:
                    yield sorted_(held)
                held, size, at = [], 0, cut
            held.append(batch.slice(at))
            size += int(total[-1] - total[at])
            last = numbers[-1]
        if held:
            yield sorted_(held)

    dealt = entries.repartition("group").sortWithinPartitions("group")
    return dealt.select("group", "inner", *PLACE, "place", "windows", "passage").mapInArrow(found, schema)


def cut_passages(entries: DataFrame, width: int, anchor: int) -> DataFrame:
    """Passages of hot anchors as runs of windows in which the anchor has near places. Columns as those of entries, and group.

    `parts` is the number of groups that an anchor needs. The place of an anchor in a window is where it stands first, so
    it depends on the window alone.
    """
    schema = StructType([entries.schema[c] for c in PLACE]).add("group", LongType()).add("place", LongType()).add(
        "windows", LongType()).add("inner", BooleanType()).add("passage", "binary")
    places = width - anchor + 1

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, groups, starts, counts, texts = [], [], [], [], []
            columns = [batch.column(c).to_pylist() for c in ("anchor", "windows", "parts")]
            for i, (body, least, windows, parts) in enumerate(zip(raw_texts(batch.column("passage")), *columns)):
                stands = np.flatnonzero(run_hashes(*running_sums(np.frombuffer(body, np.uint8)), anchor).view(np.int64) == least)
                window = np.arange(windows)
                at = stands[np.searchsorted(stands, window)] - window
                bucket = at * min(parts, places) // places
                # Single windows are told apart by their content too, where places alone do not give enough groups.
                first = window if parts > places else np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
                for start, end in zip(first.tolist(), [*first[1:].tolist(), windows]):
                    text = body[start:end + width - 1]
                    share = xxh64_intdigest(text) % -(-parts // places) if parts > places else 0
                    owner.append(i)
                    groups.append(xxh64_intdigest(b"%d %d %d" % (least, bucket[start], share)) - (1 << 63))
                    starts.append(start)
                    counts.append(end - start)
                    texts.append(text)
            of = pa.array(owner, pa.int64())
            place = batch.column("place").take(of).to_numpy() + np.array(starts, np.int64)
            yield pa.RecordBatch.from_arrays([
                *(batch.column(c).take(of) for c in PLACE), pa.array(groups, pa.int64()), pa.array(place, pa.int64()),
                pa.array(counts, pa.int64()), batch.column("inner").take(of), pa.array(texts, pa.binary())], schema.names)

    return entries.select(*PLACE, "anchor", "place", "windows", "parts", "inner", "passage").mapInArrow(cut, schema)


def find_repeats(texts: DataFrame, width: int = WIDTH, anchor: int = ANCHOR, hot: int = HOT) -> DataFrame:
    """Bytes start to end of documents (columns no_id, id, mark) that repeats cover; the rows may overlap."""
    seen = anchors(texts, width, anchor)
    shared = seen.groupBy("anchor").agg(F.count("*").alias("n"), F.max("inner").alias("inner")).filter(
        "n > 1 or inner").select("anchor")
    wanted = stored(seen.join(shared, "anchor", "left_semi").select(*PLACE, "place"), "anchors")
    blocks = bloom.block_count(wanted.select(F.approx_count_distinct("id", 0.02)).first()[0])
    known = bloom.bloom_blocks(wanted.select("id", "mark"), ["id", "mark"], blocks)
    found = stored(routed(bloom.possible_hits(texts, ["id", "mark"], known, blocks), wanted, width, anchor), "passages")
    place = F.struct(*PLACE, "place")
    entries = found.groupBy("anchor", "content", "windows").agg(
        F.min(place).alias("first"), F.max("inner").alias("inner"), F.min("passage").alias("passage"))
    entries = stored(entries.select("anchor", "content", "windows", "inner", "first.*", "passage"), "entries")
    hot_anchors = stored(entries.groupBy("anchor").agg(F.sum("windows").alias("n")).filter(F.col("n") > hot).select(
        "anchor", F.ceil(F.col("n") / hot).alias("parts")), "hot")
    sized = entries.join(hot_anchors, "anchor", "left")
    plain = sized.filter("parts is null").select(F.col("anchor").alias("group"), "inner", *PLACE, "place", "windows", "passage")
    pieces = stored(cut_passages(sized.filter("parts is not null"), width, anchor), "pieces")
    piece = ["group", "windows", "passage"]
    different = pieces.groupBy(*piece).agg(F.min(place).alias("first"), F.max("inner").alias("inner"))
    split = different.select("group", "inner", "first.*", "windows", "passage")
    by_suffix = repeats_of(plain.unionByName(split.select(plain.columns)), width)
    again = pieces.select(*piece, *PLACE, "place").join(different.select(*piece, "first"), piece).filter(
        place > F.col("first")).select(*PLACE, F.col("place").alias("start"), (F.col("place") + F.col("windows") + (width - 1)).alias("end"))
    firsts = entries.select("anchor", "content", "windows", F.struct(*PLACE, "place").alias("first"))
    copies = found.select("anchor", "content", "windows", *PLACE, "place").join(
        firsts, ["anchor", "content", "windows"]).filter(F.struct(*PLACE, "place") > F.col("first")).select(
        *PLACE, F.col("place").alias("start"), (F.col("place") + F.col("windows") + (width - 1)).alias("end"))
    return stored(by_suffix.unionByName(again).unionByName(copies), "spans")


def remove_repeats(documents: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH,
                   anchor: int = ANCHOR, hot: int = HOT, with_text: bool = False) -> DataFrame:
    """Every row with its bytes, the spans that repeats cover (ends excluded), and a digest of what is left.

    Columns: key, n_bytes, n_removed, n_spans, span_starts, span_ends, kept_sha256, and kept_text if wanted.
    """
    texts = identified(documents, key, text)
    spans = find_repeats(texts, width, anchor, hot).groupBy(*PLACE).agg(
        F.collect_list("start").alias("starts"), F.collect_list("end").alias("ends"))
    joined = texts.join(spans, PLACE, "left").select("no_id", "id", "body", "starts", "ends")
    schema = "no_id boolean, id long, n_bytes long, n_removed long, n_spans long, span_starts array<long>, " \
        "span_ends array<long>, kept_sha256 string" + (", kept_text binary" if with_text else "")
    names = [part.split()[0] for part in schema.split(", ")]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for body, starts, ends in zip(raw_texts(batch.column("body")), batch.column("starts"), batch.column("ends")):
                begin, stop = merged(starts.values, ends.values)
                kept = b"".join(body[a:b] for a, b in zip([0, *stop], [*begin, len(body)]))
                rows.append((len(body), len(body) - len(kept), len(begin), begin, stop, hashlib.sha256(kept).hexdigest(), kept))
            columns = list(zip(*rows)) or [[]] * 7
            kinds = [pa.int64()] * 3 + [pa.list_(pa.int64())] * 2 + [pa.string(), pa.binary()]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds)][:None if with_text else -1]
            yield pa.RecordBatch.from_arrays([batch.column("no_id"), batch.column("id"), *arrays], names)

    cuts = joined.mapInArrow(cut, schema)
    identity = F.when(~F.col("no_id"), F.col("id")).cast(documents.schema[key].dataType).alias(key)
    return cuts.select(identity, *names[2:])


def merged(starts: pa.Array | None, ends: pa.Array | None) -> tuple[list[int], list[int]]:
    """Spans that meet or overlap, as one."""
    if starts is None or not len(starts):
        return [], []
    a, b = starts.to_numpy(), ends.to_numpy()
    order = np.argsort(a, kind="stable")
    a, reach = a[order], np.maximum.accumulate(b[order])
    first = np.flatnonzero(np.r_[True, a[1:] > reach[:-1]])
    return a[first].tolist(), reach[np.r_[first[1:] - 1, len(a) - 1]].tolist()
