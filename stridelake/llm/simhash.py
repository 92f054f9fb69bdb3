"""Near duplicates by SimHash fingerprints, compared exactly in tiles.

A text's words are separated by white space (space, tab to carriage return) after A-Z is lower-cased. Each run of
`shingle` words is hashed by XXH64 with seed 42; further 64-bit parts of a fingerprint mix that hash. A bit is 1 if
it is set in over half of the hashes. Fewer words than a shingle are one run; no words give a fingerprint of zero.

Distinct fingerprints are dealt into tiles by their population counts. Two fingerprints that differ in at most
`radius` bits have population counts that differ in at most `radius` in total, so only tiles that are that close
are compared, each block of one with each block of the other, by exclusive-or and bit counts. A pair of blocks
returns a spanning forest of its links, which has the same components and at most one row per fingerprint.

`similar_groups` takes the set of a text's shingles, whose fingerprints only say which pairs are looked at: what they
link is compared again, tile by tile, and a pair is joined if the Jaccard similarity of its two sets is high enough.

Null and empty texts are linked with each other as they have equal fingerprints. Repeated rows stay, null ids are
larger than all others.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterator
from fractions import Fraction
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, LongType, StructType
from xxhash import xxh64_intdigest

from stridelake.llm.components import components, stored
from stridelake.llm.packed import LOWER, raw_texts, slices

SEED = 42
SLICE_BYTES = 4 << 20
BLOCK = 2048
WIDE_BLOCK = 16_384
# Shingles of a block whose sets are compared; a set counts as LEAST_SET at least.
SET_BLOCK = 1 << 19
LEAST_SET = 64
# Words of a longer fingerprint that are compared for all pairs of a tile; the rest only if these are near enough.
DENSE = 6
# The share of similar pairs that a radius may lose, and the size up to which its bits are counted exactly.
LOST = 1e-7
COUNTED = 32
TILE_BASE = 64
# More than there are classes of sizes; a power of two.
CLASSES = 128
# Each bit of a byte in a byte of its own.
SPREAD = np.array([sum((b >> i & 1) << 8 * i for i in range(8)) for b in range(256)], np.uint64)
MIX = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB], np.uint64)


def shingle_hashes(text: bytes, shingle: int) -> list[int]:
    words = text.translate(LOWER).split()
    if not words:
        return []
    joined = b" ".join(words)
    if len(words) <= shingle:
        return [xxh64_intdigest(joined, SEED)]
    places = [0, *accumulate([len(w) + 1 for w in words])]
    return [xxh64_intdigest(joined[a:b - 1], SEED) for a, b in zip(places, places[shingle:])]


def shingle_set(text: bytes, shingle: int) -> np.ndarray:
    """The different hashes of a text's shingles in order."""
    return np.unique(np.array(shingle_hashes(text, shingle), np.uint64))


def set_node(held: np.ndarray) -> int:
    """A number for a set of shingles, as a signed 64-bit one."""
    return xxh64_intdigest(held.tobytes(), SEED) - (1 << 63)


def mixed(hashes: np.ndarray, part: int) -> np.ndarray:
    """The hashes themselves for part 0, else further 64 bits of each."""
    if not part:
        return hashes
    h = hashes + np.uint64(int(MIX[0]) * part & (1 << 64) - 1)
    h = (h ^ (h >> np.uint64(30))) * MIX[1]
    h = (h ^ (h >> np.uint64(27))) * MIX[2]
    return h ^ (h >> np.uint64(31))


def majority_bits(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """One 64-bit word per run of `counts` hashes: the bits set in over half of them; zero for empty runs."""
    out = np.zeros(len(counts), np.uint64)
    full = np.flatnonzero(counts)
    if not len(full):
        return out
    sizes = counts[full]
    # Sums of bytes hold up to 255 hashes, so runs are cut into groups of 255 first.
    groups = -(-sizes // 255)
    first = np.cumsum(groups) - groups
    starts = np.repeat(np.cumsum(sizes) - sizes - 255 * first, groups) + 255 * np.arange(groups.sum())
    by_byte = hashes.view(np.uint8).reshape(-1, 8)
    sums = np.stack([np.add.reduceat(SPREAD[by_byte[:, k]], starts) for k in range(8)], axis=1)
    total = np.add.reduceat(sums.view(np.uint8).reshape(len(sums), 64), first, axis=0, dtype=np.int64)
    out[full] = np.packbits(2 * total > sizes[:, None], axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def words_of(runs: list[np.ndarray], parts: int) -> tuple[pa.Array, pa.Array]:
    """Fingerprints of runs of hashes, as lists of 64-bit words, and how many hashes each run has."""
    counts = np.array([len(r) for r in runs], np.int64)
    hashes = np.concatenate(runs)
    words = np.stack([majority_bits(mixed(hashes, p), counts) for p in range(parts)], axis=1)
    return pa.ListArray.from_arrays(
        pa.array(np.arange(0, words.size + 1, parts, dtype=np.int32)), pa.array(words.ravel().view(np.int64))), pa.array(counts)


def rows_of(documents: DataFrame, key: str, text: str) -> DataFrame:
    return documents.select(documents[key].alias("id"), documents[text].cast("string").alias("body"))


def fingerprints(documents: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """Columns id, parts (array of one 64-bit word) and size (number of shingles) of every row."""
    rows = rows_of(documents, key, text)
    schema = StructType(rows.schema.fields[:1]).add("parts", ArrayType(LongType())).add("size", LongType())

    def printed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "body", SLICE_BYTES):
                runs = [np.array(shingle_hashes(t, shingle), np.uint64) for t in raw_texts(piece.column("body"))]
                yield pa.RecordBatch.from_arrays([piece.column("id"), *words_of(runs, 1)], ["id", "parts", "size"])

    return rows.mapInArrow(printed, schema)


def set_fingerprints(documents: DataFrame, key: str, text: str, shingle: int, parts: int) -> DataFrame:
    """Columns id, parts, size (number of different shingles) and node (a number for the set) of every row."""
    rows = rows_of(documents, key, text)
    schema = StructType(rows.schema.fields[:1]).add("parts", ArrayType(LongType())).add("size", LongType()).add("node", LongType())

    def printed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "body", SLICE_BYTES):
                runs = [shingle_set(t, shingle) for t in raw_texts(piece.column("body"))]
                nodes = pa.array([set_node(r) for r in runs], pa.int64())
                yield pa.RecordBatch.from_arrays([piece.column("id"), *words_of(runs, parts), nodes], schema.names)

    return rows.mapInArrow(printed, schema)


def shingle_sets(documents: DataFrame, wanted: DataFrame, key: str, text: str, shingle: int) -> DataFrame:
    """Rows of `wanted` (columns id, node and others) with held, the shingle hashes of the text that has this id and node."""
    rows = rows_of(documents, key, text)
    ids = wanted.select(F.col("id").alias("_id"))
    rows = rows.join(ids, rows["id"].eqNullSafe(ids["_id"]), "left_semi").select("body")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "body", SLICE_BYTES):
                runs = [shingle_set(t, shingle) for t in raw_texts(piece.column("body"))]
                ends = np.cumsum([0, *map(len, runs)])
                held = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(runs).view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array([set_node(r) for r in runs], pa.int64()), held], ["_node", "held"])

    found = rows.mapInArrow(read, "_node long, held array<long>")
    return wanted.join(found, wanted["node"] == found["_node"]).drop("_node", "id").dropDuplicates(["node"])


def tile_of(part: Column) -> Column:
    """The population counts of four 16-bit words, as digits of a number."""
    digits = [F.bit_count(F.shiftrightunsigned(part, 16 * i).bitwiseAND(F.lit(0xFFFF))).cast("long") for i in range(4)]
    total = F.lit(0).cast("long")
    for d in digits:
        total = total * TILE_BASE + d
    return total


def tile_steps(radius: int) -> list[int]:
    """Differences of tile numbers within the radius, of each pair of opposite ones the one that is not negative."""
    steps = set()
    for step in itertools.product(range(-radius, radius + 1), repeat=4):
        if sum(map(abs, step)) <= radius:
            number = 0
            for d in step:
                number = number * TILE_BASE + d
            steps.add(number)
    return sorted(s for s in steps if s >= 0)


def alike(own: np.ndarray, sets: list[np.ndarray], least: Fraction) -> np.ndarray:
    """Which of the sets, each of different hashes in order, have at least this Jaccard similarity with the own one."""
    sizes = np.array([len(x) for x in sets])
    values = np.concatenate(sets)
    hits = own[np.minimum(np.searchsorted(own, values), len(own) - 1)] == values
    common = np.add.reduceat(hits, np.cumsum(sizes) - sizes, dtype=np.int64)
    return common * least.denominator >= (len(own) + sizes - common) * least.numerator


def checked(own: np.ndarray, sets: list[np.ndarray], found: np.ndarray, label: np.ndarray, least: Fraction) -> np.ndarray:
    """Places found, nearest first, of sets alike with the own one; those that an earlier one leads to are left out."""
    kept, most = [found[:0]], 4
    while len(found):
        some, found = found[:most], found[most:]
        some = some[alike(own, [sets[k] for k in some], least)]
        found = found[~np.isin(label[found], label[some])]
        kept.append(some)
        most = min(4 * most, 1024)
    return np.concatenate(kept)


def forest(a: np.ndarray, b: np.ndarray, radius: int,
           check: Callable[[int, np.ndarray, np.ndarray], np.ndarray] | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links of rows of a with rows of b (each a row of 64-bit words) within the radius, as places in a and b.

    The links returned connect what all links connect. A link of two rows of b is given as (-1 - place, place). `check`
    gets a place in a, places in b that are near it, nearest first, and the labels of b; it returns those that are linked.
    """
    label = np.arange(len(b))
    step = max(1, (1 << 20) // max(1, len(b)))
    for at in range(0, len(a), step):
        rows = a[at:at + step]
        near = np.bitwise_count(rows[:, None, 0] ^ b[None, :, 0])
        for part in range(1, min(DENSE, a.shape[1])):  # a wrapped sum only makes a pair look nearer
            near += np.bitwise_count(rows[:, None, part] ^ b[None, :, part])
        i, j = np.nonzero(near <= radius)
        if a.shape[1] > 1:
            apart = np.bitwise_count(rows[i] ^ b[j]).sum(axis=1, dtype=np.int64)
            if check:
                order = np.lexsort((apart, i))
                i, j, apart = i[order], j[order], apart[order]
            i, j = i[apart <= radius], j[apart <= radius]
        if not len(i):
            continue
        cuts = np.flatnonzero(np.r_[True, i[1:] != i[:-1]])
        for start, end in zip(cuts, np.r_[cuts[1:], len(i)]):
            found = j[start:end]
            if check:
                found = check(at + i[start], found, label)
            groups = np.unique(label[found])
            if len(groups):
                yield np.array([at + i[start]]), groups[:1]
            if len(groups) > 1:
                label[np.isin(label, groups)] = groups[0]
                yield -1 - np.repeat(groups[:1], len(groups) - 1), groups[1:]


def tile_links(prints: DataFrame, steps: list[int], radius: int | Column, parts: int, most: int | None = None,
               least: Fraction | None = None) -> DataFrame:
    """Links u, v of distinct fingerprints within the radius, which may depend on tile_a. `prints` has node, parts and tile.

    A tile of more than `most` fingerprints is cut into blocks. What is moved falls with the size of blocks. With `least`,
    prints have held too, their shingle sets, which must have this Jaccard similarity; `most` counts shingles then.
    """
    most = most or BLOCK
    sets = ["held"] if least else []
    prints = stored(prints.select("node", "parts", "tile", *sets), "prints")
    counts = prints.groupBy("tile").agg((F.sum(F.greatest(F.size("held"), F.lit(LEAST_SET))) if sets else F.count("*")).alias("n"))
    tiles = stored(counts.select("tile", F.ceil(F.col("n") / most).cast("int").alias("blocks")), "tiles")
    block = F.pmod(F.xxhash64("node"), F.col("blocks").cast("long")).cast("int")
    blocks = stored(prints.join(tiles, "tile").withColumn("block", block).groupBy("tile", "block").agg(
        F.collect_list(F.struct("node", "parts", *sets)).alias("rows")), "blocks").select(
        "tile", "block", F.col("rows.node").alias("nodes"), F.flatten("rows.parts").alias("words"),
        *([F.transform("rows.held", lambda x: F.size(x).cast("long")).alias("sizes"), F.flatten("rows.held").alias("held")] if sets else []))
    arrays = [c for c in blocks.columns if c not in ("tile", "block")]
    left = tiles.select(F.col("tile").alias("tile_a"), F.col("blocks").alias("blocks_a"),
                        F.explode(F.array(*[F.lit(s) for s in steps])).alias("step"))
    pairs = left.withColumn("tile_b", F.col("tile_a") + F.col("step")).join(
        tiles.select(F.col("tile").alias("tile_b"), F.col("blocks").alias("blocks_b")), "tile_b")
    pairs = pairs.select("tile_a", "tile_b", "blocks_b", F.explode(F.sequence(F.lit(0), F.col("blocks_a") - 1)).alias("block_a"))
    first = F.when(F.col("tile_a") == F.col("tile_b"), F.col("block_a")).otherwise(F.lit(0))
    pairs = pairs.select("tile_a", "tile_b", "block_a", F.explode(F.sequence(first, F.col("blocks_b") - 1)).alias("block_b"))
    work = pairs.join(blocks.select(*[F.col(c).alias(f"{c}_a") for c in blocks.columns]), ["tile_a", "block_a"]).join(
        blocks.select(*[F.col(c).alias(f"{c}_b") for c in blocks.columns]), ["tile_b", "block_b"]).select(
        F.lit(radius).alias("radius"), *[f"{c}_{side}" for side in "ab" for c in arrays])

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            us, vs = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for row in range(batch.num_rows):
                within = batch.column(0)[row].as_py()
                held = [column[row].values.to_numpy().astype(np.int64) for column in batch.columns[1:]]
                (nodes_a, words_a, *sets_a), (nodes_b, words_b, *sets_b) = held[:len(arrays)], held[len(arrays):]
                a, b = (w.view(np.uint64).reshape(-1, parts) for w in (words_a, words_b))
                check = None
                if least:
                    own, others = ([x.view(np.uint64) for x in np.split(all_, np.cumsum(sizes)[:-1])] for sizes, all_ in (sets_a, sets_b))
                    check = lambda i, found, label: checked(own[i], others, found, label, least)
                for i, j in forest(a, b, within, check):
                    us.append(nodes_b[-1 - i] if i[0] < 0 else nodes_a[i])
                    vs.append(nodes_b[j])
            u, v = np.concatenate(us), np.concatenate(vs)
            yield pa.RecordBatch.from_arrays([pa.array(u[u != v]), pa.array(v[u != v])], ["u", "v"])

    # The last join has dealt the pairs out by their second block; a block has a bounded number of rows in any tile.
    return work.mapInArrow(compared, "u long, v long")


def grouped(prints: DataFrame, links: DataFrame, node: str = "node") -> DataFrame:
    """Add component_id, the smallest id that links reach, to rows with id and node."""
    roots = components(links)
    distinct = prints.groupBy(node).agg(F.min("id").alias("least"))
    with_root = distinct.join(roots, distinct[node] == roots["node"], "left").select(
        distinct[node].alias("_node"), "least", F.coalesce(roots["root"], distinct[node]).alias("root"))
    names = stored(with_root, "roots")
    ids = names.groupBy("root").agg(F.min("least").alias("component_id"))
    found = names.join(ids, "root").select("_node", "component_id")
    return prints.join(found, prints[node] == found["_node"], "left").drop("_node")


def flip_share(a: int, b: int, common: int) -> float:
    """The share of bits in which fingerprints of sets of a and b hashes differ that have so many in common."""
    def ones(n: int) -> np.ndarray:
        return np.array([math.comb(n, k) for k in range(n + 1)]) / 2 ** n

    def over_half(n: int) -> np.ndarray:  # by the number of common hashes that have the bit
        rest = ones(n - common)
        return np.array([sum(p for k, p in enumerate(rest) if 2 * (held + k) > n) for held in range(common + 1)])

    one, other = over_half(a), over_half(b)
    return float((ones(common) * (one * (1 - other) + other * (1 - one))).sum())


def bits_within(share: float, bits: int) -> int:
    """The fewest bits that hold all but LOST of what differs in each bit with this probability."""
    tail = 0.0
    for k in range(bits, -1, -1):
        tail += math.comb(bits, k) * share ** k * (1 - share) ** (bits - k)
        if tail > LOST:
            return k
    return 0


def wide_radius(similarity: float, parts: int, size: int | None = None) -> int:
    """Bits in which fingerprints of sets with this Jaccard similarity differ at most, but for a share of LOST.

    `size` is that of the smaller set. Small sets have their bits counted, as sums of few hashes are often equal to a
    half; for others 5 % are added to the angle of their sums, which is more than what counting gives beyond COUNTED.
    """
    least = Fraction(str(similarity))
    share = math.acos(2 * similarity / (1 + similarity)) / math.pi * 1.05
    if size and size <= COUNTED:
        share = max(flip_share(size, b, math.ceil(least * (size + b) / (1 + least))) for b in range(size, math.floor(size / least) + 1))
    return bits_within(share, 64 * parts)


def similar_groups(documents: DataFrame, key: str, text: str = "text", shingle: int = 5, similarity: float = 0.8,
                   parts: int = 8) -> DataFrame:
    """Every row (columns id and component_id) with the smallest key of the texts that similar ones lead to.

    Similarity is that of the sets of word shingles. Fingerprints of 64 times `parts` bits, compared between texts whose
    numbers of different shingles are near enough, give candidates; the sets of what these lead to decide. Sets so small
    that one shingle more or less is too many are grouped only if they are equal.
    """
    least = Fraction(str(similarity))
    prints = stored(set_fingerprints(documents, key, text, shingle, parts), "fingerprints")
    width = -math.log(similarity)
    smallest = math.ceil(least / (1 - least)) if least < 1 else math.inf
    if smallest == math.inf:
        return grouped(prints, prints.select(F.col("node").alias("u"), F.col("node").alias("v"))).select("id", "component_id")
    nodes = prints.filter(F.col("size") >= smallest).groupBy("node").agg(
        F.min("id").alias("id"), F.first("parts").alias("parts"), F.first("size").alias("size")).withColumn(
        "class", F.floor(F.log(F.col("size").cast("double")) / F.lit(width)).cast("long"))
    nodes = stored(nodes, "sets")
    radii: dict[int, int] = {}
    for size in range(smallest, COUNTED + 2):
        of = math.floor(math.log(size) / width)
        radii[of] = max(radii.get(of, 0), wide_radius(similarity, parts, size))
    table = [radii.get(k, max(radii.values())) for k in range(max(radii) + 1)]
    radius = F.element_at(F.array(*map(F.lit, table)), F.least(F.pmod("tile_a", F.lit(CLASSES)), F.lit(len(table) - 1)).cast("int") + 1)
    near = tile_links(nodes.withColumn("tile", F.col("class")), [0, 1], radius, parts, WIDE_BLOCK)
    roots = components(near)
    # Classes of a small group are one tile. Groups with equal numbers share tiles, which only costs comparisons.
    found = stored(nodes.join(roots.select(F.col("node").alias("_node"), "root"), F.col("node") == F.col("_node")).drop("_node"), "candidates")
    weight = found.groupBy("root").agg(F.sum(F.greatest("size", F.lit(LEAST_SET))).alias("weight"))
    found = found.join(weight, "root").withColumn("tile", F.shiftrightunsigned(F.xxhash64("root"), 1).bitwiseAND(F.lit(-CLASSES)) + F.when(
        F.col("weight") > SET_BLOCK, F.col("class")).otherwise(0))
    sets = shingle_sets(documents, found.select("id", "node", "parts", "tile"), key, text, shingle)
    links = tile_links(sets, [0, 1], radius, parts, SET_BLOCK, least)
    return grouped(prints, links).select("id", "component_id")


def near_duplicates(documents: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3,
                    radius: int = 3) -> DataFrame:
    """Every row with its 64-bit fingerprint and the smallest id of its component."""
    prints = stored(fingerprints(documents, key, text, shingle).select(
        "id", F.element_at("parts", 1).alias("node"), "size"), "fingerprints")
    nodes = prints.select("node").distinct().select("node", F.array("node").alias("parts"), tile_of(F.col("node")).alias("tile"))
    found = grouped(prints, tile_links(nodes, tile_steps(radius), radius, 1))
    return found.select(F.col("id").alias(key), F.lower(F.lpad(F.hex("node"), 16, "0")).alias("fingerprint"),
                        "component_id", F.col("size").alias("n_shingles"))
