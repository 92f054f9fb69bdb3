"""Audit of how far sources diverge: the terms of every source against those of its language and of other sources.

A term is a run of letters and characters over 127, with A-Z lower-cased. Every language keeps the terms that stand in
at least `least` of its documents. A group is a language and a source; each kept term gets, in a group, the smoothed
share p = 1 + floor(10^9 (count + 2) / (N + 2 V)), where N is the number of occurrences of kept terms there and V the
number of kept terms; the language has shares of its own. Two shares differ by floor((p - q)^2 / (p + q)).

Strings come late. Tasks count terms and store one row per term and group of what they held at a time; all that is
shuffled of it to count, to keep terms and to compare groups is a digest of 64 bits. A Bloom filter of kept digests,
of bounded size, passes their rows, of which tasks find the smallest and the largest string before those are shuffled;
where they differ, the digest is shared by several terms, and just its rows are counted once more by their strings.
Texts of terms are joined back for the highest terms only.

Groups are compared in tiles: a task has the shares of two tiles of groups for CHUNK terms at most. A pair of groups is
a row of the result, so the pairs are as many as asked for; terms that neither group of a tile has are not listed but
counted, as all of them differ alike.

Null texts, languages and sources are empty ones. A group without terms is compared like any other, with counts of
zero; without kept terms every pair differs by 0. Repeated rows count as often as they stand there. An empty table has
no rows. Very long texts are counted whole.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from stridelake.llm import bloom
from stridelake.llm.components import stored
from stridelake.llm.packed import raw_texts

LEAST_DOCUMENTS = 10
SCALE = 1_000_000_000
# Different terms that a task counts before it passes them on.
HELD_TERMS = 500_000
# Terms and groups that a task compares at a time.
CHUNK = 4096
TILE = 128
# A-Z to a-z; every byte that is no part of a term becomes a space.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
COUNTS = "lang string, source string, digest long, term string, n long, docs long, first boolean"
GROUP = ["lang", "source"]
KEY = ["lang", "digest"]
TERM = ["lang", "digest", "split"]


def digest64(term: bytes) -> int:
    """A digest of fixed width, as a signed whole number."""
    return xxhash.xxh64_intdigest(term) - (1 << 63)


def count_terms(documents: DataFrame, text: str, lang: str, source: str, digest: Callable[[bytes], int]) -> DataFrame:
    """Rows of language, source, digest, term, occurrences and documents; a term may have several rows.

    A group has a row without a digest, so that it is known even if it has no terms. Of the rows that a task has of a
    term in a language, one at a time is marked as first.
    """
    rows = documents.select(
        F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("lang"),
        F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"), F.col(text).cast("string").alias("body"))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        size = 0

        def passed_on() -> Iterator[pa.RecordBatch]:
            seen: dict[str, set[bytes]] = {}
            for (lang_, source_), (occurrences, standing) in held.items():
                terms = list(occurrences)
                count = len(terms) + 1
                known = seen.setdefault(lang_, set())
                first = [t not in known for t in terms]
                known.update(terms)
                yield pa.RecordBatch.from_arrays([
                    pa.array([lang_] * count), pa.array([source_] * count),
                    pa.array([None, *map(digest, terms)], pa.int64()),
                    pa.array([None, *(t.decode() for t in terms)], pa.string()),
                    pa.array([0, *map(occurrences.__getitem__, terms)], pa.int64()),
                    pa.array([0, *map(standing.__getitem__, terms)], pa.int64()), pa.array([False, *first])],
                    ["lang", "source", "digest", "term", "n", "docs", "first"])

        for batch in batches:
            groups = zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist())
            for group, body in zip(groups, raw_texts(batch.column("body"))):
                if group not in held:
                    held[group] = Counter(), Counter()
                occurrences, standing = held[group]
                before = len(occurrences)
                terms = body.translate(TERM_BYTES).split()
                occurrences.update(terms)
                standing.update(set(terms))
                size += len(occurrences) - before + 1
                if size >= HELD_TERMS:
                    yield from passed_on()
                    held, size = {}, 0
        yield from passed_on()

    return rows.mapInArrow(counted, COUNTS)


def likely_terms(counts: DataFrame, least: int) -> DataFrame:
    """Languages and digests with enough documents: those of all kept terms, and of terms that only reach it together."""
    held = counts.filter("digest is not null")
    summed = held.groupBy(*KEY).agg(F.sum("docs").alias("docs"))
    return stored(summed.filter(F.col("docs") >= least).select(*KEY), "divergence-likely")


def rows_of(counts: DataFrame, likely: DataFrame) -> DataFrame:
    """The rows that may be of likely digests: a Bloom filter of bounded size lets most others go before any shuffle.

    What it lets pass without reason is removed by the exact joins behind it.
    """
    blocks = bloom.block_count(likely.count())
    held = counts.filter("digest is not null")
    return bloom.possible_hits(held, KEY, stored(bloom.bloom_blocks(likely, KEY, blocks), "divergence-bloom"), blocks)


def kept_terms(held: DataFrame, likely: DataFrame, least: int) -> DataFrame:
    """Language, digest and split of every kept term, with its text.

    `split` is empty where a digest has one term, which is nearly always, and is the term itself where it has several.
    Only the smallest and the largest string that a task has of a digest are shuffled, and found among first rows.
    """
    ends = held.filter("first").groupBy(*KEY).agg(F.min("term").alias("low"), F.max("term").alias("high"))
    spans = stored(ends.join(likely, KEY, "left_semi"), "divergence-spans")
    alone = spans.filter("low = high").select("lang", "digest", F.lit("").alias("split"), F.col("low").alias("term"))
    shared = spans.filter("low <> high").select("lang", "digest")
    if shared.isEmpty():
        return alone
    apart = held.join(shared, KEY, "left_semi").groupBy("lang", "digest", "term").agg(
        F.sum("docs").alias("docs")).filter(F.col("docs") >= least)
    return stored(alone.unionByName(apart.select("lang", "digest", F.col("term").alias("split"), "term")), "divergence-kept")


def group_counts(held: DataFrame, kept: DataFrame) -> DataFrame:
    """Occurrences of every kept term in every group that has it; strings only where a digest is shared."""
    alone = kept.filter("split = ''").select("lang", "digest", "split")
    plain = held.select(*GROUP, "digest", "n").join(alone, KEY).groupBy(*GROUP, "digest", "split").agg(
        F.sum("n").alias("n"))
    shared = kept.filter("split <> ''").select("lang", "digest", "split")
    if shared.isEmpty():
        return plain
    told = held.withColumnRenamed("term", "split").join(shared, TERM, "left_semi").groupBy(*GROUP, "digest", "split").agg(
        F.sum("n").alias("n"))
    return plain.unionByName(told)


def share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE (count + 2) / (total + 2 terms)), exact; 1 where no term is kept."""
    whole = F.lit(SCALE).cast("decimal(10,0)") * (count + 2).cast("decimal(20,0)")
    parts = F.greatest(total + terms * 2, F.lit(1).cast("long")).cast("decimal(20,0)")
    return F.when(terms > 0, F.call_function("div", whole, parts) + 1).otherwise(F.lit(1).cast("long"))


def difference(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q)); shares are at most SCALE + 1, so the square fits."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def with_shares(counts: DataFrame, kept: DataFrame, found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Groups with N, V and the share of an absent term, and group counts with the shares of group and language."""
    sizes = kept.groupBy("lang").agg(F.count("*").alias("terms"))
    totals = found.groupBy(*GROUP).agg(F.sum("n").alias("total"))
    every = counts.filter("digest is null").select(*GROUP).distinct()
    groups = every.join(totals, GROUP, "left").join(sizes, "lang", "left").select(
        *GROUP, F.coalesce("total", F.lit(0).cast("long")).alias("total"), F.coalesce("terms", F.lit(0).cast("long")).alias("terms"))
    groups = stored(groups.withColumn("absent", share(F.lit(0).cast("long"), F.col("total"), F.col("terms"))), "divergence-groups")
    langs = groups.groupBy("lang").agg(F.sum("total").alias("lang_total"), F.max("terms").alias("terms"))
    of_lang = found.groupBy(*TERM).agg(F.sum("n").alias("n")).join(langs, "lang").select(
        *TERM, share(F.col("n"), F.col("lang_total"), F.col("terms")).alias("q"))
    shares = found.join(groups, GROUP).withColumn("p", share(F.col("n"), F.col("total"), F.col("terms")))
    return groups, stored(shares.select(*GROUP, "digest", "split", "p").join(of_lang, TERM), "divergence-shares")


def highest_terms(shares: DataFrame, kept: DataFrame, most: int) -> DataFrame:
    """The terms that a group has most in excess of its language. Only what may be among them gets its text."""
    by_value = W.partitionBy(*GROUP).orderBy(F.desc("value"))
    likely = shares.filter("p > q").withColumn("value", difference(F.col("p"), F.col("q"))).withColumn(
        "place", F.rank().over(by_value)).filter(F.col("place") <= most).drop("place", "p", "q")
    texts = likely.join(kept, TERM).select(*GROUP, F.lit("term").alias("part"), F.col("term").alias("item"), "value")
    return ranked(texts, most)


def ranked(items: DataFrame, most: int | None = None) -> DataFrame:
    placed = items.withColumn("rank", F.row_number().over(W.partitionBy(*GROUP).orderBy(F.desc("value"), "item")))
    return placed if most is None else placed.filter(F.col("rank") <= most)


def _tile_sums(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Sums over the terms of a chunk for the pairs of groups of two tiles, and how many terms that were."""
    lang, _, a, b = key
    marks = rows["mark"].to_numpy(bool)
    groups = rows[marks].sort_values(["tile", "source"], ignore_index=True)
    terms = rows[~marks]
    column = terms.groupby(["digest", "split"], sort=False).ngroup().to_numpy()
    seen = int(column.max()) + 1 if len(column) else 0
    line = pd.Index(groups["source"]).get_indexer(terms["source"])
    table = np.repeat(groups["p"].to_numpy(np.int64)[:, None], seen, axis=1)
    table[line, column] = terms["p"].to_numpy(np.int64)
    first, names = int((groups["tile"] == a).sum()), np.array(groups["source"].tolist(), object)
    ones, others, sums = [], [], []
    for i in range(first):
        beside = np.arange(i + 1 if a == b else first, len(names))
        away, both = table[beside] - table[i], table[beside] + table[i]
        ones.append(np.full(len(beside), i))
        others.append(beside)
        sums.append((away * away // both).sum(axis=1))
    one, other = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (ones, others))
    return pd.DataFrame({"lang": np.full(len(one), lang, object), "one": names[one], "other": names[other],
                         "sum": np.concatenate([np.zeros(0, np.int64), *sums]), "seen": np.full(len(one), seen)})


def source_pairs(groups: DataFrame, shares: DataFrame) -> DataFrame:
    """Every group with every other one of its language, by how far they differ over all kept terms."""
    sizes = groups.groupBy("lang").agg(
        (F.floor((F.count("*") - 1) / TILE) + 1).alias("tiles"), F.greatest(F.floor((F.max("terms") - 1) / CHUNK) + 1, F.lit(1)).alias("chunks"))
    tile = F.pmod(F.xxhash64("source"), F.col("tiles"))
    chunk = F.pmod(F.xxhash64("digest", "split"), F.col("chunks"))
    marks = groups.join(sizes, "lang").select(
        *GROUP, tile.alias("tile"), "tiles", F.lit(True).alias("mark"), F.lit(0).cast("long").alias("digest"), F.lit("").alias("split"),
        F.col("absent").alias("p"), F.explode(F.expr("sequence(0L, chunks - 1)")).alias("chunk"))
    held = shares.select(*GROUP, "digest", "split", "p").join(sizes, "lang").select(
        *GROUP, tile.alias("tile"), "tiles", F.lit(False).alias("mark"), "digest", "split", "p", chunk.alias("chunk"))
    # A row goes to every pair of tiles that its own is in.
    dealt = marks.unionByName(held).withColumn("with", F.explode(F.expr("sequence(0L, tiles - 1)"))).select(
        *GROUP, "tile", "mark", "digest", "split", "p", "chunk", F.least("tile", "with").alias("a"), F.greatest("tile", "with").alias("b"))
    sums = dealt.groupBy("lang", "chunk", "a", "b").applyInPandas(
        _tile_sums, "lang string, one string, other string, sum long, seen long")
    pairs = sums.groupBy("lang", "one", "other").agg(F.sum("sum").alias("sum"), F.sum("seen").alias("seen"))
    absent = groups.select("lang", "source", "absent", "terms")
    of = absent.select("lang", F.col("source").alias("one"), F.col("absent").alias("p"), "terms")
    to = absent.select("lang", F.col("source").alias("other"), F.col("absent").alias("q"))
    whole = pairs.join(of, ["lang", "one"]).join(to, ["lang", "other"])
    rest = (F.col("terms") - F.col("seen")) * difference(F.col("p"), F.col("q"))
    both_ways = F.explode(F.array(F.struct(F.col("one").alias("source"), F.col("other").alias("item")),
                                  F.struct(F.col("other").alias("source"), F.col("one").alias("item")))).alias("pair")
    return whole.withColumn("value", F.col("sum") + rest).select("lang", "value", both_ways).select(
        "lang", "pair.source", F.lit("pair").alias("part"), "pair.item", "value")


def audit(documents: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
          least: int = LEAST_DOCUMENTS, most: int = 10, digest: Callable[[bytes], int] = digest64) -> DataFrame:
    """Lang, source, part, item, value and rank: all other sources (part `pair`), and the highest terms (part `term`)."""
    counts = stored(count_terms(documents, text, lang, source, digest), "divergence-counts")
    likely = likely_terms(counts, least)
    held = rows_of(counts, likely)
    kept = kept_terms(held, likely, least)
    found = stored(group_counts(held, kept), "divergence-found")
    groups, shares = with_shares(counts, kept, found)
    columns = [*GROUP, "part", "item", "value", "rank"]
    return ranked(source_pairs(groups, shares)).select(*columns).unionByName(highest_terms(shares, kept, most).select(*columns))
