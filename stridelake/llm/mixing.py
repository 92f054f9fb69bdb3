"""Mixing of sources by temperature: token shares to a power, the power found by bisection, weights made real in blocks.

The weight of a source is its share of all tokens to the power of an exponent, normalised. An exponent of 1 keeps the
shares, 0 makes all sources equal. It is bisected until the weights have the wanted entropy, or until no source is
repeated more often than allowed. A weight times the budget is the quota of a source. Its documents are dealt into
blocks of about `block_tokens`; the quota is met by whole permutations of the blocks and a part of one more, which ends
inside a block, there by documents. Nothing goes beyond a quota.

Tokens are words between white space. Null sources are one source with an empty name; null and empty texts have no
tokens and cost nothing. A source without tokens has no weight and its documents no copies, except with a budget that covers
every document. Repeated rows are dealt alike; null ids are dealt like an empty text. DataFrame functions only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from stridelake.llm.components import stored

BLOCK_TOKENS = 65_536
# Hashes of 32 bits that share all but these bits are a range of a permutation.
RANGE_BITS = 20
RESULTS = ("mix_tokens", "mix_weight", "mix_block", "mix_copies")
LEVELS = 40
LEVELS_PER_JOB = 4


@dataclass(frozen=True)
class Target:
    """One of: entropy as a share of the largest possible, or the most times that a source may be seen."""
    entropy_share: float | None = None
    max_repeats: float | None = None


def hashed(*parts: Column) -> Column:
    """A number from the digest of the parts, below 2^32."""
    text = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def token_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_shares(counted: DataFrame) -> DataFrame:
    """Source, tokens and share of all tokens."""
    sums = counted.groupBy("source").agg(F.sum("tokens").alias("source_tokens"))
    total = sums.agg(F.sum("source_tokens")).first()[0] or 0
    share = F.col("source_tokens") / F.lit(float(total)) if total else F.lit(0.0)
    return stored(sums.select("source", "source_tokens", share.alias("share")), "shares")


def find_exponent(shares: DataFrame, target: Target, budget_share: float | None) -> float:
    """Bisection; each job looks at all exponents that the next levels may need. Only sums come to the driver.

    `budget_share` is the budget as a share of all tokens; None is the budget that gives every source one epoch.
    """
    if (target.entropy_share is None) == (target.max_repeats is None):
        raise ValueError("give an entropy or a number of repeats")
    held = shares.filter("share > 0")
    count, largest, smallest = held.agg(F.count("*"), F.max("share"), F.min("share")).first()
    if not count:
        return 1.0
    whole = 1 << LEVELS

    def meets(power: Column, log_power: Column, exponent: float) -> Column:
        """Whether the exponent is small enough for the entropy, or too small for the repeats."""
        if target.entropy_share is not None:
            entropy = F.log(power) - F.lit(exponent) * log_power / power
            return entropy >= target.entropy_share * F.log(F.lit(float(count)))
        scale = F.lit(budget_share) / power if budget_share is not None else F.lit(largest ** (1 - exponent))
        return scale * F.lit(smallest ** (exponent - 1)) > target.max_repeats

    low, step = 0, whole  # the exponent is in [low, low + step] of `whole` parts
    while step > 1:
        levels = min(LEVELS_PER_JOB, step.bit_length() - 1)
        fine = step >> levels
        tried = [low + fine * i for i in range(1, 1 << levels)]
        power = [F.pow("share", F.lit(t / whole)) for t in tried]
        sums = held.agg(*[F.sum(p).alias(f"p{i}") for i, p in enumerate(power)],
                        *[F.sum(p * F.log("share")).alias(f"l{i}") for i, p in enumerate(power)])
        found = sums.select(*[meets(F.col(f"p{i}"), F.col(f"l{i}"), t / whole).alias(f"m{i}") for i, t in enumerate(tried)]).first()
        for _ in range(levels):
            step >>= 1
            if found[(low + step - tried[0]) // fine]:
                low += step
    if target.max_repeats is not None:
        return min(1.0, (low + 1) / whole) if low else 0.0
    return low / whole


def quotas(shares: DataFrame, exponent: float, budget: int | None) -> DataFrame:
    """Shares with weight, quota, whole epochs and the tokens of the epoch that is cut."""
    held = shares.filter("share > 0")
    power, largest = held.agg(F.sum(F.pow("share", F.lit(exponent))), F.max("share")).first()
    weight = F.when(F.col("share") > 0, F.pow("share", F.lit(exponent)) / F.lit(power or 1.0)).otherwise(0.0)
    if budget is None:
        times = F.when(F.col("share") > 0, F.pow(F.col("share") / F.lit(largest or 1.0), F.lit(exponent - 1))).otherwise(1.0)
        quota = F.floor(F.col("source_tokens") * times)
    else:
        quota = F.floor(weight * F.lit(float(budget)))
    size = F.greatest("source_tokens", F.lit(1).cast("long"))
    epochs = F.floor(F.col("quota") / size).cast("long")
    if budget is None:
        epochs = F.greatest(epochs, F.lit(1).cast("long"))
    return shares.withColumn("weight", weight).withColumn("quota", quota.cast("long")).withColumn("epochs", epochs).withColumn(
        "rest", F.greatest(F.col("quota") - F.col("epochs") * F.col("source_tokens"), F.lit(0).cast("long")))


def mix(documents: DataFrame, target: Target, budget_share: float | None = 1.0, seed: int = 1,
        block_tokens: int = BLOCK_TOKENS, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Every row with tokens, the weight of its source, its block, and how many copies the mixture has of it.

    The budget is a share of all tokens, or, if None, what gives every document one copy at least. Columns with the
    names of results (mix_tokens, mix_weight, mix_block, mix_copies) are replaced.
    """
    kept = [c for c in documents.columns if c.lower() not in RESULTS]
    # The columns that are kept go by number until the end, so that no name of theirs meets one of ours.
    id_, source_, tokens, block = "mix_id", "mix_source", "mix_tokens_", "mix_block_"
    rows = documents.select(
        *[F.col(f"`{c}`").alias(f"_in{i}") for i, c in enumerate(kept)], F.col(key).alias(id_),
        F.coalesce(F.col(source).cast("string"), F.lit("")).alias(source_), token_count(F.col(text)).alias(tokens))
    counted = stored(rows.select(F.col(id_).alias("id"), F.col(source_).alias("source"), F.col(tokens).alias("tokens")), "counted")
    shares = source_shares(counted)
    total = shares.agg(F.sum("source_tokens")).first()[0] or 0
    exponent = find_exponent(shares, target, budget_share)
    plan = quotas(shares, exponent, None if budget_share is None else int(budget_share * total))
    count = F.ceil(F.greatest(F.col("source_tokens"), F.lit(1).cast("long")) / F.lit(block_tokens)).cast("long")
    plan = stored(plan.withColumn("blocks", count), "plan")
    dealt = counted.join(plan.select("source", "blocks"), "source").withColumn("block", F.pmod(hashed(F.col("id")), F.col("blocks")))

    # The epoch that is cut has a permutation of its own; here a source has a row per block, not per document.
    sizes = dealt.groupBy("source", "block").agg(F.sum("tokens").alias("size"))
    # A source may have very many blocks, so its permutation is cut into ranges, and the sums of whole ranges are carried.
    turn = hashed(F.lit(seed), F.col("epochs"), F.col("source"), F.col("block"))
    turned = sizes.join(plan, "source").withColumn("turn", turn).withColumn("span", F.shiftright("turn", RANGE_BITS))
    spans = turned.groupBy("source", "span").agg(F.sum("size").alias("held"))
    earlier = Window.partitionBy("source").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select("source", "span", F.coalesce(F.sum("held").over(earlier), F.lit(0).cast("long")).alias("carried"))
    permuted = Window.partitionBy("source", "span").orderBy("turn", "block").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("size").over(permuted), F.lit(0).cast("long"))
    blocks = stored(turned.withColumn("before", before).join(spans, ["source", "span"]).withColumn(
        "left", F.col("rest") - F.col("before") - F.col("carried")).select(
        "source", "block", "epochs", "weight", "left", ((F.col("left") > 0) & (F.col("left") >= F.col("size"))).alias("whole")), "blocks")
    # In the one block of a source that is cut, documents go by their own order. Equal rows go together.
    in_block = Window.partitionBy("source", "block").orderBy(hashed(F.lit(seed), F.col("id")), "id", "tokens")
    cut = blocks.filter("left > 0 and not whole").select("source", "block", "left")
    taken = dealt.join(cut, ["source", "block"]).withColumn("reach", F.sum("tokens").over(in_block)).filter(
        "reach <= left").select("source", "block", "id", "tokens").distinct()

    with_block = rows.join(plan.select(F.col("source").alias(source_), "blocks"), source_).withColumn(
        block, F.pmod(hashed(F.col(id_)), F.col("blocks"))).drop("blocks")
    chosen = taken.select(F.col("source").alias(source_), F.col("block").alias(block), F.col("id").alias("_id"),
                          F.col("tokens").alias(tokens), F.lit(True).alias("_taken"))
    limits = blocks.select(F.col("source").alias(source_), F.col("block").alias(block), "epochs", "weight", "whole")
    # Both joins are on the place of a row; the rows taken from cut blocks are few, the limits one row per block.
    decided = with_block.join(limits, [source_, block]).alias("d").join(
        chosen.alias("t"), (F.col(f"d.{source_}") == F.col(f"t.{source_}")) & (F.col(f"d.{block}") == F.col(f"t.{block}"))
        & F.col(f"d.{id_}").eqNullSafe(F.col("t._id")) & (F.col(f"d.{tokens}") == F.col(f"t.{tokens}")), "left")
    extra = F.when(F.col("d.whole") | F.col("t._taken"), 1).otherwise(0)
    return decided.select(
        *[F.col(f"d._in{i}").alias(c) for i, c in enumerate(kept)], F.col(f"d.{tokens}").alias("mix_tokens"), F.col("d.weight").alias("mix_weight"),
        F.col(f"d.{block}").alias("mix_block"), (F.col("d.epochs") + extra).alias("mix_copies"))


def permutations(mixed: DataFrame, seed: int = 1, key: str = "doc_id", source: str = "source") -> DataFrame:
    """A row per copy, with its epoch and the order of its block and of itself within that epoch."""
    epochs = mixed.filter("mix_copies > 0").withColumn("mix_epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("mix_copies") - 1)))
    return epochs.withColumns({
        "mix_block_order": hashed(F.lit(seed), F.col("mix_epoch"), F.coalesce(F.col(source).cast("string"), F.lit("")), F.col("mix_block")),
        "mix_order": hashed(F.lit(seed), F.col(key))})
