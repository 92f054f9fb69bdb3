"""Merkle manifest of a dataset: a digest per record, a tree of digests per group, and one root over the groups.

A leaf is the SHA-256 of a record's fields, each as its UTF-8 byte count, a colon and its value, or `-` for null; digests
are lower-case hex. A group's leaves are in ascending order; while there are several nodes, every FAN consecutive ones
become the digest of their concatenation, the last run with fewer, even one. What remains is the group's subroot; the
subroots, in order of the group, give the root in the same way.

Nodes are numbered over sorted partitions, with a row per partition and group carried along. Aligned blocks of BLOCK
nodes are a row each. In a block, a level is one hex string: the digests of its nodes without anything between. The
parents are digests of its substrings of fixed width, the siblings of a node are the two substrings beside it in its
run, so a block needs no rows per node. The digests left by the blocks are the nodes of the next round, until each
group has one; the subroots go through the same rounds. Paths of siblings come down the rounds in the opposite order.
A group of any size is so many blocks, never one task. Levels are held as bytes, in which Spark cuts without counting
characters.

Null groups come first and are apart from empty ones; null keys come before others. Rows with equal keys are ordered
by their leaf, and equal rows have places of their own. An empty table has an empty manifest.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from stridelake.llm.components import stored

FAN = 16
LEVELS = 3
BLOCK = FAN ** LEVELS
HEX = 64
RUN = FAN * HEX
NO_PATH = "cast(array() as array<struct<left: binary, right: binary>>)"


def digest(data: Column) -> Column:
    return F.sha2(data.cast("binary"), 256)


def leaf(fields: Sequence[Column]) -> Column:
    """The digest of a record's fields."""
    texts = [f.cast("string") for f in fields]
    return digest(F.concat(*[
        F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]))


def fold(node: Column, path: Column) -> Column:
    """The root that a node and the siblings on its way give."""
    return F.aggregate(path, node.cast("binary"), lambda held, at: digest(
        F.concat(at["left"], held, at["right"])).cast("binary")).cast("string")


def proof_digest(path: Column) -> Column:
    """The digest of all siblings of a path, from the lowest level up, left to right."""
    return digest(F.aggregate(path, F.lit(b""), lambda held, at: F.concat(held, at["left"], at["right"])))


def placed(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows with `pos`, their place in their `grp` from 0 in the given order, and `n`, the rows of the group.

    The rows are stored once in sorted partitions. A place is the row's number in its partition, less that of the first
    row there of its group, and the rows of the group in partitions before, of which there is one row per partition.
    """
    ordered = rows.repartitionByRange("grp", *order).sortWithinPartitions("grp", *order)
    kept = stored(ordered.withColumn("_row", F.monotonically_increasing_id()).withColumn(
        "_part", F.shiftright("_row", 33)), "manifest-order")
    parts = kept.groupBy("grp", "_part").agg(F.min("_row").alias("_first"), F.count("*").alias("_held"))
    in_group = W.partitionBy("grp")
    before = in_group.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    carried = stored(parts.select(
        F.col("grp").alias("_grp"), F.col("_part").alias("_of"), F.sum("_held").over(in_group).alias("n"),
        (F.coalesce(F.sum("_held").over(before), F.lit(0)) - F.col("_first")).cast("long").alias("_shift")), "manifest-parts")
    found = kept.join(carried, (F.col("grp") == F.col("_grp")) & (F.col("_part") == F.col("_of")))
    return found.withColumn("pos", F.col("_row") + F.col("_shift")).drop("_row", "_part", "_grp", "_of", "_shift")


def _above(level: str) -> Column:
    """The next level of a block: a digest per run of a level."""
    return F.expr(f"cast(array_join(transform(sequence(0, cast((length({level}) - 1) div {RUN} as int)), "
                  f"i -> sha2(substring({level}, i * {RUN} + 1, {RUN}), 256)), '') as binary)")


def blocks_of(nodes: DataFrame) -> DataFrame:
    """A row per aligned block: its levels, and the digest that it leaves. `nodes` has grp, n, pos, digest and held.

    A level is made while the group has several nodes there, whatever the block itself has.
    """
    members = F.sort_array(F.collect_list(F.struct("pos", "digest", "held")))
    found = nodes.groupBy("grp", "n", F.expr(f"pos div {BLOCK}").alias("block")).agg(members.alias("members"))
    found = found.withColumn("level0", F.expr("cast(array_join(transform(members, m -> m.digest), '') as binary)"))
    for i in range(1, LEVELS + 1):
        found = found.withColumn(f"level{i}", F.when(F.col("n") > FAN ** (i - 1), _above(f"level{i - 1}")))
    top = F.coalesce(*[F.col(f"level{i}") for i in range(LEVELS, -1, -1)])
    return found.select("grp", "n", "block", F.expr("transform(members, m -> m.held)").alias("held"),
                        *[f"level{i}" for i in range(LEVELS)], top.cast("string").alias("top"))


def ascend(nodes: DataFrame, most: int) -> list[DataFrame]:
    """The stored blocks of every round. `most` is the number of nodes of the largest group."""
    rounds = []
    while True:
        rounds.append(stored(blocks_of(nodes), "manifest-blocks"))
        if most <= BLOCK:
            return rounds
        most = -(-most // BLOCK)
        nodes = rounds[-1].select(
            "grp", F.expr(f"(n - 1) div {BLOCK} + 1").alias("n"), F.col("block").alias("pos"), F.col("top").alias("digest"),
            F.col("block").alias("held"))


def _beside(level: str, place: str) -> str:
    """The siblings of a node, as the substrings of its level on both sides of it within its run."""
    run = f"({place} div {FAN}) * {RUN}"
    left = f"substring({level}, cast({run} + 1 as int), cast(({place} % {FAN}) * {HEX} as int))"
    right = f"substring({level}, cast({place} * {HEX} + {HEX} + 1 as int), cast({run} + {RUN} - {place} * {HEX} - {HEX} as int))"
    return f"named_struct('left', {left}, 'right', {right})"


def descend(rounds: list[DataFrame], tops: DataFrame, carried: Sequence[str]) -> DataFrame:
    """A row per node of the first round, with its `held`, digest, path and what was carried down.

    `tops` has a row per group: grp, path (from its top to the root) and the carried columns.
    """
    paths = tops.withColumn("block", F.lit(0).cast("long"))
    for number, blocks in reversed(list(enumerate(rounds))):
        upper = paths.select(F.col("grp").alias("_grp"), F.col("block").alias("_block"), "path", *carried)
        both = blocks.join(upper, (F.col("grp") == F.col("_grp")) & (F.col("block") == F.col("_block")))
        # A run's upper path is made once; only runs and paths are copied to the nodes, not levels.
        higher = ", ".join([*(
            f"case when n > {FAN ** i} then array({_beside(f'level{i}', f'(i div {FAN ** (i - 1)})')}) else {NO_PATH} end"
            for i in range(1, LEVELS)), "path"])
        runs = both.select("grp", "n", *carried, F.explode(F.expr(
            f"transform(sequence(0, cast((length(level0) - 1) div {RUN} as int)), i -> named_struct("
            f"'run', substring(level0, i * {RUN} + 1, {RUN}), 'held', slice(held, i * {FAN} + 1, {FAN}), "
            f"'path', concat({higher})))")).alias("r"))
        nodes = runs.select("grp", "n", *carried, F.col("r.run").alias("run"), F.col("r.path").alias("upper"),
                            F.posexplode("r.held").alias("place", "held"))
        own = f"case when n > 1 then array({_beside('run', 'place')}) else {NO_PATH} end"
        paths = nodes.select(
            "grp", "held", *carried, F.expr(f"cast(substring(run, place * {HEX} + 1, {HEX}) as string)").alias("digest"),
            F.expr(f"concat({own}, upper)").alias("path"))
        if number:
            paths = paths.withColumn("block", F.col("held"))
    return paths


def most_nodes(nodes: DataFrame) -> int:
    return nodes.agg(F.max("n")).first()[0] or 0


def manifest(records: DataFrame, fields: Sequence[str], key: str = "doc_id", group: str = "source",
             presented: Column | None = None) -> DataFrame:
    """Every record with its place in the tree, and the way to the root.

    Columns: key, group, leaf, path (left and right siblings per level, from the leaf up), subroot, root, and
    `presented`, if given: any column over the records, such as the leaf of a record as it was received.
    """
    shown = F.lit(None).cast("string") if presented is None else presented
    # The first letter keeps null groups before all others and apart from empty ones.
    grouped = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    leaves = stored(records.select(
        grouped.alias("grp"), F.col(key).alias("key"), leaf([F.col(f) for f in fields]).alias("digest"),
        shown.alias("presented"), F.monotonically_increasing_id().alias("row")), "manifest-leaves")
    nodes = placed(leaves, ["key", "digest", "row"]).select(
        "grp", "n", "pos", "digest", F.struct("key", "presented").alias("held"))
    rounds = ascend(nodes, most_nodes(nodes))
    subroots = rounds[-1].select("grp", F.col("top").alias("subroot"))
    groups = placed(subroots.select(F.lit("").alias("grp"), F.col("grp").alias("name"), "subroot"), ["name"]).select(
        "grp", "n", "pos", F.col("subroot").alias("digest"), F.col("name").alias("held"))
    over = ascend(groups, most_nodes(groups))
    root = over[-1].select("grp", F.col("top").alias("root"), F.expr(NO_PATH).alias("path"))
    tops = stored(descend(over, root, ["root"]).select(
        F.col("held").alias("grp"), "root", F.col("digest").alias("subroot"), "path"), "manifest-groups")
    found = descend(rounds, tops, ["root", "subroot"])
    name = F.when(F.col("grp") != "", F.expr("substring(grp, 2)")).cast(records.schema[group].dataType)
    extra = [] if presented is None else [F.col("held.presented").alias("presented")]
    return found.select(F.col("held.key").alias(key), name.alias(group), F.col("digest").alias("leaf"), "path",
                        "subroot", "root", *extra)


def verified(manifest_rows: DataFrame, node: str = "leaf") -> DataFrame:
    """The manifest with the root that the given leaf folds to, and whether it is the root."""
    folded = manifest_rows.withColumn("folded_root", fold(F.col(node), F.col("path")))
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))
