"""Connected components of a table of links, by rounds of star contraction.

Each round replaces the links around every node by links to its smallest neighbour, first to larger and then to
smaller neighbours. The links of a node are never gathered: a round is two minimum aggregations, which combine before
the shuffle, and two joins on the node, whose hot keys Spark splits. Rounds are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stridelake.session import new_folder


# Shuffle files go when a stored step is done; until then a lost executor's part can be made again from them.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write the rows to the shared folder and read them back, which cuts the lineage and frees the shuffles before it."""
    spark = df.sparkSession
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path := new_folder(spark, name))
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _mark(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """Columns node and root of every node with a link; the root is the smallest node that can be reached.

    `links` has whole numbers u and v; links of a node with itself and repeated links change nothing.
    """
    current = stored(links.filter("u != v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    mark = _mark(current)
    while True:
        current = stored(_small_star(_large_star(current).distinct()), "links")
        previous, mark = mark, _mark(current)
        if mark == previous:
            break
    roots = current.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
