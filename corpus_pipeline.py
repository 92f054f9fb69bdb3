"""From raw documents to token files: quality, near duplicates, benchmark passages, mixture, token ids.

Every stage takes the documents that its predecessor kept. Rows with a null text or id are documents like others;
extra columns stay; rows that are equal in id and text are one document from the second stage on. Empty tables pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from stridelake.llm import decontaminate, mixing, quality, simhash, token_files
from stridelake.llm.components import stored
from stridelake.llm.names import free_name
from stridelake.sources.files import table

SIMILARITY = 0.8
SHINGLE = 5
# The most times that a source is seen; every document is seen once at least.
MAX_REPEATS = 1.5


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose labelled neighbours are mostly of good quality."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    score = free_name(docs, "quality_score")
    return quality.score(docs, model, name=score).filter(F.col(score) >= 0.5).drop(score)


def one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar documents, the one with the smallest id; null ids come last."""
    row = free_name(docs, "document_row")
    identity = F.struct(F.col("doc_id").isNull().alias("no_id"), F.coalesce(F.col("doc_id"), F.lit(0)).alias("id"),
                        F.xxhash64(F.coalesce("text", F.lit(""))).alias("mark"))
    named = docs.withColumn(row, identity)
    groups = simhash.similar_groups(named, row, "text", SHINGLE, SIMILARITY)
    kept = stored(groups.select(F.col("component_id").alias("_kept")).distinct(), "kept")
    return named.join(kept, named[row] == kept["_kept"], "left_semi").dropDuplicates([row]).drop(row)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item stands."""
    mark = free_name(docs, "text_mark")
    named = docs.withColumn(mark, F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256))
    found = decontaminate.find_passages(named, table(spark, sf_dir, "benchmark"), key=mark)
    hit = stored(found.filter(F.size("run_starts") > 0).select(F.col(mark).alias("_hit")).distinct(), "hits")
    return named.join(hit, named[mark] == hit["_hit"], "left_anti").drop(mark)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each time that the mixture sees a document; smaller sources are seen more often."""
    marked = mixing.mix(docs, mixing.Target(max_repeats=MAX_REPEATS), budget_share=None)
    copies = free_name(docs, "copy")
    return marked.withColumn(copies, F.explode(F.sequence(F.lit(1).cast("long"), F.col("mix_copies")))).select(
        *[F.col(f"`{c}`") for c in docs.columns])


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the token files, as read back from them."""
    return token_files.encode_and_read(docs)


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", one_of_similar),
    ("decontamination", without_benchmark),
    ("mixture", mixed_sources),
    ("tokens", token_ids),
]

# Nearest neighbours, fingerprints and token ids are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each result is stored before the next stage reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
