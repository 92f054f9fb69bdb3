"""Allow and block rules for URLs: a blocked Bloom filter in front of an exact hash join.

A rule is a host and a path prefix. It fits the host and its subdomains, if the path starts with the prefix.
Each URL gives one canonical key for each shape of rule: so many labels of its host, so many characters of its
path. Keys that the Bloom filter passes are joined with the rules, which removes false positives; the longest
rule that fits a URL wins. All of it is DataFrame functions.

Null URLs and URLs without `://` have an empty host and path. Repeated rows and null ids keep a row each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stridelake.llm import bloom
from stridelake.llm.names import free_name

SAMPLE_RULES = [
    ("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"), ("block", "com", "/de/")]

RULE_SCHEMA = "verdict string, host string, path string"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(rules, RULE_SCHEMA)


def url_host(url: Column) -> Column:
    """Between `://` and the next `/`, `?`, `#` or end, with A-Z lower-cased; empty if there is none."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)


def url_path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def labels_of(host: Column) -> Column:
    return F.size(F.split(host, r"\."))


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", url: str = "url", key: str = "page_id") -> DataFrame:
    """Every row with host, path, rule and verdict; URLs that no rule fits get the default verdict.

    If several rules of the same length fit, the one with the longer host wins, then the smaller text.
    """
    # One row and one verdict per rule: of a host and path that are listed twice, block wins.
    listed = rules.select("host", "path", "verdict").na.fill("").groupBy("host", "path").agg(
        F.max("verdict").alias("verdict"))
    shapes = [(r.labels, r.chars) for r in listed.select(
        labels_of(F.col("host")).alias("labels"), F.length("path").alias("chars")).distinct().collect()]
    blocks = bloom.block_count(listed.count())
    known = listed.select(F.col("host").alias("key_host"), F.col("path").alias("key_path"), "verdict")
    key_names = ["key_host", "key_path"]
    row_key, row_url = free_name(pages, "row_key"), free_name(pages, "row_url")
    urls = pages.select(F.col(key).alias(row_key), F.col(url).alias(row_url)).withColumns({
        "host": url_host(F.col(row_url)), "path": url_path(F.col(row_url))}).filter(F.col("host") != "")
    keys = [F.struct(
        F.substring_index("host", ".", -labels).alias("key_host"),
        F.substring(F.col("path"), 1, chars).alias("key_path")) for labels, chars in sorted(shapes)]
    candidates = urls.select(row_key, row_url, F.explode(F.array_distinct(F.array(*keys))).alias("k")).select(
        row_key, row_url, "k.*") if keys else urls.select(row_key, row_url, F.lit("").alias("key_host"), F.lit("").alias("key_path"))
    hits = bloom.possible_hits(candidates, key_names, bloom.bloom_blocks(known, key_names, blocks), blocks)
    exact = hits.join(known, key_names)
    rule = F.concat("key_host", "key_path")
    best = exact.groupBy(row_key, row_url).agg(F.max_by(
        F.struct(rule.alias("rule"), F.col("verdict")),
        F.struct(F.length(rule), F.length("key_host"), rule)).alias("best"))
    found = best.select(
        F.col(row_key).alias("_key"), F.col(row_url).alias("_url"), F.col("best.rule").alias("rule"),
        F.col("best.verdict").alias("_verdict"))
    kept = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    return pages.join(found, pages[key].eqNullSafe(found["_key"]) & pages[url].eqNullSafe(found["_url"]), "left").select(
        *[pages[c] for c in kept], url_host(pages[url]).alias("host"), url_path(pages[url]).alias("path"),
        found["rule"], F.coalesce(found["_verdict"], F.lit(default)).alias("verdict"))
