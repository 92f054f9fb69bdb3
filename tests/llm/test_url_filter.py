from pyspark.sql import functions as F

from stridelake.llm import bloom, url_filter


def plain(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, path = rest[:cut].translate({c: c + 32 for c in range(65, 91)}), rest[cut:]
        path = path[:min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fits = [(len(h + p), len(h), h + p, v) for v, h, p in rules
            if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[2], best[3] if best else "allow"


URLS = [None, "", "no scheme", "http://", "http://ORG/", "http://x.org", "https://a.example.org/es/x", "http://example.org/en/123?q#f",
        "ftp://b.com/fr/", "http://b.com/de/1", "http://badexample.org/es/", "http://example.org?/es/", "x://y://example.org/es/",
        "http://u.com/fr/\n/de/", "http://É.com/de/ü", "http://a.b.c.d.e.org/x#y", "http://example.org./es/", "http://.org/"]


def test_rules_and_odd_urls(spark):
    rows = [(i % 5 if i % 7 else None, u, "h", "r") for i, u in enumerate(URLS * 2)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, key string")
    found = url_filter.judge(pages, url_filter.rule_table(spark, url_filter.SAMPLE_RULES)).collect()
    want = sorted((str((p, u)), *map(str, plain(u, url_filter.SAMPLE_RULES))) for p, u, _, _ in rows)
    assert sorted((str((r.page_id, r.url)), *map(str, (r.host, r.path, r.rule, r.verdict))) for r in found) == want
    assert url_filter.judge(pages.limit(0), url_filter.rule_table(spark, url_filter.SAMPLE_RULES)).count() == 0


def test_no_rules(spark):
    pages = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    assert [r.verdict for r in url_filter.judge(pages, url_filter.rule_table(spark, [])).collect()] == ["allow"]


def test_filter_loses_no_key_and_passes_few_others(spark):
    keys = spark.range(5000).select(F.col("id").cast("string").alias("k"))
    blocks = bloom.block_count(5000)
    built = bloom.bloom_blocks(keys, ["k"], blocks)
    rows = spark.range(100_000).select(F.col("id").cast("string").alias("k"))
    passed = bloom.possible_hits(rows, ["k"], built, blocks)
    assert passed.filter("cast(k as long) < 5000").count() == 5000
    assert passed.count() < 5000 + 0.03 * 95_000
    one = bloom.bloom_blocks(keys, ["k"], 1)
    assert bloom.possible_hits(rows.limit(6000), ["k"], one, 1).filter("cast(k as long) < 5000").count() == 5000
