"""The audit against plain Python, with digests that several terms share, and with small tiles."""

import random
import re
from collections import Counter, defaultdict

import pytest

import brute
from stridelake.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def expected(rows, least=10, most=10):
    """Rows are text, lang, source."""
    terms = [(lang or "", source or "", Counter(TERM.findall((text or "").translate(brute.UP)))) for text, lang, source in rows]
    out = []
    for lang in {t[0] for t in terms}:
        own = [t for t in terms if t[0] == lang]
        standing = Counter(w for t in own for w in t[2])
        kept = sorted(w for w, n in standing.items() if n >= least)
        counts = defaultdict(Counter)
        for _, source, c in own:
            counts[source].update({w: n for w, n in c.items() if w in set(kept)})

        def shares(c):
            total = sum(c.values())
            return {w: 1 + 10 ** 9 * (c[w] + 2) // (total + 2 * len(kept)) for w in kept}

        q = shares(sum(counts.values(), Counter()))
        p = {source: shares(c) for source, c in counts.items()}
        for source in p:
            pairs = [(sum((a - b) ** 2 // (a + b) for a, b in zip(p[source].values(), p[o].values())), o) for o in p if o != source]
            found = [((p[source][w] - q[w]) ** 2 // (p[source][w] + q[w]), w) for w in kept if counts[source][w] and p[source][w] > q[w]]
            for part, items in (("pair", pairs), ("term", found)):
                ordered = sorted(items, key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, source, part, item, value, i + 1) for i, (value, item) in enumerate(ordered) if part == "pair" or i < most]
    return sorted(out)


def made_rows(seed=5, count=400):
    draw = random.Random(seed)
    words = [a + b for a in "abcdefghij" for b in ("", "lo", "RA", "é", "漢")]
    rows = []
    for i in range(count):
        lang, source = draw.choice(["en", "de", None]), f"s{draw.choice([0, 0, 0, 1, 2, 3, 4, 5])}"
        near = words[:30] if source == "s0" else words[10:]
        rows.append((" ".join(draw.choice(near) for _ in range(draw.randrange(1, 40))), lang, source))
    return rows + [(None, "en", "empty"), ("", "en", None), ("12 34 !", "fr", "x"), ("a b", "fr", "y"), ("solo", "it", "z")]


def audit(spark, rows, **options):
    docs = spark.createDataFrame(rows, "text string, lang string, source string").repartition(5)
    return sorted(map(tuple, divergence.audit(docs, **options).collect()))


def test_against_plain_python(spark):
    rows = made_rows()
    assert audit(spark, rows) == expected(rows)


@pytest.mark.parametrize("digest", [len, lambda t: t[0] % 3, lambda t: 0])
def test_terms_with_one_digest_are_told_apart(spark, digest):
    rows = made_rows(7, 200)
    assert audit(spark, rows, digest=digest) == expected(rows)


def test_small_tiles_and_tasks(spark, monkeypatch):
    monkeypatch.setattr(divergence, "TILE", 2)
    monkeypatch.setattr(divergence, "CHUNK", 4)
    rows = made_rows(9, 300)
    assert audit(spark, rows) == expected(rows)


def test_ties_go_by_item(spark):
    rows = [(" ".join(f"w{c}" for c in "abcdefghijklmnop"), "en", "a")] * 12 + [("other", "en", "b")] * 12
    assert audit(spark, rows) == expected(rows)
    assert [r[3] for r in audit(spark, rows) if r[1] == "a" and r[2] == "term"] == [f"w{c}" for c in "abcdefghij"]


def test_odd_rows(spark, odd_documents, no_documents):
    """Nulls, empty and long texts, repeated rows, clashing names, no rows."""
    from pyspark.sql import functions as F
    docs = odd_documents.withColumn("lang", F.lit(None).cast("string")).withColumn("digest", F.lit(1)).withColumn("n", F.lit(1))
    many = docs
    for _ in range(3):
        many = many.unionByName(many)
    rows = [(r.text, r.lang, r.source) for r in many.collect()]
    got = sorted(map(tuple, divergence.audit(many).collect()))
    assert got == expected(rows)
    assert divergence.audit(no_documents.withColumn("lang", F.lit("x"))).collect() == []
