import hashlib
import random

import pytest
from pyspark.sql import functions as F

import brute
from stridelake.llm import catalog, decontaminate


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = catalog.QUERIES["op6_decontaminate"](spark, folder).collect()
    assert len(rows) == len(texts) and sum(r.contaminated for r in rows) > 0
    for r in rows:
        n, hit, found = brute.hit_windows(texts[r.doc_id], items)
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == (n, hit, len(found), digest, hit > 0)


@pytest.mark.parametrize("slice_bytes", [60, 1 << 20])
def test_few_words_and_short_items(spark, slice_bytes):
    """A small vocabulary, so that windows overlap, repeat and touch; the benchmark in one slice and in many."""
    random.seed(5)
    items = [(i, " ".join(random.choices("abc", k=random.randrange(1, 9)))) for i in range(25)] + [(3, "a b"), (None, "c c"), (7, None), (8, "!")]
    docs = [(i, " ".join(random.choices("abcd", k=random.randrange(0, 40)))) for i in range(60)] + [(60, None), (60, "a"), (None, "b c a")]
    found = decontaminate.find_passages(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"),
        width=4, slice_bytes=slice_bytes).withColumn("hit", decontaminate.hit_words()).collect()
    named = [("" if i is None else i, t) for i, t in items]
    want = []
    for i, t in docs:
        n, hit, names = brute.hit_windows(t, named, 4)
        want.append(str((i, n, hit, sorted(names))))
    assert sorted(str((r.doc_id, r.n_words, r.hit, list(r["items"]))) for r in found) == sorted(want)
    for r in found:
        spans = [*zip(r.run_starts, r.run_ends)]
        assert all(a < b for a, b in spans) and all(b < c for (_, b), (c, _) in zip(spans, spans[1:]))


def test_near_matches(spark):
    item = "one two three four five six seven eight nine ten"
    docs = [(1, item), (2, item.replace("five", "five and")), (3, item.replace("five", "")), (4, item.replace("five", "x y z u v w five")),
            (5, "one two three four five"), (6, "six seven eight nine ten")]
    found = {r.doc_id: r for r in decontaminate.find_passages(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(9, item)], "item_id long, text string"), slop=2).collect()}
    assert {i: list(r["items"]) for i, r in found.items()} == {1: ["9"], 2: [], 3: [], 4: [], 5: [], 6: []}
    assert {i for i, r in found.items() if list(r.near_items) == ["9"]} == {1, 2}


def test_near_matches_at_every_place(spark):
    """A near copy of an item's middle: none of the windows laid end to end from its start stands there."""
    words = [f"w{i}" for i in range(35)]
    docs = [(i, " ".join([*words[i:i + 5], "and", *words[i + 5:i + 10]])) for i in range(26)]
    found = decontaminate.find_passages(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(9, " ".join(words))], "item_id long, text string"),
        slop=2).collect()
    assert len(found) == 26 and all(list(r.near_items) == ["9"] and not r["items"] for r in found)


def test_odd_documents(spark, odd_documents, no_documents):
    benchmark = spark.createDataFrame([(1, "ab " * 12), (2, "xxx"), (3, "漢字 кириллица")], "item_id long, text string")
    rows = decontaminate.find_passages(odd_documents, benchmark).withColumn("hit", decontaminate.hit_words()).collect()
    items = [(r.item_id, r.text) for r in benchmark.collect()]
    want = sorted(str((r.doc_id, *brute.hit_windows(r.text, items)[:2])) for r in odd_documents.collect())
    assert sorted(str((r.doc_id, r.n_words, r.hit)) for r in rows) == want
    assert decontaminate.find_passages(no_documents, benchmark).count() == 0
    nothing = decontaminate.find_passages(odd_documents, benchmark.limit(0)).filter(F.size("items") > 0)
    assert nothing.count() == 0


def test_slices_do_not_depend_on_partitions(spark):
    """Every pass over the documents sees them in other partitions, as when executors come and go."""
    documents = spark.createDataFrame([(i, f"w{i} one two three w{i % 7}") for i in range(40)], "doc_id long, text string")
    benchmark = spark.createDataFrame([(i, f"w{i} one two") for i in range(5)] + [(9, "two three w3")], "item_id long, text string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    want = {i: {str(i)} if i < 5 else set() for i in range(40)}
    for i in range(3, 40, 7):
        want[i] = want[i] | {"9"}
    try:
        for partitions in (1, 3, 8):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            shuffled = documents.repartition(F.col("doc_id"))
            rows = decontaminate.find_passages(shuffled, benchmark, width=3, slice_bytes=15).collect()
            assert len(rows) == 40 and {r.doc_id: set(r["items"]) for r in rows} == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
