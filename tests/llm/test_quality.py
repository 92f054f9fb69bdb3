import zlib

import numpy as np
from pyspark.sql import functions as F

from stridelake.llm import catalog, quality

FOLDER = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    found = catalog.QUERIES["op3_quality"](spark, FOLDER)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    rows = found.collect()
    assert len(rows) == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    judged = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert len(judged) > 50 and sum(p == y for p, y in judged) >= 0.97 * len(judged)


def test_only_the_text_counts(spark):
    """Scores stay when every other column changes, and held-out labels change nothing."""
    documents, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.train(documents, labels)
    flipped = labels.withColumn("quality", F.when(quality.is_held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    other = quality.train(documents, flipped.withColumn("toxic", F.lit(1)))
    assert np.array_equal(model.vectors, other.vectors) and np.array_equal(model.labels, other.labels)
    few = documents.limit(50)
    changed = few.withColumns({"doc_id": F.col("doc_id") + 10**9, "lang": F.lit("xx"), "source": F.lit("other")})
    assert sorted((r.text, r.score) for r in quality.score(few, model).collect()) == sorted(
        (r.text, r.score) for r in quality.score(changed, model).collect())


def test_terms_of_texts_side_by_side_are_those_of_each_alone():
    texts = [b"", b"One two two, THREE!! 4", b"", "ça été | là".encode(), b"a", b" ", b"two two", b"!" * 40]
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.r_[0, np.cumsum([len(t) for t in texts])]
    row, term, count = quality.term_counts(data, offsets)
    for i, text in enumerate(texts):
        alone = quality.term_counts(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
        assert dict(zip(alone[1].tolist(), alone[2].tolist())) == dict(zip(term[row == i].tolist(), count[row == i].tolist()))


def test_votes_are_those_of_all_neighbours():
    """Blocked products against one text at a time and a full sort."""
    rng = np.random.default_rng(1)
    texts = [quality.term_counts(np.frombuffer(t, np.uint8), np.array([0, len(t)]))[1:] for t in (
        " ".join("".join(rng.choice(list("abcde!|A"), 5)) for _ in range(20)).encode() for _ in range(80))]
    labels = rng.integers(0, 2, 80).astype(float)
    model = quality.fit(texts, labels, 0.5)
    row = np.repeat(np.arange(80), [len(t) for t, _ in texts])
    found = model.score(80, row, np.concatenate([t for t, _ in texts]), np.concatenate([c for _, c in texts]))
    for i, (term, count) in enumerate(texts):
        vector = quality.unit(quality.weighted(1, np.zeros(len(term), int), term, count, model.idf) @ model.directions)[0]
        near = np.maximum(model.vectors @ vector, 0).astype(float)
        best = np.argsort(-near)[:quality.NEIGHBOURS]
        weight = near[best] ** quality.SHARPNESS
        assert abs(found[i] - (weight * labels[best]).sum() / weight.sum()) < 1e-4


def test_odd_documents(spark, odd_documents, no_documents):
    labels = spark.createDataFrame([(i, i % 2, None) for i in range(1, 10)] + [(None, 1, 0), (4, None, 0), (1, 7, 0)],
                                   "doc_id long, quality int, toxic int")
    model = quality.train(odd_documents, labels)
    rows = quality.score(odd_documents, model).collect()
    assert len(rows) == odd_documents.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if not (r.text or "").strip("\t\n ")}) <= 2
    assert quality.score(no_documents, model).count() == 0
    unlabelled = quality.train(no_documents, labels.limit(0))
    assert {r.score for r in quality.score(odd_documents, unlabelled).collect()} == {0.5}
    assert {r.score for r in quality.score(odd_documents, quality.train(no_documents, labels)).collect()} == {
        quality.train(no_documents, labels).prior}
