
import pytest

import brute
import corpus_pipeline
from stridelake.llm.components import stored

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def results(spark):
    """Documents before the first stage and after each."""
    docs = [spark.read.parquet(f"{FOLDER}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        docs.append(stored(stage(spark, docs[-1], FOLDER), name))
    return [d.collect() for d in docs]


def test_columns(spark, results):
    before = results[0][0].asDict().keys()
    assert all(r[0].asDict().keys() == before for r in results[:5])
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "mixture", "tokens"]


def test_quality_keeps_the_clean(spark, results):
    kept = {r.doc_id for r in results[1]}
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").collect()
    here = {r.doc_id for r in results[0]}
    good = [r.doc_id in kept for r in labels if r.quality == 1 and r.doc_id in here]
    bad = [r.doc_id in kept for r in labels if r.quality == 0 and r.doc_id in here]
    assert sum(good) >= 0.99 * len(good) and sum(bad) <= 0.05 * len(bad)


def test_one_of_each_group_of_similar_documents(results):
    def shingles(text):
        own = (text or "").translate(brute.UP).split()
        return frozenset(tuple(own[i:i + 5]) for i in range(max(1, len(own) - 4)))

    sets = {r.doc_id: shingles(r.text) for r in results[1]}
    kept = {r.doc_id for r in results[2]}
    holders = {}
    for i, s in sets.items():
        for g in s:
            holders.setdefault(g, []).append(i)
    near = {}
    for i, s in sets.items():
        for j in {j for g in s for j in holders[g] if j != i}:
            near.setdefault(i, []).append((len(s & sets[j]) / len(s | sets[j]), j))
    ids = sorted(sets)
    place = {i: n for n, i in enumerate(ids)}
    root = brute.roots(len(ids), [(place[i], place[j]) for i, x in near.items() for s, j in x if s >= 0.8])
    twins = {ids[n] for n, r in enumerate(root) if r != n}
    assert len(twins & kept) <= 0.02 * len(twins)  # copies go
    assert all(max(s for s, _ in near[i]) > 0.6 for i in set(ids) - kept)  # nothing without a near one goes
    assert not kept & {r.doc_id for r in results[0]} - set(ids)


def test_benchmark_documents_go_and_others_stay(spark, results):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    clean = {r.doc_id for r in results[2] if not brute.hit_windows(r.text, items)[1]}
    assert {r.doc_id for r in results[3]} == clean and len(clean) < len(results[2])


def test_mixture_and_tokens(results):
    before, after = [r.doc_id for r in results[3]], [r.doc_id for r in results[4]]
    assert set(before) == set(after) and len(before) < len(after) <= 1.5 * len(before)
    assert sorted(after) == sorted(r.doc_id for r in results[5])
    starts = sorted((r.start, r.n_tokens) for r in results[5])
    assert all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:]))


def test_run(spark, results):
    assert sorted(map(tuple, corpus_pipeline.run(spark, FOLDER).collect())) == sorted(map(tuple, results[5]))


def test_odd_and_empty_documents(spark, odd_documents, no_documents):
    for docs in (odd_documents, no_documents):
        for name, stage in corpus_pipeline.STAGES:
            out = stored(stage(spark, docs, "/root/testdata/sf0.001"), name)
            if name == "near_duplicates" and docs.count():
                kept = [(r.doc_id, r.text) for r in out.collect()]
                assert len([k for k in kept if k[0] in (1, 2)]) == 1 and not {(4, ""), (None, None)} & set(kept)
            if name != "tokens":
                assert out.columns == odd_documents.columns
            docs = out
    assert docs.count() == 0
