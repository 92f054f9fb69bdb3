import math
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from stridelake.llm import mixing

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "source", "text")


def totals(rows):
    """Per source: tokens, weight, tokens in the mixture."""
    out = defaultdict(lambda: [0, 0.0, 0])
    for r in rows:
        out[r.source][0] += r.mix_tokens
        out[r.source][1] = r.mix_weight
        out[r.source][2] += r.mix_tokens * r.mix_copies
    return out


@pytest.mark.parametrize("share", [0.88, 0.95, 0.999])
def test_entropy(documents, share):
    sources = totals(mixing.mix(documents, mixing.Target(entropy_share=share), block_tokens=2000).collect())
    weights = [w for _, w, _ in sources.values()]
    assert abs(sum(weights) - 1) < 1e-9
    start = [t / sum(x for x, _, _ in sources.values()) for t, _, _ in sources.values()]
    own = -sum(p * math.log(p) for p in start)
    got = -sum(w * math.log(w) for w in weights)
    assert got == pytest.approx(max(own, share * math.log(len(weights))), abs=1e-6)
    budget = sum(t for t, _, _ in sources.values())
    for tokens, weight, seen in sources.values():  # a quota is never exceeded, and missed by less than a document
        assert weight * budget - 25_000 < seen <= weight * budget + 1e-6


@pytest.mark.parametrize("repeats", [1.1, 1.3, 50.0])
def test_repeats(documents, repeats):
    sources = totals(mixing.mix(documents, mixing.Target(max_repeats=repeats), block_tokens=2000).collect())
    assert max(seen / tokens for tokens, _, seen in sources.values()) <= repeats
    smallest = min(sources.values())
    if repeats < 50:
        budget = sum(t for t, _, _ in sources.values())
        assert smallest[1] * budget / smallest[0] == pytest.approx(repeats, rel=1e-6)


def test_every_document_once_at_least(documents):
    rows = mixing.mix(documents, mixing.Target(max_repeats=1.5), budget_share=None, block_tokens=2000).collect()
    assert {r.mix_copies for r in rows} == {1, 2} and len(rows) == documents.count()
    sources = totals(rows)
    assert max(seen / tokens for tokens, _, seen in sources.values()) <= 1.5
    largest = max(sources.values())
    assert largest[0] == largest[2]


def test_blocks_are_taken_whole_but_one(documents):
    rows = mixing.mix(documents, mixing.Target(entropy_share=0.95), block_tokens=2000).collect()
    blocks = defaultdict(set)
    for r in rows:
        if r.mix_tokens:
            blocks[r.source, r.mix_block].add(r.mix_copies)
    mixed = defaultdict(int)
    for (source, _), copies in blocks.items():
        mixed[source] += len(copies) > 1
    assert len(blocks) > 100 and max(mixed.values()) == 1


def test_permutations_hold_every_copy(documents):
    mixed = mixing.mix(documents, mixing.Target(max_repeats=3.0), budget_share=2.0)
    copies = mixing.permutations(mixed)
    assert copies.count() == mixed.agg(F.sum("mix_copies")).first()[0]
    assert copies.groupBy("doc_id", "mix_epoch").count().filter("count > 1").count() == 0
    orders = copies.filter("source = 'src0'").groupBy("mix_epoch").agg(F.collect_list(F.struct("mix_block", "mix_block_order"))).collect()
    assert len(orders) >= 1


def test_odd_documents(odd_documents, no_documents):
    rows = mixing.mix(odd_documents, mixing.Target(max_repeats=2.0), budget_share=None).collect()
    assert len(rows) == odd_documents.count() and min(r.mix_copies for r in rows) == 1
    again = mixing.mix(odd_documents, mixing.Target(entropy_share=0.9)).collect()
    assert len(again) == len(rows) and all(r.node == "n" for r in again)
    assert {r.mix_tokens for r in again if not (r.text or "").strip()} == {0}
    assert mixing.mix(no_documents, mixing.Target(entropy_share=0.9)).count() == 0
    inner = ["weight", "epochs", "whole", "blocks", "left", "block", "size", "turn", "span", "id", "_id", "_taken", "tokens", "_in0", "mix_id", "_in1"]
    clash = odd_documents.select("doc_id", "text", "source", *[F.lit(c).alias(c) for c in inner])
    named = mixing.mix(clash, mixing.Target(entropy_share=0.9)).collect()
    assert all(r[c] == c for r in named for c in inner)
    assert sorted(repr((r.doc_id, r.text, r.mix_copies)) for r in named) == sorted(repr((r.doc_id, r.text, r.mix_copies)) for r in again)
    with pytest.raises(ValueError):
        mixing.mix(odd_documents, mixing.Target())
