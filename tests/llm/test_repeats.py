import random

import numpy as np
import pytest

import brute
from stridelake.llm import catalog, repeats
from stridelake.llm.suffixes import common_prefixes, later_windows, suffix_order


def result(df, key="doc_id"):
    return sorted(str((r[key], r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)) for r in df.collect())


def want(rows, width=100):
    return sorted(str((i, *x)) for (i, _), x in zip(rows, brute.without_repeats([t for _, t in rows], width)))


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = sorted((r.doc_id, (r.text or "").encode()) for r in spark.read.parquet(f"{folder}/documents.parquet").collect())
    assert result(catalog.QUERIES["op4_repeats"](spark, folder)) == want(rows)


@pytest.mark.parametrize("hot", [1, 20_000])
@pytest.mark.parametrize("alphabet", ["ab", "abcdefgh", "a"])
def test_small_texts_with_many_repeats(spark, hot, alphabet):
    random.seed(len(alphabet))
    rows = []
    for i in range(60):
        text = "".join(random.choices(alphabet, k=random.randrange(60)))
        if rows and i % 3 == 0:
            other = random.choice(rows)[1]
            text = text[:9] + other[:random.randrange(1 + len(other))] + text[9:]
        rows.append((i, text))
    found = repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), width=12, anchor=4, hot=hot)
    assert result(found) == want([(i, t.encode()) for i, t in rows], 12)


def test_odd_documents(odd_documents, no_documents):
    """Rows with equal id and text are one document; null ids come after all others."""
    rows = list({(r.doc_id, (r.text or "").encode()) for r in odd_documents.collect()})
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0))
    once = dict(zip(rows, brute.without_repeats([t for _, t in rows], 20)))
    every = sorted(str((r.doc_id, *once[r.doc_id, (r.text or "").encode()])) for r in odd_documents.collect())
    assert result(repeats.remove_repeats(odd_documents, width=20, anchor=6)) == every
    assert repeats.remove_repeats(no_documents).count() == 0


def test_what_is_left(spark):
    text = "0123456789" * 30
    rows = spark.createDataFrame([(1, "head" + text), (2, "ä" + text + "tail")], "doc_id long, text string")
    found = {r.doc_id: r for r in repeats.remove_repeats(rows, with_text=True).collect()}
    assert bytes(found[2].kept_text).decode() == "ätail" and found[2].span_starts == [2] and found[2].span_ends == [302]
    assert found[1].n_removed == 290


def test_two_stage_order_is_that_of_all_suffixes():
    for seed in range(60):
        random.seed(seed)
        data = bytes(random.choices(random.choice([b"ab", b"a", bytes(range(256))]), k=random.randrange(1, 200))) + b"\x00\xff"
        text = np.frombuffer(data, np.uint8)
        wanted = np.ones(len(text), bool)
        wanted[-1] = False
        order = suffix_order(text, wanted, 400)
        assert order.tolist() == sorted(range(len(data) - 1), key=lambda i: data[i:])
        prefix = common_prefixes(text, order, 400)
        for k in range(1, len(order)):
            a, b = data[order[k - 1]:], data[order[k]:]
            assert prefix[k] == next((n for n, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def test_later_windows():
    passages = [b"abcabcabc", b"zabcabc", b"abcab"]
    owner, place = later_windows(passages, np.array([5, 3, 1]), np.array([1, 0, 2]), 5)
    first = {}
    everything = [(r, p, passages[i][p:p + 5], i) for i, (n, r) in enumerate(zip((5, 3, 1), (1, 0, 2))) for p in range(n)]
    for r, p, w, i in sorted(everything):
        first.setdefault(w, (r, p))
    assert sorted(zip(owner.tolist(), place.tolist())) == sorted((i, p) for r, p, w, i in everything if first[w] != (r, p))


@pytest.mark.parametrize("hot", [40, 1000, 50_000])
def test_one_passage_in_thousands_of_texts(spark, hot):
    """A passage that stands in every text, with an edit near it in most."""
    draw = random.Random(4)
    common = "".join(draw.choices("abcdefghijklmnop ", k=90))
    rows = []
    for i in range(5000):
        body = list(common)
        if i % 3:
            body[draw.randrange(90)] = draw.choice("XYZ")
        rows.append((i, "".join(draw.choices("abcdefgh ", k=draw.randrange(30))) + "".join(body) + draw.choice(["", "tail of it"])))
    found = repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(9), width=24, anchor=8, hot=hot)
    assert result(found) == want([(i, t.encode()) for i, t in rows], 24)
