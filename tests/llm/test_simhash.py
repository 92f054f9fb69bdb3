import random

import numpy as np
import pytest

import brute
from stridelake.llm import catalog, simhash
from stridelake.llm.components import components


def groups(rows, radius=3):
    prints = [brute.fingerprint(t) for _, t in rows]
    links = [(a, b) for a in range(len(rows)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= radius]
    root = brute.roots(len(rows), links)
    least = {}
    for (i, _), r in zip(rows, root):
        if i is not None:
            least[r] = min(least.get(r, i), i)
    return sorted(str((i, f"{p:016x}", least.get(r))) for (i, _), p, r in zip(rows, prints, root))


def result(df):
    return sorted(str((r.doc_id, r.fingerprint, r.component_id)) for r in df.collect())


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert result(catalog.QUERIES["op9_simhash"](spark, folder)) == groups(rows)


def test_odd_documents(spark, odd_documents, no_documents):
    rows = [(r.doc_id, r.text) for r in odd_documents.collect()]
    assert result(simhash.near_duplicates(odd_documents)) == groups(rows)
    assert simhash.near_duplicates(no_documents).count() == 0


def test_majority_of_long_runs():
    rng = np.random.default_rng(1)
    counts = np.array([0, 1, 254, 255, 256, 0, 70_000, 3])
    hashes = rng.integers(0, 1 << 63, counts.sum(), dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, counts.sum(), dtype=np.uint64)
    found, at = simhash.majority_bits(hashes, counts), 0
    for n, word in zip(counts, found):
        held = hashes[at:at + n]
        at += n
        assert int(word) == sum(1 << b for b in range(64) if 2 * int((held >> np.uint64(b) & np.uint64(1)).sum()) > n)


@pytest.mark.parametrize("block", [3, 2048])
def test_links_connect_like_all_pairs(spark, monkeypatch, block):
    """A cluster in which everything is near, chains that leave tiles, and noise; blocks of a few rows."""
    monkeypatch.setattr(simhash, "BLOCK", block)
    random.seed(2)
    centre = random.getrandbits(64)
    values = {centre ^ (1 << random.randrange(64)) for _ in range(40)} | {random.getrandbits(64) for _ in range(40)} | {0, 1, 3, 7, 15, 31, 63}
    chain = centre
    for bit in range(0, 60, 3):
        chain ^= 0b111 << bit
        values.add(chain)
    values = [v - (1 << 64) if v >> 63 else v for v in sorted(values)]
    from pyspark.sql import functions as F
    nodes = spark.createDataFrame([(v,) for v in values], "node long").select(
        "node", F.array("node").alias("parts"), simhash.tile_of(F.col("node")).alias("tile"))
    links = simhash.tile_links(nodes, simhash.tile_steps(3), 3, 1)
    index = {v: i for i, v in enumerate(values)}
    found = brute.roots(len(values), [(index[r.u], index[r.v]) for r in links.collect()])
    mask = (1 << 64) - 1
    want = brute.roots(len(values), [(a, b) for a in range(len(values)) for b in range(a)
                                     if ((values[a] ^ values[b]) & mask).bit_count() <= 3])
    assert found == want
    roots = {r.node: r.root for r in components(links).collect()}
    assert [roots.get(v, v) for v in values] == [values[r] for r in want]


def test_components_of_chains_stars_and_rings(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(1, i) for i in range(2, 50)] + [(60, 70), (70, 80), (80, 60), (90, 90), (70, 60)]
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    want = {i: 100 for i in range(100, 161)} | {i: 1 for i in range(1, 50)} | {60: 60, 70: 60, 80: 60}
    assert found == want
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_similar_groups(spark):
    """Copies with a few changed words meet, texts that share less than half of their words do not."""
    random.seed(3)
    words = [f"w{i}" for i in range(3000)]
    rows = []
    for n in range(30):
        own = random.choices(words, k=300)
        rows.append((10 * n, " ".join(own)))
        for copy in range(1, 4):  # similarity 0.9 and more
            changed = list(own)
            changed[random.randrange(300)] = f"new{n}{copy}"
            changed[random.randrange(300)] = f"other{n}{copy}"
            rows.append((10 * n + copy, " ".join(changed)))
        rows.append((10 * n + 9, " ".join(own[:140] + random.choices(words, k=160))))
    found = {r.id: r.component_id for r in simhash.similar_groups(
        spark.createDataFrame(rows, "doc_id long, text string"), "doc_id").collect()}
    assert found == {i: i if i % 10 == 9 else i - i % 10 for i, _ in rows}


def test_similar_groups_of_odd_documents(odd_documents, no_documents):
    rows = simhash.similar_groups(odd_documents, "doc_id").collect()
    assert len(rows) == odd_documents.count()
    found = {r.id: r.component_id for r in rows}
    assert found[1] == found[2] == 1 and found[3] == found[4] == found[5] == 3 and found[6] == 6 and found[9] == 9
    assert simhash.similar_groups(no_documents, "doc_id").count() == 0


def component_ids(spark, texts):
    rows = list(enumerate(texts))
    found = simhash.similar_groups(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id").collect()
    return [i for _, i in sorted((r.id, r.component_id) for r in found)]


def own_words(name, count):
    return [f"{name}{i}" for i in range(count)]


def longer(name, size, more):
    """A text of so many different shingles, and the same with further words at the end."""
    words = own_words(name, size + 4 + more)
    return [" ".join(words[:size + 4]), " ".join(words)]


def test_texts_with_a_common_repeated_line_stay_apart(spark):
    line = "all rights reserved by the owner".split()
    assert component_ids(spark, [" ".join(own_words(n, 100) + line * 100) for n in "abc"]) == [0, 1, 2]


@pytest.mark.parametrize("block", [100, 1 << 19])
def test_only_sets_of_enough_similarity_meet(spark, monkeypatch, block):
    """Pairs just under 0.8 (0.7 to 0.797), in large and in small blocks."""
    monkeypatch.setattr(simhash, "SET_BLOCK", block)
    under = [t for n in range(40) for t in longer(f"u{n}x", 200, 51 + n % 35)]
    assert component_ids(spark, under) == list(range(80))


def test_equal_sets_with_other_repeat_counts_meet(spark):
    body, line = own_words("b", 300), own_words("l", 20)
    assert component_ids(spark, [" ".join(body + line * 10), " ".join(body + line * 30)]) == [0, 0]


@pytest.mark.parametrize("block", [500, 1 << 19])
def test_every_near_copy_from_the_limit_on_meets(spark, monkeypatch, block):
    """No exact copies: pairs at 0.8 to 0.85, some of few shingles, each found without tolerance."""
    monkeypatch.setattr(simhash, "WIDE_BLOCK", block)
    sizes = [(20, 5), (24, 5), (40, 8), (88, 22), (100, 25), (160, 40), (400, 100), (800, 200)]
    texts = [t for n in range(800) for t in longer(f"p{n}x", *sizes[n % len(sizes)])]
    assert component_ids(spark, texts) == [i - i % 2 for i in range(len(texts))]


def test_radius_holds_for_every_pair_of_small_sets():
    for a in range(4, 27):
        radius = simhash.wide_radius(0.8, 8, a)
        for b in range(a, 5 * a // 4 + 1):
            for common in range(1, a + 1):
                if 10 * common >= 8 * (a + b - common):
                    assert simhash.bits_within(simhash.flip_share(a, b, common), 512) <= radius


def test_short_texts_meet_from_four_shingles_on(spark):
    """One word more (0.9, 0.83 and 0.8), one of nine shingles exchanged (0.8); three shingles and four (0.75) stay apart."""
    texts = [t for n in range(20) for size in (9, 5, 4) for t in longer(f"s{n}x{size}x", size, 1)]
    words = own_words("e", 14)
    texts += [" ".join(words[:13]), " ".join(words[1:]), *longer("t", 3, 1), "one two", "one two", "one two three"]
    want = [i - i % 2 for i in range(122)] + [122, 123, 124, 124, 126]
    assert component_ids(spark, texts) == want
