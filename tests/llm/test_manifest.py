"""The manifest against plain Python, with several rounds of small blocks, and on odd rows."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from stridelake.llm import manifest

FIELDS = ["doc_id", "source", "text"]


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def levels(nodes):
    found = [nodes]
    while len(found[-1]) > 1:
        found.append([h("".join(found[-1][i:i + 16])) for i in range(0, len(found[-1]), 16)])
    return found


def ways(nodes):
    """The top, and per node the siblings left and right on each level."""
    found = levels(nodes)
    paths = []
    for place in range(len(nodes)):
        path = []
        for level in found[:-1]:
            run = place // 16 * 16
            path.append(("".join(level[run:place]), "".join(level[place + 1:run + 16])))
            place //= 16
        paths.append(path)
    return found[-1][0], paths


def expected(rows):
    """Digest, path and top of every row, ordered as the manifest orders them."""
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    made = {}
    for name in names:
        ordered = sorted(groups[name], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        nodes = [leaf(r) for r in ordered]
        made[name] = (ordered, nodes, *ways(nodes))
    root, over = ways([made[n][2] for n in names])
    out = []
    for name, upper in zip(names, over):
        ordered, nodes, top, paths = made[name]
        out += [(r[0], name, node, path + upper, top, root) for r, node, path in zip(ordered, nodes, paths)]
    return out


def plain(found):
    return sorted(((r[0], r[1], r.leaf, [(bytes(p.left).decode(), bytes(p.right).decode()) for p in r.path], r.subroot, r.root)
                   for r in found.collect()), key=repr)


@pytest.mark.parametrize("levels_held", [1, 2])
def test_many_rounds(spark, monkeypatch, levels_held):
    monkeypatch.setattr(manifest, "LEVELS", levels_held)
    monkeypatch.setattr(manifest, "BLOCK", 16 ** levels_held)
    draw = random.Random(3)
    sizes = {"big": 700, "one": 1, "sixteen": 16, "seventeen": 17, None: 5, "": 3, **{f"s{i}": 2 for i in range(30)}}
    rows = [(draw.randrange(10 ** 6), name, f"text {draw.random()}") for name, n in sizes.items() for _ in range(n)]
    draw.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(7)
    assert plain(manifest.manifest(docs, FIELDS)) == sorted(expected(rows), key=repr)


def test_tampering_shows(spark):
    rows = [(i, "a" if i % 3 else "b", f"Text {i}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    shown = F.when(F.col("doc_id") % 7 == 0, manifest.leaf([F.col("doc_id"), F.col("source"), F.lower("text")]))
    found = manifest.manifest(docs, FIELDS, presented=shown).withColumn("shown", F.coalesce("presented", "leaf"))
    got = {r.doc_id: (r.verified, r.folded_root == r.root) for r in manifest.verified(found, "shown").collect()}
    assert got == {i: (i % 7 != 0,) * 2 for i in range(60)}


def test_odd_rows(spark, odd_documents, no_documents):
    """Null ids and groups, repeated rows, long texts, clashing names, no rows."""
    rows = [(r.doc_id, r.source, r.text) for r in odd_documents.collect()]
    assert plain(manifest.manifest(odd_documents, FIELDS)) == sorted(expected(rows), key=repr)
    one = manifest.manifest(odd_documents.filter("doc_id = 9"), FIELDS)
    only = one.collect()[0]
    assert only.path == [] and only.leaf == only.subroot == only.root
    assert manifest.verified(manifest.manifest(no_documents, FIELDS)).collect() == []
    clash = odd_documents.select("doc_id", "source", "text", *[F.lit("x").alias(c) for c in ("grp", "n", "pos", "held", "digest", "block")])
    assert plain(manifest.manifest(clash, FIELDS)) == sorted(expected(rows), key=repr)


def test_proof_of_all_siblings(spark):
    rows = [(i, "a", str(i)) for i in range(40)]
    found = manifest.manifest(spark.createDataFrame(rows, "doc_id long, source string, text string"), FIELDS)
    got = {r.doc_id: r.proof for r in found.select("doc_id", manifest.proof_digest(F.col("path")).alias("proof")).collect()}
    assert got == {r[0]: h("".join(a + b for a, b in r[3])) for r in expected(rows)}
