import pytest

import brute
from stridelake.llm import catalog, licenses

PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def base(text):
    own = brute.words(text)
    hits = [(i, label) for phrase, label in PHRASES.items() for i in range(len(own))
            if own[i:i + len(phrase.split())] == phrase.split()]
    at = [i for i, _ in hits]
    return (len(own), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({n for _, n in hits})))


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = catalog.QUERIES["op2_licenses"](spark, folder).collect()
    assert len(rows) == len(texts) and sum(r.n_base for r in rows) > 0
    for r in rows:
        assert base(texts[r.doc_id]) == (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1


@pytest.mark.parametrize("text", [
    "Apache License, apache LICENSE mit\nlicense", "CC-BY cc by by", "gnu  general-public license", "xmit license mit licenses",
    "GNU General Public Licensé", "", "MIT License" * 3, "mit license mit license"])
def test_phrases(text):
    assert licenses.scan_text(text.encode())[:5] == base(text)


@pytest.mark.parametrize("line, names, holds", [
    (" MIT", {"mit"}, True), (" MIT OR GPL-3.0-only", {"mit", "gpl-3.0-only"}, True),
    (" MIT AND GPL-3.0-only", {"mit", "gpl-3.0-only"}, False), (" (MIT OR GPL-2.0+) AND ISC */", {"mit", "gpl-2.0+", "isc"}, True),
    (" GPL-2.0-only WITH Classpath-exception-2.0 OR MIT", {"gpl-2.0-only with classpath-exception-2.0", "mit"}, True),
    (" MIT OR GPL-2.0-only AND GPL-3.0-only", {"mit", "gpl-2.0-only", "gpl-3.0-only"}, True)])
def test_expressions(line, names, holds):
    postfix = licenses.read_expression(line.lower())
    assert licenses.names(postfix) == names and licenses.holds(postfix, licenses.PERMISSIVE) == holds


@pytest.mark.parametrize("line", ["", " AND mit", " (mit", " mit or", " ()", " (a or b) with c", "#"])
def test_unreadable_expressions(line):
    with pytest.raises(licenses.BadExpression):
        licenses.names(licenses.read_expression(line.lower()))


def test_tags():
    text = b"# SPDX-License-Identifier: Apache-2.0 OR MIT\n# SPDX-License-Identifier: (broken\nno spdx-license-identifier here"
    found = dict(zip(licenses.FIELDS, licenses.scan_text(text)))
    assert found["labels"] == "apache-2.0,mit" and found["n_tags"] == 2 and found["score"] == 1.0 and found["permissive"]


def test_odd_documents(odd_documents, no_documents):
    rows = licenses.scan(odd_documents).collect()
    assert len(rows) == odd_documents.count() and {r.score for r in rows} == {0.0}
    for r in rows:
        assert base(r.text) == (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) and r.node == "n"
    assert licenses.scan(no_documents).count() == 0
