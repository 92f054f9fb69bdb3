"""Registered corpus queries against their SQL, and their columns."""

import pytest

import __spark_entry__ as entry
from oracle import compare, duck
from stridelake.llm import catalog

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query(spark, name):
    same, note = compare(catalog.QUERIES[name](spark, FOLDER), duck(FOLDER), catalog.ORACLES[name])
    assert same, note


def test_all_are_registered():
    names = set(entry.queries())
    assert "pipeline" in names and {n.split("_")[0] for n in catalog.QUERIES} == {f"op{i}" for i in range(1, 14)} <= {
        n.split("_")[0] for n in names}
