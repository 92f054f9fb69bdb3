"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from oracle import compare, duck
from stridelake.functions.crc import crc16
from stridelake.plans import catalog

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    same, note = compare(df, con, entry.oracle_sql()[name])
    assert same, note


def test_every_query_is_known(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0


def test_checksums_of_whole_texts(spark):
    """The query without SQL: byte by byte in plain Python."""
    def plain(data):
        total = 0
        for byte in data:
            total ^= byte
            for _ in range(8):
                total = (total >> 1) ^ 0xA001 if total & 1 else total >> 1
        return total
    got = {r.doc_id: r.crc for r in catalog.QUERIES["crc16_arc_texts"](spark, FOLDER).collect()}
    texts = sorted(spark.read.parquet(f"{FOLDER}/documents.parquet").collect(), key=lambda r: len(r.text))
    for row in texts[:20] + texts[-3:]:
        assert got[row.doc_id] == plain(row.text.encode()) == crc16(row.text.encode())
