
import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

ROWS = [
    (1, "The quick brown fox jumps over the lazy dog and runs away into the dark wood tonight", "a"),
    (2, "The quick brown fox jumps over the lazy dog and runs away into the dark wood tonight", "a"),
    (2, "The quick brown fox jumps over the lazy dog and runs away into the dark wood tonight", "a"),
    (3, None, "b"), (4, "", None), (5, " \t\n ", "b"), (6, "one", "b"), (7, "two words", None),
    (None, "no id at all here", "c"), (None, None, None),
    (8, "ça été là déjà vu naïve œuvre Straße ÄÖÜ 漢字 кириллица", "c"),
    (9, "ab " * 40_000, "d"), (10, "x" * 30_000, "d"), (11, "!!! ### ***", "d")]


@pytest.fixture
def odd_documents(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, and columns with names that results have."""
    names = ("doc_id", "text", "source", "score", "key", "row", "node", "block", "tokens")
    kinds = (LongType(), StringType(), StringType(), *[StringType()] * 6)
    rows = [(*r, "s", None, "r", "n", "b", "t") for r in ROWS]
    return spark.createDataFrame(rows, StructType([StructField(n, k) for n, k in zip(names, kinds)]))


@pytest.fixture
def no_documents(odd_documents):
    return odd_documents.limit(0)
