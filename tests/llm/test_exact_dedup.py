import hashlib
import re
import shutil

from pyspark.sql import functions as F

from stridelake.llm import exact_dedup


def plain(rows):
    """Per row: kept id, size, kept, digest. Null ids come last."""
    body = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    groups = {}
    for (i, _), t in zip(rows, body):
        groups.setdefault(t, []).append(i)
    keep = {t: min((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    return sorted(str((i, keep[t], len(groups[t]), i == keep[t], hashlib.sha256(t.encode()).hexdigest()))
                  for (i, _), t in zip(rows, body))


def result(df):
    return sorted(str((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256)) for r in df.collect())


def test_odd_documents_in_several_triggers(spark, odd_documents, tmp_path):
    path = str(tmp_path / "documents.parquet")
    odd_documents.repartition(5).write.parquet(path)
    rows = [(r.doc_id, r.text) for r in odd_documents.collect()]
    assert result(exact_dedup.deduplicate(spark, path, files_per_trigger=1)) == plain(rows)


def test_equal_digests_are_told_apart_by_their_texts(spark, odd_documents, tmp_path):
    path = str(tmp_path / "documents.parquet")
    odd_documents.repartition(3).write.parquet(path)
    rows = [(r.doc_id, r.text) for r in odd_documents.collect()]
    found = exact_dedup.deduplicate(spark, path, digest=lambda body: F.substring(exact_dedup.sha256(body), 1, 1))
    assert result(found) == plain(rows)
    one = exact_dedup.deduplicate(spark, path, digest=lambda body: F.substring(exact_dedup.sha256(body), 1, 0))
    assert result(one) == plain(rows)


def test_state_goes_on_with_new_files(spark, tmp_path):
    path, folder = str(tmp_path / "documents.parquet"), str(tmp_path / "state")
    first = [(5, "a b"), (7, "c"), (9, "a  b")]
    later = [(3, "a\tb"), (8, "c"), (11, "d")]
    spark.createDataFrame(first, "doc_id long, text string").write.parquet(path)
    assert result(exact_dedup.deduplicate(spark, path, folder=folder)) == plain(first)
    spark.createDataFrame(later, "doc_id long, text string").write.mode("append").parquet(path)
    assert result(exact_dedup.deduplicate(spark, path, folder=folder)) == plain(first + later)


def test_one_file_and_no_rows(spark, no_documents, tmp_path):
    spark.createDataFrame([(1, "x"), (2, "x")], "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "parts"))
    part, = (tmp_path / "parts").glob("*.parquet")
    shutil.copy(part, tmp_path / "documents.parquet")
    assert result(exact_dedup.deduplicate(spark, str(tmp_path / "documents.parquet"))) == plain([(1, "x"), (2, "x")])
    no_documents.write.parquet(str(tmp_path / "none.parquet"))
    assert exact_dedup.deduplicate(spark, str(tmp_path / "none.parquet")).count() == 0


def test_settings_of_the_session_stay(spark, tmp_path):
    spark.createDataFrame([(1, "x")], "doc_id long, text string").write.parquet(path := str(tmp_path / "d.parquet"))
    before = {k: spark.conf.get(k, None) for k in exact_dedup.STATE_SETTINGS}
    exact_dedup.deduplicate(spark, path).collect()
    assert {k: spark.conf.get(k, None) for k in exact_dedup.STATE_SETTINGS} == before
