"""The stored registry against a dictionary, with merges that are repeated or break off."""

import glob
import random

import pytest
from pyspark.sql import functions as F

from stridelake.sources import buckets
from stridelake.streaming import jobs

ROW = "sensor_session_id string, sensor_id string, started_at double, ended_at double, inserted_ts timestamp, modified_ts timestamp"
CHANGE = "sensor_session_id string, sensor_id string, started_at double, deleted boolean, at int"


def moment(number):
    return F.timestamp_seconds(F.lit(1000 + number))


def first_registry(spark, count=40):
    rows = spark.createDataFrame([(f"s{i}_1", f"s{i}", float(i), None if i % 3 else 9.0) for i in range(count)] + [(None, "x", 1.0, 1.0)],
                                 "sensor_session_id string, sensor_id string, started_at double, ended_at double")
    return rows.withColumns({"inserted_ts": moment(-1), "modified_ts": moment(-1)})


def table_rows(df):
    rows = df.withColumns({c: F.unix_seconds(c) for c in ("inserted_ts", "modified_ts")}).collect()
    return {r.sensor_session_id: tuple(r[c] for c in df.columns[1:]) for r in rows}


def applied(rows, changes, number):
    """The changes of a batch one after the other."""
    now, touched = 1000 + number, set()
    for key, sensor, start, gone, _ in sorted((c for c in changes if c[0] is not None), key=lambda c: c[4]):
        if gone:
            rows.pop(key, None)
        else:
            old = rows.get(key, (None, None, None, now, None))
            rows[key] = (sensor, start, old[2], old[3], now)


@pytest.mark.parametrize("count", [1, 7])
def test_merges_are_those_of_a_dictionary(spark, tmp_path, count):
    draw, path = random.Random(count), f"{tmp_path}/table"
    buckets.create(first_registry(spark), path, count)
    want = table_rows(first_registry(spark).filter("sensor_session_id is not null"))
    at = 0
    for number in range(4):
        changes = []
        for _ in range(30):
            key, at = draw.randrange(60), at + 1
            changes.append((f"s{key}_1" if key else None, f"t{at}", draw.choice([None, float(at)]), draw.choice([True, False, None]), at))
        df = spark.createDataFrame(draw.sample(changes, len(changes)), CHANGE)
        assert buckets.merge(df, path, number, "at", moment(number), "deleted")
        applied(want, changes, number)
        assert table_rows(buckets.read(spark, path)) == want
        # The same batch once more, and an earlier one, change nothing.
        assert buckets.merge(df, path, number, "at", moment(99), "deleted") == []
        assert table_rows(buckets.read(spark, path)) == want
    assert buckets.versions(spark, path) == [0, 1, 2, 3, 4]
    buckets.drop_old(spark, path, keep=2)
    assert buckets.versions(spark, path) == [3, 4] and table_rows(buckets.read(spark, path)) == want
    assert buckets.read(spark, path, 3).count() > 0


def test_only_touched_buckets_are_written(spark, tmp_path):
    path = f"{tmp_path}/table"
    buckets.create(first_registry(spark, 400), path, 16)
    assert len(glob.glob(f"{path}/rows/v=0/registry_bucket=*")) == 16
    one = spark.createDataFrame([("s3_1", "hot", 1.0, False, n) for n in range(500)], CHANGE)
    touched = buckets.merge(one, path, 0, "at", deleted="deleted")
    assert len(touched) == 1
    assert [f.rsplit("=", 1)[1] for f in glob.glob(f"{path}/rows/v=1/registry_bucket=*")] == [str(touched[0])]
    files = buckets.read(spark, path).inputFiles()
    assert sum("/v=1/" in f for f in files) == 1 and buckets.read(spark, path).count() == 400
    assert buckets.merge(one.limit(0), path, 1, "at", deleted="deleted") == []
    assert buckets.read_version(spark, path).batch == 1


def test_a_merge_that_breaks_off_is_not_seen(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/table"
    buckets.create(first_registry(spark), path, 4)
    before = table_rows(buckets.read(spark, path))
    change = spark.createDataFrame([("s1_1", "a", 5.0, False, 1), ("s2_1", "a", 5.0, True, 1)], CHANGE)

    def stop(*args):
        raise RuntimeError("lost")
    with monkeypatch.context() as m:
        m.setattr(buckets, "_write_version", stop)
        with pytest.raises(RuntimeError):
            buckets.merge(change, path, 0, "at", moment(0), "deleted")
    assert glob.glob(f"{path}/rows/v=1/*") and table_rows(buckets.read(spark, path)) == before
    buckets.drop_old(spark, path)  # rows of a merge that may still run stay
    assert glob.glob(f"{path}/rows/v=1/*")
    buckets.merge(change, path, 0, "at", moment(0), "deleted")
    after = table_rows(buckets.read(spark, path))
    assert after["s1_1"][1] == 5.0 and "s2_1" not in after and len(after) == len(before) - 1


def test_logged_batches_rewrite_the_registry_when_as_much_came(spark, tmp_path):
    """Batches that touch all buckets: what is rewritten follows what came, and the result is that of merges one by one."""
    draw, path, want, at = random.Random(3), f"{tmp_path}/table", table_rows(first_registry(spark).filter("sensor_session_id is not null")), 0
    buckets.create(first_registry(spark), path, 4)

    def changes_of(rows):
        return rows.withColumn("order", F.struct("batch", "at")).drop("batch", "at")

    def folded(share):
        return buckets.merge_logged(spark, path, changes_of, "order", moment(7), "deleted", share)

    for number in range(12):
        changes = []
        for _ in range(10):
            key, at = draw.randrange(60), at + 1
            changes.append((f"s{key}_1" if key else None, f"t{at}", float(at), draw.choice([True, False, None]), at % 4))
        changes = [*{(c[0], c[4]): c for c in changes}.values()]
        for _ in range(2):  # the same batch once more changes nothing
            buckets.log(spark.createDataFrame(changes, CHANGE), path, number)
            folded(1.0)
        applied(want, changes, 7)
    assert 1 < len(buckets.versions(spark, path)) < 6
    folded(0.0)
    assert table_rows(buckets.read(spark, path)) == want and folded(0.0) == []


def test_empty_registry_new_columns_and_types(spark, tmp_path):
    path = f"{tmp_path}/table"
    buckets.create(first_registry(spark).limit(0), path, 4)
    assert buckets.read(spark, path).count() == 0
    change = spark.createDataFrame([("a_1", "a", 1.0, 7, 1)], "sensor_session_id string, sensor_id string, started_at double, registry_row int, at int")
    buckets.merge(change, path, 0, "at")
    buckets.merge(change.withColumn("sensor_session_id", F.lit("b_1")).drop("registry_row"), path, 1, "at")
    assert {r.sensor_session_id: r.registry_row for r in buckets.read(spark, path).collect()} == {"a_1": 7, "b_1": None}
    gone = spark.createDataFrame([("a_1", True, 1), ("b_1", True, 1)], "sensor_session_id string, deleted boolean, at int")
    buckets.merge(gone, path, 2, "at", deleted="deleted")
    assert buckets.read(spark, path).count() == 0
    with pytest.raises(ValueError, match="started_at$"):
        buckets.merge(change.withColumn("started_at", F.lit("x")), path, 3, "at")
    with pytest.raises(ValueError, match="there is a registry"):
        buckets.create(first_registry(spark), path)


def test_log_is_folded_into_the_registry(spark, tmp_path):
    path = f"{tmp_path}/registry"
    write = jobs.folded_registry(path, buckets=4, every=2)
    rows = "sensor_session_id string, sensor_id string, session_id_part string, session_start_timestamp_us long"
    for number in range(5):
        batch = spark.createDataFrame([(f"s_{number}", "s", str(number), number), ("t_1", "t", "1", number)], rows)
        write(batch, number)
        write(batch, number)  # repeated, as after a restart
        now = {r.sensor_session_id: r.session_start_timestamp_us for r in jobs.registry_now(spark, path).collect()}
        assert now == {f"s_{n}": n for n in range(number + 1)} | {"t_1": number}
    assert buckets.read_version(spark, f"{path}/table").batch == 3
    assert {f.rsplit("=", 1)[1] for f in glob.glob(f"{path}/log/batch=*")} == {"4"}
