"""Ingest, transform, documents, serving views, registry, storage."""

import json

import pytest
from pyspark.sql import functions as F

from stridelake.functions import clock, keys, motion
from stridelake.operators import ingest, outputs, registry, serving, transform
from stridelake.plans import lookups
from stridelake.sources import files


def messages(spark, *payloads, at_ms=5_000):
    rows = [(None, p, "imu-data-all", 0, i) for i, p in enumerate(payloads)]
    df = spark.createDataFrame(rows, "key string, value string, topic string, partition int, offset long")
    return df.withColumn("timestamp", F.timestamp_millis(F.lit(at_ms)))


GOOD = '{"sensor_id":"a","header_timestamp_us":2000000,"x":{"y":1},"samples":[%s]}'


def one(spark, sample):
    records = transform.transform_records(ingest.input_records(messages(spark, GOOD % sample)))
    return records.select(F.explode("samples").alias("s")).select("s.*").collect()


def test_gate(spark):
    assert ingest.gate(messages(spark, "{}", "", None)).count() == 1
    assert ingest.gate(messages(spark, "{}", at_ms=0)).count() == 0
    assert ingest.decode_bytes(messages(spark, "é").withColumn("value", F.col("value").cast("binary"))).first().value == "é"


def test_quarantine_and_strict(spark):
    bad = ['{"k": 5', "[]", "nonsense", "null", "5", '{"header_timestamp_us":"abc"}', '{"samples":{"a":1}}', '{"samples":[5]}']
    good = [GOOD % '{"acc":{"x":"bad","y":1}},null', "{}", GOOD % '{"acc":5}', GOOD % '{"acc":{"x":"NaN"}}']
    parsed = ingest.parse(messages(spark, *bad, *good))
    assert sorted(r.offset for r in ingest.quarantine(parsed).collect()) == list(range(len(bad)))
    assert ingest.good_rows(parsed).count() == len(good)
    with pytest.raises(Exception, match="bad JSON"):
        ingest.input_records(messages(spark, "nonsense"), on_error="fail").collect()


def test_broker_time_overwrites(spark):
    row = ingest.input_records(messages(spark, '{"sensor_id":"a","kafka_timestamp":7}')).first()
    assert row.kafka_timestamp == 5_000_000 and row.samples is None
    assert list(transform.transform_records(ingest.input_records(messages(spark, '{"sensor_id":"a"}'))).first().samples) == []


def test_flattening(spark):
    s, = one(spark, '{"acc":{"x":3,"y":4},"gyro":{"x":180,"q":9},"mag":{"z":1},"gyro_y":2,"other":5,"accl_mag":99},null')
    assert (s.acc_x, s.acc_y, s.acc_z, s.accl_mag) == (3.0, 4.0, None, 5.0)
    assert abs(s.gyro_x - 3.141592653589793) < 1e-15 and s.gyro_y == 2.0 and s.mag_z == 1.0
    assert abs(s.gyro_mag - (s.gyro_x ** 2 + 4) ** 0.5) < 1e-12
    assert s.timestamp == 2.0 and s.predicted_velocity is None
    text, = one(spark, '{"acc":{"x":"bad","y":2}}')
    assert (text.acc_x, text.acc_y) == (None, 2.0)


def test_missing_header_and_sensor(spark):
    rows = messages(spark, '{"sensor_id":"a","samples":[{"acc":{"x":1}}]}', '{"samples":[{"acc":{"x":1}}]}')
    records = transform.transform_records(ingest.input_records(rows))
    assert records.count() == 1 and records.first().samples[0].timestamp == 0.0
    assert transform.explode_samples(records).count() == 0
    assert transform.nonempty(records).count() == 1


def test_interpolated_times_count_null_samples(spark):
    schema = "sensor_id string, header_timestamp_us long, kafka_timestamp long, samples array<struct<%s>>" % ",".join(
        f"{c}:double" for c in transform.SAMPLE_FIELDS)
    sample = tuple([1.0] * len(transform.SAMPLE_FIELDS))
    df = spark.createDataFrame([("a", 1_000_000, None, [sample, None, sample])], schema)
    got = transform.explode_samples(df).collect()
    assert [r.cur_timestamp for r in got] == [1.0, 1.01] and [r.kafka_timestamp for r in got] == [None, None]


def test_times(spark):
    df = spark.createDataFrame([(1_704_067_200_123_999,), (None,)], "us long")
    got = df.select(clock.micros_to_text(F.col("us")), clock.text_to_millis(clock.micros_to_text(F.col("us"))),
                    clock.delay_seconds(F.lit(1_704_067_201_000), F.col("us"))).collect()
    assert tuple(got[0]) == ("2024-01-01 00:00:00.123", 1_704_067_200_123, 0.877) and tuple(got[1]) == (None, None, None)
    assert df.select(clock.delay_seconds(F.lit(1), F.lit(0))).first()[0] is None
    assert len(df.select(clock.now_text()).first()[0]) == 23


def test_keys(spark):
    df = spark.createDataFrame([("sensors/7/imu", "0_9_1"), ("other", "10_2")], "t string, s string")
    got = df.select(keys.topic_sensor_id(F.col("t"), "sensors/+/imu"), keys.normal_session_key(F.col("s")),
                    keys.stable_partition(F.lit("123456789"), 1000)).collect()
    assert [tuple(r) for r in got] == [("7", "9_1", 0xCBF43926 % 1000), (None, "10_2", 0xCBF43926 % 1000)]


def test_numbers(spark):
    df = spark.createDataFrame([("1.5",), ("x",), (None,), ("NaN",), ("12abc",), (" -3e2z",)], "t string")
    assert [r[0] for r in df.select(motion.coerced_number(F.col("t"))).collect()] == [1.5, 0.0, 0.0, 0.0, 0.0, 0.0]
    assert [r[0] for r in df.select(motion.leading_number(F.col("t"))).collect()] == [1.5, None, None, None, 12.0, -300.0]


def test_documents(spark):
    aggregate = spark.createDataFrame([("a_1", "a", 2.0, None, 5)],
        "sensor_session_id string, sensor_id string, session_max_velocity double, session_total_distance double, aggregation_timestamp_ms long")
    assert json.loads(outputs.aggregate_json(aggregate).first().value) == {
        "sensor_session_id": "a_1", "sensor_id": "a", "session_max_velocity": 2.0, "session_total_distance": None,
        "aggregation_timestamp_ms": 5, "max_velocity_so_far": 2.0, "distance_so_far": None}
    records = transform.transform_records(ingest.input_records(messages(spark, GOOD % '{"acc":{"x":1}}')))
    row = outputs.record_json(records.withColumn("sensor_session_id", F.lit("a_5")), F.lit(5_250)).first()
    document = json.loads(row.value)
    assert row.key == "a" and document["kafka_timestamp"] == "1970-01-01 00:00:05.000" and document["delay_s"] == 0.25
    assert document["delay_ms"] == 250 and document["type"] == "transformed-data" and document["samples"][0]["acc_y"] is None


def test_batch_of_three_raw_messages(spark):
    df = spark.createDataFrame(
        [(i, "s", 1.1 + i / 10, f"2025-01-01T10:00:0{i + 1}") for i in range(4)], "seq long, sensor_id string, acc_z double, timestamp string")
    doc, = serving.full_batch_documents(df, "seq", ["sensor_id", "acc_z", "timestamp"], size=3).collect()
    assert (doc.type, doc.batch_size, doc.sensor_id, doc.message) == ("transformed-data", 3, "s", None)
    assert [round(m.acc_z, 1) for m in doc.samples] == [1.1, 1.2, 1.3]
    rest = serving.with_batch_number(df, "seq", 3).filter("not batch_full")
    last, = serving.flush_documents(rest, "seq", ["sensor_id", "acc_z"]).collect()
    assert last.batch_size == 1


def test_workload_messages_send_only_the_last(spark):
    df = spark.createDataFrame([(1, "s", 15.5, 5.2), (2, "s", 18.7, 3.2)], "seq long, sensor_id string, sum_workload double, last_workload double")
    doc, = serving.full_batch_documents(df, "seq", ["sensor_id", "sum_workload", "last_workload"], size=2).collect()
    assert doc.samples is None and doc.message.sum_workload == 18.7
    assert serving.latest_workload(df, "seq", ["sum_workload"]).first().sum_workload == 18.7
    plain = df.withColumn("sum_workload", F.when(F.col("seq") > 1, F.col("sum_workload"))).drop("last_workload")
    assert serving.latest_workload(plain, "seq", ["sum_workload"]).count() == 0


def test_last_messages_and_points(spark):
    df = spark.createDataFrame([(i, "s" if i % 3 else "t", "x" if i % 5 == 0 else str(i)) for i in range(60)], "seq long, sensor_id string, acc_z string")
    assert sorted(r.seq for r in serving.last_messages(df, "seq", 2).collect()) == [54, 57, 58, 59]
    assert sorted(r.acc_z for r in serving.chart_points(df, "seq", n=2).collect()) == [54.0, 57.0, 58.0, 59.0]


def test_registry(spark):
    now = F.lit("2024-02-01").cast("timestamp")
    old = F.lit("2024-01-01").cast("timestamp")
    have = spark.createDataFrame([("a_1", "a", 1.0, 9.0), ("b_1", "b", 2.0, None)], "sensor_session_id string, sensor_id string, started_at double, ended_at double")
    have = have.withColumns({"inserted_ts": old, "modified_ts": old})
    change = spark.createDataFrame([("a_1", "a", 3.0, 1), ("a_1", "a", 4.0, 2), ("c_1", "c", 5.0, 1)], "sensor_session_id string, sensor_id string, started_at double, at int")
    got = {r.sensor_session_id: r for r in registry.upsert_sessions(have, change, now, "at").collect()}
    assert set(got) == {"a_1", "b_1", "c_1"}
    assert (got["a_1"].started_at, got["a_1"].ended_at) == (4.0, 9.0)
    assert got["a_1"].inserted_ts.month == 1 and got["a_1"].modified_ts.month == 2
    assert got["b_1"].modified_ts.month == 1 and got["c_1"].inserted_ts.month == 2
    assert [r.sensor_session_id for r in registry.list_sessions(have, active_only=True).collect()] == ["b_1"]
    assert registry.list_sessions(have).count() == 2
    assert [r.sensor_session_id for r in registry.delete_sessions(have, change).collect()] == ["b_1"]


def stored(spark):
    rows = [(s, 1_704_067_200.0 + i / 200, 1_704_067_200.0 + i / 200) for i in range(50) for s in ("hot", "hot2", "b")]
    df = spark.createDataFrame(rows, "sensor_id string, cur_timestamp double, kafka_timestamp double")
    for name in files.FLAT_RECORD.names[3:]:
        df = df.withColumn(name, F.lit(1.0))
    return files.with_date(df, F.timestamp_seconds("cur_timestamp"))


@pytest.mark.parametrize("by_sensor", [False, True])
def test_storage_by_date(spark, tmp_path, by_sensor):
    path = str(tmp_path / "samples")
    files.write_samples(stored(spark), path, by_sensor)
    rows = files.read_samples(spark, path, "2024-01-01")
    found = lookups.sensor_on_date(rows, "b", "2024-01-01")
    assert found.count() == 50 and lookups.first_rows(found).count() == 5
    assert found.first().datetime.isoformat() == "2024-01-01T00:00:00"
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "dt#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    pushed = plan.split("PartitionFilters: [" if by_sensor else "PushedFilters: [")[1].split("]")[0]
    assert "sensor_id" in pushed
    assert lookups.sensor_on_date(rows, "nobody", "2024-01-01").count() == 0
    series = lookups.sensor_series(rows, "hot")._jdf.queryExecution().executedPlan().toString()
    assert "gyro_x" not in series.split("ReadSchema:")[1]


def test_plain_date_folders(spark, tmp_path):
    stored(spark).drop("dt").write.parquet(f"{tmp_path}/2024-01-01")
    rows = files.read_samples(spark, str(tmp_path), "2024-01-01", plain_folders=True)
    assert lookups.sensor_on_date(rows, "hot", "2024-01-01").count() == 50


def test_whole_numbers_as_texts_and_with_fractions(spark):
    good = ['{"sensor_id":"a","header_timestamp_us":"123","samples":[]}', '{"sensor_id":"a","header_timestamp_us":12.0,"samples":[]}',
            '{"sensor_id":"a","header_timestamp_us":1704067200000001,"samples":[]}', '{"sensor_id":"a","header_timestamp_us":null}']
    bad = ['{"sensor_id":"a","header_timestamp_us":"soon"}', '{"sensor_id":"a","header_timestamp_us":{"t":1}}', '{"sensor_id":"a","header_timestamp_us":true}']
    messages = spark.createDataFrame([(v,) for v in good + bad], "value string").withColumn("timestamp", F.timestamp_millis(F.lit(1)))
    parsed = ingest.parse(messages)
    found = {r.value: r.record.header_timestamp_us for r in ingest.good_rows(parsed).collect()}
    assert found == dict(zip(good, [123, 12, 1704067200000001, None]))
    assert sorted(r.payload for r in ingest.quarantine(parsed).collect()) == sorted(bad)


def test_required_columns_are_named_when_missing(spark):
    df = spark.createDataFrame([("1.5", None, 3, "x"), ("no", "NaN", None, "y")], "`a.b` string, T string, n int, other string")
    got = ingest.required_numbers(df, ["a.b", "t", "n"])
    assert [tuple(r) for r in got.collect()] == [(1.5, 0.0, 3.0, "x"), (0.0, 0.0, 0.0, "y")]
    assert ingest.required_numbers(df.limit(0), ["n"]).count() == 0
    with pytest.raises(ValueError, match="gone, Missing too$"):
        ingest.required_numbers(df, ["n", "gone", "Missing too"])
