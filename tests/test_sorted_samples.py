"""The layout for lookups: what a lookup reads of it, and that it is written once."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from stridelake.plans import lookups
from stridelake.sources import files, sorted_samples

START = 1_704_067_200.0


@pytest.fixture(scope="module")
def plain(spark):
    """A spark session without adaptive plans, whose scan metrics can be read."""
    own = spark.newSession()
    own.conf.set("spark.sql.adaptive.enabled", "false")
    own.conf.set("spark.sql.shuffle.partitions", "4")
    return own


def samples(spark, count=60_000):
    """A third of the samples are of one sensor, some of none; two dates."""
    i = F.col("id")
    sensor = F.when(i % 3 == 0, F.lit("hot")).when(i % 50 == 1, F.lit(None)).otherwise(F.concat(F.lit("s"), (i % 200).cast("string")))
    rows = spark.range(count).select(sensor.alias("sensor_id"), (F.lit(START) + i * 2.5).alias("cur_timestamp"), i.cast("double").alias("kafka_timestamp"))
    for name in files.FLAT_RECORD.names[3:]:
        rows = rows.withColumn(name, F.col("kafka_timestamp") / 7)
    return files.with_date(rows, F.timestamp_seconds("cur_timestamp"))


def rows_scanned(stored, sensor, date):
    """Without the sort, which would scan once more for its ranges."""
    df = stored.filter((F.col("dt") == F.lit(date).cast("date")) & (F.col("sensor_id") == sensor))
    plan = df._jdf.queryExecution().executedPlan()
    plan.executeCollect()  # the metrics are those of this very plan
    return plan.collectLeaves().head().metrics().apply("numOutputRows").value()


def test_a_lookup_reads_few_rows(plain, tmp_path):
    path, given = f"{tmp_path}/sorted", samples(plain)
    sorted_samples.write_sorted(given, path, 4, row_group_bytes=64 * 1024)
    stored = files.read_samples(plain, path)
    assert stored.count() == given.count()
    for sensor, date in (("s7", "2024-01-01"), ("hot", "2024-01-02"), ("nobody", "2024-01-01")):
        found = lookups.sensor_on_date(stored, sensor, date)
        want = lookups.sensor_on_date(given, sensor, date)
        assert [tuple(r) for r in found.select(want.columns).collect()] == [tuple(r) for r in want.collect()]
        # Besides the sensor's rows, at most the rest of the row groups at both ends of its range.
        groups = [pq.ParquetFile(f).metadata for f in glob.glob(f"{path}/dt={date}/*.parquet")]
        sizes = [g.row_group(n).num_rows for g in groups for n in range(g.num_row_groups)]
        assert len(sizes) > 3
        assert rows_scanned(stored, sensor, date) <= want.count() + 2 * max(sizes) < sum(sizes)
    assert rows_scanned(stored, "nobody", "2024-01-01") == 0
    hot = [f for f in glob.glob(f"{path}/dt=*/*.parquet") if "hot" in pq.read_table(f, columns=["sensor_id"], partitioning=None)["sensor_id"].to_pylist()]
    assert len(hot) > 1


def test_layout_is_written_once_for_each_input(spark, tmp_path):
    given = samples(spark, 300)
    for name in ("a", "b"):
        given.drop("dt").write.parquet(f"{tmp_path}/{name}")

    def stored(name):
        rows = files.with_date(spark.read.parquet(f"{tmp_path}/{name}"), F.timestamp_seconds("cur_timestamp"))
        return sorted_samples.stored_once(rows, "test")
    first, again, other = stored("a"), stored("a"), stored("b")
    assert sorted(first.inputFiles()) == sorted(again.inputFiles()) and first.count() == 300
    assert not set(first.inputFiles()) & set(other.inputFiles())
    given.drop("dt").limit(5).write.mode("append").parquet(f"{tmp_path}/a")
    assert stored("a").count() == 305
    assert files.read_samples(spark, first.inputFiles()[0].rsplit("/", 2)[0]).count() == 300


def test_empty_table_and_ties(spark, tmp_path):
    sorted_samples.write_sorted(samples(spark, 10).limit(0), f"{tmp_path}/none")
    assert files.read_samples(spark, f"{tmp_path}/none").count() == 0
    same = samples(spark, 30).withColumn("cur_timestamp", F.lit(START))
    firsts = [[tuple(r) for r in lookups.first_rows(same.repartition(n), 7).collect()] for n in (1, 3, 5)]
    assert firsts[0] == firsts[1] == firsts[2]
