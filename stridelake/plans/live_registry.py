"""The registered query of a session registry that a stream of changes keeps up to date in place."""

from __future__ import annotations

from pyspark.sql import functions as F

from stridelake.plans import derive
from stridelake.plans.catalog import REG, query
from stridelake.plans.live import in_slices, run
from stridelake.session import new_folder
from stridelake.sources import buckets, files
from stridelake.streaming import timers

BUCKETS = 32


@query("stream_session_registry", f"""WITH {REG},
 ch AS (SELECT CASE WHEN l_returnflag = 'R' THEN 'n' ELSE CAST(o_custkey AS VARCHAR) END AS sensor, l_orderkey, l_extendedprice AS price,
          CAST(l_shipdate AS DATE) AS day, l_linenumber AS line, l_quantity > 45 AS gone
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
 ranked AS (SELECT *, sensor || '_' || CAST(l_orderkey AS VARCHAR) AS id, bool_or(gone) OVER (PARTITION BY sensor, l_orderkey) AS cut,
          row_number() OVER (PARTITION BY sensor, l_orderkey ORDER BY day DESC, line DESC, price DESC, gone DESC) AS r FROM ch),
 last AS (SELECT * FROM ranked WHERE r = 1)
 SELECT coalesce(id, sensor_session_id) AS sensor_session_id, coalesce(last.sensor, reg.sensor_id) AS sensor_id,
   coalesce(price, started_at) AS started_at, CASE WHEN cut IS NOT TRUE THEN ended_at END AS ended_at,
   CASE WHEN cut IS NOT TRUE THEN sum_workload END AS sum_workload,
   reg.inserted_ts IS NOT NULL AND cut IS NOT TRUE AS known, id IS NOT NULL AS modified
 FROM reg FULL JOIN last ON id = sensor_session_id WHERE gone IS NOT TRUE""")
def stream_session_registry(spark, folder):
    """Orders as the stored registry, and their lines by ship date as changes; lines of large quantities delete."""
    path = new_folder(spark, "session-registry")
    own = timers.state_session(spark)
    buckets.create(derive.session_registry(own, folder), f"{path}/table", BUCKETS)
    lines = files.table(own, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "l_returnflag", "l_quantity", F.unix_date(F.to_date("l_shipdate")).alias("day"))
    in_slices(lines, "day", f"{path}/in")
    known = files.table(own, folder, "orders").select("o_orderkey", "o_custkey")
    sensor = F.when(F.col("l_returnflag") == "R", F.lit("n")).otherwise(F.col("o_custkey").cast("string"))
    start = F.timestamp_seconds(F.lit(2_000_000_000))

    def changes_of(came):
        return came.join(known, F.col("l_orderkey") == F.col("o_orderkey")).select(
            F.concat(sensor, F.lit("_"), F.col("l_orderkey").cast("string")).alias("sensor_session_id"), sensor.alias("sensor_id"),
            F.col("l_extendedprice").alias("started_at"), (F.col("l_quantity") > 45).alias("deleted"),
            F.struct("batch", "day", "l_linenumber", "l_extendedprice", F.col("l_quantity") > 45).alias("at"))

    def write(batch, number):
        buckets.log(batch, f"{path}/table", number)
        buckets.merge_logged(own, f"{path}/table", changes_of, "at", start, "deleted", share=1.0)

    run(files.stream_files(own, f"{path}/in", lines.schema, files_per_trigger=1), path, write, timed=False)
    buckets.merge_logged(own, f"{path}/table", changes_of, "at", start, "deleted")
    return buckets.read(own, f"{path}/table").select(
        "sensor_session_id", "sensor_id", "started_at", "ended_at", "sum_workload",
        (F.col("inserted_ts") < start).alias("known"), (F.col("modified_ts") == start).alias("modified"))
