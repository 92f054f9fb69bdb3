"""The registered queries, each with the SQL that must give the same rows on the same tables."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from stridelake.functions import clock, keys, motion
from stridelake.functions.crc import crc16_arc
from stridelake.operators import (
    aggregates, features, ingest, outputs, packets, registry, scoring, serving, sessions, transform,
)
from stridelake.plans import derive, lookups
from stridelake.session import new_folder
from stridelake.sources import files, sorted_samples
from stridelake.sources.files import table
from stridelake.streaming import jobs, keyed

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# A gap that joins some of the events of a user; the job's own gap makes nearly every event a session.
GAP_US = 6 * 3600 * 1_000_000
DAY_MS = 86_400_000


def query(name: str, sql: str | None = None):
    def add(fn: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, folder)
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


# ---- SQL forms of the derived views ------------------------------------------------------------

SENS = """sens AS (
  SELECT event_id AS seq, CAST(user_id AS VARCHAR) AS sensor_id, epoch_us(ts) AS kafka_timestamp,
         value AS v, event_type, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events)"""

TYPES = SENS.replace("CAST(user_id AS VARCHAR)", "event_type")

SESS = SENS + f""",
 gaps AS (SELECT *, lag(kafka_timestamp) OVER (PARTITION BY sensor_id ORDER BY seq) AS prev FROM sens),
 flags AS (SELECT *, (prev IS NULL OR kafka_timestamp - prev > {GAP_US}) AS is_new FROM gaps),
 sess AS (SELECT *, max(CASE WHEN is_new THEN kafka_timestamp END) OVER (
            PARTITION BY sensor_id ORDER BY seq ROWS UNBOUNDED PRECEDING) AS part FROM flags)"""

GATED = SENS + """,
 gated AS (SELECT * FROM sens WHERE NOT (event_type = 'purchase' AND (k < 5 OR k >= 95))
             AND NOT (event_type = 'click' AND k < 5)),
 rec AS (SELECT seq, k, v, k // 20 AS n,
           CASE WHEN event_type = 'error' AND k < 10 THEN NULL ELSE sensor_id END AS sensor_id,
           CASE WHEN event_type = 'view' AND k < 10 THEN NULL ELSE kafka_timestamp + 1 END AS header_timestamp_us,
           (kafka_timestamp // 1000) * 1000 AS kafka_timestamp,
           (event_type = 'click' AND k >= 95) AS no_list
         FROM gated WHERE NOT (event_type = 'signup' AND k < 10))"""

# Sample kinds 0, 2 and 3 of the derived messages; kind 1 is null and leaves no row.
SAMPLES = GATED + """,
 smp AS (
  SELECT *, 0 AS pos, v AS ax, CAST(k AS DOUBLE) AS ay, 1.5 AS az, radians(CAST(k AS DOUBLE)) AS gx, radians(v) AS gy,
         NULL AS gz, CAST(k AS DOUBLE) AS mx, 2.0 AS my, 3.0 AS mz FROM rec WHERE n > 0 AND NOT no_list
  UNION ALL
  SELECT *, 1, NULL, k, v, radians(1.0), radians(2.0), radians(3.0), k, NULL, NULL FROM rec WHERE n > 2 AND NOT no_list
  UNION ALL
  SELECT *, 2, -v, NULL, NULL, 90.0, NULL, NULL, NULL, NULL, NULL FROM rec WHERE n > 3 AND NOT no_list),
 flat AS (SELECT *,
    sqrt(coalesce(ax, 0) * coalesce(ax, 0) + coalesce(ay, 0) * coalesce(ay, 0) + coalesce(az, 0) * coalesce(az, 0)) AS am,
    sqrt(coalesce(gx, 0) * coalesce(gx, 0) + coalesce(gy, 0) * coalesce(gy, 0) + coalesce(gz, 0) * coalesce(gz, 0)) AS gm
  FROM smp WHERE sensor_id IS NOT NULL)"""

VECS = """vecs AS (
  SELECT vec_id AS seq, CAST(label AS VARCHAR) AS sensor_id, 1704067200000000 + vec_id * 320000 AS base, embedding AS e, i
  FROM embeddings, (SELECT unnest(range(0, 7)) AS i))"""


def message_records(spark: SparkSession, folder: str) -> DataFrame:
    return ingest.input_records(derive.event_messages(spark, folder))


def user_sessions(spark: SparkSession, folder: str) -> DataFrame:
    return sessions.assign_sessions(derive.event_readings(spark, folder), "seq", GAP_US)


# ---- Ingest -------------------------------------------------------------------------------------

@query("payload_gate", f"WITH {GATED} SELECT seq AS \"offset\", sensor_id AS \"key\" FROM gated")
def payload_gate(spark, folder):
    return ingest.gate(derive.event_messages(spark, folder)).select("offset", "key")


@query("byte_payload_gate", f"""WITH {GATED}
 SELECT seq AS "offset", CASE WHEN event_type = 'signup' AND k < 10 THEN 6 END AS short_length FROM gated""")
def byte_payload_gate(spark, folder):
    raw = derive.event_messages(spark, folder).withColumn("value", F.col("value").cast("binary"))
    text = ingest.decode_bytes(raw)
    return text.select("offset", F.when(F.length("value") < 10, F.length("value")).alias("short_length"))


@query("json_parse", f"""WITH {GATED} SELECT seq AS "offset", sensor_id, header_timestamp_us,
 CASE WHEN NOT no_list THEN n END AS samples_listed FROM rec""")
def json_parse(spark, folder):
    records = message_records(spark, folder)
    listed = F.when(F.col("samples").isNotNull(), F.size("samples"))
    return records.select("offset", "sensor_id", "header_timestamp_us", listed.alias("samples_listed"))


@query("json_quarantine_counts", f"""WITH {GATED}
 SELECT 'imu-data-all' AS topic, count(*) FILTER (WHERE NOT (event_type = 'signup' AND k < 10)) AS good,
        count(*) FILTER (WHERE event_type = 'signup' AND k < 10) AS bad FROM gated
 UNION ALL
 SELECT 'notes', count(*) FILTER (WHERE json_valid(text) AND left(trim(text), 1) = '{{'),
        count(*) FILTER (WHERE NOT (json_valid(text) AND left(trim(text), 1) = '{{')) FROM documents WHERE text <> ''""")
def json_quarantine_counts(spark, folder):
    every = derive.event_messages(spark, folder).unionByName(derive.document_messages(spark, folder))
    parsed = ingest.parse(ingest.gate(every))
    bad = F.col(ingest.CORRUPT).isNotNull()
    return parsed.groupBy("topic").agg(F.count_if(~bad).alias("good"), F.count_if(bad).alias("bad"))


@query("quarantined_payloads", f"""WITH {GATED}
 SELECT 'imu-data-all' AS topic, seq AS "offset", 6 AS payload_length
 FROM gated WHERE event_type = 'signup' AND k < 10
 UNION ALL SELECT 'notes', doc_id, length(text) FROM documents
 WHERE text <> '' AND NOT (json_valid(text) AND left(trim(text), 1) = '{{')""")
def quarantined_payloads(spark, folder):
    every = derive.event_messages(spark, folder).unionByName(derive.document_messages(spark, folder))
    bad = ingest.quarantine(ingest.parse(ingest.gate(every)))
    return bad.select("topic", "offset", F.length("payload").alias("payload_length"))


@query("kafka_timestamp_us", f"WITH {GATED} SELECT seq AS \"offset\", kafka_timestamp FROM rec")
def kafka_timestamp_us(spark, folder):
    return message_records(spark, folder).select("offset", "kafka_timestamp")


@query("topic_sensor_id", r"""SELECT page_id, regexp_extract(url, '//([^/]+)/', 1) AS sensor_id FROM pages
 WHERE regexp_extract(url, '//([^/]+)/', 1) <> ''""")
def topic_sensor_id(spark, folder):
    pages = table(spark, folder, "pages")
    found = pages.select("page_id", keys.topic_sensor_id(F.col("url"), "//+/").alias("sensor_id"))
    return ingest.with_sensor(found)


@query("missing_sensor_filter", f"WITH {GATED} SELECT sensor_id, count(*) AS messages FROM rec WHERE sensor_id IS NOT NULL GROUP BY ALL")
def missing_sensor_filter(spark, folder):
    kept = ingest.with_sensor(message_records(spark, folder))
    return kept.groupBy("sensor_id").agg(F.count(F.lit(1)).alias("messages"))


@query("normalize_session_key", """WITH s AS (SELECT o_orderkey, CAST(o_custkey % 3 AS VARCHAR) || '_' || CAST(o_orderkey AS VARCHAR) AS id FROM orders)
 SELECT o_orderkey, CASE WHEN starts_with(id, '0_') THEN substr(id, 3) ELSE id END AS session_key FROM s""")
def normalize_session_key(spark, folder):
    made = F.concat((F.col("o_custkey") % 3).cast("string"), F.lit("_"), F.col("o_orderkey").cast("string"))
    return table(spark, folder, "orders").select("o_orderkey", keys.normal_session_key(made).alias("session_key"))


@query("numeric_coerce", """SELECT event_id, coalesce(try_cast(CASE WHEN event_type = 'error' THEN event_type
 ELSE CAST(value AS VARCHAR) END AS DOUBLE), 0.0) AS number FROM events""")
def numeric_coerce(spark, folder):
    text = F.when(F.col("event_type") == "error", F.col("event_type")).otherwise(F.col("value").cast("string"))
    return ingest.required_numbers(table(spark, folder, "events").select("event_id", text.alias("number")), ["number"])


# ---- Scalars ------------------------------------------------------------------------------------

@query("deg_to_rad", "SELECT l_orderkey, l_linenumber, round(radians(l_quantity), 9) AS rad FROM lineitem")
def deg_to_rad(spark, folder):
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", F.round(F.radians("l_quantity"), 9).alias("rad"))


@query("vector_magnitude", """SELECT l_orderkey, l_linenumber, round(sqrt(l_quantity * l_quantity +
 coalesce(CASE WHEN l_returnflag <> 'N' THEN l_discount END, 0) * coalesce(CASE WHEN l_returnflag <> 'N' THEN l_discount END, 0)
 + l_tax * l_tax), 9) AS magnitude FROM lineitem""")
def vector_magnitude(spark, folder):
    y = F.when(F.col("l_returnflag") != "N", F.col("l_discount"))
    size = motion.magnitude(F.col("l_quantity"), y, F.col("l_tax"))
    return table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", F.round(size, 9).alias("magnitude"))


@query("feature_default", f"""WITH {SAMPLES}
 SELECT seq AS "offset", pos, coalesce(az, -1.0) AS acc_z, 7.0 AS gyro_mag_energy FROM flat""")
def feature_default(spark, folder):
    from stridelake.schemas import SAMPLE_FIELDS
    records = transform.transform_records(message_records(spark, folder))
    s = records.select("offset", F.posexplode("samples").alias("pos", "s"))
    return s.select("offset", "pos", motion.feature(F.col("s"), "acc_z", SAMPLE_FIELDS, -1.0).alias("acc_z"),
                    motion.feature(F.col("s"), "gyro_mag_energy", SAMPLE_FIELDS, 7.0).alias("gyro_mag_energy"))


@query("header_seconds", f"""WITH {SAMPLES}
 SELECT seq AS "offset", pos, CASE WHEN header_timestamp_us IS NULL THEN 0.0 ELSE header_timestamp_us / 1000000.0 END AS seconds FROM flat""")
def header_seconds(spark, folder):
    records = transform.transform_records(message_records(spark, folder))
    return records.select("offset", F.posexplode("samples").alias("pos", "s")).select(
        "offset", "pos", F.col("s.timestamp").alias("seconds"))


@query("utc_ms_format", "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS text FROM events")
def utc_ms_format(spark, folder):
    return table(spark, folder, "events").select("event_id", clock.micros_to_text(derive.micros("ts")).alias("text"))


@query("utc_ms_parse", "SELECT event_id, epoch_ms(date_trunc('millisecond', ts)) AS millis FROM events")
def utc_ms_parse(spark, folder):
    text = clock.micros_to_text(derive.micros("ts"))
    return table(spark, folder, "events").select("event_id", clock.text_to_millis(text).alias("millis"))


@query("epoch_seconds_timestamp", "SELECT o_orderkey, epoch_us(o_orderdate) AS micros FROM orders")
def epoch_seconds_timestamp(spark, folder):
    seconds = F.unix_seconds(F.col("o_orderdate").cast("timestamp")).cast("double")
    return table(spark, folder, "orders").select(
        "o_orderkey", F.unix_micros(clock.seconds_to_timestamp(seconds)).alias("micros"))


@query("delay", f"""WITH {SENS} SELECT seq, CASE WHEN event_type <> 'signup'
 THEN (kafka_timestamp // 1000 + k - kafka_timestamp // 1000) / 1000.0 END AS delay_s FROM sens""")
def delay(spark, folder):
    readings = derive.untimed_readings(spark, folder)
    processing = F.floor(F.col("kafka_timestamp") / 1000) + F.col("k")
    return readings.select("seq", clock.delay_seconds(processing, F.col("kafka_timestamp")).alias("delay_s"))


@query("partition_assign", """WITH b AS (
  SELECT DISTINCT CAST(user_id AS VARCHAR) AS sensor_id FROM events),
 c AS (SELECT sensor_id, list_reduce(
     list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, length(sensor_id) + 1), lambda i: CAST(ascii(sensor_id[i:i]) AS BIGINT))),
     lambda c, x: list_reduce(list_prepend(xor(c, x), range(8)), lambda a, s: xor(a >> 1, (a & 1) * CAST(3988292384 AS BIGINT)))) AS crc FROM b)
 SELECT sensor_id, CAST(xor(crc, CAST(4294967295 AS BIGINT)) % 20 AS INTEGER) AS "partition" FROM c""")
def partition_assign(spark, folder):
    sensors = derive.event_readings(spark, folder).select("sensor_id").distinct()
    return sensors.select("sensor_id", keys.stable_partition(F.col("sensor_id"), 20).alias("partition"))


@query("crc16_arc", """SELECT c_custkey, CAST(list_reduce(
     list_prepend(CAST(0 AS BIGINT), list_transform(range(1, length(c_name) + 1), lambda i: CAST(ascii(c_name[i:i]) AS BIGINT))),
     lambda c, x: list_reduce(list_prepend(xor(c, x), range(8)), lambda a, s: xor(a >> 1, (a & 1) * 40961))) AS INTEGER) AS crc FROM customer""")
def crc16_of_names(spark, folder):
    return table(spark, folder, "customer").select("c_custkey", crc16_arc(F.col("c_name").cast("binary")).alias("crc"))


# A table of one byte's sums from its rule, then the text's bytes one after the other.
_BYTE_SUMS = "range(256)"
for _ in range(8):
    _BYTE_SUMS = f"list_transform({_BYTE_SUMS}, lambda x: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 40961) ELSE x >> 1 END)"


@query("crc16_arc_texts", f"""WITH t AS MATERIALIZED (SELECT {_BYTE_SUMS} AS sums),
 d AS (SELECT doc_id, hex(encode(text)) AS h FROM documents),
 b AS (SELECT doc_id, list_prepend(CAST(0 AS BIGINT), list_transform(
   range(length(h) // 2), lambda i: CAST('0x' || substr(h, i * 2 + 1, 2) AS BIGINT))) AS bytes FROM d)
 SELECT doc_id, CAST(list_reduce(bytes, lambda c, x: xor(sums[(xor(c, x) & 255) + 1], c >> 8)) AS INTEGER) AS crc FROM b, t""")
def crc16_of_texts(spark, folder):
    return table(spark, folder, "documents").select("doc_id", crc16_arc(F.col("text").cast("binary")).alias("crc"))


# ---- Records and samples ------------------------------------------------------------------------

@query("transform_records", f"""WITH {SAMPLES}
 SELECT rec.seq AS "offset", rec.sensor_id, rec.header_timestamp_us, rec.kafka_timestamp,
        count(flat.pos) AS samples, round(coalesce(sum(flat.am), 0), 4) AS accl, round(coalesce(sum(flat.gm), 0), 4) AS gyro
 FROM rec LEFT JOIN flat ON rec.seq = flat.seq WHERE rec.sensor_id IS NOT NULL GROUP BY ALL""")
def transform_records(spark, folder):
    records = transform.transform_records(message_records(spark, folder))
    def total(field):
        return F.round(F.aggregate("samples", F.lit(0.0), lambda t, s: t + s[field]), 4)
    return records.select(
        "offset", "sensor_id", "header_timestamp_us", "kafka_timestamp",
        F.size("samples").cast("long").alias("samples"), total("accl_mag").alias("accl"), total("gyro_mag").alias("gyro"))


@query("explode_interpolated", f"""WITH {SAMPLES}
 SELECT seq AS "offset", pos, sensor_id, round(header_timestamp_us / 1000000.0 + pos * 0.005, 6) AS cur_timestamp,
  round(kafka_timestamp / 1000000.0 + pos * 0.005, 6) AS kafka_timestamp, ax AS acc_x, ay AS acc_y, az AS acc_z,
  round(gx, 9) AS gyro_x, round(gy, 9) AS gyro_y, round(gz, 9) AS gyro_z, mx AS mag_x, my AS mag_y, mz AS mag_z,
  round(am, 6) AS accl_mag, round(gm, 6) AS gyro_mag, CAST(NULL AS DOUBLE) AS predicted_velocity
 FROM flat WHERE header_timestamp_us IS NOT NULL""")
def explode_interpolated(spark, folder):
    records = transform.transform_records(message_records(spark, folder))
    rows = transform.explode_samples(records, "offset")
    rows = rounded(rows, "gyro_x", "gyro_y", "gyro_z", digits=9)
    return rounded(rows, "cur_timestamp", "kafka_timestamp", "accl_mag", "gyro_mag")


@query("flat_projection", f"""WITH {VECS},
 x AS (SELECT seq, sensor_id, base, i, CAST(e[i*9+1] AS DOUBLE) AS ax, CAST(e[i*9+2] AS DOUBLE) AS ay, CAST(e[i*9+3] AS DOUBLE) AS az,
   radians(CAST(e[i*9+4] AS DOUBLE)) AS gx, radians(CAST(e[i*9+5] AS DOUBLE)) AS gy, radians(CAST(e[i*9+6] AS DOUBLE)) AS gz,
   CAST(e[i*9+7] AS DOUBLE) AS mx, CAST(e[i*9+8] AS DOUBLE) AS my, CAST(e[i*9+9] AS DOUBLE) AS mz FROM vecs)
 SELECT seq, CAST(i AS INTEGER) AS pos, sensor_id, round(base / 1000000.0 + i * 0.005, 6) AS cur_timestamp,
   round((base + 1000) / 1000000.0 + i * 0.005, 6) AS kafka_timestamp,
   ax AS acc_x, ay AS acc_y, az AS acc_z, round(gx, 9) AS gyro_x, round(gy, 9) AS gyro_y, round(gz, 9) AS gyro_z,
   mx AS mag_x, my AS mag_y, mz AS mag_z, round(sqrt(ax*ax + ay*ay + az*az), 6) AS accl_mag,
   round(sqrt(gx*gx + gy*gy + gz*gz), 6) AS gyro_mag, CAST(NULL AS DOUBLE) AS predicted_velocity FROM x""")
def flat_projection(spark, folder):
    rows = transform.explode_samples(transform.transform_records(derive.vector_records(spark, folder)), "seq")
    rows = rounded(rows, "gyro_x", "gyro_y", "gyro_z", digits=9)
    return rounded(rows, "cur_timestamp", "kafka_timestamp", "accl_mag", "gyro_mag")


@query("nonempty_records", f"""WITH {GATED} SELECT seq AS "offset" FROM rec
 WHERE sensor_id IS NOT NULL AND n > 0 AND NOT no_list""")
def nonempty_records(spark, folder):
    return transform.nonempty(transform.transform_records(message_records(spark, folder))).select("offset")


# ---- Sessions and aggregates --------------------------------------------------------------------

SESSION_COLUMNS = "sensor_id || '_' || CAST(part AS VARCHAR)"


@query("session_ids", f"""WITH {SESS} SELECT seq, sensor_id, kafka_timestamp, part AS session_id_part,
 {SESSION_COLUMNS} AS sensor_session_id, is_new AS is_new_session FROM sess""")
def session_ids(spark, folder):
    return user_sessions(spark, folder).select(
        "seq", "sensor_id", "kafka_timestamp", "session_id_part", "sensor_session_id", "is_new_session")


@query("new_session_events", f"""WITH {SESS} SELECT {SESSION_COLUMNS} AS sensor_session_id, sensor_id,
 part AS session_id_part, kafka_timestamp AS session_start_timestamp_us FROM sess WHERE is_new""")
def new_session_events(spark, folder):
    return sessions.new_session_events(user_sessions(spark, folder))


@query("session_window_native", f"""WITH {SESS} SELECT {SESSION_COLUMNS} AS sensor_session_id, sensor_id,
 part AS session_start_us, max(kafka_timestamp) AS session_last_us, count(*) AS records, max(v) AS max_velocity
 FROM sess GROUP BY sensor_id, part""")
def session_window_native(spark, folder):
    return sessions.event_time_sessions(derive.event_readings(spark, folder), GAP_US)


@query("null_ts_sessions", f"""WITH {SESS.replace("FROM sens)", "FROM sens WHERE event_type <> 'signup')")}
 SELECT seq, sensor_id, {SESSION_COLUMNS} AS sensor_session_id, is_new AS is_new_session FROM sess
 UNION ALL SELECT seq, sensor_id, '', false FROM sens WHERE event_type = 'signup'""")
def null_ts_sessions(spark, folder):
    found = sessions.assign_sessions(derive.untimed_readings(spark, folder), "seq", GAP_US)
    return found.select("seq", "sensor_id", "sensor_session_id", "is_new_session")


FINAL = f"""SELECT {SESSION_COLUMNS} AS sensor_session_id, sensor_id, max(v) AS session_max_velocity,
 round(sum(abs(v)) * 0.005, 6) AS session_total_distance FROM sess GROUP BY sensor_id, part"""


@query("session_final_aggregate", f"WITH {SESS} {FINAL}")
def session_final_aggregate(spark, folder):
    return rounded(aggregates.session_totals(user_sessions(spark, folder)), "session_total_distance")


@query("session_running_aggregate", f"""WITH {SESS} SELECT seq, {SESSION_COLUMNS} AS sensor_session_id,
 max(v) OVER w AS session_max_velocity, round(sum(abs(v)) OVER w * 0.005, 6) AS session_total_distance FROM sess
 WINDOW w AS (PARTITION BY sensor_id, part ORDER BY seq ROWS UNBOUNDED PRECEDING)""")
def session_running_aggregate(spark, folder):
    placed = sessions.assign_sessions(derive.event_readings(spark, folder), "seq", GAP_US, keep_chunk=True)
    totals = aggregates.running_session_totals(placed, "seq")
    return rounded(totals, "session_total_distance").select(
        "seq", "sensor_session_id", "session_max_velocity", "session_total_distance")


@query("session_interval_emit", f"""WITH {SESS},
 cut AS (SELECT sensor_id, part, (kafka_timestamp - part) // {DAY_MS // 24 * 1000} AS slot, max(v) AS mv, sum(abs(v)) AS d
         FROM sess GROUP BY ALL)
 SELECT {SESSION_COLUMNS} AS sensor_session_id, sensor_id,
   max(mv) OVER w AS session_max_velocity, round(sum(d) OVER w * 0.005, 6) AS session_total_distance,
   (part + (slot + 1) * {DAY_MS // 24 * 1000}) // 1000 AS aggregation_timestamp_ms FROM cut
 WINDOW w AS (PARTITION BY sensor_id, part ORDER BY slot ROWS UNBOUNDED PRECEDING)""")
def session_interval_emit(spark, folder):
    totals = aggregates.interval_session_totals(user_sessions(spark, folder), interval_ms=DAY_MS // 24)
    return rounded(totals, "session_total_distance")


@query("velocity_histogram", """SELECT CAST(greatest(0, least(99, floor(l_quantity / 4 / (13.0 / 100)))) AS INTEGER) AS bin,
 count(*) AS samples FROM lineitem GROUP BY 1""")
def velocity_histogram(spark, folder):
    speeds = table(spark, folder, "lineitem").select((F.col("l_quantity") / 4).alias("predicted_velocity"))
    return aggregates.velocity_histogram(speeds)


@query("delivery_completeness", f"""WITH {SENS}, d AS (SELECT sensor_id, count(*) AS actual_packets,
   (max(kafka_timestamp) - min(kafka_timestamp)) / 1e6 AS duration_s FROM sens GROUP BY 1)
 SELECT *, CAST(floor(duration_s / 0.32) AS BIGINT) AS expected_packets,
   actual_packets / CAST(floor(duration_s / 0.32) AS BIGINT) AS completeness FROM d""")
def delivery_completeness(spark, folder):
    return aggregates.delivery_by_sensor(derive.event_readings(spark, folder))


@query("delivery_total", f"""WITH {SENS}, d AS (SELECT count(DISTINCT sensor_id) AS sensors, count(*) AS actual_packets,
   (max(kafka_timestamp) - min(kafka_timestamp)) / 1e6 AS duration_s FROM sens)
 SELECT *, sensors * 70 AS expected_packets, actual_packets / (sensors * 70) AS completeness FROM d""")
def delivery_total(spark, folder):
    return aggregates.delivery_in_total(derive.event_readings(spark, folder), target=70)


# ---- The same on a stream -------------------------------------------------------------------------

def finished(query) -> None:
    query.awaitTermination()
    if query.exception():
        raise query.exception()


def streamed_sessions(spark: SparkSession, folder: str) -> DataFrame:
    """Read the events as a stream, assign sessions and totals with keyed state, and store what comes."""
    events = files.stream_table(spark, folder, "events")
    found = keyed.sessions_and_scores(derive.readings_of(events).drop("k"), ["seq"], GAP_US, totals=True)
    path = new_folder(spark, "sessions")
    finished(found.writeStream.foreachBatch(jobs.into_folder(f"{path}/rows")).option(
        "checkpointLocation", f"{path}/state").trigger(availableNow=True).start())
    return spark.read.parquet(f"{path}/rows")


@query("stream_session_ids", ORACLES["session_ids"])
def stream_session_ids(spark, folder):
    return streamed_sessions(spark, folder).filter(F.col("kind") == keyed.SAMPLE_ROW).select(
        "seq", "sensor_id", "kafka_timestamp", "session_id_part", "sensor_session_id", "is_new_session")


@query("stream_session_totals", ORACLES["session_final_aggregate"])
def stream_session_totals(spark, folder):
    rows = streamed_sessions(spark, folder).filter(F.col("kind") == keyed.TOTAL_ROW)
    # Every trigger writes the sessions it changed; the last write of a session has its totals.
    newest = rows.groupBy("sensor_session_id").agg(F.max_by(
        F.struct("sensor_id", "session_max_velocity", "session_total_distance"), "batch").alias("t"))
    return rounded(newest.select("sensor_session_id", "t.*"), "session_total_distance")


@query("stream_quarantine", f"""WITH {GATED}
 SELECT 'imu-data-all' AS topic, seq AS "offset", 6 AS payload_length
 FROM gated WHERE event_type = 'signup' AND k < 10""")
def stream_quarantine(spark, folder):
    path = new_folder(spark, "quarantine")
    events = files.stream_table(spark, folder, "events")
    finished(jobs.start_quarantine(
        derive.messages_of(derive.readings_of(events)), f"{path}/state", {"availableNow": True}, jobs.into_folder(f"{path}/rows")))
    return spark.read.parquet(f"{path}/rows").select("topic", "offset", F.length("payload").alias("payload_length"))


# ---- Windows of messages and samples ------------------------------------------------------------

LISTS = TYPES + """,
 lists AS (SELECT seq, sensor_id, CASE WHEN k // 20 > 0 THEN list_transform(range(0, k // 20), lambda i: v + i) ELSE [] END AS samples FROM sens)"""


def message_lists(spark: SparkSession, folder: str) -> DataFrame:
    """Messages of 0 to 4 numbers, with the event type as a sensor that has a fifth of all rows."""
    return lists_of(derive.event_readings(spark, folder, "event_type"))


def lists_of(readings: DataFrame) -> DataFrame:
    count = F.floor(F.col("k") / F.lit(20)).cast("int")
    numbers = F.transform(F.slice(F.sequence(F.lit(0), F.lit(4)), F.lit(1), count), lambda i: F.col("predicted_velocity") + i)
    return readings.select("seq", "sensor_id", numbers.alias("samples"))


def window_summary(df: DataFrame) -> DataFrame:
    w = F.col("window_samples")
    return df.select(
        "seq", "sensor_id", F.size(w).cast("long").alias("samples"), F.get(w, 0).alias("oldest"),
        F.get(w, F.size(w) - 1).alias("newest"),
        F.round(F.aggregate(w, F.lit(0.0), lambda a, x: a + x), 4).alias("total"))


WINDOW_SUMMARY = """seq, sensor_id, len(w) AS samples, w[1] AS oldest, w[len(w)] AS newest,
 round(coalesce(list_sum(w), 0), 4) AS total"""


@query("count_window_4_1", f"""WITH {LISTS}, x AS (SELECT seq, sensor_id, flatten(list(samples) OVER (
  PARTITION BY sensor_id ORDER BY seq ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)) AS w FROM lists)
 SELECT {WINDOW_SUMMARY} FROM x WHERE len(w) > 0""")
def count_window(spark, folder):
    return window_summary(features.sliding_messages(message_lists(spark, folder), "seq", 4))


@query("message_buffer_window", f"""WITH {LISTS},
 numbered AS (SELECT *, count(*) FILTER (WHERE len(samples) > 0) OVER (PARTITION BY sensor_id ORDER BY seq) AS m FROM lists),
 filled AS (SELECT *, flatten(list(samples) OVER (PARTITION BY sensor_id ORDER BY seq ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)) AS w4,
   flatten(list(samples) OVER (PARTITION BY sensor_id ORDER BY seq ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)) AS w3
   FROM numbered WHERE len(samples) > 0),
 x AS (SELECT seq, sensor_id, w4 AS w FROM filled UNION ALL
   SELECT n.seq, n.sensor_id, f.w3 FROM numbered n JOIN filled f ON n.sensor_id = f.sensor_id AND n.m = f.m WHERE len(n.samples) = 0)
 SELECT {WINDOW_SUMMARY} FROM x""")
def message_buffer_window(spark, folder):
    return window_summary(features.buffered_messages(message_lists(spark, folder), "seq", 3))


ROLLING = TYPES + """,
 steps AS (SELECT *, coalesce(abs(v - lag(v) OVER (PARTITION BY sensor_id ORDER BY seq)), 0) AS change FROM sens)"""


def rolled(spark: SparkSession, folder: str) -> DataFrame:
    samples = derive.event_readings(spark, folder, "event_type").select(
        "seq", "sensor_id", F.col("predicted_velocity").alias("accl_mag"), F.col("k").cast("double").alias("gyro_mag"))
    return features.rolling_features(samples, ["seq"])


@query("rolling_sum_of_changes", f"""WITH {ROLLING} SELECT seq, sensor_id, round(sum(change) OVER (
  PARTITION BY sensor_id ORDER BY seq ROWS BETWEEN 131 PRECEDING AND CURRENT ROW), 4) AS accl_sum_of_changes FROM steps""")
def rolling_sum_of_changes(spark, folder):
    return rounded(rolled(spark, folder).select("seq", "sensor_id", "accl_sum_of_changes"), "accl_sum_of_changes", digits=4)


@query("rolling_energy", f"""WITH {ROLLING} SELECT seq, sensor_id, CAST(sum(k * k) OVER (
  PARTITION BY sensor_id ORDER BY seq ROWS BETWEEN 131 PRECEDING AND CURRENT ROW) AS DOUBLE) AS gyro_mag_energy FROM steps""")
def rolling_energy(spark, folder):
    return rolled(spark, folder).select("seq", "sensor_id", "gyro_mag_energy")


@query("last_64_samples", f"""WITH {TYPES} SELECT seq, sensor_id, v AS predicted_velocity FROM sens
 QUALIFY row_number() OVER (PARTITION BY sensor_id ORDER BY seq DESC) <= 64""")
def last_64_samples(spark, folder):
    samples = derive.event_readings(spark, folder, "event_type").select("seq", "sensor_id", "predicted_velocity")
    return features.tail_rows(samples, ["seq"])


@query("tail_of_lists", """SELECT vec_id, len(t) AS kept, CAST(t[1] AS DOUBLE) AS oldest FROM (
 SELECT vec_id, embedding[15:64] AS t FROM embeddings)""")
def tail_of_lists(spark, folder):
    cut = features.tail_samples(table(spark, folder, "embeddings"), "embedding", 50)
    return cut.select("vec_id", F.size("embedding").cast("long").alias("kept"), F.get("embedding", 0).cast("double").alias("oldest"))


@query("scaler_fit", """SELECT 'l_quantity' AS feature, round(avg(l_quantity), 6) AS mean, round(stddev_pop(l_quantity), 6) AS std FROM lineitem
 UNION ALL SELECT 'l_discount', round(avg(l_discount), 6), round(stddev_pop(l_discount), 6) FROM lineitem
 UNION ALL SELECT 'constant', 1.0, 1e-6""")
def scaler_fit(spark, folder):
    lines = table(spark, folder, "lineitem").withColumn("constant", F.lit(1.0))
    fitted = features.scaler_statistics(lines, ["l_quantity", "l_discount", "constant"])
    return rounded(fitted, "mean", "std")


@query("scaler_apply", """WITH f AS (SELECT avg(l_quantity) AS m, stddev_pop(l_quantity) AS s FROM lineitem)
 SELECT l_orderkey, l_linenumber, round((l_quantity - m) / s, 6) AS l_quantity, l_tax FROM lineitem, f""")
def scaler_apply(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_tax")
    means, stds = features.fit_scaler(lines, ["l_quantity"])
    return rounded(features.scale(lines, ["l_quantity", "l_tax"], means, stds), "l_quantity")


@query("scaler_lists", f"""WITH {VECS} SELECT seq, i AS pos, round((CAST(e[i*9+1] AS DOUBLE) - 0.1) / 0.5, 9) AS acc_x,
 CAST(e[i*9+2] AS DOUBLE) AS acc_y FROM vecs""")
def scaler_lists(spark, folder):
    records = transform.transform_records(derive.vector_records(spark, folder))
    scaled = features.scale_lists(records, ["acc_x", "acc_y"], {"acc_x": 0.1}, {"acc_x": 0.5})
    rows = scaled.select("seq", F.posexplode("samples").alias("pos", "s")).select(
        "seq", F.col("pos").cast("long").alias("pos"), "s.acc_x", "s.acc_y")
    return rounded(rows, "acc_x", digits=9)


# ---- Scoring ------------------------------------------------------------------------------------

@query("movement_mask", f"WITH {SENS} SELECT seq, CASE WHEN k / 100.0 < 0.5 THEN 0.0 ELSE v END AS predicted_velocity FROM sens")
def movement_mask(spark, folder):
    r = derive.event_readings(spark, folder)
    return r.select("seq", motion.masked_velocity(F.col("predicted_velocity"), F.col("k") / 100.0).alias("predicted_velocity"))


@query("linear_score", f"""WITH {SAMPLES}
 SELECT seq AS "offset", pos, round(0.5 + am * 0.25 + gm * -0.125, 6) AS velocity FROM flat""")
def linear_score(spark, folder):
    records = transform.transform_records(message_records(spark, folder))
    rows = records.select("offset", F.posexplode("samples").alias("pos", "s")).select("offset", "pos", "s.*")
    score = scoring.linear_score({"accl_mag": 0.25, "gyro_mag": -0.125}, 0.5)
    return rows.select("offset", "pos", F.round(score, 6).alias("velocity"))


class PacketMean:
    """A model without state that looks at a whole sequence: every sample gets the mean of its packet."""

    params, stateful, state_dtype = scoring.ModelParams(hidden_dim=1), False, np.dtype("float32")

    def score(self, features, h, c):
        mean = np.broadcast_to(features[:, :, 0].mean(axis=1, keepdims=True, dtype=np.float64), features.shape[:2])
        return mean, np.ones(features.shape[:2]), h, c


@query("stateless_score", f"""WITH {SAMPLES}
 SELECT seq AS "offset", pos, round(avg(CAST(CAST(am AS FLOAT) AS DOUBLE)) OVER (PARTITION BY seq), 3) AS velocity FROM flat
 WHERE sensor_id IS NOT NULL""")
def stateless_score(spark, folder):
    records = transform.transform_records(message_records(spark, folder))
    rows = records.select("sensor_id", "offset", F.posexplode("samples").alias("pos", "s")).select("sensor_id", "offset", "pos", "s.*")
    scored = scoring.score_samples(rows, PacketMean, ["offset", "pos"])
    return scored.select("offset", "pos", F.round("predicted_velocity", 3).alias("velocity"))


LSTM = scoring.LstmScorer.seeded(scoring.ModelParams(hidden_dim=2), seed=7, dtype="float64")


def _lstm_sql(scorer: scoring.LstmScorer) -> str:
    """One recursion step per sample of a sensor, in double precision, with the model's weights."""
    w_in, w_hidden, bias = scorer.layers[0]
    size = scorer.params.hidden_dim
    def gate(row: int) -> str:
        terms = [f"s.x{j} * ({float(w)!r})" for j, w in enumerate(w_in[row])]
        terms += [f"r.h{j} * ({float(w)!r})" for j, w in enumerate(w_hidden[row])]
        return "(" + " + ".join(terms) + f" + ({float(bias[row])!r}))"
    gates = ", ".join(f"{gate(g * size + u)} AS {name}{u}" for g, name in enumerate("ifgo") for u in range(size))
    sig = "(1 / (1 + exp(-{})))".format
    cells = ", ".join(f"{sig(f'f{u}')} * c{u} + {sig(f'i{u}')} * tanh(g{u}) AS c{u}" for u in range(size))
    hidden = ", ".join(f"{sig(f'o{u}')} * tanh(n{u}) AS h{u}" for u in range(size))
    old = ", ".join(f"r.c{u}" for u in range(size))
    zero = ", ".join(f"CAST(0 AS DOUBLE) AS {v}{u}" for v in "hc" for u in range(size))
    names = ", ".join(f"{v}{u}" for v in "hc" for u in range(size))
    kept_c = ", ".join(f"n{u} AS c{u}" for u in range(size))
    new_c = cells
    for u in range(size):
        new_c = new_c.replace(f"AS c{u}", f"AS n{u}")
    def head(weights, bias_value):
        return "(" + " + ".join(f"h{u} * ({float(w)!r})" for u, w in enumerate(weights)) + f" + ({bias_value!r}))"
    v, m = head(*scorer.velocity_head), head(*scorer.movement_head)
    gate_names = ", ".join(f"{n}{u}" for n in "ifgo" for u in range(size))
    return f"""WITH RECURSIVE {SENS},
 steps AS (SELECT seq, sensor_id, CAST(CAST(v / 500 AS FLOAT) AS DOUBLE) AS x0, CAST(CAST(k / 100.0 AS FLOAT) AS DOUBLE) AS x1,
           row_number() OVER (PARTITION BY sensor_id ORDER BY seq) AS n FROM sens),
 run AS (
  SELECT CAST(-1 AS BIGINT) AS seq, sensor_id, CAST(0 AS BIGINT) AS n, {zero} FROM (SELECT DISTINCT sensor_id FROM sens)
  UNION ALL
  SELECT seq, sensor_id, n, {hidden}, {kept_c} FROM (
    SELECT seq, sensor_id, n, {new_c}, {", ".join(f"o{u}" for u in range(size))} FROM (
      SELECT s.seq, s.sensor_id, s.n, {old}, {gates} FROM run r JOIN steps s ON s.sensor_id = r.sensor_id AND s.n = r.n + 1)))
 SELECT seq, sensor_id, round(CASE WHEN {sig(m)} < 0.5 THEN 0.0 ELSE {v} END, 6) AS predicted_velocity FROM run WHERE n > 0"""


@query("recurrent_score", _lstm_sql(LSTM))
def recurrent_score(spark, folder):
    samples = derive.event_readings(spark, folder).select(
        "seq", "sensor_id", (F.col("predicted_velocity") / 500).alias("accl_mag"), (F.col("k") / 100.0).alias("gyro_mag"))
    scored = scoring.score_samples(samples, lambda: LSTM, ["seq"])
    return rounded(scored.select("seq", "sensor_id", "predicted_velocity"), "predicted_velocity")


@query("scored_records", f"""WITH {VECS}, x AS (SELECT seq, sensor_id, i,
   CAST(e[i*9+1] AS DOUBLE) * 10 AS v FROM vecs)
 SELECT seq, sensor_id, count(*) AS samples, round(max(CASE WHEN i = 0 THEN v END), 6) AS first_velocity,
   round(max(CASE WHEN i = 6 THEN v END), 6) AS last_velocity FROM x GROUP BY 1, 2""")
def scored_records(spark, folder):
    rows = transform.explode_samples(transform.transform_records(derive.vector_records(spark, folder)), "seq")
    scored = rows.withColumn("predicted_velocity", scoring.linear_score({"acc_x": 10.0}))
    back = scoring.regroup_records(scored, ["seq", "sensor_id"], "pos", ["predicted_velocity", "acc_x"])
    return back.select(
        "seq", "sensor_id", F.size("samples").cast("long").alias("samples"),
        F.round(F.get("samples", F.lit(0))["predicted_velocity"], 6).alias("first_velocity"),
        F.round(F.element_at("samples", -1)["predicted_velocity"], 6).alias("last_velocity"))


# ---- Documents ----------------------------------------------------------------------------------

@query("record_json", f"""WITH {SAMPLES} SELECT rec.sensor_id AS "key", rec.header_timestamp_us,
  strftime(make_timestamp(rec.kafka_timestamp), '%Y-%m-%d %H:%M:%S.%g') AS kafka_timestamp, 'transformed-data' AS "type",
  strftime(make_timestamp(rec.kafka_timestamp + 1500000), '%Y-%m-%d %H:%M:%S.%g') AS processing_timestamp_ms,
  1.5 AS delay_s, CAST(1500 AS BIGINT) AS delay_ms, count(flat.pos) AS samples, max(CASE WHEN pos = 0 THEN ax END) AS acc_x
 FROM rec LEFT JOIN flat ON rec.seq = flat.seq WHERE rec.sensor_id IS NOT NULL
 GROUP BY rec.seq, rec.sensor_id, rec.header_timestamp_us, rec.kafka_timestamp""")
def record_json(spark, folder):
    records = transform.transform_records(message_records(spark, folder)).withColumn("sensor_session_id", F.lit("s"))
    texts = outputs.record_json(records, F.floor(F.col("kafka_timestamp") / 1000) + 1500)
    shape = ("header_timestamp_us long, kafka_timestamp string, type string, processing_timestamp_ms string, "
             "delay_s double, delay_ms long, samples array<struct<acc_x: double>>")
    read = texts.select("key", F.from_json("value", shape).alias("d"))
    return read.select(
        "key", "d.header_timestamp_us", "d.kafka_timestamp", "d.type", "d.processing_timestamp_ms", "d.delay_s", "d.delay_ms",
        F.size("d.samples").cast("long").alias("samples"), F.get("d.samples", F.lit(0))["acc_x"].alias("acc_x"))


@query("aggregate_json", f"""WITH {SESS}, t AS ({FINAL})
 SELECT sensor_session_id AS "key", sensor_id, session_max_velocity, session_total_distance,
  CAST(0 AS BIGINT) AS aggregation_timestamp_ms, session_max_velocity AS max_velocity_so_far,
  session_total_distance AS distance_so_far FROM t""")
def aggregate_json(spark, folder):
    totals = aggregates.session_totals(user_sessions(spark, folder)).withColumn("aggregation_timestamp_ms", F.lit(0).cast("long"))
    shape = ("sensor_id string, session_max_velocity double, session_total_distance double, "
             "aggregation_timestamp_ms long, max_velocity_so_far double, distance_so_far double")
    read = outputs.aggregate_json(totals).select("key", F.from_json("value", shape).alias("d")).select("key", "d.*")
    return rounded(read, "session_total_distance", "distance_so_far")


@query("new_session_json", f"""WITH {SESS} SELECT '{{"sensor_session_id":"' || {SESSION_COLUMNS} || '","sensor_id":"' || sensor_id
 || '","session_id_part":' || CAST(part AS VARCHAR) || ',"session_start_timestamp_us":' || CAST(kafka_timestamp AS VARCHAR)
 || '}}' AS "value" FROM sess WHERE is_new""")
def new_session_json(spark, folder):
    return outputs.new_session_json(sessions.new_session_events(user_sessions(spark, folder))).select("value")


@query("packet_json", f"""WITH {{PACKETS}} SELECT sensor_id AS "key", header_timestamp_us, num_samples_in_packet AS samples FROM ok""")
def packet_json(spark, folder):
    found = packets.packets(packets.frames(derive.event_packets(spark, folder), "arrival"))
    texts = outputs.packet_json(found)
    read = texts.select("key", F.from_json("value", "header_timestamp_us long, samples array<struct<temp_raw: int>>").alias("d"))
    return read.select("key", "d.header_timestamp_us", F.size("d.samples").alias("samples"))


@query("storage_documents", f"""WITH {VECS} SELECT sensor_id, CAST(e[i*9+1] AS DOUBLE) AS acc_x, 'v1' AS processing_info FROM vecs""")
def storage_documents(spark, folder):
    rows = transform.explode_samples(transform.transform_records(derive.vector_records(spark, folder)))
    return outputs.storage_documents(rows, "v1").select("sensor_id", "sample_data.acc_x", "processing_info")


# ---- Packets ------------------------------------------------------------------------------------

PACKETS = SENS + """,
 raw AS (SELECT *, CAST(round(v * 10) AS BIGINT) AS r, k // 20 AS n FROM sens),
 ok AS (SELECT seq, sensor_id, kafka_timestamp AS header_timestamp_us, seq * 64 AS base_sample_number, n AS num_samples_in_packet, k, r
        FROM raw WHERE k < 97 AND NOT (k >= 60 AND k < 62) AND NOT (k >= 20 AND k < 23))"""
ORACLES["packet_json"] = ORACLES["packet_json"].replace("{PACKETS}", PACKETS)


@query("packet_decode", f"""WITH {PACKETS}, s AS (SELECT *, unnest(range(0, num_samples_in_packet)) AS j FROM ok)
 SELECT sensor_id, base_sample_number + j AS sample_index, header_timestamp_us + j * 5000 AS header_timestamp_us,
  round((r + j) * 0.000488, 9) AS acc_x, round(-r * 0.000488, 9) AS acc_y, round(k * 0.000488, 9) AS acc_z,
  round((k * 10 + j) * 0.14, 9) AS gyro_x, round(-k * 0.14, 9) AS gyro_y, round(j * 0.14, 9) AS gyro_z,
  round(r / 1711.0, 9) AS mag_x, round((-k - j) / 1711.0, 9) AS mag_y, round(j / 1711.0, 9) AS mag_z,
  CAST(k - 50 AS INTEGER) AS temp_raw FROM s""")
def packet_decode(spark, folder):
    found = packets.packets(packets.frames(derive.event_packets(spark, folder), "arrival"))
    rows = found.select("sensor_id", F.explode("samples").alias("s"))
    axes = [F.round(F.col(f"s.{g}.{a}"), 9).alias(f"{g}_{a}") for g in ("acc", "gyro", "mag") for a in "xyz"]
    return rows.select("sensor_id", "s.sample_index", "s.header_timestamp_us", *axes,
                       F.col("s.temp_raw").cast("int").alias("temp_raw"))


@query("packet_headers", f"""WITH {PACKETS}
 SELECT sensor_id, seq * 2 + 1 AS arrival, header_timestamp_us, base_sample_number, num_samples_in_packet FROM ok""")
def packet_headers(spark, folder):
    found = packets.packets(packets.frames(derive.event_packets(spark, folder), "arrival"))
    return found.select("sensor_id", "arrival", "header_timestamp_us", "base_sample_number", "num_samples_in_packet")


@query("packet_status_counts", f"""WITH {PACKETS} SELECT CASE WHEN k >= 97 THEN 'bad_crc' WHEN k >= 60 AND k < 62 THEN 'short_payload'
  WHEN k < 20 THEN 'no_samples' WHEN k < 23 THEN 'short_samples' WHEN k >= 40 AND k < 43 THEN 'extra_bytes' ELSE 'ok' END AS status,
  count(*) AS frames FROM raw GROUP BY 1""")
def packet_status_counts(spark, folder):
    return packets.status_counts(packets.frames(derive.event_packets(spark, folder), "arrival"))


# ---- Stored samples and lookups -----------------------------------------------------------------

def dated_samples(spark: SparkSession, folder: str, sensor: str = "user_id") -> DataFrame:
    r = derive.event_readings(spark, folder, sensor)
    axes = {name: F.lit(None).cast("double") for name in
            ("acc_y", "acc_z", "gyro_x", "gyro_y", "gyro_z", "mag_x", "mag_y", "mag_z", "accl_mag", "gyro_mag")}
    rows = r.select(
        "sensor_id", (F.col("kafka_timestamp") / 1e6).alias("cur_timestamp"),
        (F.col("kafka_timestamp") / 1e6).alias("kafka_timestamp"), F.col("k").cast("double").alias("acc_x"),
        "predicted_velocity").withColumns(axes)
    return files.with_date(rows, F.timestamp_seconds(F.col("cur_timestamp")))


def stored_samples(spark: SparkSession, folder: str, by_sensor: bool = False) -> DataFrame:
    """Readings written to the shared folder, and read back from there: by date, or by date and event type."""
    path = new_folder(spark, "samples")
    files.write_samples(dated_samples(spark, folder, "event_type" if by_sensor else "user_id"), path, by_sensor)
    return files.read_samples(spark, path)


def lookup_samples(spark: SparkSession, folder: str) -> DataFrame:
    """The readings in the layout for lookups, which the application's first lookup of these tables writes."""
    return sorted_samples.stored_once(dated_samples(spark, folder), "lookups")


@query("daily_partition_counts", "SELECT CAST(ts AS DATE) AS dt, count(*) AS \"rows\" FROM events GROUP BY 1")
def daily_partition_counts(spark, folder):
    return lookups.daily_counts(stored_samples(spark, folder))


@query("sensor_partition_counts", "SELECT CAST(ts AS DATE) AS dt, event_type AS sensor_id, count(*) AS \"rows\" FROM events GROUP BY 1, 2")
def sensor_partition_counts(spark, folder):
    return stored_samples(spark, folder, by_sensor=True).groupBy("dt", "sensor_id").agg(F.count(F.lit(1)).alias("rows"))


@query("sensor_day_lookup", """SELECT epoch_us(ts) / 1000000.0 AS cur_timestamp, value AS predicted_velocity FROM events
 WHERE user_id = 8 AND CAST(ts AS DATE) = DATE '2024-01-05'""")
def sensor_day_lookup(spark, folder):
    found = lookups.sensor_on_date(lookup_samples(spark, folder), "8", "2024-01-05")
    return found.select("cur_timestamp", "predicted_velocity")


@query("sensor_day_first_rows", """SELECT epoch_us(ts) / 1000000.0 AS cur_timestamp, value AS predicted_velocity FROM events
 WHERE CAST(ts AS DATE) = DATE '2024-01-05' ORDER BY event_id LIMIT 5""")
def sensor_day_first_rows(spark, folder):
    rows = lookup_samples(spark, folder)
    return lookups.first_rows(rows.filter(F.col("dt") == F.lit("2024-01-05").cast("date"))).select(
        "cur_timestamp", "predicted_velocity")


@query("sensor_series", f"""WITH {SENS} SELECT kafka_timestamp AS micros, v AS predicted_velocity, CAST(k AS DOUBLE) AS acc_x FROM sens WHERE sensor_id = '8'""")
def sensor_series(spark, folder):
    series = lookups.sensor_series(lookup_samples(spark, folder), "8")
    return series.select(F.unix_micros("datetime").alias("micros"), "predicted_velocity", "acc_x")


# ---- Registry -----------------------------------------------------------------------------------

REG = """reg AS (SELECT CAST(o_custkey AS VARCHAR) || '_' || CAST(o_orderkey AS VARCHAR) AS sensor_session_id,
   CAST(o_custkey AS VARCHAR) AS sensor_id, epoch(o_orderdate) AS started_at,
   CASE WHEN o_orderstatus = 'F' THEN epoch(o_orderdate) + 86400 END AS ended_at,
   CASE WHEN o_orderstatus <> 'P' THEN CAST(left(o_orderpriority, 1) AS INTEGER) END AS "count",
   CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice END AS sum_workload, o_orderdate AS inserted_ts FROM orders)"""


def registry_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines as changes of sessions: repeats of a session, and sessions not known before."""
    lines = table(spark, folder, "lineitem")
    known = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    joined = lines.join(known, F.col("l_orderkey") == F.col("o_orderkey"))
    new = F.col("l_returnflag") == "R"
    sensor = F.when(new, F.lit("n")).otherwise(F.col("o_custkey").cast("string"))
    return joined.select(
        F.concat(sensor, F.lit("_"), F.col("l_orderkey").cast("string")).alias("sensor_session_id"),
        sensor.alias("sensor_id"), F.col("l_extendedprice").alias("started_at"))


@query("session_upsert", f"""WITH {REG},
 ch AS (SELECT CASE WHEN l_returnflag = 'R' THEN 'n' ELSE CAST(o_custkey AS VARCHAR) END AS sensor_id, l_orderkey, l_extendedprice
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
 last AS (SELECT sensor_id || '_' || CAST(l_orderkey AS VARCHAR) AS id, any_value(sensor_id) AS sensor_id, max(l_extendedprice) AS started_at
          FROM ch GROUP BY 1)
 SELECT coalesce(id, sensor_session_id) AS sensor_session_id, coalesce(last.sensor_id, reg.sensor_id) AS sensor_id,
   coalesce(last.started_at, reg.started_at) AS started_at, ended_at, sum_workload,
   reg.inserted_ts IS NOT NULL AS known, id IS NOT NULL AS modified
 FROM reg FULL JOIN last ON id = sensor_session_id""")
def session_upsert(spark, folder):
    now = F.timestamp_seconds(F.lit(2_000_000_000))
    merged = registry.upsert_sessions(
        derive.session_registry(spark, folder), registry_changes(spark, folder), now, order="started_at")
    return merged.select(
        "sensor_session_id", "sensor_id", "started_at", "ended_at", "sum_workload",
        (F.col("inserted_ts") < now).alias("known"), (F.col("modified_ts") == now).alias("modified"))


@query("session_list", f"WITH {REG} SELECT sensor_session_id, sensor_id, started_at, ended_at FROM reg")
def session_list(spark, folder):
    return registry.list_sessions(derive.session_registry(spark, folder)).select(
        "sensor_session_id", "sensor_id", "started_at", "ended_at")


@query("active_sessions", f"WITH {REG} SELECT sensor_session_id, sensor_id, started_at FROM reg WHERE ended_at IS NULL")
def active_sessions(spark, folder):
    return registry.list_sessions(derive.session_registry(spark, folder), active_only=True).select(
        "sensor_session_id", "sensor_id", "started_at")


@query("session_listing", f"""WITH {REG} SELECT sensor_session_id, sensor_id, CAST(started_at AS BIGINT) AS started_s,
   coalesce(CAST("count" AS VARCHAR), 'N/A') AS "count",
   coalesce(printf('%.2f', sum_workload), 'N/A') AS sum_workload FROM reg""")
def session_listing(spark, folder):
    listed = registry.session_listing(derive.session_registry(spark, folder))
    return listed.select("sensor_session_id", "sensor_id", F.unix_seconds("started_at").alias("started_s"), "count", "sum_workload")


@query("session_delete", f"""WITH {REG} SELECT sensor_session_id FROM reg WHERE sensor_session_id NOT IN (
  SELECT CAST(o_custkey AS VARCHAR) || '_' || CAST(l_orderkey AS VARCHAR) FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag <> 'R')""")
def session_delete(spark, folder):
    changes = registry_changes(spark, folder)
    return registry.delete_sessions(derive.session_registry(spark, folder), changes).select("sensor_session_id")


# ---- Serving ------------------------------------------------------------------------------------

def type_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Messages with the event type as sensor; errors and purchases carry a workload."""
    r = derive.event_readings(spark, folder, "event_type")
    loaded = F.col("event_type").isin("error", "purchase")
    return r.select(
        "seq", "sensor_id", F.col("predicted_velocity").alias("acc_z"),
        F.when(loaded, F.col("predicted_velocity")).alias("sum_workload"), F.when(loaded, F.col("k")).alias("last_workload"))


@query("last_10_batch", f"""WITH {SENS} SELECT seq, sensor_id, v AS acc_z FROM sens
 QUALIFY row_number() OVER (PARTITION BY sensor_id ORDER BY seq DESC) <= 10""")
def last_10_batch(spark, folder):
    messages = derive.event_readings(spark, folder).select("seq", "sensor_id", F.col("predicted_velocity").alias("acc_z"))
    return serving.last_messages(messages, "seq")


@query("last_10_documents", f"""WITH {SENS}, m AS (SELECT * FROM sens QUALIFY row_number() OVER (PARTITION BY sensor_id ORDER BY seq DESC) <= 10)
 SELECT sensor_id, 'transformed-data' AS "type", CAST(count(*) AS INTEGER) AS batch_size, arg_min(v, seq) AS oldest, arg_max(v, seq) AS newest
 FROM m GROUP BY 1""")
def last_10_documents(spark, folder):
    messages = derive.event_readings(spark, folder).select("seq", "sensor_id", F.col("predicted_velocity").alias("acc_z"))
    made = serving.flush_documents(messages, "seq", ["sensor_id", "acc_z"])
    return made.select("sensor_id", "type", "batch_size", F.get("samples", F.lit(0))["acc_z"].alias("oldest"),
                       F.element_at("samples", -1)["acc_z"].alias("newest"))


@query("batch_100", f"""WITH {TYPES}, n AS (SELECT *, (row_number() OVER (PARTITION BY sensor_id ORDER BY seq) - 1) // 100 AS batch_no FROM sens),
 b AS (SELECT sensor_id, batch_no, count(*) AS c, arg_min(v, seq) AS oldest, arg_max(v, seq) AS newest, arg_max(k, seq) AS last_k,
       sensor_id IN ('error', 'purchase') AS single FROM n GROUP BY 1, 2 HAVING count(*) = 100)
 SELECT sensor_id, batch_no, CASE WHEN NOT single THEN 'transformed-data' END AS "type",
   CASE WHEN NOT single THEN CAST(c AS INTEGER) END AS batch_size, CASE WHEN NOT single THEN oldest END AS oldest,
   CASE WHEN NOT single THEN newest END AS newest, CASE WHEN single THEN newest END AS sum_workload,
   CASE WHEN single THEN last_k END AS last_workload FROM b""")
def batch_100(spark, folder):
    made = serving.full_batch_documents(
        type_messages(spark, folder), "seq", ["sensor_id", "acc_z", "sum_workload", "last_workload"])
    return made.select(
        "sensor_id", "batch_no", "type", "batch_size", F.get("samples", F.lit(0))["acc_z"].alias("oldest"),
        F.element_at("samples", -1)["acc_z"].alias("newest"), "message.sum_workload", "message.last_workload")


@query("latest_workload", f"""WITH {TYPES} SELECT sensor_id, max(seq) AS seq, arg_max(v, seq) AS sum_workload, arg_max(k, seq) AS last_workload
 FROM sens WHERE sensor_id IN ('error', 'purchase') GROUP BY 1""")
def latest_workload(spark, folder):
    return serving.latest_workload(type_messages(spark, folder), "seq", ["seq", "sum_workload", "last_workload"])


@query("last_100_points", f"""WITH {TYPES} SELECT seq, sensor_id, v AS acc_z FROM sens WHERE k < 80
 QUALIFY row_number() OVER (PARTITION BY sensor_id ORDER BY seq DESC) <= 100""")
def last_100_points(spark, folder):
    r = derive.event_readings(spark, folder, "event_type")
    shown = F.when(F.col("k") >= 80, F.lit("n/a")).otherwise(F.col("predicted_velocity").cast("string"))
    return serving.chart_points(r.select("seq", "sensor_id", shown.alias("acc_z")), "seq").select("seq", "sensor_id", "acc_z")


@query("quality_counters", f"""WITH {SENS} SELECT count(*) FILTER (WHERE event_type IN ('view', 'click', 'signup')) AS samples_seen,
  count(*) FILTER (WHERE event_type = 'purchase') AS aggregates_seen,
  count(*) FILTER (WHERE event_type = 'click') AS missing_acc_z,
  count(*) FILTER (WHERE event_type IN ('view', 'signup') AND k >= 80) AS invalid_acc_z,
  count(*) FILTER (WHERE event_type = 'error') AS errors FROM sens""")
def quality_counters(spark, folder):
    r = derive.event_readings(spark, folder)
    kind = F.when(F.col("event_type") == "purchase", "aggregate").when(F.col("event_type") == "error", "error").otherwise("raw")
    shown = F.when(F.col("k") >= 80, F.lit("n/a")).otherwise(F.col("predicted_velocity").cast("string"))
    return serving.quality_counters(r.select(
        kind.alias("kind"), (F.col("event_type") != "click").alias("has_acc_z"), shown.alias("acc_z")))
