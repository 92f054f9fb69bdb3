"""The given tables seen as sensor data. Everything here is a lazy expression over whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stridelake.functions.crc import crc16_arc
from stridelake.operators.once import computed_once
from stridelake.sources.files import table


def micros(ts: str) -> Column:
    return F.unix_micros(F.col(ts).cast("timestamp"))


def event_readings(spark: SparkSession, folder: str, sensor: str = "user_id") -> DataFrame:
    """One scored reading per event; the event number is the arrival number."""
    return readings_of(table(spark, folder, "events"), sensor)


def readings_of(events: DataFrame, sensor: str = "user_id") -> DataFrame:
    return events.select(
        F.col("event_id").alias("seq"), F.col(sensor).cast("string").alias("sensor_id"),
        micros("ts").alias("kafka_timestamp"), F.col("value").alias("predicted_velocity"),
        "event_type", F.get_json_object("props", "$.k").cast("int").alias("k"))


def untimed_readings(spark: SparkSession, folder: str) -> DataFrame:
    """The readings, with no broker time on sign-up events."""
    return event_readings(spark, folder).withColumn(
        "kafka_timestamp", F.when(F.col("event_type") != "signup", F.col("kafka_timestamp")))


def _sample_texts(v: Column, k: Column) -> Column:
    """Four kinds of sample: nested, null, with wrong types and unknown names, and partly flat."""
    return F.array(
        F.concat(F.lit('{"acc":{"x":'), v, F.lit(',"y":'), k, F.lit(',"z":1.5},"gyro":{"x":'), k, F.lit(',"y":'), v,
                 F.lit('},"mag":{"x":'), k, F.lit(',"y":2,"z":3},"temp_raw":'), k, F.lit("}")),
        F.lit("null"),
        F.concat(F.lit('{"acc":{"x":"bad","y":'), k, F.lit(',"z":'), v,
                 F.lit('},"gyro":{"x":1,"y":2,"z":3},"mag_x":'), k, F.lit(',"unknown":7}')),
        F.concat(F.lit('{"acc":{"x":-'), v, F.lit('},"gyro_x":90,"accl_mag":5}')))


def event_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Broker rows with one JSON packet per event, among them every kind of faulty message."""
    return messages_of(event_readings(spark, folder))


def messages_of(readings: DataFrame) -> DataFrame:
    r = computed_once(readings, k=F.col("k"))
    kind, k = F.col("event_type"), F.col("k")
    v_text, k_text = F.col("predicted_velocity").cast("decimal(18,2)").cast("string"), k.cast("string")
    count = F.floor(k / F.lit(20)).cast("int")
    samples = F.concat(F.lit("["), F.array_join(F.slice(_sample_texts(v_text, k_text), F.lit(1), count), ","), F.lit("]"))
    samples = F.when((kind == "click") & (k >= 95), F.lit("null")).otherwise(samples)
    sensor = F.when((kind == "error") & (k < 10), F.lit("null")).otherwise(
        F.concat(F.lit('"'), F.col("sensor_id"), F.lit('"')))
    header = F.when((kind == "view") & (k < 10), F.lit("null")).otherwise(
        (F.col("kafka_timestamp") + 1).cast("string"))
    packet = F.concat(
        F.lit('{"sensor_id":'), sensor, F.lit(',"header_timestamp_us":'), header,
        F.lit(',"kafka_timestamp":1,"firmware":"r2","samples":'), samples, F.lit("}"))
    value = (
        F.when((kind == "signup") & (k < 10), F.lit('{"k": '))
        .when((kind == "purchase") & (k < 5), F.lit(""))
        .when((kind == "click") & (k < 5), F.lit(None).cast("string"))
        .otherwise(packet))
    stamp = F.when((kind == "purchase") & (k >= 95), F.lit(0)).otherwise(F.col("kafka_timestamp"))
    return computed_once(r, value=value, timestamp=F.timestamp_micros(stamp)).select(
        F.col("sensor_id").alias("key"), "value", F.lit("imu-data-all").alias("topic"),
        F.lit(0).alias("partition"), F.col("seq").alias("offset"), "timestamp")


def document_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Whole document texts as payloads, none of which is a packet."""
    return table(spark, folder, "documents").select(
        F.lit(None).cast("string").alias("key"), F.col("text").alias("value"), F.lit("notes").alias("topic"),
        F.lit(0).alias("partition"), F.col("doc_id").alias("offset"), F.timestamp_millis(F.lit(1)).alias("timestamp"))


def vector_records(spark: SparkSession, folder: str) -> DataFrame:
    """Every embedding as a packet of seven samples of nine axis values; the label is the sensor."""
    axes = ("x", "y", "z")
    e = F.col("embedding")

    def group(i: Column, at: int) -> Column:
        return F.struct(*[F.get(e, i * 9 + (at + a)).cast("double").alias(axis) for a, axis in enumerate(axes)])

    known = ("acc_x", "acc_y", "acc_z", "gyro_x", "gyro_y", "gyro_z", "mag_x", "mag_y", "mag_z",
             "accl_mag", "gyro_mag", "timestamp", "kafka_timestamp", "predicted_velocity")
    nothing = [F.lit(None).cast("double").alias(n) for n in known]
    places = F.sequence(F.lit(0), F.floor(F.size(e) / 9).cast("int") - 1)
    samples = F.transform(places, lambda i: F.struct(
        group(i, 0).alias("acc"), group(i, 3).alias("gyro"), group(i, 6).alias("mag"), *nothing))
    base = F.lit(1_704_067_200_000_000) + F.col("vec_id") * 320_000
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("seq"), F.col("label").cast("string").alias("sensor_id"),
        base.alias("header_timestamp_us"), (base + 1000).alias("kafka_timestamp"), samples.alias("samples"))


def _hex(value: Column, digits: int) -> Column:
    return F.lpad(F.hex(F.pmod(value, F.lit(16 ** digits))), digits, "0")


def _swapped(text: str | Column, digits: int) -> Column:
    return F.concat(*[F.substring(text, at, 2) for at in range(digits - 1, 0, -2)])


def _hex_little(value: Column, digits: int) -> Column:
    return _swapped(_hex(value, digits), digits)


def event_packets(spark: SparkSession, folder: str) -> DataFrame:
    """Every event as a binary packet that arrives in two messages.

    Packets hold 0 to 4 samples made from the event. Some come with junk before them, with a wrong
    sum, with fewer sample bytes than declared, with more, or with a payload that is too short.
    """
    return packets_of(event_readings(spark, folder))


def packets_of(readings: DataFrame) -> DataFrame:
    """What a packet needs many times is made once (`computed_once`), and only if the packet has it."""
    r = computed_once(readings, k=F.col("k"))
    k, seq, raw = F.col("k"), F.col("seq"), F.col("_raw")
    declared = F.floor(k / F.lit(20)).cast("int")
    short, extra, tiny = (k >= 20) & (k < 23), (k >= 40) & (k < 43), (k >= 60) & (k < 62)
    held = declared + F.when(short, -1).when(extra, 1).otherwise(0)
    r = computed_once(r, _held=F.when(~tiny, held))

    def used(part: Column) -> Column:
        return F.when(F.col("_held") > 0, part)

    r = computed_once(r, _raw=used(F.round(F.col("predicted_velocity") * 10).cast("long")))
    r = computed_once(
        r, _seq=F.when(~tiny, _hex(seq * 64, 8)), _time=F.lpad(F.hex("kafka_timestamp"), 16, "0"),
        _raw_k=used(F.concat(_hex(-raw, 4), _hex(k, 4))), _k=used(_hex(-k, 4)), _little_raw=_hex_little(raw, 4),
        _temp=used(_hex(k - 50, 4)))

    def sample(j: Column) -> Column:
        return F.concat(
            _hex(raw + j, 4), F.col("_raw_k"),
            _hex(k * 10 + j, 4), F.col("_k"), _hex(j, 4),
            F.col("_little_raw"), _hex_little(-k - j, 4), _hex_little(j, 4),
            F.col("_temp"))

    places = used(F.sequence(F.lit(0), F.col("_held") - 1))
    samples = F.coalesce(F.array_join(F.transform(places, sample), ""), F.lit(""))
    r = computed_once(r, _samples=samples)
    r = computed_once(r, _payload=F.when(tiny, F.lit("00FF00FF")).otherwise(F.concat(
        _swapped("_seq", 8), _swapped("_time", 16), _hex_little(declared, 4), F.col("_samples"))))
    size = F.floor(F.length("_payload") / F.lit(2)).cast("long")
    framed = r.withColumn("_body", F.unhex(F.concat(F.lit("7C1E"), _hex_little(size, 4), F.col("_payload"))))
    summed = framed.withColumn("_crc", crc16_arc("_body"))
    crc = F.when(k >= 97, F.col("_crc").bitwiseXOR(F.lit(1))).otherwise(F.col("_crc"))
    junk = F.when((k >= 10) & (k < 15), F.lit("7C00FF")).otherwise(F.lit(""))
    whole = F.concat(F.unhex(junk), F.col("_body"), F.unhex(_hex_little(crc.cast("long"), 4)))
    # The first message ends inside the packet, after ten bytes.
    halves = summed.withColumn("_whole", whole).select(
        "sensor_id", "seq", "_whole", F.explode(F.array(F.lit(0), F.lit(1))).alias("half"))
    payload = F.when(F.col("half") == 0, F.substring("_whole", 1, 10)).otherwise(F.substr("_whole", F.lit(11)))
    return halves.select("sensor_id", (F.col("seq") * 2 + F.col("half")).alias("arrival"), payload.alias("payload"))


def session_registry(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as a session registry: one document per order, open orders have not ended."""
    started = F.unix_seconds(F.col("o_orderdate").cast("timestamp")).cast("double")
    return table(spark, folder, "orders").select(
        F.concat(F.col("o_custkey").cast("string"), F.lit("_"), F.col("o_orderkey").cast("string")).alias("sensor_session_id"),
        F.col("o_custkey").cast("string").alias("sensor_id"),
        started.alias("started_at"),
        F.when(F.col("o_orderstatus") == "F", started + 86_400).alias("ended_at"),
        F.when(F.col("o_orderstatus") != "P", F.substring("o_orderpriority", 1, 1).cast("int")).alias("count"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_totalprice")).alias("sum_workload"),
        F.col("o_orderdate").cast("timestamp").alias("inserted_ts"),
        F.col("o_orderdate").cast("timestamp").alias("modified_ts"))
