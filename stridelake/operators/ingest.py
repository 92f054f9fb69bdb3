"""From broker rows to input records: gate, parse, quarantine, broker time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from stridelake.functions.motion import coerced_number
from stridelake.operators.once import computed_once
from stridelake.schemas import INPUT_RECORD

CORRUPT = "_corrupt_record"


def gate(messages: DataFrame) -> DataFrame:
    """Drop rows with no payload, or with a broker time that is missing or not after the epoch."""
    return messages.filter(
        F.col("value").isNotNull() & (F.length("value") > 0) & (F.unix_millis("timestamp") > 0))


def decode_bytes(messages: DataFrame) -> DataFrame:
    """The same gate on binary values, which become UTF-8 text."""
    return gate(messages).withColumn("value", F.decode("value", "UTF-8"))


def _reading(schema: T.StructType) -> F.Column:
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return F.from_json("value", with_corrupt, {
        "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "allowNonNumericNumbers": "false"})


def _outline(schema: T.StructType) -> T.StructType:
    """The same record with open maps for its samples."""
    open_maps = T.ArrayType(T.MapType(T.StringType(), T.StringType()))
    return T.StructType([
        T.StructField(f.name, open_maps if isinstance(f.dataType, T.ArrayType) else f.dataType) for f in schema])


def _with_texts(schema: T.StructType) -> T.StructType:
    """The same record with its whole numbers read as texts."""
    return T.StructType([
        T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.LongType) else f.dataType) for f in schema])


def whole_number(text: F.Column) -> F.Column:
    """`"123"` and `12.0` are taken as whole numbers, fractions are cut off; null if it is no number."""
    return F.coalesce(text.try_cast("bigint"), text.try_cast("decimal(38,6)").try_cast("bigint"))


def parse(messages: DataFrame, schema: T.StructType = INPUT_RECORD) -> DataFrame:
    """Add `record`, and `_corrupt_record` with the text of a payload that is no such JSON record.

    Inside a sample, anything that is not a number is only left out. Spark marks such rows as corrupt
    too, so the marked ones, and only those, are read again with open maps to see if the outline holds.
    Whole numbers may come as texts or with a fraction; a record is corrupt if one of them is no number.
    """
    texts = _with_texts(schema)
    parsed = computed_once(messages, record=_reading(texts))
    marked = F.col(f"record.{CORRUPT}")
    wrong = F.lit(False)
    for f in schema:
        if isinstance(f.dataType, T.LongType):
            wrong = wrong | (F.col(f"record.{f.name}").isNotNull() & whole_number(F.col(f"record.{f.name}")).isNull())
    unread = F.when(marked.isNotNull(), _reading(_outline(texts))[CORRUPT])
    checked = computed_once(parsed, **{CORRUPT: F.coalesce(unread, F.when(wrong, F.col("value")))})
    return checked.withColumn("record", F.struct(*[
        (whole_number(F.col(f"record.{f.name}")) if isinstance(f.dataType, T.LongType) else F.col(f"record.{f.name}")).alias(f.name)
        for f in schema]))


def good_rows(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col(CORRUPT).isNull())


def quarantine(parsed: DataFrame) -> DataFrame:
    """Rows that did not parse, with where they came from."""
    places = [c for c in ("topic", "partition", "offset", "timestamp", "key") if c in parsed.columns]
    return parsed.filter(F.col(CORRUPT).isNotNull()).select(*places, F.col(CORRUPT).alias("payload"))


def strict(parsed: DataFrame) -> DataFrame:
    """Fail the job on the first payload that did not parse."""
    checked = F.when(F.col(CORRUPT).isNotNull(), F.raise_error(F.concat(F.lit("bad JSON: "), F.col(CORRUPT))))
    return parsed.filter(checked.isNull())


def with_broker_time(records: DataFrame) -> DataFrame:
    """Set the record's kafka_timestamp, in microseconds, from the broker's milliseconds."""
    stamp = F.unix_millis("timestamp") * 1000
    fields = [f.name for f in records.schema["record"].dataType]
    kept = [stamp.alias(f) if f == "kafka_timestamp" else F.col(f"record.{f}").alias(f) for f in fields]
    return records.withColumn("record", F.struct(*kept))


def input_records(messages: DataFrame, on_error: str = "quarantine") -> DataFrame:
    """Gate, parse and broker time in one narrow step; keeps partition and offset as arrival order."""
    parsed = parse(gate(messages))
    kept = strict(parsed) if on_error == "fail" else good_rows(parsed)
    places = [c for c in ("partition", "offset") if c in messages.columns]
    return with_broker_time(kept).select(*places, "record.*")


def with_sensor(df: DataFrame) -> DataFrame:
    """Drop messages that name no sensor."""
    return df.filter(F.col("sensor_id").isNotNull() & (F.col("sensor_id") != ""))


def required_numbers(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The rows with these columns as doubles, 0.0 where a value is no number; an error names the columns that are not there."""
    held = {c.lower() for c in rows.columns}
    missing = [c for c in columns if c.lower() not in held]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return rows.withColumns({c: coerced_number(F.col(f"`{c}`")) for c in columns})
