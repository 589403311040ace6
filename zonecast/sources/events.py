"""Trip event payloads: JSON decode (S5, S6) and the stream source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S
from ..functions.numeric import to_double
from ..functions.timefn import parse_ts

CORRUPT = "_corrupt_record"
# every field is first read as text, so one ill-typed value cannot void its neighbours
_TEXT_SCHEMA = T.StructType(
    [T.StructField(f.name, T.StringType()) for f in S.TRIP_EVENT_SCHEMA.fields] + [T.StructField(CORRUPT, T.StringType())]
)


def typed_field(text, kind: T.DataType):
    """One field's text in its wire type; what does not fit is null.

    Numbers are read as double; a whole-number field is truncated toward zero,
    and null outside its range.
    """
    if isinstance(kind, T.StringType):
        return text
    number = to_double(text)
    if isinstance(kind, T.IntegerType):
        return F.when(F.abs(number) < F.lit(2147483648.0), number).cast("int")
    return number.cast(kind)


def decode_events(df: DataFrame, value: str = "value", keep: list[str] | None = None) -> DataFrame:
    """JSON text/bytes -> typed event columns (PERMISSIVE).

    A payload that is not a JSON object (or not JSON at all) yields an all-null
    row with ``is_malformed = true``; the row is kept, never dropped.  In an object
    only the fields whose value does not fit their type are null.
    """
    keep = keep or []
    txt = F.col(value).cast("string")
    parsed = F.from_json(txt, _TEXT_SCHEMA, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    out = df.select(*keep, parsed.alias("e"), txt.alias("__txt"))
    is_obj = F.coalesce(F.ltrim(F.col("__txt")).startswith("{"), F.lit(False))
    malformed = F.col("e").isNull() | F.col(f"e.{CORRUPT}").isNotNull() | ~is_obj
    fields = [
        F.when(~malformed, typed_field(F.col(f"e.{f.name}"), f.dataType)).alias(f.name)
        for f in S.TRIP_EVENT_SCHEMA.fields
    ]
    return out.select(*keep, *fields, malformed.alias("is_malformed"))


def parse_event_times(df: DataFrame) -> DataFrame:
    """pickup_ts / dropoff_ts from the text fields; unparsable -> null."""
    return df.withColumn("pickup_ts", parse_ts("pickup_datetime")).withColumn(
        "dropoff_ts", parse_ts("dropoff_datetime")
    )


def live_rows(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Decoded events as live-table rows with real timestamps."""
    keep = keep or []
    return df.select(
        *keep,
        parse_ts("pickup_datetime").alias("pickup_datetime"),
        parse_ts("dropoff_datetime").alias("dropoff_datetime"),
        "passenger_count",
        "trip_distance",
        "pu_location_id",
        "do_location_id",
        "total_amount",
        parse_ts("emitted_at").alias("emitted_at"),
    )


def kafka_stream(spark: SparkSession, bootstrap: str, topic: str, starting: str = "latest",
                 fail_on_data_loss: bool = True) -> DataFrame:
    """The broker topic as a streaming frame (needs the Kafka connector jar)."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .option("failOnDataLoss", str(fail_on_data_loss).lower())
        .load()
    )


def json_file_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = 1) -> DataFrame:
    """Payload files as a stream (oldest modification time first): one JSON payload per line in ``value``."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)
