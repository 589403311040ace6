"""Streaming and sink plans: the stream replays of the feed (T1-T4) with their
sinks (K1, K2), the keyed upsert of overlapping batches (K1) and the duplicate
repair of the aggregate table (W1)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.numeric import round6 as r6
from ..operators.aggregate import sliding_traffic_agg
from ..operators.select import dedup_first
from ..session import scratch_path
from ..sinks.events import to_event_json
from ..sinks.tables import append_batch, read_live, read_upserted, upsert_latest, within_retention
from ..sources import adapter
from ..sources.events import decode_events, json_file_stream
from ..streaming.live import replay_clock, run_live_stream
from ..streaming.normalize import run_event_stream
from ..streaming.replay import write_time_slices
from ..streaming.traffic import run_traffic_stream
from .ingest import NORMALIZE_SQL
from .registry import query
from .traffic import TRAFFIC_AGG_SQL, clean_stream_trips, duck_stream, duck_traffic_body

REPLAY_SLICES = 6

_AVG = ["avg_speed_mph", "avg_duration_min", "avg_trip_distance", "avg_total_amount"]


def _round_agg(df: DataFrame) -> DataFrame:
    return df.select(*[r6(c).alias(c) if c in _AVG else F.col(c) for c in S.TRAFFIC_AGG_COLUMNS])


def replay_feed(spark: SparkSession, sf_dir: str, emitted_at=None) -> str:
    """Write the trip feed as time-ordered JSON-lines slices; returns the directory.

    ``emitted_at``: what the events state as their arrival (a Column); their order stays.
    """
    t = adapter.trips(spark, sf_dir)
    stated = F.col("emitted_at") if emitted_at is None else emitted_at
    txt = t.select(
        F.date_format("pickup_datetime", S.TS_TEXT_FORMAT).alias("pickup_datetime"),
        F.date_format("dropoff_datetime", S.TS_TEXT_FORMAT).alias("dropoff_datetime"),
        "passenger_count",
        "trip_distance",
        "pu_location_id",
        "do_location_id",
        "total_amount",
        F.date_format(stated, S.TS_TEXT_FORMAT).alias("emitted_at"),
        F.col("emitted_at").alias("__arrival"),
    )
    payload = to_event_json(txt, keep=["__arrival"])
    directory = scratch_path(spark, "feed")
    write_time_slices(payload, "__arrival", directory, REPLAY_SLICES)
    return directory


@query("traffic_agg_stream", TRAFFIC_AGG_SQL)
def traffic_agg_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1-T3 + K1: the feed replayed through the watermarked, update-mode
    sliding aggregate, upserted per micro-batch; returns the stored table."""
    feed = replay_feed(spark, sf_dir)
    target = scratch_path(spark, "traffic_agg")
    run_traffic_stream(
        spark, json_file_stream(spark, feed, max_files_per_trigger=1), target, scratch_path(spark, "ckpt-traffic")
    )
    return _round_agg(read_upserted(spark, target))


DUCK_LIVE_STREAM = """
select date_trunc('second', pickup_datetime) as pickup_datetime,
       date_trunc('second', dropoff_datetime) as dropoff_datetime,
       passenger_count, trip_distance, pu_location_id, do_location_id, total_amount,
       date_trunc('second', emitted_at) as emitted_at
from trips
where date_trunc('second', emitted_at) >=
      (select max(date_trunc('second', emitted_at)) from trips) - interval 10 minute
"""


@query("live_trips_stream", adapter.duck_with() + DUCK_LIVE_STREAM)
def live_trips_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4 + K2: the feed streamed into the live table, whose sink expires old
    arrivals; read back within the 10-minute retention of the newest arrival."""
    feed = replay_feed(spark, sf_dir)
    target = scratch_path(spark, "live_trips")
    _run_live(spark, feed, target)
    table = read_live(spark, target)
    as_of = table.select(F.max("emitted_at")).scalar()
    return within_retention(table, as_of, S.LIVE_RETENTION_MIN).select(*S.LIVE_TRIP_COLUMNS)


def _run_live(spark: SparkSession, feed: str, target: str) -> None:
    run_live_stream(
        spark, json_file_stream(spark, feed, max_files_per_trigger=1), target, scratch_path(spark, "ckpt-live"),
        clock=replay_clock(),
    )


#: of a thousand events, one states an arrival ten years ahead and one ten years ago
_STRAY_YEARS, _STRAY_BOUND = 10, "2030-01-01 00:00:00"

DUCK_LIVE_STRAYS = f"""
select date_trunc('second', pickup_datetime) as pickup_datetime,
       date_trunc('second', dropoff_datetime) as dropoff_datetime,
       passenger_count, trip_distance, pu_location_id, do_location_id, total_amount, stated as emitted_at
from s where stated >= (select max(stated) from s where stated < timestamp '{_STRAY_BOUND}') - interval 10 minute
"""
_DUCK_STATED = f"""
select *, date_trunc('second', emitted_at) + to_years(case event_id % 1000 when 7 then {_STRAY_YEARS} when 11 then -{_STRAY_YEARS} else 0 end) as stated
from trips
"""


@query("live_stray_events", adapter.duck_with(("s", _DUCK_STATED)) + DUCK_LIVE_STRAYS)
def live_stray_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4 + K2 on a feed with stray clocks: events of the far future are stored and
    expire nothing, events of the far past expire; the others are kept as without them."""
    e = F.col("event_id") % 1000
    years = F.when(e == 7, _STRAY_YEARS).when(e == 11, -_STRAY_YEARS).otherwise(0)
    feed = replay_feed(spark, sf_dir, F.col("emitted_at") + F.make_ym_interval(years))
    target = scratch_path(spark, "live_strays")
    _run_live(spark, feed, target)
    table = read_live(spark, target)
    as_of = table.filter(F.col("emitted_at") < F.lit(_STRAY_BOUND).cast("timestamp")).select(F.max("emitted_at")).scalar()
    return within_retention(table, as_of, S.LIVE_RETENTION_MIN).select(*S.LIVE_TRIP_COLUMNS)


@query(
    "normalize_events_stream",
    f"select event_id, pickup_datetime, dropoff_datetime, passenger_count, trip_distance, pu_location_id, do_location_id, total_amount from ({NORMALIZE_SQL}) as n",
)
def normalize_events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5 as a stream: raw rows of all schema families through ``readStream``, normalised
    (nearest zone included), written as JSON events; the stored events decoded again."""
    raw = adapter.raw_wide(spark, sf_dir)
    source, target = scratch_path(spark, "raw-rows"), scratch_path(spark, "events")
    raw.repartition(REPLAY_SLICES).write.parquet(source)
    stream = spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", "2").parquet(source)
    run_event_stream(stream, adapter.zones(spark, sf_dir), scratch_path(spark, "ckpt-events"), target, keep=["event_id"])
    events = decode_events(spark.read.parquet(target), keep=["event_id"])
    return events.select("event_id", *(c for c in S.LIVE_TRIP_COLUMNS if c != "emitted_at"))


_CUT_US = "div(min_us + max_us, 2)"


@query(
    "upsert_latest",
    duck_stream(
        ("cut", "select (min(epoch_us(pickup_ts)) + max(epoch_us(pickup_ts))) // 2 as c from clean"),
        ("c0", "select * from clean where epoch_us(pickup_ts) < (select c from cut)"),
        ("c1", "select * from clean where epoch_us(pickup_ts) >= (select c from cut) - 600000000"),
        ("a0", duck_traffic_body(True, "c0")),
        ("a1", duck_traffic_body(True, "c1")),
        ("u", "select 0 as b, * from a0 union all select 1 as b, * from a1"),
    )
    + "select * exclude (b, rn) from (select *, row_number() over"
    " (partition by window_start, window_end, pu_location_id order by b desc) as rn from u) where rn = 1",
)
def upsert_latest_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1: two overlapping batches upserted by key; the later batch wins."""
    clean = clean_stream_trips(spark, sf_dir)
    us = F.unix_micros("pickup_ts")
    bounds = clean.select(F.min(us).alias("min_us"), F.max(us).alias("max_us"))
    cut = bounds.select(F.expr(_CUT_US)).scalar()
    b0 = sliding_traffic_agg(clean.filter(us < cut))
    b1 = sliding_traffic_agg(clean.filter(us >= cut - F.lit(600_000_000)))
    target = scratch_path(spark, "upsert")
    upsert_latest(spark, b0, 0, target)
    upsert_latest(spark, b1, 1, target)
    return _round_agg(read_upserted(spark, target))


@query(
    "upsert_after_restart",
    duck_stream(("traffic", duck_traffic_body(True, "clean")))
    + "select * exclude (trip_count), cast(trip_count + case when pu_location_id % 2 = 0 then 100 else 0 end as bigint)"
    " as trip_count from traffic",
)
def upsert_after_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 after a checkpoint reset: batch 0 of a new run replaces what batch 7 of
    the old run wrote, and an older batch of the new run, delivered again, undoes nothing."""
    agg = sliding_traffic_agg(clean_stream_trips(spark, sf_dir))
    bump = lambda n: agg.withColumn("trip_count", F.col("trip_count") + n)
    even = F.col("pu_location_id") % 2 == 0
    target = scratch_path(spark, "upsert-restart")
    upsert_latest(spark, bump(7), 7, target, run_id="old")
    upsert_latest(spark, bump(0), 0, target, run_id="new")
    upsert_latest(spark, bump(100).filter(even), 1, target, run_id="new")
    upsert_latest(spark, bump(0).filter(even), 0, target, run_id="new")
    return _round_agg(read_upserted(spark, target))


@query(
    "live_append_after_restart",
    adapter.duck_with()
    + "select event_id, emitted_at from trips where event_id % 3 = 0"
    " union all select event_id, emitted_at from trips where event_id % 3 = 1",
)
def live_append_after_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2 after a checkpoint reset: batch 0 of a new run is added to batch 0 of the
    old one; batch 0 delivered twice in a run is stored once."""
    t = adapter.trips(spark, sf_dir).select("event_id", "emitted_at")
    target = scratch_path(spark, "append-restart")
    append_batch(t.filter("event_id % 3 = 0"), 0, target, "old")
    append_batch(t.filter("event_id % 3 = 1"), 0, target, "new")
    append_batch(t.filter("event_id % 3 = 1"), 0, target, "new")
    return read_live(spark, target)


@query("dedup_agg", TRAFFIC_AGG_SQL)
def dedup_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An aggregate table holding every key twice (second copy altered);
    duplicates removed keeping the first copy per key in ingest order."""
    agg = sliding_traffic_agg(clean_stream_trips(spark, sf_dir), digits=6)
    first = agg.withColumn("ingest_seq", F.lit(0))
    second = agg.withColumn("trip_count", F.col("trip_count") + 1000).withColumn("ingest_seq", F.lit(1))
    d = dedup_first(first.unionByName(second), S.AGG_KEYS, ["ingest_seq"])
    return d.select(*S.TRAFFIC_AGG_COLUMNS)
