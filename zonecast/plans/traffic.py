"""Stream-side batch plans: cleaning, derived measures, sliding aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.aggregate import sliding_traffic_agg
from ..operators.quality import clean_stream, derive_duration_speed
from ..sources import adapter
from . import duck as D
from .registry import query


def stream_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adapter trips in the stream's shape: pickup_ts / dropoff_ts."""
    return adapter.trips(spark, sf_dir).select(
        "event_id",
        F.col("pickup_datetime").alias("pickup_ts"),
        F.col("dropoff_datetime").alias("dropoff_ts"),
        "passenger_count",
        "trip_distance",
        "pu_location_id",
        "do_location_id",
        "total_amount",
        "emitted_at",
    )


def clean_stream_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_stream(stream_trips(spark, sf_dir))


# DuckDB: the same derived frame.
DUCK_STREAM_TRIPS = f"""
select *, {D.SPEED} from (
  select event_id, pickup_datetime as pickup_ts, dropoff_datetime as dropoff_ts, passenger_count,
         trip_distance, pu_location_id, do_location_id, total_amount, emitted_at,
         {D.stream_measures()}
  from trips)
"""
DUCK_CLEAN = f"select * from stream_trips where {D.F1}"

def duck_traffic_body(rounded: bool = True, src: str = "clean") -> str:
    """DuckDB sliding-window aggregate over the ``src`` CTE (default ``clean``)."""
    rr = D.r6 if rounded else (lambda x: x)
    return f"""
select window_start, window_start + interval 10 minute as window_end, pu_location_id,
       cast(count(speed_mph) as bigint) as trip_count,
       {rr('avg(speed_mph)')} as avg_speed_mph,
       {rr('avg(duration_min)')} as avg_duration_min,
       {rr('avg(trip_distance)')} as avg_trip_distance,
       {rr('avg(total_amount)')} as avg_total_amount,
       cast(sum(case when speed_mph < 3 or speed_mph > 45 then 1 else 0 end) as bigint) as anomaly_count,
       cast(window_start as date) as service_date
from (select c.*, time_bucket(interval 5 minute, pickup_ts) - o.k * interval 5 minute as window_start
      from {src} c, (values (0), (1)) o(k))
group by window_start, pu_location_id
"""


DUCK_TRAFFIC_AGG_BODY = duck_traffic_body(True)


def duck_stream(*extra: tuple[str, str], base: tuple[str, ...] = ("zones", "trips")) -> str:
    return adapter.duck_with(("stream_trips", DUCK_STREAM_TRIPS), ("clean", DUCK_CLEAN), *extra, base=base)


STREAM_CTES = (("stream_trips", DUCK_STREAM_TRIPS), ("clean", DUCK_CLEAN))


TRAFFIC_AGG_SQL = duck_stream(("traffic", DUCK_TRAFFIC_AGG_BODY)) + "select * from traffic"


@query("traffic_agg", TRAFFIC_AGG_SQL, headline=True)
def traffic_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: sliding 10/5-minute traffic statistics per pickup zone."""
    return sliding_traffic_agg(clean_stream_trips(spark, sf_dir), digits=6)


@query(
    "derive_duration_speed",
    duck_stream()
    + f"select event_id, {D.r6('duration_min')} as duration_min, {D.r6('speed_mph')} as speed_mph"
    " from stream_trips",
)
def derive_duration_speed_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole-second duration (minutes) and speed; zero duration -> null speed."""
    from ..functions.numeric import round6 as r6

    t = derive_duration_speed(stream_trips(spark, sf_dir))
    return t.select(
        "event_id",
        r6("duration_min").alias("duration_min"),
        r6("speed_mph").alias("speed_mph"),
    )


@query("clean_trips", duck_stream() + "select event_id from clean")
def clean_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of trips passing the stream quality rule F1."""
    return clean_stream_trips(spark, sf_dir).select("event_id")
