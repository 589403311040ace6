"""Ingest plans: zone dimension, JSON decode/encode, alias resolution, zone ids,
producer normalisation, time shift, coercion, labels, box and nearest zone
(S3, S5, S6, K4, P1-P4, P10, P11, F3, J1, J2, T5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.numeric import parse_zone_id, to_double
from ..operators.dims import add_zone_labels
from ..operators.geo import nearest_zone
from ..operators.normalize import canonical, normalize_events, shift_time, stamp_arrival
from ..operators.quality import bbox_filter
from ..sinks.events import to_event_json
from ..sources import adapter
from ..sources.events import decode_events, live_rows, parse_event_times
from . import duck as D
from .registry import query

W = adapter.duck_with

# ---------------------------------------------------------------------------
# zone dimension
# ---------------------------------------------------------------------------


@query("zone_dim", W() + "select * from zones")
def zone_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: zone dimension (location_id, zone_name, latitude, longitude)."""
    return adapter.zones(spark, sf_dir)


# ---------------------------------------------------------------------------
# JSON payloads.  Corruption rule for the decode checks (applied to every row,
# none dropped): id divisible by 97 -> payload '{'; by 101 -> pickup text
# 'not-a-time'; by 7 -> passengers with a fraction; by 11 -> distance as text;
# by 13 -> a zone id beyond its range; by 17 -> passengers that are no number.
# ---------------------------------------------------------------------------


def event_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = adapter.trips(spark, sf_dir)
    e = F.col("event_id")
    txt = t.select(
        "event_id",
        F.when(e % 101 == 0, F.lit("not-a-time"))
        .otherwise(F.date_format("pickup_datetime", S.TS_TEXT_FORMAT))
        .alias("pickup_datetime"),
        F.date_format("dropoff_datetime", S.TS_TEXT_FORMAT).alias("dropoff_datetime"),
        "passenger_count",
        "trip_distance",
        "pu_location_id",
        "do_location_id",
        "total_amount",
        F.date_format("emitted_at", S.TS_TEXT_FORMAT).alias("emitted_at"),
    )
    js = to_event_json(txt, keep=["event_id"])
    body = F.col("value")
    body = F.when(e % 7 == 0, F.regexp_replace(body, r'"passenger_count":([0-9]+)', r'"passenger_count":$1.75')).otherwise(body)
    body = F.when(e % 17 == 0, F.regexp_replace(body, r'"passenger_count":[0-9.]+', '"passenger_count":"few"')).otherwise(body)
    body = F.when(e % 11 == 0, F.regexp_replace(body, r'"trip_distance":([0-9.]+)', r'"trip_distance":"far $1"')).otherwise(body)
    body = F.when(e % 13 == 0, F.regexp_replace(body, r'"do_location_id":[0-9]+', '"do_location_id":3000000000')).otherwise(body)
    return js.select("event_id", F.when(e % 97 == 0, F.lit("{")).otherwise(body).alias("value"))


DUCK_PAYLOAD_FIELDS = """
select event_id, (event_id % 97 = 0) as is_malformed,
  case when event_id % 97 = 0 then null when event_id % 101 = 0 then 'not-a-time'
       else strftime(pickup_datetime, '%Y-%m-%d %H:%M:%S') end as pickup_datetime,
  case when event_id % 97 <> 0 then strftime(dropoff_datetime, '%Y-%m-%d %H:%M:%S') end as dropoff_datetime,
  case when event_id % 97 <> 0 and event_id % 17 <> 0 then passenger_count end as passenger_count,
  case when event_id % 97 <> 0 and event_id % 11 <> 0 then trip_distance end as trip_distance,
  case when event_id % 97 <> 0 then pu_location_id end as pu_location_id,
  case when event_id % 97 <> 0 and event_id % 13 <> 0 then do_location_id end as do_location_id,
  case when event_id % 97 <> 0 then total_amount end as total_amount,
  case when event_id % 97 <> 0 then strftime(emitted_at, '%Y-%m-%d %H:%M:%S') end as emitted_at
from trips
"""
_TS = "try_strptime({0}, '%Y-%m-%d %H:%M:%S')"


@query(
    "parse_trip_json",
    W(("p", DUCK_PAYLOAD_FIELDS))
    + "select *, "
    + _TS.format("pickup_datetime")
    + " as pickup_ts, "
    + _TS.format("dropoff_datetime")
    + " as dropoff_ts from p",
)
def parse_trip_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S5 + P6: decode JSON payloads; malformed -> all-null row flagged, bad time -> null."""
    return parse_event_times(decode_events(event_payloads(spark, sf_dir), keep=["event_id"]))


DUCK_LIVE_ROWS = (
    "select event_id, "
    + _TS.format("pickup_datetime")
    + " as pickup_datetime, "
    + _TS.format("dropoff_datetime")
    + " as dropoff_datetime, passenger_count, trip_distance, pu_location_id, do_location_id,"
    " total_amount, "
    + _TS.format("emitted_at")
    + " as emitted_at from p"
)


@query("live_trip_rows", W(("p", DUCK_PAYLOAD_FIELDS)) + DUCK_LIVE_ROWS)
def live_trip_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads as live-table rows (timestamps parsed, malformed -> nulls)."""
    return live_rows(decode_events(event_payloads(spark, sf_dir), keep=["event_id"]), keep=["event_id"])


@query(
    "event_json",
    W()
    + """select event_id, strftime(pickup_datetime, '%Y-%m-%d %H:%M:%S') as pickup_datetime,
  strftime(dropoff_datetime, '%Y-%m-%d %H:%M:%S') as dropoff_datetime, passenger_count, trip_distance,
  pu_location_id, do_location_id, total_amount, strftime(emitted_at, '%Y-%m-%d %H:%M:%S') as emitted_at
from trips""",
)
def event_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4: encode trips as JSON events, then re-parse the fields for comparison."""
    t = adapter.trips(spark, sf_dir)
    txt = t.select(
        "event_id",
        F.date_format("pickup_datetime", S.TS_TEXT_FORMAT).alias("pickup_datetime"),
        F.date_format("dropoff_datetime", S.TS_TEXT_FORMAT).alias("dropoff_datetime"),
        "passenger_count",
        "trip_distance",
        "pu_location_id",
        "do_location_id",
        "total_amount",
        F.date_format("emitted_at", S.TS_TEXT_FORMAT).alias("emitted_at"),
    )
    js = to_event_json(txt, keep=["event_id"])
    return decode_events(js, keep=["event_id"]).drop("is_malformed")


# ---------------------------------------------------------------------------
# aliases, zone ids, producer normalisation
# ---------------------------------------------------------------------------

DUCK_CANON = """
select event_id, family,
  coalesce(tpep_pickup_datetime, lpep_pickup_datetime, pickup_datetime) as pickup_datetime,
  coalesce(tpep_dropoff_datetime, lpep_dropoff_datetime, dropoff_datetime) as dropoff_datetime,
  passenger_count, trip_distance,
  coalesce(PULocationID, pu_location_id) as pu_location_raw,
  coalesce(DOLocationID, do_location_id) as do_location_raw,
  pickup_latitude, pickup_longitude, dropoff_latitude, dropoff_longitude,
  coalesce(total_amount, fare_amount) as total_amount, tip_amount
from raw_wide
"""


def _canon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical(adapter.raw_wide(spark, sf_dir), keep=["event_id", "family"])


@query(
    "alias_coalesce",
    W(("c", DUCK_CANON), base=("zones", "trips", "raw_wide"))
    + "select event_id, family, pickup_datetime, dropoff_datetime, pu_location_raw,"
    " do_location_raw, total_amount from c",
)
def alias_coalesce(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First non-null alias per canonical field across schema families."""
    return _canon(spark, sf_dir).select(
        "event_id", "family", "pickup_datetime", "dropoff_datetime", "pu_location_raw",
        "do_location_raw", "total_amount",
    )


def _duck_zone(x: str) -> str:
    return f"case when trunc({x}) > 0 and trunc({x}) < 2147483648 then cast(trunc({x}) as int) end"


@query(
    "zone_id_parse",
    W(("c", DUCK_CANON), base=("zones", "trips", "raw_wide"))
    + f"select event_id, pu_location_raw, {_duck_zone('pu_location_raw')} as pu_location_id,"
    f" do_location_raw, {_duck_zone('do_location_raw')} as do_location_id from c",
)
def zone_id_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone id = truncated number, null unless > 0."""
    c = _canon(spark, sf_dir)
    return c.select(
        "event_id",
        "pu_location_raw",
        parse_zone_id("pu_location_raw").alias("pu_location_id"),
        "do_location_raw",
        parse_zone_id("do_location_raw").alias("do_location_id"),
    )


def _duck_nearest(name: str, src: str, lat: str, lon: str, metric: str) -> tuple[str, str]:
    """CTE computing (lat_r, lon_r) -> nearest zone id for the distinct rounded points."""
    if metric == "euclid":
        dist = "(z.latitude - p.lat_r)*(z.latitude - p.lat_r) + (z.longitude - p.lon_r)*(z.longitude - p.lon_r)"
    else:
        dist = (
            "2.0*asin(sqrt(pow(sin((radians(z.latitude)-radians(p.lat_r))/2),2) + "
            "cos(radians(p.lat_r))*cos(radians(z.latitude))*"
            "pow(sin((radians(z.longitude)-radians(p.lon_r))/2),2)))"
        )
    body = f"""
select lat_r, lon_r, location_id from (
  select p.lat_r, p.lon_r, z.location_id,
         row_number() over (partition by p.lat_r, p.lon_r order by {D.dist12(dist)}, z.location_id) as rn
  from (select distinct {D.r(lat, 3)} as lat_r, {D.r(lon, 3)} as lon_r from {src}
        where {lat} is not null and {lon} is not null) p, zones z
  where z.latitude is not null and z.longitude is not null)
where rn = 1
"""
    return name, body


def _duck_join_nearest(src: str, lat: str, lon: str, nz: str) -> str:
    return (
        f"left join {nz} on {nz}.lat_r = {D.r(src + '.' + lat, 3)}"
        f" and {nz}.lon_r = {D.r(src + '.' + lon, 3)}"
    )


def _producer_text(x: str) -> str:
    return (
        f"case when epoch_us({x}) % 1000000 = 0 then strftime({x}, '%Y-%m-%d %H:%M:%S')"
        f" else strftime({x}, '%Y-%m-%d %H:%M:%S.%f') end"
    )


NORMALIZE_SQL = (
    W(
        ("c", DUCK_CANON),
        _duck_nearest("npu", "c", "pickup_latitude", "pickup_longitude", "euclid"),
        _duck_nearest("ndo", "c", "dropoff_latitude", "dropoff_longitude", "euclid"),
        base=("zones", "trips", "raw_wide"),
    )
    + f"""select c.event_id, c.family,
  coalesce({_producer_text('c.pickup_datetime')}, '') as pickup_datetime,
  coalesce({_producer_text('c.dropoff_datetime')}, '') as dropoff_datetime,
  cast(coalesce(c.passenger_count, 1.0) as int) as passenger_count,
  coalesce(c.trip_distance, 1.0) as trip_distance,
  cast(coalesce({_duck_zone('c.pu_location_raw')}, npu.location_id, 161) as int) as pu_location_id,
  cast(coalesce({_duck_zone('c.do_location_raw')}, ndo.location_id, 161) as int) as do_location_id,
  coalesce(c.total_amount, 10.0) as total_amount
from c {_duck_join_nearest('c', 'pickup_latitude', 'pickup_longitude', 'npu')}
       {_duck_join_nearest('c', 'dropoff_latitude', 'dropoff_longitude', 'ndo')}
where c.pickup_datetime is not null and c.dropoff_datetime is not null"""
)


@query("normalize_trips", NORMALIZE_SQL)
def normalize_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5: any-family raw rows -> producer records (ids, snap, defaults, required check)."""
    raw = adapter.raw_wide(spark, sf_dir)
    return normalize_events(raw, adapter.zones(spark, sf_dir), keep=["event_id", "family"])


@query(
    "shift_time",
    W()
    + """select event_id,
  strftime(pickup_datetime + interval 62 day, '%Y-%m-%d %H:%M:%S') as pickup_datetime,
  strftime(dropoff_datetime + interval 62 day, '%Y-%m-%d %H:%M:%S') as dropoff_datetime
from trips""",
)
def shift_time_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replay cycle 2 -> times advanced by 62 days, whole-second text."""
    t = adapter.trips(spark, sf_dir).select("event_id", "pickup_datetime", "dropoff_datetime")
    return shift_time(t, 2)


# ---------------------------------------------------------------------------
# coercion and labels over the decoded live rows
# ---------------------------------------------------------------------------

DUCK_COERCED = f"""
select event_id,
  coalesce(pu_location_id, 0) as pu_location_id, coalesce(do_location_id, 0) as do_location_id,
  coalesce(total_amount, 0.0) as total_amount, coalesce(trip_distance, 0.0) as trip_distance,
  {_TS.format('emitted_at')} as emitted_at
from p
"""


def coerced_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = live_rows(decode_events(event_payloads(spark, sf_dir), keep=["event_id"]), keep=["event_id"])
    return coerce_numeric(rows)


def coerce_numeric(rows: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """P10 (display variant): numeric coercion with 0 for missing, ids as int."""
    keep = keep if keep is not None else ["event_id"]
    zero_int = lambda c: F.coalesce(to_double(c), F.lit(0.0)).cast("long").cast("int")
    return rows.select(
        *keep,
        zero_int("pu_location_id").alias("pu_location_id"),
        zero_int("do_location_id").alias("do_location_id"),
        F.coalesce(to_double("total_amount"), F.lit(0.0)).alias("total_amount"),
        F.coalesce(to_double("trip_distance"), F.lit(0.0)).alias("trip_distance"),
        F.col("emitted_at"),
    )


@query("coerce_trips", W(("p", DUCK_PAYLOAD_FIELDS), ("k", DUCK_COERCED)) + "select * from k")
def coerce_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P10: decoded rows with numeric fields coerced (missing -> 0)."""
    return coerced_live(spark, sf_dir)


@query(
    "zone_labels",
    W(("p", DUCK_PAYLOAD_FIELDS), ("k", DUCK_COERCED))
    + """select k.event_id, k.pu_location_id, k.do_location_id,
  coalesce(nullif(zp.zone_name, ''), 'Unknown Zone ' || cast(k.pu_location_id as varchar)) as pickup_name,
  coalesce(nullif(zd.zone_name, ''), 'Unknown Zone ' || cast(k.do_location_id as varchar)) as dropoff_name
from k left join zones zp on zp.location_id = k.pu_location_id
       left join zones zd on zd.location_id = k.do_location_id""",
)
def zone_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pickup/dropoff zone names with 'Unknown Zone N' fallback."""
    k = coerced_live(spark, sf_dir).select("event_id", "pu_location_id", "do_location_id")
    return add_zone_labels(
        k, adapter.zones(spark, sf_dir), {"pu_location_id": "pickup_name", "do_location_id": "dropoff_name"}
    )


# ---------------------------------------------------------------------------
# box and nearest zone over the lat/lon family
# ---------------------------------------------------------------------------

BOX = (
    "pickup_latitude between 40.4 and 41.0 and pickup_longitude between -74.5 and -73.5"
)


@query("bbox_filter", W(base=("legacy",)) + f"select event_id from legacy where {BOX}")
def bbox_filter_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """coordinates inside the inclusive city box."""
    return bbox_filter(adapter.legacy_coords(spark, sf_dir)).select("event_id")


@query(
    "nearest_zone_euclid",
    W(_duck_nearest("nz", "legacy", "pickup_latitude", "pickup_longitude", "euclid"), base=("zones", "legacy"))
    + "select legacy.event_id, nz.location_id from legacy "
    + _duck_join_nearest("legacy", "pickup_latitude", "pickup_longitude", "nz"),
)
def nearest_zone_euclid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearest zone by squared degree distance (3-dp key, lowest id on ties)."""
    c = adapter.legacy_coords(spark, sf_dir)
    out = nearest_zone(c, adapter.zones(spark, sf_dir), "pickup_latitude", "pickup_longitude", "location_id", "euclid")
    return out.select("event_id", "location_id")


@query(
    "nearest_zone_haversine",
    W(
        ("inbox", f"select * from legacy where {BOX}"),
        _duck_nearest("nz", "inbox", "pickup_latitude", "pickup_longitude", "haversine"),
        base=("zones", "legacy"),
    )
    + "select inbox.event_id, nz.location_id from inbox "
    + _duck_join_nearest("inbox", "pickup_latitude", "pickup_longitude", "nz"),
)
def nearest_zone_haversine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In-box coordinates snapped by great-circle distance over distinct 3-dp pairs."""
    c = bbox_filter(adapter.legacy_coords(spark, sf_dir))
    out = nearest_zone(
        c, adapter.zones(spark, sf_dir), "pickup_latitude", "pickup_longitude", "location_id", "haversine"
    )
    return out.select("event_id", "location_id")


@query(
    "arrival_stamp",
    W() + "select event_id, strftime(date_trunc('second', emitted_at), '%Y-%m-%d %H:%M:%S') as emitted_at from trips",
)
def arrival_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5: arrival time as whole-second text; the clock is the trip's own arrival."""
    t = adapter.trips(spark, sf_dir).select("event_id", F.col("emitted_at").alias("clock"))
    return stamp_arrival(t, F.col("clock")).select("event_id", "emitted_at")
