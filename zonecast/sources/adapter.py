"""Adapter: derive trip records and a zone dimension from the driver test tables.

The test tables are a generic event log (``events``) and a small ``nation``
dimension.  Trips are a column-wise rule over ``events`` (one trip per event,
so the work grows with the table); zones are a rule over ``nation``.  The
DuckDB text next to each Spark plan is the oracle's version of the same rule.

Clocks
------
* dense clock (``pickup_datetime``/``dropoff_datetime``/``emitted_at``): the
  event clock compressed 60x, used by stream and live operators;
* real clock (``pickup_raw``/``dropoff_raw``): the event clock itself, used for
  training features (varied hours and weekdays).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Origin of the dense clock (2024-01-01 00:00:00 UTC, micros) and
# the compression factor.
CLOCK_ORIGIN_US = 1704067200000000
CLOCK_COMPRESSION = 60


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _prop_k():
    """``props.k`` as bigint.  Fast path for the flat '{"k": N}' payload (plain
    string slicing); any other shape goes through the JSON path parser."""
    props = F.col("props")
    prefix = '{"k": '
    simple = props.startswith(prefix) & props.endswith("}")
    digits = F.expr(f"substring(props, {len(prefix) + 1}, length(props) - {len(prefix) + 1})")
    return F.when(simple, digits.try_cast("bigint")).otherwise(
        F.get_json_object(props, "$.k").try_cast("bigint")
    )


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """location_id, zone_name, latitude, longitude (one row per nation)."""
    n = read_table(spark, sf_dir, "nation")
    key = F.col("n_nationkey")
    return n.select(
        (key + 1).cast("int").alias("location_id"),
        F.col("n_name").alias("zone_name"),
        (F.lit(40.5) + F.lit(0.02) * ((key * 7) % 25)).cast("double").alias("latitude"),
        (F.lit(-74.2) + F.lit(0.02) * ((key * 11) % 25)).cast("double").alias("longitude"),
    )


def _event_base(spark: SparkSession, sf_dir: str, since=None) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    if since is not None:
        ev = ev.filter(F.col("ts") >= since)
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    k = _prop_k()
    return ev.select(
        "event_id",
        "user_id",
        "value",
        "event_type",
        us.alias("us"),
        k.alias("k"),
    )


def newest_arrival(spark: SparkSession, sf_dir: str):
    """The newest arrival on the dense clock, from the event clock's column alone."""
    us = F.unix_micros(F.max("ts").cast("timestamp"))
    dense = F.lit(CLOCK_ORIGIN_US) + F.floor((us - CLOCK_ORIGIN_US) / CLOCK_COMPRESSION)
    return read_table(spark, sf_dir, "events").select(F.timestamp_micros(dense.cast("long"))).scalar()


def trips_within(spark: SparkSession, sf_dir: str, seconds: int) -> DataFrame:
    """Trips that arrived at most ``seconds`` before the newest arrival.

    An arrival a is floor((us - origin) / 60) after the origin, and floor(x / 60) >= k
    is the same as x >= 60 k: the bound is set on the scanned column itself, so
    row groups and files outside the window are skipped.
    """
    us = F.unix_micros(F.max("ts").cast("timestamp")) - CLOCK_ORIGIN_US
    first = F.floor(us / CLOCK_COMPRESSION).cast("long") - seconds * 1_000_000
    bound = F.timestamp_micros(F.lit(CLOCK_ORIGIN_US) + first * CLOCK_COMPRESSION).cast("timestamp_ntz")
    since = read_table(spark, sf_dir, "events").select(bound).scalar()
    return trips(spark, sf_dir, since)


def trips(spark: SparkSession, sf_dir: str, since=None) -> DataFrame:
    """Typed trip records derived from ``events`` (see module docstring)."""
    b = _event_base(spark, sf_dir, since)
    origin = F.lit(CLOCK_ORIGIN_US)
    pus = origin + F.expr(f"div(us - {CLOCK_ORIGIN_US}, {CLOCK_COMPRESSION})")
    dur_us = (F.col("k") * 60 + F.col("event_id") % 60) * F.lit(1_000_000)
    return b.select(
        F.col("event_id"),
        F.timestamp_micros(pus).alias("pickup_datetime"),
        F.timestamp_micros(pus + dur_us).alias("dropoff_datetime"),
        (F.col("event_id") % 6 + 1).cast("int").alias("passenger_count"),
        (F.col("value") / 5).alias("trip_distance"),
        (F.col("user_id") % 27).cast("int").alias("pu_location_id"),
        ((F.col("user_id") * 7 + F.col("event_id")) % 26 + 1).cast("int").alias("do_location_id"),
        F.col("value").alias("total_amount"),
        (F.col("value") * ((F.col("k") % 30) / F.lit(100.0))).alias("tip_amount"),
        F.timestamp_micros(pus).alias("emitted_at"),
        F.timestamp_micros(F.col("us")).alias("pickup_raw"),
        F.timestamp_micros(F.col("us") + dur_us).alias("dropoff_raw"),
        F.col("event_type").alias("source"),
    )


def legacy_coords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pickup coordinates for the lat/lon family (some fall outside the box)."""
    ev = read_table(spark, sf_dir, "events").select("event_id")
    e = F.col("event_id")
    return ev.select(
        "event_id",
        (F.lit(40.35) + (e % 700) / F.lit(1000.0)).alias("pickup_latitude"),
        (F.lit(-74.55) + ((e * 13) % 1100) / F.lit(1000.0)).alias("pickup_longitude"),
    )


def training_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips on the real clock, with the tip column (training input)."""
    t = trips(spark, sf_dir)
    return t.select(
        "event_id",
        F.col("pickup_raw").alias("pickup_datetime"),
        F.col("dropoff_raw").alias("dropoff_datetime"),
        "passenger_count",
        "trip_distance",
        "pu_location_id",
        "do_location_id",
        "total_amount",
        "tip_amount",
    )


# ---------------------------------------------------------------------------
# DuckDB text of the same rules (oracle side).  Each is a CTE body.
# ---------------------------------------------------------------------------
DUCK_ZONES = """
select cast(n_nationkey+1 as int) as location_id, n_name as zone_name,
       40.5::double + 0.02::double*((n_nationkey*7)%25) as latitude,
       -74.2::double + 0.02::double*((n_nationkey*11)%25) as longitude
from nation
"""

DUCK_TRIPS = """
with b as (select event_id, user_id, value, event_type, epoch_us(ts) as us,
                  cast(json_extract(props,'$.k') as bigint) as k from events),
     d as (select *, 1704067200000000 + (us-1704067200000000)//60 as pus,
                  k*60 + event_id%60 as dur_s from b)
select event_id,
       make_timestamp(pus) as pickup_datetime,
       make_timestamp(pus + dur_s*1000000) as dropoff_datetime,
       cast(event_id%6+1 as int) as passenger_count,
       value/5 as trip_distance,
       cast(user_id%27 as int) as pu_location_id,
       cast((user_id*7+event_id)%26+1 as int) as do_location_id,
       value as total_amount,
       value*((k%30)/100::double) as tip_amount,
       make_timestamp(pus) as emitted_at,
       make_timestamp(us) as pickup_raw,
       make_timestamp(us + dur_s*1000000) as dropoff_raw,
       event_type as source
from d
"""

DUCK_LEGACY = """
select event_id, 40.35::double + (event_id%700)/1000::double as pickup_latitude,
       -74.55::double + ((event_id*13)%1100)/1000::double as pickup_longitude
from events
"""

DUCK_TRAINING_TRIPS = """
select event_id, pickup_raw as pickup_datetime, dropoff_raw as dropoff_datetime,
       passenger_count, trip_distance, pu_location_id, do_location_id, total_amount, tip_amount
from trips
"""


def duck_with(*ctes: tuple[str, str], base: tuple[str, ...] = ("zones", "trips")) -> str:
    """Build a ``WITH`` prefix holding the adapter views plus extra CTEs."""
    parts = []
    known = {
        "zones": DUCK_ZONES,
        "trips": DUCK_TRIPS,
        "legacy": DUCK_LEGACY,
        "training_trips": DUCK_TRAINING_TRIPS,
        "raw_wide": DUCK_RAW_WIDE,
    }
    for name in base:
        parts.append(f"{name} as ({known[name]})")
    for name, body in ctes:
        parts.append(f"{name} as ({body})")
    return "with " + ",\n".join(parts) + "\n"


# ---------------------------------------------------------------------------
# Raw trip files of differing schema families, derived from the same events.
# The family of a record is a rule over ``event_type``:
#   view -> yellow (tpep_*, PULocationID with a fractional part)
#   click -> green (lpep_*), purchase -> generic (pickup_datetime,
#   pu_location_id, fare_amount only), signup -> legacy (lat/lon, no zone id),
#   error -> mixed (two aliases of the same field both set, passengers missing).
# ---------------------------------------------------------------------------
FAMILY_OF_EVENT_TYPE = {
    "view": "yellow",
    "click": "green",
    "purchase": "generic",
    "signup": "legacy",
    "error": "mixed",
}

RAW_COLUMNS = [
    "tpep_pickup_datetime", "tpep_dropoff_datetime", "lpep_pickup_datetime",
    "lpep_dropoff_datetime", "pickup_datetime", "dropoff_datetime", "passenger_count",
    "trip_distance", "PULocationID", "DOLocationID", "pu_location_id", "do_location_id",
    "pickup_latitude", "pickup_longitude", "dropoff_latitude", "dropoff_longitude",
    "total_amount", "fare_amount", "tip_amount",
]


def raw_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All families in one wide frame (absent columns are null) + ``family``."""
    t = trips(spark, sf_dir)
    fam = F.col("source")
    family = F.create_map(*[x for kv in FAMILY_OF_EVENT_TYPE.items() for x in map(F.lit, kv)])[fam]
    yellow, green, generic = fam == "view", fam == "click", fam == "purchase"
    legacy, mixed = fam == "signup", fam == "error"
    e = F.col("event_id")
    pu = F.col("pu_location_id").cast("double")
    do = F.col("do_location_id").cast("double")
    hour = F.make_dt_interval(F.lit(0), F.lit(1))
    on = F.when
    return t.select(
        "event_id",
        family.alias("family"),
        on(yellow | mixed, F.col("pickup_datetime")).alias("tpep_pickup_datetime"),
        on(yellow | mixed, F.col("dropoff_datetime")).alias("tpep_dropoff_datetime"),
        on(green, F.col("pickup_datetime")).alias("lpep_pickup_datetime"),
        on(green, F.col("dropoff_datetime")).alias("lpep_dropoff_datetime"),
        on(generic | legacy, F.col("pickup_datetime"))
        .when(mixed, F.col("pickup_datetime") + hour).alias("pickup_datetime"),
        on(generic | legacy, F.col("dropoff_datetime"))
        .when(mixed, F.col("dropoff_datetime") + hour).alias("dropoff_datetime"),
        on(~mixed, F.col("passenger_count").cast("double")).alias("passenger_count"),
        F.col("trip_distance"),
        # some mixed rows lack the first of their two zone aliases
        on(yellow, pu + (e % 10) / F.lit(10.0)).when(green | (mixed & (e % 5 != 0)), pu).alias("PULocationID"),
        on(yellow | green | mixed, do).alias("DOLocationID"),
        on(generic, pu).when(mixed, do).alias("pu_location_id"),
        on(generic, do).when(mixed, pu).alias("do_location_id"),
        on(legacy, F.lit(40.35) + (e % 700) / F.lit(1000.0)).alias("pickup_latitude"),
        on(legacy, F.lit(-74.55) + ((e * 13) % 1100) / F.lit(1000.0)).alias("pickup_longitude"),
        on(legacy, F.lit(40.35) + ((e * 3) % 700) / F.lit(1000.0)).alias("dropoff_latitude"),
        on(legacy, F.lit(-74.55) + ((e * 7) % 1100) / F.lit(1000.0)).alias("dropoff_longitude"),
        on(~generic, F.col("total_amount")).alias("total_amount"),
        on(generic, F.col("total_amount"))
        .when(mixed, F.col("total_amount") / F.lit(2.0)).alias("fare_amount"),
        F.col("tip_amount"),
    )


DUCK_RAW_WIDE = """
select event_id,
  case source when 'view' then 'yellow' when 'click' then 'green' when 'purchase' then 'generic'
              when 'signup' then 'legacy' when 'error' then 'mixed' end as family,
  case when source in ('view','error') then pickup_datetime end as tpep_pickup_datetime,
  case when source in ('view','error') then dropoff_datetime end as tpep_dropoff_datetime,
  case when source = 'click' then pickup_datetime end as lpep_pickup_datetime,
  case when source = 'click' then dropoff_datetime end as lpep_dropoff_datetime,
  case when source in ('purchase','signup') then pickup_datetime
       when source = 'error' then pickup_datetime + interval 1 hour end as pickup_datetime,
  case when source in ('purchase','signup') then dropoff_datetime
       when source = 'error' then dropoff_datetime + interval 1 hour end as dropoff_datetime,
  case when source <> 'error' then cast(passenger_count as double) end as passenger_count,
  trip_distance,
  case when source = 'view' then cast(pu_location_id as double) + (event_id%10)/10.0::double
       when source = 'click' or (source = 'error' and event_id % 5 <> 0) then cast(pu_location_id as double) end as PULocationID,
  case when source in ('view','click','error') then cast(do_location_id as double) end as DOLocationID,
  case when source = 'purchase' then cast(pu_location_id as double)
       when source = 'error' then cast(do_location_id as double) end as pu_location_id,
  case when source = 'purchase' then cast(do_location_id as double)
       when source = 'error' then cast(pu_location_id as double) end as do_location_id,
  case when source = 'signup' then 40.35::double + (event_id%700)/1000::double end as pickup_latitude,
  case when source = 'signup' then -74.55::double + ((event_id*13)%1100)/1000::double end as pickup_longitude,
  case when source = 'signup' then 40.35::double + ((event_id*3)%700)/1000::double end as dropoff_latitude,
  case when source = 'signup' then -74.55::double + ((event_id*7)%1100)/1000::double end as dropoff_longitude,
  case when source <> 'purchase' then total_amount end as total_amount,
  case when source = 'purchase' then total_amount when source = 'error' then total_amount/2.0::double end as fare_amount,
  tip_amount
from trips
"""
