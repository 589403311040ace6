"""Live-view plans (dashboard data): A10-A14, A16, J4, W4-W7, P13, P14, M3, K2 read side.

The live table is the trip feed bounded by retention: trips that arrived no
more than 10 minutes before ``as_of`` = newest arrival.  The station and KPI
views read the newest 200 of them (the live sample).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.numeric import round6 as r6
from ..operators import live as L
from ..sources import adapter
from . import duck as D
from .registry import query

W = adapter.duck_with


def live_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapter.trips_within(spark, sf_dir, S.LIVE_RETENTION_MIN * 60).select(
        "event_id", "pickup_datetime", "dropoff_datetime", "passenger_count", "trip_distance",
        "pu_location_id", "do_location_id", "total_amount", "emitted_at",
    )


def sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.newest(live_trips(spark, sf_dir), S.LIVE_SAMPLE)


DUCK_LIVE = """
select * from trips where emitted_at >= (select max(emitted_at) from trips) - interval 10 minute
"""
DUCK_SAMPLE = "select * from live order by emitted_at desc, event_id desc limit 200"
DUCK_STATIONS = """
select z.location_id, z.zone_name, z.latitude, z.longitude,
       coalesce(p.n, 0) as pickup_trips, coalesce(d.n, 0) as dropoff_trips,
       coalesce(p.n, 0) + coalesce(d.n, 0) as total_trips
from zones z
left join (select pu_location_id as location_id, count(*) as n from sample group by 1) p using (location_id)
left join (select do_location_id as location_id, count(*) as n from sample group by 1) d using (location_id)
"""


def duck_live(*extra: tuple[str, str]) -> str:
    return W(("live", DUCK_LIVE), ("sample", DUCK_SAMPLE), ("stations", DUCK_STATIONS), *extra)


@query(
    "live_retention",
    duck_live() + "select event_id, emitted_at from live",
)
def live_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2 (read side): trips within 10 minutes of the newest arrival."""
    return live_trips(spark, sf_dir).select("event_id", "emitted_at")


@query(
    "trips_per_minute",
    duck_live()
    + "select cast(count(*) as bigint) as trip_count from live"
    " where emitted_at >= (select max(emitted_at) from trips) - interval 60 second",
    headline=True,
)
def trips_per_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10 + F7: trips that arrived in the last 60 seconds."""
    live = live_trips(spark, sf_dir)
    return L.trips_per_minute(live, adapter.newest_arrival(spark, sf_dir))


_REC_COLS = "event_id, emitted_at, pu_location_id, do_location_id, total_amount, trip_distance"


@query("recent_trips", duck_live() + f"select {_REC_COLS} from sample")
def recent_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest 200 live trips."""
    return sample(spark, sf_dir).select(*_REC_COLS.split(", "))


@query(
    "live_trips_table",
    duck_live()
    + """select event_id, strftime(emitted_at, '%H:%M:%S') as time_text,
  coalesce(nullif(zp.zone_name, ''), 'Unknown Zone ' || cast(s.pu_location_id as varchar)) as pickup_name,
  coalesce(nullif(zd.zone_name, ''), 'Unknown Zone ' || cast(s.do_location_id as varchar)) as dropoff_name,
  printf('%.1f mi', """
    + D.r("s.trip_distance", 1)
    + ") as miles_text, "
    + D.r2("s.total_amount")
    + """ as fare, cast(null as double) as model_tip
from (select * from sample order by emitted_at desc, event_id desc limit 20) s
left join zones zp on zp.location_id = s.pu_location_id
left join zones zd on zd.location_id = s.do_location_id""",
)
def live_trips_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W5 + P13: newest 20 trips with display text."""
    return L.live_table(sample(spark, sf_dir), adapter.zones(spark, sf_dir))


@query(
    "kpi_row",
    duck_live(
        (
            "hot",
            "select pu_location_id as hottest_zone_id from sample group by 1 order by count(*) desc, 1 limit 1",
        )
    )
    + f"""select cast(count(*) as bigint) as n, {D.r6('avg(total_amount)')} as avg_fare,
  {D.r6('avg(trip_distance)')} as avg_miles, (select hottest_zone_id from hot) as hottest_zone_id,
  max(emitted_at) as latest_emitted_at,
  (select coalesce(nullif(z.zone_name, ''), 'Zone ' || cast(h.hottest_zone_id as varchar))
     from hot h left join zones z on z.location_id = h.hottest_zone_id) as hottest_zone
from sample""",
)
def kpi_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A11 + A16: KPI row over the live sample."""
    k = L.kpi_row(sample(spark, sf_dir), adapter.zones(spark, sf_dir))
    return k.select("n", r6("avg_fare").alias("avg_fare"), r6("avg_miles").alias("avg_miles"),
                    "hottest_zone_id", "latest_emitted_at", "hottest_zone")


def _stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.station_popularity(sample(spark, sf_dir), adapter.zones(spark, sf_dir))


@query("station_popularity", duck_live() + "select * from stations")
def station_popularity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J4 + A13: all zones with pickup/dropoff counts of the live sample."""
    return _stations(spark, sf_dir)


@query(
    "popular_stations",
    duck_live(("top", "select * from stations order by total_trips desc, location_id limit 12"))
    + "select *, "
    + D.r6("12.0 + cast(total_trips as double) / (select greatest(max(total_trips), 1) from top) * 20.0")
    + " as marker_size from top",
)
def popular_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W7 + P14: 12 busiest stations with marker size."""
    p = L.popular_stations(_stations(spark, sf_dir))
    return p.withColumn("marker_size", r6("marker_size"))


_HOVER = "'<br>Pickup: ' || cast(pickup_trips as varchar) || '<br>Dropoff: ' || cast(dropoff_trips as varchar)"


@query(
    "station_hover",
    duck_live(("top", "select * from stations order by total_trips desc, location_id limit 12"))
    + f"select location_id, false as popular, zone_name || {_HOVER} as hover_text from stations union all"
    f" select location_id, true, zone_name || '<br>Total: ' || cast(total_trips as varchar) || {_HOVER} from top",
)
def station_hover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hover text of all stations and of the popular ones."""
    stations = _stations(spark, sf_dir)
    every = L.station_hover(stations).select("location_id", F.lit(False).alias("popular"), "hover_text")
    top = L.station_hover(L.popular_stations(stations), with_total=True)
    return every.unionByName(top.select("location_id", F.lit(True).alias("popular"), "hover_text"))


@query(
    "active_zones",
    duck_live()
    + """select cast(count(*) filter (where pickup_trips > 0) as bigint) as active_pickup_zones,
  cast(count(*) filter (where dropoff_trips > 0) as bigint) as active_dropoff_zones,
  (select zone_name from stations order by total_trips desc, location_id limit 1) as top_station
from stations""",
)
def active_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Active zone counts and the most active station."""
    return L.active_zones(_stations(spark, sf_dir))


@query(
    "trip_features",
    W()
    + """select event_id, cast(pu_location_id as double) as pu_location_id, cast(hour(pickup_datetime) as int) as hour,
  cast(isodow(pickup_datetime) - 1 as int) as day_of_week, cast(isodow(pickup_datetime) - 1 >= 5 as int) as is_weekend,
  trip_distance as avg_trip_distance, """
    + D.r6("dur")
    + " as avg_duration_min, "
    + D.r6("coalesce(least(greatest(case when dur/60.0 <> 0 then trip_distance/(dur/60.0) end, 1.0), 80.0), 15.0)")
    + """ as avg_speed_mph, 1 as trip_count
from (select *, coalesce(least(greatest((epoch_us(dropoff_datetime) - epoch_us(pickup_datetime))/60000000.0, 1.0), 180.0), 10.0) as dur
      from trips)""",
)
def trip_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3: per-trip model features with fallbacks (all trips)."""
    f = L.trip_features(adapter.trips(spark, sf_dir))
    return f.withColumn("avg_duration_min", r6("avg_duration_min")).withColumn(
        "avg_speed_mph", r6("avg_speed_mph")
    )
