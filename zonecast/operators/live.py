"""Live-view operators over the rolling trip table.

``as_of`` is always an explicit Column (scalar subquery or literal), never the
wall clock, so every view is repeatable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.numeric import clip, round_half_even
from ..functions.timefn import is_weekend, minutes_fractional, speed_mph, weekday_mon0
from .dims import add_zone_labels
from .select import top_n


def recent_window(df: DataFrame, as_of: Column, seconds: int, col: str = "emitted_at") -> DataFrame:
    """Rows that arrived within ``seconds`` before ``as_of`` (F7 / K2 retention)."""
    cutoff = as_of - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(seconds))
    return df.filter(F.col(col) >= cutoff)


def trips_per_minute(live: DataFrame, as_of: Column) -> DataFrame:
    """A10: trips that arrived in the last 60 s."""
    return recent_window(live, as_of, S.RECENT_SECONDS).agg(F.count(F.lit(1)).alias("trip_count"))


def newest(live: DataFrame, n: int = S.LIVE_SAMPLE) -> DataFrame:
    """Newest n rows by arrival (ties: higher event id first)."""
    return top_n(live, n, [F.col("emitted_at").desc(), F.col("event_id").desc()])


def kpi_row(sample: DataFrame, zones: DataFrame) -> DataFrame:
    """A11 + A16: sample size, mean fare and miles, hottest pickup zone
    (most frequent, lowest id on ties) and the newest arrival."""
    agg = sample.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("total_amount").alias("avg_fare"),
        F.avg("trip_distance").alias("avg_miles"),
        F.mode("pu_location_id", deterministic=True).alias("hottest_zone_id"),
        F.max("emitted_at").alias("latest_emitted_at"),
    )
    return add_zone_labels(agg, zones, {"hottest_zone_id": "hottest_zone"}, prefix="Zone ")


def live_table(
    sample: DataFrame, zones: DataFrame, n: int = S.LIVE_TABLE_ROWS, tips: DataFrame | None = None
) -> DataFrame:
    """W5 + P13: top rows of the sample with display text.  ``tips`` (event_id, model_tip)
    are the model's estimates; without a model the column is null."""
    top = newest(sample, n)
    if tips is None:
        top = top.withColumn("model_tip", F.lit(None).cast("double"))
    else:
        top = top.join(tips.select("event_id", "model_tip"), "event_id", "left")
    labelled = add_zone_labels(
        top, zones, {"pu_location_id": "pickup_name", "do_location_id": "dropoff_name"}
    )
    return labelled.select(
        "event_id",
        F.date_format("emitted_at", "HH:mm:ss").alias("time_text"),
        "pickup_name",
        "dropoff_name",
        F.format_string("%.1f mi", round_half_even("trip_distance", 1)).alias("miles_text"),
        round_half_even("total_amount", 2).alias("fare"),
        round_half_even("model_tip", 2).alias("model_tip"),
    )


def station_hover(stations: DataFrame, with_total: bool = False) -> DataFrame:
    """Hover text of the map markers (the popular ones also state their total)."""
    count = lambda text, c: F.concat(F.lit(f"<br>{text}: "), F.col(c).cast("string"))
    total = [count("Total", "total_trips")] if with_total else []
    text = F.concat(F.col("zone_name"), *total, count("Pickup", "pickup_trips"), count("Dropoff", "dropoff_trips"))
    return stations.withColumn("hover_text", text)


def station_popularity(sample: DataFrame, zones: DataFrame) -> DataFrame:
    """J4 + A13: every zone with pickup / dropoff counts of the sample (0 fill)."""
    pick = sample.groupBy(F.col("pu_location_id").alias("location_id")).agg(
        F.count(F.lit(1)).alias("pickup_trips")
    )
    drop = sample.groupBy(F.col("do_location_id").alias("location_id")).agg(
        F.count(F.lit(1)).alias("dropoff_trips")
    )
    base = zones.select("location_id", "zone_name", "latitude", "longitude")
    out = base.join(pick, "location_id", "left").join(drop, "location_id", "left")
    out = out.fillna(0, ["pickup_trips", "dropoff_trips"])
    return out.withColumn("total_trips", F.col("pickup_trips") + F.col("dropoff_trips"))


def popular_stations(stations: DataFrame, n: int = S.TOP_STATIONS) -> DataFrame:
    """W7 + P14: top n stations by total trips (ties: lowest id) and marker size
    12 + total / max(top total, 1) x 20."""
    top = top_n(stations, n, [F.col("total_trips").desc(), F.col("location_id")])
    top_total = top.select(F.greatest(F.max("total_trips"), F.lit(1))).scalar()
    return top.withColumn(
        "marker_size",
        F.lit(S.MARKER_BASE) + F.col("total_trips").cast("double") / top_total * F.lit(S.MARKER_SPAN),
    )


def active_zones(stations: DataFrame) -> DataFrame:
    """Active pickup / dropoff zones and the most active station."""
    top = top_n(stations, 1, [F.col("total_trips").desc(), F.col("location_id")])
    return stations.agg(
        F.count_if(F.col("pickup_trips") > 0).alias("active_pickup_zones"),
        F.count_if(F.col("dropoff_trips") > 0).alias("active_dropoff_zones"),
    ).withColumn("top_station", top.select(F.first("zone_name")).scalar())


def trip_features(trips: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """M3: per-trip model features with the live-view fallbacks; ``keep``: columns carried along."""
    pick, drop = F.col("pickup_datetime"), F.col("dropoff_datetime")
    dur = clip(minutes_fractional(pick, drop), S.MIN_DURATION_MIN, S.MAX_DURATION_MIN)
    dur = F.coalesce(dur, F.lit(S.TRIP_DURATION_DEFAULT))
    dist = F.coalesce(F.col("trip_distance").try_cast("double"), F.lit(0.0))
    spd = F.coalesce(clip(speed_mph(dist, dur), S.MIN_SPEED_MPH, S.MAX_SPEED_MPH), F.lit(S.TRIP_SPEED_DEFAULT))
    dow = F.coalesce(weekday_mon0(pick), F.lit(S.TRIP_DOW_DEFAULT))
    return trips.select(
        "event_id",
        *(keep or []),
        F.coalesce(F.col("pu_location_id").cast("double"), F.lit(0.0)).alias("pu_location_id"),
        F.coalesce(F.hour(pick), F.lit(S.TRIP_HOUR_DEFAULT)).alias("hour"),
        dow.alias("day_of_week"),
        is_weekend(dow).alias("is_weekend"),
        dist.alias("avg_trip_distance"),
        dur.alias("avg_duration_min"),
        spd.alias("avg_speed_mph"),
        F.lit(1).alias("trip_count"),
    )
