"""Scoring plans: latest aggregate per zone, surge, baseline zone predictions,
stored snapshot and its read-side views (W2, W3, J5, A8, A9, A12, A15, M7-M10,
K3, P12, W6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.numeric import round6 as r6
from ..operators import scoring as SC
from ..operators.aggregate import baseline_table as baseline_op
from ..operators.aggregate import global_mean, sliding_traffic_agg
from ..operators.dims import add_zone_labels
from ..session import materialize, scratch_path
from ..sinks.tables import read_snapshot, write_snapshot
from ..sources import adapter
from . import duck as D
from .registry import query
from .traffic import STREAM_CTES, clean_stream_trips, duck_traffic_body
from .training import TRAIN_CTES, positioned

# ---------------------------------------------------------------------------
# Spark side
# ---------------------------------------------------------------------------


def traffic_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored aggregate table (unrounded A1 output), materialised once: the
    scorer reads it for the newest window and for the latest row per zone."""
    return materialize(sliding_traffic_agg(clean_stream_trips(spark, sf_dir)))


def latest_per_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per zone, stored: the scorer reads it for its rows and for the median."""
    return materialize(SC.latest_agg_per_zone(traffic_raw(spark, sf_dir)))


def as_of(spark: SparkSession, sf_dir: str):
    """Newest arrival time over all trips (scalar subquery)."""
    return adapter.newest_arrival(spark, sf_dir)


def baseline_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M7-M10 with the baseline scorer: tip = train mean by (zone, hour of the
    latest window), global train mean when the pair is unseen."""
    latest = latest_per_zone(spark, sf_dir)
    train = positioned(spark, sf_dir).filter(F.col("split") == "train")
    base = baseline_op(train)
    gmean = global_mean(train)
    scored = latest.withColumn("hour", F.hour("window_start")).join(
        base, ["pu_location_id", "hour"], "left"
    )
    tip = F.coalesce(F.col("baseline_pred"), gmean)
    return SC.zone_predictions(scored.drop("hour"), tip, as_of(spark, sf_dir))


def stored_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3: write the snapshot (overwrite) to the shared scratch area and read it back."""
    path = scratch_path(spark, "predictions")
    write_snapshot(SC.prediction_defaults(baseline_predictions(spark, sf_dir)), path)
    return read_snapshot(spark, path)


def _round_pred(df: DataFrame) -> DataFrame:
    return df.select(
        *[r6(c).alias(c) if c in ("avg_speed_mph", "avg_trip_distance") else F.col(c) for c in S.PREDICTION_COLUMNS]
    )


# ---------------------------------------------------------------------------
# DuckDB side
# ---------------------------------------------------------------------------

DUCK_LATEST = """
select window_start, window_end, pu_location_id, trip_count, avg_speed_mph, avg_duration_min,
       avg_trip_distance, avg_total_amount, anomaly_count from (
  select t.*, row_number() over (partition by pu_location_id order by window_end desc, window_start desc) as rn
  from traffic_raw t
  where window_end >= (select max(window_end) from traffic_raw) - interval 48 hour)
where rn = 1
"""
DUCK_SURGE = f"""
select l.*, case when m.med > 0 then {D.r2('least(greatest(l.trip_count / m.med, 1.0), 3.0)')} else 1.0 end
       as surge_multiplier
from latest l, (select quantile_cont(trip_count, 0.5) as med from latest) m
"""
DUCK_PRED = f"""
select s.pu_location_id, s.window_start, s.window_end, s.trip_count, s.avg_speed_mph, s.avg_trip_distance,
  {D.r2(D.r('greatest(coalesce(s.avg_total_amount, 0.0), 0.0)', 9))} as predicted_avg_fare,
  {D.r2('greatest(' + D.r('coalesce(b.baseline_pred, g.gmean)', 9) + ', 0.0) * 0.9')} as predicted_tip_low,
  {D.r2('greatest(' + D.r('coalesce(b.baseline_pred, g.gmean)', 9) + ', 0.0) * 1.1')} as predicted_tip_high,
  s.surge_multiplier,
  s.window_end as prediction_for_window_start,
  s.window_end + interval 10 minute as prediction_for_window_end,
  (select max(emitted_at) from trips) as prediction_generated_at
from surged s
left join (select pu_location_id, hour, avg(avg_tip_amount) as baseline_pred from pos
           where split = 'train' group by all) b
  on b.pu_location_id = s.pu_location_id and b.hour = hour(s.window_start),
  (select avg(avg_tip_amount) as gmean from pos where split = 'train') g
"""


def duck_scoring(*extra: tuple[str, str]) -> str:
    return adapter.duck_with(
        *STREAM_CTES,
        ("traffic_raw", duck_traffic_body(False)),
        *TRAIN_CTES,
        ("latest", DUCK_LATEST),
        ("surged", DUCK_SURGE),
        ("pred", DUCK_PRED),
        *extra,
        base=("zones", "trips", "training_trips"),
    )


_PRED_OUT = "select " + ", ".join(
    D.r6(c) + f" as {c}" if c in ("avg_speed_mph", "avg_trip_distance") else c for c in S.PREDICTION_COLUMNS
) + " from pred"

# ---------------------------------------------------------------------------
# registered queries
# ---------------------------------------------------------------------------


@query(
    "latest_agg_per_zone",
    duck_scoring()
    + "select window_start, window_end, pu_location_id, trip_count, "
    + ", ".join(f"{D.r6(c)} as {c}" for c in ["avg_speed_mph", "avg_duration_min", "avg_trip_distance", "avg_total_amount"])
    + ", anomaly_count from latest",
)
def latest_agg_per_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W2 + J5 + A8: newest aggregate per zone within 48 h of the newest window."""
    l = latest_per_zone(spark, sf_dir)
    return l.select(
        "window_start", "window_end", "pu_location_id", "trip_count",
        *[r6(c).alias(c) for c in ["avg_speed_mph", "avg_duration_min", "avg_trip_distance", "avg_total_amount"]],
        "anomaly_count",
    )


@query("surge", duck_scoring() + "select pu_location_id, trip_count, surge_multiplier from surged")
def surge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A9 + M9: surge multiplier per zone against the median zone trip count."""
    return SC.with_surge(latest_per_zone(spark, sf_dir)).select("pu_location_id", "trip_count", "surge_multiplier")


@query("predict_zones_baseline", duck_scoring() + _PRED_OUT, headline=True)
def predict_zones_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Next-window tip band, fare and surge per zone (baseline scorer)."""
    return _round_pred(baseline_predictions(spark, sf_dir))


@query("predictions_snapshot", duck_scoring() + _PRED_OUT)
def predictions_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3: predictions written as a replaced snapshot and read back."""
    return _round_pred(stored_predictions(spark, sf_dir))


DUCK_LATEST_PRED = f"""
select pu_location_id, trip_count, avg_speed_mph, avg_trip_distance, predicted_avg_fare as predicted_fare,
       predicted_tip_low, predicted_tip_high, surge_multiplier as surge,
       {D.r2('(predicted_tip_low + predicted_tip_high) / 2')} as predicted_tip
from (select *, row_number() over (partition by pu_location_id order by prediction_generated_at desc) as rn from pred)
where rn = 1
"""


@query(
    "latest_predictions",
    duck_scoring(("lp", DUCK_LATEST_PRED))
    + "select pu_location_id, trip_count, "
    + D.r6("avg_speed_mph")
    + " as avg_speed_mph, "
    + D.r6("avg_trip_distance")
    + " as avg_trip_distance, predicted_fare, predicted_tip_low, predicted_tip_high, surge, predicted_tip from lp",
)
def latest_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W3 + P12: newest stored prediction per zone, display names, midpoint tip."""
    lp = SC.latest_predictions(stored_predictions(spark, sf_dir))
    return lp.withColumn("avg_speed_mph", r6("avg_speed_mph")).withColumn(
        "avg_trip_distance", r6("avg_trip_distance")
    )


@query(
    "prediction_summary",
    duck_scoring()
    + """select cast(count(*) as bigint) as zones, max(predicted_avg_fare) as max_fare,
  max(greatest(predicted_tip_low, predicted_tip_high)) as max_tip, max(surge_multiplier) as max_surge from pred""",
)
def prediction_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cycle summary over the written predictions."""
    return SC.prediction_summary(stored_predictions(spark, sf_dir))


@query(
    "max_surge",
    duck_scoring(("lp", DUCK_LATEST_PRED))
    + """select max(surge) as max_surge,
  case when max(surge) >= 2 then 'High' when max(surge) >= 1.3 then 'Moderate' else 'Normal' end as surge_level
from lp""",
)
def max_surge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Highest surge among the latest predictions, with its level label."""
    lp = SC.latest_predictions(stored_predictions(spark, sf_dir))
    m = lp.agg(F.max("surge").alias("max_surge"))
    return m.select("max_surge", SC.surge_label(F.col("max_surge")).alias("surge_level"))


@query(
    "top_zones",
    duck_scoring(("lp", DUCK_LATEST_PRED))
    + """select cast(row_number() over (order by predicted_fare desc, pu_location_id) as int) as rank, pu_location_id,
  coalesce(nullif(z.zone_name, ''), 'Zone ' || cast(pu_location_id as varchar)) as zone_name,
  predicted_fare, predicted_tip, surge, printf('%.0f mph', round_even(coalesce(avg_speed_mph, 0), 0)) as speed_text,
  cast(trip_count as varchar) || case when trip_count <> 1 then ' trips' else ' trip' end as trips_text,
  case when surge >= 2 then 'red' when surge >= 1.3 then 'yellow' else 'green' end as surge_badge,
  printf('%.1fx', surge) as surge_text
from lp left join zones z on z.location_id = lp.pu_location_id
order by predicted_fare desc, pu_location_id limit 6""",
)
def top_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top 6 zones by predicted fare (ties: lowest zone id), rank and surge badge."""
    from pyspark.sql import Window

    lp = SC.latest_predictions(stored_predictions(spark, sf_dir))
    top = lp.orderBy(F.col("predicted_fare").desc(), F.col("pu_location_id")).limit(S.TOP_ZONES)
    top = add_zone_labels(top, adapter.zones(spark, sf_dir), {"pu_location_id": "zone_name"}, prefix="Zone ")
    # ``rank`` is computed over the <= 6 rows that survive the limit.
    w = Window.orderBy(F.col("predicted_fare").desc(), F.col("pu_location_id"))
    return top.select(
        F.row_number().over(w).alias("rank"),
        "pu_location_id",
        "zone_name",
        "predicted_fare",
        "predicted_tip",
        "surge",
        F.format_string("%.0f mph", F.rint(F.coalesce("avg_speed_mph", F.lit(0.0)))).alias("speed_text"),
        F.concat(F.col("trip_count").cast("string"), F.when(F.col("trip_count") != 1, " trips").otherwise(" trip")).alias("trips_text"),
        SC.surge_badge(F.col("surge")).alias("surge_badge"),
        F.format_string("%.1fx", F.col("surge")).alias("surge_text"),
    )


@query(
    "predictions_defaults",
    duck_scoring()
    + f"""select pu_location_id, case when pu_location_id % 3 = 0 then 0 else trip_count end as trip_count,
  case when pu_location_id % 2 = 0 then 0.0 else {D.r6('avg_speed_mph')} end as avg_speed_mph,
  case when pu_location_id % 5 = 0 then 1.0 else surge_multiplier end as surge_multiplier from pred""",
)
def predictions_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3: predictions with missing values, as stored."""
    zone = F.col("pu_location_id")
    pred = baseline_predictions(spark, sf_dir)
    holes = {"trip_count": 3, "avg_speed_mph": 2, "surge_multiplier": 5}
    pred = pred.select(*(F.when(zone % holes[c] != 0, F.col(c)).alias(c) if c in holes else F.col(c) for c in pred.columns))
    path = scratch_path(spark, "predictions")
    write_snapshot(SC.prediction_defaults(pred), path)
    return read_snapshot(spark, path).select("pu_location_id", "trip_count", r6("avg_speed_mph").alias("avg_speed_mph"), "surge_multiplier")


@query(
    "fare_fallback",
    duck_scoring() + f"select pu_location_id, {D.r2('5 * ' + D.r('2.0 + pu_location_id / 7.0', 9))} as predicted_avg_fare from latest",
)
def fare_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M8: without amounts in the aggregates the fare is five times the tip estimate."""
    latest = latest_per_zone(spark, sf_dir).drop("avg_total_amount")
    tip = F.lit(2.0) + F.col("pu_location_id") / F.lit(7.0)
    return SC.zone_predictions(latest, tip, as_of(spark, sf_dir)).select("pu_location_id", "predicted_avg_fare")
