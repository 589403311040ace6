"""Latest aggregate per zone, surge and zone predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.numeric import round_half_even
from ..functions.timefn import add_minutes
from .aggregate import latest_window_end
from .select import latest_per_key

AGG_VALUE_COLUMNS = [
    "window_start", "window_end", "pu_location_id", "trip_count", "avg_speed_mph",
    "avg_duration_min", "avg_trip_distance", "avg_total_amount", "anomaly_count",
]


def latest_agg_per_zone(agg: DataFrame, lookback_hours: int = S.LOOKBACK_HOURS) -> DataFrame:
    """W2 + J5: newest (window_end, window_start) row per zone among rows whose
    window_end lies within ``lookback_hours`` of the newest window_end.

    The newest window_end is a scalar subquery (one value, no cross join); the
    per-zone pick is a ``max_by`` aggregate (partial + final, skew-safe).
    """
    newest = latest_window_end(agg)
    horizon = newest - F.make_dt_interval(F.lit(0), F.lit(lookback_hours))
    recent = agg.select(*AGG_VALUE_COLUMNS).filter(F.col("window_end") >= horizon)
    return latest_per_key(recent, ["pu_location_id"], ["window_end", "window_start"]).select(
        *AGG_VALUE_COLUMNS
    )


def median_trip_count(latest: DataFrame) -> Column:
    """Interpolated median of trip_count over zones, as a scalar subquery."""
    return latest.select(F.median(F.col("trip_count").cast("double"))).scalar()


def surge_multiplier(trip_count: Column, median: Column) -> Column:
    """M9: trip_count / median clipped to [1, 3], 2 dp; 1.0 when median <= 0 or null."""
    ratio = trip_count.cast("double") / median
    clipped = F.least(F.greatest(ratio, F.lit(S.SURGE_MIN)), F.lit(S.SURGE_MAX))
    return F.when(median > 0, round_half_even(clipped, 2)).otherwise(F.lit(1.0))


def with_surge(latest: DataFrame) -> DataFrame:
    return latest.withColumn("surge_multiplier", surge_multiplier(F.col("trip_count"), median_trip_count(latest)))


def zone_predictions(latest: DataFrame, tip_pred: Column, generated_at: Column) -> DataFrame:
    """Prediction rows for the next window of every zone.

    ``tip_pred`` is the raw tip estimate column (any scorer); it is stabilised to
    9 dp, clipped at 0 and banded 0.9x / 1.1x at 2 dp.  The fare (a mean) is
    likewise stabilised to 9 dp before its 2-dp rounding, so exact decimal ties
    do not depend on the summation order.
    """
    tip = F.greatest(round_half_even(tip_pred, 9), F.lit(0.0))
    if "avg_total_amount" in latest.columns:
        fare = F.greatest(F.coalesce(F.col("avg_total_amount"), F.lit(0.0)), F.lit(0.0))
    else:  # M8 without amounts
        fare = tip * F.lit(S.FARE_FROM_TIP_FACTOR)
    s = with_surge(latest)
    return s.select(
        "pu_location_id",
        "window_start",
        "window_end",
        "trip_count",
        "avg_speed_mph",
        "avg_trip_distance",
        round_half_even(round_half_even(fare, 9), 2).alias("predicted_avg_fare"),
        round_half_even(tip * F.lit(S.TIP_LOW_FACTOR), 2).alias("predicted_tip_low"),
        round_half_even(tip * F.lit(S.TIP_HIGH_FACTOR), 2).alias("predicted_tip_high"),
        "surge_multiplier",
        F.col("window_end").alias("prediction_for_window_start"),
        add_minutes("window_end", S.WINDOW_MINUTES).alias("prediction_for_window_end"),
        generated_at.alias("prediction_generated_at"),
    )


def prediction_defaults(pred: DataFrame) -> DataFrame:
    """K3: what a stored prediction has in place of null: 0 for counts and measures, surge 1.0."""
    zero = {c: 0 for c in ("trip_count", "avg_speed_mph", "avg_trip_distance", "predicted_avg_fare", "predicted_tip_low", "predicted_tip_high")}
    return pred.fillna(zero | {"surge_multiplier": S.SURGE_MIN})


def latest_predictions(pred: DataFrame) -> DataFrame:
    """W3 + P12: newest prediction per zone, renamed for display, midpoint tip."""
    latest = latest_per_key(
        pred.select(
            "pu_location_id", "trip_count", "avg_speed_mph", "avg_trip_distance", "predicted_avg_fare",
            "predicted_tip_low", "predicted_tip_high", "surge_multiplier", "prediction_generated_at",
        ),
        ["pu_location_id"],
        ["prediction_generated_at"],
    )
    return latest.select(
        "pu_location_id",
        "trip_count",
        "avg_speed_mph",
        "avg_trip_distance",
        F.col("predicted_avg_fare").alias("predicted_fare"),
        "predicted_tip_low",
        "predicted_tip_high",
        F.col("surge_multiplier").alias("surge"),
        round_half_even((F.col("predicted_tip_low") + F.col("predicted_tip_high")) / 2, 2).alias("predicted_tip"),
    ).orderBy(F.col("predicted_fare").desc(), F.col("pu_location_id"))  # W12 display order


def prediction_summary(pred: DataFrame) -> DataFrame:
    """Zones scored, max fare, max tip over both bounds, max surge."""
    return pred.agg(
        F.count(F.lit(1)).alias("zones"),
        F.max("predicted_avg_fare").alias("max_fare"),
        F.max(F.greatest("predicted_tip_low", "predicted_tip_high")).alias("max_tip"),
        F.max("surge_multiplier").alias("max_surge"),
    )


def surge_label(surge: Column) -> Column:
    """A12 label: High >= 2, Moderate >= 1.3, else Normal."""
    high, moderate, normal = S.SURGE_LABELS
    return (
        F.when(surge >= S.SURGE_HIGH, high)
        .when(surge >= S.SURGE_MODERATE, moderate)
        .otherwise(normal)
    )


def surge_badge(surge: Column) -> Column:
    """W6 badge colour: red >= 2, yellow >= 1.3, else green."""
    return (
        F.when(surge >= S.SURGE_HIGH, "red")
        .when(surge >= S.SURGE_MODERATE, "yellow")
        .otherwise("green")
    )
