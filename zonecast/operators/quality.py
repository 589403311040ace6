"""Derived trip measures and quality predicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.timefn import minutes_fractional, minutes_whole_seconds, speed_mph


def derive_duration_speed(
    df: DataFrame,
    pickup: str = "pickup_ts",
    dropoff: str = "dropoff_ts",
    distance: str = "trip_distance",
    fractional: bool = False,
) -> DataFrame:
    """Add ``duration_min`` and ``speed_mph``.

    ``fractional=False`` is the stream rule (whole epoch seconds),
    ``fractional=True`` the training rule (microsecond precision).
    Zero duration gives a null speed.
    """
    dur = (minutes_fractional if fractional else minutes_whole_seconds)(pickup, dropoff)
    out = df.withColumn("duration_min", dur).withColumn(
        "speed_mph", speed_mph(distance, "duration_min")
    )
    return evaluate_once(out)


def evaluate_once(df: DataFrame) -> DataFrame:
    """Pass the rows through a one-element ``inline`` (a Generate node).

    The quality rules test duration and speed in several conjuncts; pushed
    below a plain projection, each conjunct would re-derive them (and whatever
    produced the timestamps), which multiplies per-row work and can grow the
    generated code past the JIT's method-size limit.  Filters cannot be pushed
    below a generator, so every column here is computed once per row.  Columns
    not selected before this point are already pruned from the scan.
    """
    return df.select(F.inline(F.array(F.struct(*[F.col(c) for c in df.columns]))))


def _between_strict(c: str, lo: float, hi: float) -> Column:
    # the upper bound also rejects NaN, which Spark orders above every number
    return (F.col(c) > F.lit(lo)) & (F.col(c) < F.lit(hi))


def raw_quality(pickup: str = "pickup_ts", dropoff: str = "dropoff_ts", training: bool = False) -> Column:
    """The part of F1 (and F2) that needs no derived measure: times present, distance and
    zone in range, for training also amount and tip.  It sits below the derivation,
    next to the scan."""
    rule = (
        F.col(pickup).isNotNull() & F.col(dropoff).isNotNull()
        & _between_strict("trip_distance", S.MIN_DISTANCE_MI, S.MAX_DISTANCE_MI)
        & (F.col("pu_location_id") > 0)
    )
    if training:
        rule = (
            rule & _between_strict("total_amount", S.MIN_AMOUNT, S.MAX_AMOUNT)
            & (F.col("tip_amount") >= F.lit(S.MIN_TIP)) & (F.col("tip_amount") < F.lit(S.MAX_TIP))
        )
    return rule


def measured_quality() -> Column:
    """The part of F1 on duration and speed."""
    return _between_strict("duration_min", S.MIN_DURATION_MIN, S.MAX_DURATION_MIN) & _between_strict(
        "speed_mph", S.MIN_SPEED_MPH, S.MAX_SPEED_MPH
    )


def clean_stream(df: DataFrame, pickup: str = "pickup_ts", dropoff: str = "dropoff_ts") -> DataFrame:
    """the passing rows with ``duration_min`` (whole seconds) and ``speed_mph``.
    Null and NaN never pass."""
    raw = df.filter(raw_quality(pickup, dropoff))
    return derive_duration_speed(raw, pickup, dropoff).filter(measured_quality())


def clean_training(
    df: DataFrame, pickup: str = "pickup_ts", dropoff: str = "dropoff_ts"
) -> DataFrame:
    """F2 = F1 with fractional durations + 0 < amount < 500, 0 <= tip < 100."""
    raw = df.filter(raw_quality(pickup, dropoff, training=True))
    return derive_duration_speed(raw, pickup, dropoff, fractional=True).filter(measured_quality())


def in_box(lat: str = "pickup_latitude", lon: str = "pickup_longitude") -> Column:
    """inclusive city bounding box."""
    return F.col(lat).between(S.BOX_LAT[0], S.BOX_LAT[1]) & F.col(lon).between(
        S.BOX_LON[0], S.BOX_LON[1]
    )


def bbox_filter(df: DataFrame, lat: str = "pickup_latitude", lon: str = "pickup_longitude") -> DataFrame:
    return df.filter(F.coalesce(in_box(lat, lon), F.lit(False)))


def is_anomaly(speed: str = "speed_mph") -> Column:
    """implausibly slow or fast trip."""
    return (F.col(speed) < F.lit(S.ANOMALY_SLOW_MPH)) | (F.col(speed) > F.lit(S.ANOMALY_FAST_MPH))
