"""Row normalisation for raw trip records of differing schemas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.numeric import nan_to_null, parse_zone_id, to_double
from ..functions.timefn import add_days
from .geo import nearest_zones


def _present(df: DataFrame, name: str) -> Column:
    """The column, with NaN as missing (so that it cannot hide a later alias)."""
    c = F.col(name)
    return nan_to_null(c) if dict(df.dtypes)[name] in ("float", "double") else c


def coalesce_alias(df: DataFrame, names: list[str], cast: str | None = None, by_schema: bool = False) -> Column:
    """First non-null among the aliases present in ``df`` (in list order).

    ``by_schema``: the first alias that ``df`` has, for all its rows.
    """
    present = [_present(df, c) for c in names if c in df.columns][: 1 if by_schema else None]
    out = F.coalesce(*present) if present else F.lit(None)
    return out.cast(cast) if cast else out


def canonical(df: DataFrame, keep: list[str] | None = None, by_schema: bool = False) -> DataFrame:
    """Resolve every alias list to one canonical column (absent -> null).

    Row by row for the event producer; ``by_schema`` for the trainer, which picks
    one column per file and drops rows where that one is null.
    """
    pick = lambda names, cast=None: coalesce_alias(df, names, cast, by_schema)
    cols = [
        pick(S.PICKUP_ALIASES, "timestamp").alias("pickup_datetime"),
        pick(S.DROPOFF_ALIASES, "timestamp").alias("dropoff_datetime"),
        to_double(pick(S.PASSENGER_ALIASES)).alias("passenger_count"),
        to_double(pick(S.DISTANCE_ALIASES)).alias("trip_distance"),
        pick(S.PU_LOCATION_ALIASES).alias("pu_location_raw"),
        pick(S.DO_LOCATION_ALIASES).alias("do_location_raw"),
        to_double(pick(S.PICKUP_LAT_ALIASES)).alias("pickup_latitude"),
        to_double(pick(S.PICKUP_LON_ALIASES)).alias("pickup_longitude"),
        to_double(pick(S.DROPOFF_LAT_ALIASES)).alias("dropoff_latitude"),
        to_double(pick(S.DROPOFF_LON_ALIASES)).alias("dropoff_longitude"),
        to_double(pick(S.AMOUNT_ALIASES)).alias("total_amount"),
        to_double(pick(S.TIP_ALIASES)).alias("tip_amount"),
    ]
    return df.select(*(keep or []), *cols)


def producer_time_text(c: Column) -> Column:
    """Text of a timestamp as the event producer writes it on the first replay
    cycle: seconds, plus a 6-digit fraction only when it is non-zero."""
    whole = F.unix_micros(c) % 1_000_000 == 0
    return F.when(whole, F.date_format(c, S.TS_TEXT_FORMAT)).otherwise(
        F.date_format(c, S.TS_TEXT_FORMAT + ".SSSSSS")
    )


def normalize_events(df: DataFrame, zones: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """T5: raw rows of any family -> producer record.

    zone id (P2) -> else nearest zone of lat/lon (J1, Euclidean) -> else 161;
    defaults passengers 1, distance 1.0, amount 10.0 (P3); rows lacking pickup
    or dropoff text are dropped (F5).
    """
    keep = keep or []
    c = canonical(df, keep)
    c = c.withColumn("pu_id", parse_zone_id("pu_location_raw")).withColumn(
        "do_id", parse_zone_id("do_location_raw")
    )
    c = nearest_zones(
        c,
        zones,
        [("pickup_latitude", "pickup_longitude", "pu_snap"), ("dropoff_latitude", "dropoff_longitude", "do_snap")],
        "euclid",
        unless={"pu_snap": F.col("pu_id").isNotNull(), "do_snap": F.col("do_id").isNotNull()},
    )
    pick = F.col("pickup_datetime")
    drop = F.col("dropoff_datetime")
    out = c.select(
        *keep,
        F.coalesce(producer_time_text(pick), F.lit("")).alias("pickup_datetime"),
        F.coalesce(producer_time_text(drop), F.lit("")).alias("dropoff_datetime"),
        F.coalesce(F.col("passenger_count"), F.lit(float(S.DEFAULT_PASSENGERS)))
        .cast("int")
        .alias("passenger_count"),
        F.coalesce(F.col("trip_distance"), F.lit(S.DEFAULT_DISTANCE)).alias("trip_distance"),
        F.coalesce("pu_id", "pu_snap", F.lit(S.DEFAULT_ZONE)).cast("int").alias("pu_location_id"),
        F.coalesce("do_id", "do_snap", F.lit(S.DEFAULT_ZONE)).cast("int").alias("do_location_id"),
        F.coalesce(F.col("total_amount"), F.lit(S.DEFAULT_AMOUNT)).alias("total_amount"),
    )
    return required_fields(out)


def required_fields(df: DataFrame) -> DataFrame:
    """pickup/dropoff text and both zone ids present and non-empty."""
    ok = F.lit(True)
    for c in ["pickup_datetime", "dropoff_datetime"]:
        ok = ok & F.col(c).isNotNull() & (F.col(c) != "")
    for c in ["pu_location_id", "do_location_id"]:
        ok = ok & F.col(c).isNotNull()
    return df.filter(ok)


def shift_time(
    df: DataFrame, cycle: int | Column, cols=("pickup_datetime", "dropoff_datetime")
) -> DataFrame:
    """Advance times by cycle x 31 days and format them to whole seconds."""
    days = (cycle if isinstance(cycle, Column) else F.lit(cycle)) * S.SHIFT_DAYS_PER_CYCLE
    out = df
    for c in cols:
        out = out.withColumn(c, F.date_format(add_days(F.col(c), days), S.TS_TEXT_FORMAT))
    return out


def stamp_arrival(df: DataFrame, clock: Column | None = None, col: str = "emitted_at") -> DataFrame:
    """P5: arrival time in UTC, whole seconds, as text.  ``clock`` is injectable."""
    ts = clock if clock is not None else F.current_timestamp()
    return df.withColumn(col, F.date_format(F.date_trunc("second", ts), S.TS_TEXT_FORMAT))
