"""K4: trip record -> JSON event payload."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def event_struct(emitted_at: Column | None = None) -> Column:
    """Typed event fields (ints as ints, amounts as doubles, times as text)."""
    zero = F.lit(0)
    return F.struct(
        F.col("pickup_datetime").cast("string").alias("pickup_datetime"),
        F.col("dropoff_datetime").cast("string").alias("dropoff_datetime"),
        F.coalesce(F.col("passenger_count").cast("int"), zero).alias("passenger_count"),
        F.coalesce(F.col("trip_distance").cast("double"), F.lit(0.0)).alias("trip_distance"),
        F.coalesce(F.col("pu_location_id").cast("int"), zero).alias("pu_location_id"),
        F.coalesce(F.col("do_location_id").cast("int"), zero).alias("do_location_id"),
        F.coalesce(F.col("total_amount").cast("double"), F.lit(0.0)).alias("total_amount"),
        (emitted_at if emitted_at is not None else F.col("emitted_at")).cast("string").alias("emitted_at"),
    )


def to_event_json(df: DataFrame, keep: list[str] | None = None, emitted_at: Column | None = None) -> DataFrame:
    """Rows with text times -> ``value`` JSON string (one flat object per row)."""
    return df.select(*(keep or []), F.to_json(event_struct(emitted_at)).alias("value"))

