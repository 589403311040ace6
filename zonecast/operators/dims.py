"""Zone labels (P11): one left join per id column, whatever the dimension's size.

The dimension is first reduced to one name per id (the last one wins), so the
join never multiplies rows; the adaptive planner broadcasts it when its measured
bytes are small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S


def one_per_zone(zones: DataFrame, *columns: str) -> DataFrame:
    """``zones`` with one row per location_id: of repeated ids the last row's columns."""
    value = F.struct(*columns)
    return (
        zones.withColumn("__place", F.monotonically_increasing_id())
        .groupBy("location_id").agg(F.max(F.struct("__place", value.alias("v"))).alias("__last"))
        .select("location_id", *(F.col(f"__last.v.{c}").alias(c) for c in columns))
    )


def label(name: Column, zone_id: Column, prefix: str = S.UNKNOWN_ZONE_PREFIX) -> Column:
    """Zone name, or '<prefix><id>' when the id has no (non-empty) name."""
    return F.when(name.isNotNull() & (name != ""), name).otherwise(F.concat(F.lit(prefix), zone_id.cast("string")))


def add_zone_labels(
    df: DataFrame,
    zones: DataFrame,
    cols: dict[str, str],
    prefix: str = S.UNKNOWN_ZONE_PREFIX,
) -> DataFrame:
    """Add a label column per {id_col: label_col}."""
    names = one_per_zone(zones, "zone_name")
    out = df
    for id_col, label_col in cols.items():
        side = names.select(F.col("location_id").alias("__zid"), F.col("zone_name").alias("__name"))
        out = out.join(side, F.col(id_col) == F.col("__zid"), "left").withColumn(
            label_col, label(F.col("__name"), F.col(id_col), prefix)
        ).drop("__zid", "__name")
    return out
