"""Dedup, latest-per-key, top-n and positional splits.

Latest/first-per-key number the rows of a key and keep number 1.  Spark turns
that filter into a group limit before the shuffle, so each task sends at most
one row per key, and a key holding a third of all rows is not gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from .. import schema as S


def latest_per_key(
    df: DataFrame, keys: list[str], order: list[str | Column], latest: bool = True
) -> DataFrame:
    """One row per key: the row with the greatest (or least) ``order`` tuple (null is least)."""
    columns = [F.col(o) if isinstance(o, str) else o for o in order]
    ordering = [c.desc_nulls_last() if latest else c.asc_nulls_first() for c in columns]
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*ordering))
    return df.withColumn("__place", place).filter(F.col("__place") == 1).drop("__place")


def dedup_first(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """Keep the first row per key in ``order`` (e.g. ingest sequence)."""
    return latest_per_key(df, keys, order, latest=False)


def dedup_last(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """Keep the last row per key in ``order``."""
    return latest_per_key(df, keys, order, latest=True)


def top_n(df: DataFrame, n: int, order: list[Column]) -> DataFrame:
    """newest/largest n rows (TakeOrderedAndProject: per-partition
    top-n, then a merge of n x partitions rows)."""
    return df.orderBy(*order).limit(n)


def global_row_number(
    df: DataFrame, group: str, within: list[str], out: str = "rn"
) -> DataFrame:
    """1-based position in the total order (group, *within) without a
    single-partition sort of the data.

    Rows are counted per ``group`` value (e.g. window_start: bounded by the
    calendar, not by data volume); a running sum over that small table gives
    each group's offset; a row's position is offset + its rank inside the
    group (groups are small: one row per zone).
    """
    counts = df.groupBy(group).agg(F.count(F.lit(1)).alias("__n"))
    offsets = counts.select(
        group,
        (
            F.sum("__n").over(Window.orderBy(group).rowsBetween(Window.unboundedPreceding, 0))
            - F.col("__n")
        ).alias("__off"),
    )
    local = F.row_number().over(Window.partitionBy(group).orderBy(*within))
    # offsets: one row per group value (calendar-bounded); the adaptive planner
    # broadcasts it when its measured bytes are small
    return (
        df.withColumn("__local", local)
        .join(offsets, group, "inner")
        .withColumn(out, F.col("__off") + F.col("__local"))
        .drop("__off", "__local")
    )


def split_sizes(n: Column) -> dict[str, Column]:
    """Row counts of the temporal split given total rows ``n`` (Column):
    train t = floor(0.8 n); validation v = min(max(5000, floor(0.1 t)), max(1, t div 3))."""
    t = F.floor(n * F.lit(S.TRAIN_FRACTION)).cast("long")
    v = F.least(
        F.greatest(F.lit(S.VALIDATION_MIN_ROWS).cast("long"), F.floor(t * F.lit(S.VALIDATION_FRACTION)).cast("long")),
        F.greatest(F.lit(1).cast("long"), F.floor(t / F.lit(3)).cast("long")),
    )
    return {"train": t, "val": v, "core": t - v}


def label_split(df: DataFrame, rn: str = "rn", n: Column | None = None) -> DataFrame:
    """Add ``split`` (train/test) and ``part`` (core/val/test) from positions."""
    total = n if n is not None else df.select(F.count(F.lit(1))).scalar()
    sizes = split_sizes(total)
    out = df.withColumn("__t", sizes["train"]).withColumn("__core", sizes["core"])
    return out.select(
        "*",
        F.when(F.col(rn) <= F.col("__t"), "train").otherwise("test").alias("split"),
        F.when(F.col(rn) <= F.col("__core"), "core")
        .when(F.col(rn) <= F.col("__t"), "val")
        .otherwise("test")
        .alias("part"),
    ).drop("__t", "__core")


def batch_index(rn: str | Column, rows_per_batch: int) -> Column:
    """Chronological batch number floor((rn - 1) / N)."""
    position = F.col(rn) if isinstance(rn, str) else rn
    return F.floor((position - 1) / F.lit(rows_per_batch)).cast("long")
