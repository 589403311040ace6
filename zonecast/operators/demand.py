"""Demand frame (D5): a gap-free zone x window calendar with lagged counts and the count to come.

Everything a row needs from other windows of its zone is sent to it: each stored count
travels to its own window, ahead by every lag, and back by the horizon; calendar rows
travel to themselves.  One aggregation by (zone, window) brings them together, so all
lags and the label cost one shuffle, pre-aggregated, with no window over a zone's history.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW_MINUTES = 10
#: windows back: the last two, and the same time a day ago
LAGS = (1, 2, 144)
ZONE, WINDOW = "pu_location_id", "window_start"


def _windows(n: int | Column) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), (n if isinstance(n, Column) else F.lit(n)) * WINDOW_MINUTES)


def window_counts(trips: DataFrame, time_col: str = "pickup_ts") -> DataFrame:
    """(zone, window_start, trip_count) of the windows that have trips."""
    w = F.window(time_col, f"{WINDOW_MINUTES} minutes")
    return trips.groupBy(w.start.alias(WINDOW), ZONE).agg(F.count("*").alias("trip_count")).select(ZONE, WINDOW, "trip_count")


def calendar(counts: DataFrame) -> DataFrame:
    """Every zone that has a count x every window from the first to the last one."""
    first = counts.select(F.min(WINDOW)).scalar()
    last = counts.select(F.max(WINDOW)).scalar()
    return counts.select(ZONE).distinct().select(ZONE, F.explode(F.sequence(first, last, _windows(1))).alias(WINDOW))


def demand_frame(counts: DataFrame, lags: tuple[int, ...] = LAGS, horizon: int = 1, share: float = 0.8) -> DataFrame:
    """zone, window_start, trip_count, lag_<k>, label, hour_of_day, day_of_week, split for each calendar cell.

    A window without trips counts 0; a lag from before the calendar and a label from
    beyond it are null.  ``split``: the first ``share`` of the windows train, the others
    test; a row whose label lies across the border is ``gap``, one without a label ``future``.
    """
    first = counts.select(F.min(WINDOW)).scalar()
    last = counts.select(F.max(WINDOW)).scalar()
    shifts = {"trip_count": 0, **{f"lag_{k}": k for k in lags}, "label": -horizon}
    sent = counts.select(
        ZONE, "trip_count",
        F.explode(F.array(*(F.struct(F.lit(name).alias("kind"), (F.col(WINDOW) + _windows(n)).alias(WINDOW)) for name, n in shifts.items()))).alias("to"),
    ).select(ZONE, F.col(f"to.{WINDOW}").alias(WINDOW), F.col("to.kind").alias("kind"), "trip_count")
    cells = calendar(counts).select(ZONE, WINDOW, F.lit("cell").alias("kind"), F.lit(0).cast("long").alias("trip_count"))
    of = lambda name: F.max(F.when(F.col("kind") == name, F.col("trip_count"))).alias(name)
    met = cells.unionByName(sent).groupBy(ZONE, WINDOW).agg(F.max(F.col("kind") == "cell").alias("__cell"), *(of(name) for name in shifts))
    known = lambda name, n: F.when((F.col(WINDOW) - _windows(n)).between(first, last), F.coalesce(name, F.lit(0))).alias(name)
    total = F.floor((F.unix_seconds(last) - F.unix_seconds(first)) / (60 * WINDOW_MINUTES)) + 1
    border = first + _windows(F.floor(total * share).cast("int"))
    target = F.col(WINDOW) + _windows(horizon)
    split = (
        F.when(target > last, "future").when(target < border, "train").when(F.col(WINDOW) >= border, "test").otherwise("gap")
    )
    return met.filter("__cell").select(
        ZONE, WINDOW, *(known(name, n) for name, n in shifts.items()), F.hour(WINDOW).alias("hour_of_day"),
        F.weekday(WINDOW).alias("day_of_week"), split.alias("split"),
    )


def demand_features(lags: tuple[int, ...] = LAGS) -> list[str]:
    return [ZONE, "hour_of_day", "day_of_week", "trip_count", *(f"lag_{k}" for k in lags)]


def demand_errors(frame: DataFrame, **predictions: str | Column) -> DataFrame:
    """model, rows, mae over the test rows, for each named prediction (a column)."""
    test = frame.filter("split = 'test'")
    pairs = F.array(*(
        F.struct(F.lit(name).alias("model"), (F.col(p) if isinstance(p, str) else p).cast("double").alias("p")) for name, p in predictions.items()
    ))
    scored = test.select("label", F.explode(pairs).alias("x")).select("label", "x.model", "x.p")
    return scored.groupBy("model").agg(F.count("*").alias("rows"), F.avg(F.abs(F.col("label") - F.col("p"))).alias("mae"))


def zone_hour_mean(frame: DataFrame) -> DataFrame:
    """zone, hour_of_day, mean_demand over the training rows' labels (by the hour the label falls into)."""
    target = F.hour(F.col(WINDOW) + _windows(1))
    return frame.filter("split = 'train'").groupBy(ZONE, target.alias("target_hour")).agg(F.avg("label").alias("mean_demand"))
