"""Scoring cycles over the stored aggregate table with a saved model.

``score_latest`` returns the prediction rows for the next window of every zone,
or an empty frame (same schema) when there is no model yet or no aggregate
row; callers choose the cadence (the original polled every 30 s).

``score_changes`` gives the same rows, but scores only the zones that batches touched
since the cycle before: its state, one row per zone, holds each zone's newest aggregate,
its raw tip estimate, the scorer's version and the position in the change feed.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S
from ..operators.aggregate import latest_window_end
from ..operators.scoring import AGG_VALUE_COLUMNS, latest_agg_per_zone, zone_predictions
from ..operators.select import latest_per_key
from ..session import materialize
from ..sinks.changes import Change, advanced, pending_changes, prune_changes, read_changes
from ..sinks.tables import path_exists, read_snapshot, write_snapshot
from .model import load_model

PREDICTION_SCHEMA = T.StructType(
    [
        T.StructField("pu_location_id", T.IntegerType()),
        T.StructField("window_start", T.TimestampType()),
        T.StructField("window_end", T.TimestampType()),
        T.StructField("trip_count", T.LongType()),
        T.StructField("avg_speed_mph", T.DoubleType()),
        T.StructField("avg_trip_distance", T.DoubleType()),
        T.StructField("predicted_avg_fare", T.DoubleType()),
        T.StructField("predicted_tip_low", T.DoubleType()),
        T.StructField("predicted_tip_high", T.DoubleType()),
        T.StructField("surge_multiplier", T.DoubleType()),
        T.StructField("prediction_for_window_start", T.TimestampType()),
        T.StructField("prediction_for_window_end", T.TimestampType()),
        T.StructField("prediction_generated_at", T.TimestampType()),
    ]
)


def empty_predictions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], PREDICTION_SCHEMA)


def score_latest(
    spark: SparkSession, agg_path: str, model_path: str, generated_at: Column | None = None
) -> DataFrame:
    """Predictions for the zones of the newest stored windows, or an empty frame."""
    if not path_exists(spark, model_path) or not path_exists(spark, agg_path):
        return empty_predictions(spark)
    agg = spark.read.parquet(agg_path)
    if agg.isEmpty():
        return empty_predictions(spark)
    scored = model_scorer(spark, model_path).predict(latest_agg_per_zone(agg))
    return _published(scored, generated_at)


def _published(scored: DataFrame, generated_at: Column | None) -> DataFrame:
    gen = generated_at if generated_at is not None else F.current_timestamp()
    out = zone_predictions(scored, F.col("tip_pred"), gen)
    return out.select(*[F.col(f.name).cast(f.dataType) for f in PREDICTION_SCHEMA.fields]).select(
        *S.PREDICTION_COLUMNS
    )


def scoring_features(latest: DataFrame) -> DataFrame:
    return (
        latest.withColumn("hour", F.hour("window_start"))
        .withColumn("day_of_week", F.weekday("window_start"))
        .withColumn("is_weekend", (F.col("day_of_week") >= 5).cast("int"))
    )


# ---------------------------------------------------------------------------
# Incremental cycles
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Scorer:
    """``predict`` adds ``tip_pred`` to rows, each on its own; ``version`` names the model."""

    version: str
    predict: Callable[[DataFrame], DataFrame]


def model_scorer(spark: SparkSession, model_path: str, features: Callable[[DataFrame], DataFrame] = scoring_features) -> Scorer:
    """The saved model over aggregate rows, or over rows that ``features`` makes its input of."""
    model = load_model(spark, model_path)
    version = f"{model.trained_at}/{model.training_rows}/{len(model.stages)}"
    return Scorer(version, lambda latest: model.predict(features(latest), "tip_pred"))


_STATE = [*AGG_VALUE_COLUMNS, "tip_pred"]


def touched_keys(spark: SparkSession, changes: list[Change], state: DataFrame | None) -> DataFrame:
    """The newest announced key per zone, where the state has no newer window.

    A window that is not its zone's newest changes no prediction, so its rows are never read.
    """
    newest = latest_per_key(read_changes(spark, changes), ["pu_location_id"], ["window_end", "window_start"])
    if state is None:
        return newest
    known = state.select("pu_location_id", F.struct("window_end", "window_start").alias("__known"))
    at = F.struct("window_end", "window_start")
    return newest.join(known, "pu_location_id", "left").filter(F.col("__known").isNull() | (at >= F.col("__known"))).drop("__known")


def touched_rows(spark: SparkSession, agg_path: str, keys: DataFrame, partition: str = "service_date") -> DataFrame | None:
    """The stored rows of ``keys``, from their partitions only; None without keys.

    The keys are one per zone, so their partition values (dates) are few.
    """
    dates = [r[0] for r in keys.select(partition).distinct().toLocalIterator()]
    if not dates:
        return None
    table = spark.read.parquet(agg_path).filter(F.col(partition).isin(dates)).select(*AGG_VALUE_COLUMNS)
    return table.join(keys.select(*S.AGG_KEYS), S.AGG_KEYS, "left_semi").select(*AGG_VALUE_COLUMNS)


def score_changes(
    spark: SparkSession, agg_path: str, feed: str, state_path: str, scorer: Scorer,
    generated_at: Column | None = None, lookback_hours: int = S.LOOKBACK_HOURS, prune: bool = True,
) -> DataFrame:
    """One incremental cycle: the rows that ``score_latest`` gives for the whole table.

    Reads the batches announced since the last cycle, takes the touched zones' newest
    rows from the table, scores these (every zone when the scorer's version changed),
    and publishes the state and its position in the feed together, by one rename: a
    cycle that dies changes nothing and is simply run again.  The surge depends on
    all zones (the median), so it is computed over the state, not stored.  Seen batches
    leave the feed (``prune``; not where several readers share one).  No batch yet:
    an empty frame.  The result reads the state, which the cycle after the next replaces.
    """
    stored = read_snapshot(spark, state_path) if path_exists(spark, state_path) else None
    mark = None if stored is None else stored.select("seen", "scorer").first()
    seen, version = (dict(mark.seen), mark.scorer) if mark else ({}, None)
    changes = pending_changes(spark, feed, seen)
    if changes:
        keys = materialize(touched_keys(spark, changes, stored), "touched")
        fresh = touched_rows(spark, agg_path, keys)
    else:
        fresh = None
    if fresh is not None or (mark and version != scorer.version):
        kept = stored.select(*_STATE) if mark else None
        if fresh is not None and kept is not None:
            fresh = materialize(fresh, "fresh")
            kept = kept.join(fresh.select("pu_location_id"), "pu_location_id", "left_anti").select(*_STATE)
        if kept is not None and version != scorer.version:
            old = kept.select(*AGG_VALUE_COLUMNS)
            fresh, kept = old if fresh is None else fresh.unionByName(old), None
        state = scorer.predict(fresh).withColumn("tip_pred", F.col("tip_pred").cast("double")).select(*_STATE)
        if kept is not None:
            state = state.unionByName(kept)
        seen = advanced(seen, changes)
        position = F.create_map(*(x for run, n in seen.items() for x in (F.lit(run), F.lit(n).cast("long"))))
        write_snapshot(state.withColumn("seen", position).withColumn("scorer", F.lit(scorer.version)), state_path)
        if prune:
            prune_changes(spark, feed, seen)
    elif not mark:
        return empty_predictions(spark)
    state = read_snapshot(spark, state_path)
    horizon = latest_window_end(state) - F.make_dt_interval(F.lit(0), F.lit(lookback_hours))
    return _published(state.filter(F.col("window_end") >= horizon).select(*_STATE), generated_at)
