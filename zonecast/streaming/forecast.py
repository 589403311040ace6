"""Predicted against actual amounts on the live feed.

Each micro-batch is scored by the model that stands when it starts; its rows are stored
with the model's version, and the errors are kept per version and arrival hour.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.numeric import round_half_even
from ..ml.cycle import Scorer, model_scorer
from ..operators.live import trip_features
from ..sinks.tables import append_batch, path_exists, read_snapshot, run_id_of, write_snapshot
from ..sources.events import decode_events, live_rows

_SUMS = ["trips", "compared", "error_sum", "share_sum"]
_KEYS = ["model_version", "emit_hour"]
EVENT_ID = "event_id"


def trip_scorer(spark: SparkSession, model_path: str) -> Scorer:
    """The saved model over trip features, which already are its input."""
    return model_scorer(spark, model_path, features=lambda trips: trips)


def compared_trips(trips: DataFrame, scorer: Scorer) -> DataFrame:
    """Each trip with its predicted amount (five times the tip estimate, as in M8, 2 dp),
    the actual one, their difference and the model's version.  Row by row: a trip without an
    amount keeps its prediction and has no error; a trip of nulls gets the fallback features.
    """
    features = scorer.predict(trip_features(trips, keep=["emitted_at", "total_amount"]))
    tip = F.greatest(round_half_even(F.col("tip_pred"), 9), F.lit(0.0))
    predicted = round_half_even(round_half_even(tip * F.lit(S.FARE_FROM_TIP_FACTOR), 9), 2)
    return features.select(
        EVENT_ID, "emitted_at", predicted.alias("predicted_amount"), F.col("total_amount").alias("actual_amount"),
    ).select(
        "*", (F.col("actual_amount") - F.col("predicted_amount")).alias("amount_error"),
        F.lit(scorer.version).alias("model_version"),
    )


def error_sums(compared: DataFrame) -> DataFrame:
    """Mergeable sums per model version and arrival hour (null where unknown)."""
    actual, error = F.col("actual_amount"), F.abs("amount_error")
    share = error / F.when(actual == 0, F.lit(S.MAPE_ZERO_TRUTH)).otherwise(actual)
    return compared.groupBy("model_version", F.date_trunc("hour", "emitted_at").alias("emit_hour")).agg(
        F.count(F.lit(1)).alias("trips"), F.count("amount_error").alias("compared"),
        F.coalesce(F.sum(error), F.lit(0.0)).alias("error_sum"), F.coalesce(F.sum(share), F.lit(0.0)).alias("share_sum"),
    )


def add_errors(spark: SparkSession, sums: DataFrame, batch_id: int, path: str, run_id: str) -> None:
    """Add one batch's sums to the stored ones, once.

    Sums and the last batch number of every run are published by one rename, so a
    batch that is delivered again is recognised and adds nothing.  The store has one row per
    version and hour, whatever the number of trips or batches.
    """
    old = read_snapshot(spark, path) if path_exists(spark, path) else None
    mark = None if old is None else old.select("seen").first()
    seen = dict(mark.seen) if mark else {}
    if seen.get(run_id, -1) >= batch_id:
        return
    seen[run_id] = batch_id
    both = sums if old is None else sums.unionByName(old.select(*_KEYS, *_SUMS))
    merged = both.groupBy(*_KEYS).agg(*(F.sum(c).alias(c) for c in _SUMS))
    position = F.create_map(*(x for run, n in seen.items() for x in (F.lit(run), F.lit(n).cast("long"))))
    write_snapshot(merged.withColumn("seen", position), path)


def read_errors(spark: SparkSession, path: str, by: list[str] | None = None) -> DataFrame:
    """Trips, compared trips, mean absolute error and mean percentage error by ``by`` (default: version)."""
    by = by or ["model_version"]
    total = read_snapshot(spark, path).groupBy(*by).agg(*(F.sum(c).alias(c) for c in _SUMS))
    return total.select(
        *by, "trips", "compared", F.try_divide("error_sum", "compared").alias("mae"),
        (F.try_divide("share_sum", "compared") * F.lit(100.0)).alias("mape"),
    )


def run_compared_stream(
    spark: SparkSession,
    raw: DataFrame,
    current: Callable[[], Scorer],
    target_path: str,
    errors_path: str,
    checkpoint: str,
    trigger: dict | None = None,
    await_termination: bool = True,
):
    """Payloads (``value``) scored batch by batch into ``target_path`` and ``errors_path``.

    A trip is known by the feed's ``event_id``, or by its payload's 64-bit hash where the feed has none.

    ``current`` gives the standing model when a batch starts, so a new one takes over
    between two batches without a restart.  A batch delivered again replaces its own
    rows and adds no error; were the model exchanged between the two deliveries, its rows
    carry the new version while its errors stay with the old one.  Retention of the rows
    is the live table's (``prune_expired``); the errors outlive them.
    """
    if EVENT_ID not in raw.columns:
        raw = raw.withColumn(EVENT_ID, F.xxhash64("value"))
    rows = live_rows(decode_events(raw, keep=[EVENT_ID]), keep=[EVENT_ID])
    run: dict[str, str] = {}

    def sink(batch_df: DataFrame, batch_id: int) -> None:
        if "id" not in run:
            run["id"] = run_id_of(spark, checkpoint)
        scored = compared_trips(batch_df, current()).persist()  # read twice: rows and errors
        try:
            append_batch(scored, batch_id, target_path, run["id"])
            add_errors(spark, error_sums(scored), batch_id, errors_path, run["id"])
        finally:
            scored.unpersist()

    q = (
        rows.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(sink)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
    if await_termination:
        q.awaitTermination()
    return q
