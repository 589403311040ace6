"""Raw event feed into the rolling live-trip table (T4 + K2)."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..sinks.tables import append_batch, prune_expired, run_id_of
from ..sources.events import decode_events, live_rows


def live_plan(raw: DataFrame) -> DataFrame:
    """Payload stream -> live-table rows (malformed payloads kept as null rows)."""
    return live_rows(decode_events(raw))


def wall_clock(_batch_df: DataFrame) -> datetime:
    """The present moment (UTC)."""
    return datetime.now(timezone.utc)


def replay_clock(strays: float = 0.01) -> Callable[[DataFrame], datetime | None]:
    """A clock for replays of old feeds: the newest arrival of a batch, stray ones left out.

    The share ``strays`` of a batch's rows, and one row at least, may carry a time
    ahead of the feed without moving the clock; it never passes the wall clock, and a
    batch with too few rows to tell moves nothing (None).
    """

    def now(batch_df: DataFrame) -> datetime | None:
        us = F.unix_micros("emitted_at")
        n = batch_df.agg(F.count(us)).first()[0]
        ahead = max(1, int(strays * n))
        if n <= ahead:
            return None
        newest = batch_df.agg(F.percentile_approx(us, 1 - (ahead + 0.5) / n)).first()[0]
        return min(datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(microseconds=newest), wall_clock(batch_df))

    return now


def run_live_stream(
    spark: SparkSession,
    raw: DataFrame,
    target_path: str,
    checkpoint: str,
    trigger: dict | None = None,
    await_termination: bool = True,
    retention_minutes: int | None = S.LIVE_RETENTION_MIN,
    clock: Callable[[DataFrame], datetime | None] = wall_clock,
):
    """Append each micro-batch to the live table, then drop what retention has passed.

    Rows lie under their emit hour, the checkpoint's id and the batch number,
    so a batch replayed after a failure replaces its own rows: exactly once per
    batch, where the row-by-row consumer was at-least-once.  ``clock`` gives the
    present for retention: the wall clock, against which a row of the future deletes
    nothing and stays; pass ``replay_clock()`` to prune an old feed as the live job
    would have, or ``retention_minutes=None`` to keep everything.
    """
    rows = live_plan(raw)
    run: dict[str, str] = {}

    def sink(batch_df: DataFrame, batch_id: int) -> None:
        if "id" not in run:
            run["id"] = run_id_of(spark, checkpoint)
        batch_df.persist()  # read twice: for the clock and for the write
        try:
            now = clock(batch_df) if retention_minutes is not None else None
            fresh = batch_df
            if now is not None:  # what the next step would expire is not written
                oldest = now - timedelta(minutes=retention_minutes)
                fresh = batch_df.filter(F.col("emitted_at").isNull() | (F.col("emitted_at") >= F.lit(oldest)))
            append_batch(fresh, batch_id, target_path, run["id"])
        finally:
            batch_df.unpersist()
        if now is not None:
            prune_expired(spark, target_path, now, retention_minutes)

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
