"""Change feed of an upserted table: the keys that every batch wrote.

``<feed>/run-<id>/batch-<n>`` holds the keys of one batch, written after the batch
reached the table.  A batch that is delivered again replaces its own folder; a
batch lost between table and feed is delivered again by the stream, so every
change that the table shows is announced at least once.
"""

from __future__ import annotations

from typing import NamedTuple
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from .tables import delete_path, list_folders, path_exists, upsert_latest


class Change(NamedTuple):
    run_id: str
    batch_id: int
    path: str


def record_changes(batch: DataFrame, batch_id: int, feed: str, run_id: str, columns: list[str]) -> None:
    """Announce the keys of ``batch``: one small folder, complete by its ``_SUCCESS`` mark."""
    target = f"{feed.rstrip('/')}/run-{quote(run_id, safe='')}/batch-{int(batch_id):012d}"
    batch.select(*columns).hint("rebalance", F.col(columns[0])).write.mode("overwrite").parquet(target)


def upsert_announced(
    spark: SparkSession, batch: DataFrame, batch_id: int, path: str, feed: str, run_id: str = "", partition: str = "service_date"
) -> None:
    """``upsert_latest`` by the aggregate's keys, then the batch's keys announced in ``feed``."""
    batch.persist()  # read by the upsert and by the feed
    try:
        upsert_latest(spark, batch, batch_id, path, partition=partition, run_id=run_id)
        record_changes(batch, batch_id, feed, run_id, [partition, *S.AGG_KEYS])
    finally:
        batch.unpersist()


def pending_changes(spark: SparkSession, feed: str, seen: dict[str, int]) -> list[Change]:
    """Complete batches that a reader has not seen; ``seen``: its last batch number by run.

    Only folder names are read; ``prune_changes`` bounds their number.
    """
    out = []
    for run in list_folders(spark, feed, "run-"):
        run_id = unquote(run.rsplit("/run-", 1)[1])
        for path in list_folders(spark, run, "batch-"):
            n = int(path.rsplit("/batch-", 1)[1])
            if n > seen.get(run_id, -1) and path_exists(spark, f"{path}/_SUCCESS"):
                out.append(Change(run_id, n, path))
    return out


def advanced(seen: dict[str, int], changes: list[Change]) -> dict[str, int]:
    """The cursor after ``changes``."""
    out = dict(seen)
    for c in changes:
        out[c.run_id] = max(c.batch_id, out.get(c.run_id, -1))
    return out


def read_changes(spark: SparkSession, changes: list[Change]) -> DataFrame:
    """The keys of ``changes`` (not empty); a key that several batches wrote comes several times."""
    return spark.read.parquet(*(c.path for c in changes))


def prune_changes(spark: SparkSession, feed: str, seen: dict[str, int]) -> int:
    """Delete the folders that every reader has seen (``seen``: the slowest reader's cursor); how many."""
    gone = 0
    for run in list_folders(spark, feed, "run-"):
        last = seen.get(unquote(run.rsplit("/run-", 1)[1]), -1)
        for path in list_folders(spark, run, "batch-"):
            if int(path.rsplit("/batch-", 1)[1]) <= last:
                delete_path(spark, path)
                gone += 1
    return gone
