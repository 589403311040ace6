"""Incremental scoring cycles against the full cycle, batch by batch."""

import datetime as dt
import os

from pyspark.sql import functions as F

from zonecast.ml import cycle as C
from zonecast.operators.scoring import latest_agg_per_zone
from zonecast.sinks.changes import pending_changes, read_changes, upsert_announced

AGG = (
    "window_start timestamp, window_end timestamp, pu_location_id int, trip_count long, avg_speed_mph double, "
    "avg_duration_min double, avg_trip_distance double, avg_total_amount double, anomaly_count long, service_date date"
)


def now():
    return F.lit("2024-02-01 00:00:00").cast("timestamp")


def rows(*items):
    """(zone, hours after the start, trips)."""
    out = []
    for zone, hours, trips in items:
        start = dt.datetime(2024, 1, 1) + dt.timedelta(hours=hours)
        out.append((start, start + dt.timedelta(minutes=10), zone, trips, 10.0 + zone, 5.0, 1.0 + trips, 3.0 * trips, 0, start.date()))
    return out


class Counted:
    """A scorer that notes how many rows it was given."""

    def __init__(self, version, slope):
        self.version, self.slope, self.given = version, slope, []

    def predict(self, latest):
        self.given.append(latest.count())
        return latest.withColumn("tip_pred", F.col("trip_count") * self.slope + F.col("pu_location_id"))


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def full(spark, table, scorer):
    scored = C._published(Counted("x", scorer.slope).predict(latest_agg_per_zone(spark.read.parquet(table))), now())
    return got(scored)


def test_equals_the_full_cycle_after_every_batch(spark, tmp_dir):
    table, feed, state = (os.path.join(tmp_dir, n) for n in ("table", "feed", "state"))
    one, two = Counted("v1", 0.5), Counted("v2", 0.25)
    assert got(C.score_changes(spark, table, feed, state, one, now())) == []
    steps = [  # run, batch, rows, scorer, zones to score
        ("a", 0, rows((1, 0, 4), (2, 0, 6), (3, 0, 8)), one, 3),
        ("a", 1, rows((2, 1, 9), (2, 0, 7)), one, 1),           # a new window of one zone
        ("a", 2, rows((2, 0, 70), (3, 0, 80)), one, 1),         # an old window of zone 2: nothing to score
        ("a", 2, rows((2, 0, 70), (3, 0, 80)), one, 0),         # delivered again: seen
        ("a", 3, rows((1, 40, 2), (1, 47, 3)), one, 1),         # an update of another date
        ("a", 4, rows((3, 49, 5)), one, 1),                     # zone 2 leaves the 48 hours
        ("b /=", 0, rows((3, 49, 6), (4, 48, 1)), one, 2),      # a new checkpoint replaces the same key
        ("b /=", 1, rows((2, 48, 2)), two, 4),                  # a new model scores every zone
        ("b /=", 2, [], two, 0),
    ]
    for run, n, batch, scorer, scored in steps:
        upsert_announced(spark, spark.createDataFrame(batch, AGG), n, table, feed, run_id=run)
        before = len(scorer.given)
        out = got(C.score_changes(spark, table, feed, state, scorer, now()))
        assert out == full(spark, table, scorer), (run, n)
        assert sum(scorer.given[before:]) == scored, (run, n)
    # several batches between two cycles, and a cycle without a batch
    for n in (3, 4, 5):
        upsert_announced(spark, spark.createDataFrame(rows((n, 50, n), (1, 50 + n, n)), AGG), n, table, feed, run_id="b /=")
    assert got(C.score_changes(spark, table, feed, state, two, now())) == full(spark, table, two)
    before = len(two.given)
    assert got(C.score_changes(spark, table, feed, state, two, now())) == full(spark, table, two)
    assert len(two.given) == before


def test_reads_only_touched_partitions(spark, tmp_dir):
    table, feed = os.path.join(tmp_dir, "table"), os.path.join(tmp_dir, "feed")
    upsert_announced(spark, spark.createDataFrame(rows(*((z, 24 * d, 1) for z in (1, 2) for d in range(10))), AGG), 0, table, feed, run_id="a")
    upsert_announced(spark, spark.createDataFrame(rows((1, 24 * 9, 5)), AGG), 1, table, feed, run_id="a")
    changes = pending_changes(spark, feed, {"a": 0})
    keys = C.touched_keys(spark, changes, None)
    assert read_changes(spark, changes).count() == 1
    found = C.touched_rows(spark, table, keys)
    assert [(r.pu_location_id, r.trip_count) for r in found.collect()] == [(1, 5)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "service_date" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_an_interrupted_cycle_is_run_again(spark, tmp_dir):
    """The state and the position in the feed are published together."""
    table, feed, state = (os.path.join(tmp_dir, n) for n in ("table", "feed", "state"))
    upsert_announced(spark, spark.createDataFrame(rows((1, 0, 4), (2, 0, 6)), AGG), 0, table, feed)

    class Broken(Counted):
        def predict(self, latest):
            raise RuntimeError("lost")

    for _ in range(2):
        try:
            C.score_changes(spark, table, feed, state, Broken("v1", 0.5), now())
        except RuntimeError:
            pass
    assert len(pending_changes(spark, feed, {})) == 1
    one = Counted("v1", 0.5)
    assert got(C.score_changes(spark, table, feed, state, one, now())) == full(spark, table, one)
    assert pending_changes(spark, feed, {}) == []
