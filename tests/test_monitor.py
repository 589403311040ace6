"""Demand frame and model, monthly summaries, contracts and stored-table checks."""

import os
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from zonecast.ml.demand import predict_demand, train_demand
from zonecast.operators import checks, contracts, demand, monthly
from zonecast.sources import adapter
from tests.conftest import SF_MID

START = datetime(2024, 1, 1)


def counts_of(spark, cells):
    rows = [(z, START + timedelta(minutes=10 * w), n) for (z, w), n in cells.items()]
    return spark.createDataFrame(rows, "pu_location_id int, window_start timestamp, trip_count long")


def test_demand_frame_equals_a_plain_calendar(spark):
    rng = np.random.default_rng(1)
    cells = {(int(z), int(w)): int(rng.integers(1, 9)) for z in (1, 2, 5) for w in rng.choice(300, 120, replace=False)}
    cells[(1, 0)], cells[(2, 299)] = 4, 7
    cells[(9, 150)] = 3  # a zone with one window
    got = {(r.pu_location_id, int((r.window_start - START).total_seconds() // 600)): r for r in demand.demand_frame(counts_of(spark, cells)).collect()}
    assert len(got) == 4 * 300
    for (z, w), r in got.items():
        assert r.trip_count == cells.get((z, w), 0)
        for k in demand.LAGS:
            assert r[f"lag_{k}"] == (cells.get((z, w - k), 0) if w >= k else None)
        assert r.label == (cells.get((z, w + 1), 0) if w < 299 else None)
        assert r.split == ("future" if w == 299 else "train" if w + 1 < 240 else "test" if w >= 240 else "gap")


def test_no_label_crosses_the_split(spark):
    cells = {(1, w): w + 1 for w in range(100)}
    rows = demand.demand_frame(counts_of(spark, cells), horizon=5).collect()
    border = START + timedelta(minutes=10 * 80)
    assert all(r.window_start + timedelta(minutes=50) < border for r in rows if r.split == "train")
    assert all(r.window_start >= border for r in rows if r.split == "test")
    assert sum(r.split == "gap" for r in rows) == 5 and sum(r.split == "future" for r in rows) == 5
    assert demand.demand_frame(counts_of(spark, {}).filter("false")).count() == 0


def test_planted_signal_beats_last_value(spark):
    """Demand swings with the hour and the zone, and jumps between neighbouring windows: the last value is a bad forecast."""
    cells = {}
    for z in (1, 2, 3):
        for w in range(144 * 6):
            hour = w // 6 % 24
            n = 3 * z + (12 if hour in (7, 8, 17, 18) else 2) + (6 if w % 2 else 0)
            cells[(z, w)] = n
    frame = demand.demand_frame(counts_of(spark, cells)).cache()
    model = train_demand(frame, trees=30)
    scored = predict_demand(model, frame.filter("split = 'test'"))
    mae = {r.model: r.mae for r in demand.demand_errors(scored, last="trip_count", model="demand_pred").collect()}
    assert mae["model"] < 0.5 * mae["last"] and mae["last"] > 5
    assert scored.count() == frame.filter("split = 'test'").count()


def test_summaries_merge_to_the_whole(spark, tmp_dir):
    trips = adapter.training_trips(spark, SF_MID).withColumn("pickup_datetime", F.col("pickup_datetime") + F.make_ym_interval(F.lit(0), (F.col("event_id") % 3).cast("int")))
    path = os.path.join(tmp_dir, "m")
    for load in (0, 1, 2, 0):  # the first load is delivered again
        monthly.store_part(monthly.summarize(trips.filter(F.col("event_id") % 7 % 3 == load)), path, f"l{load}")
    merged, whole = monthly.merge_summaries(monthly.read_parts(spark, path)), monthly.summarize(trips)
    plain = lambda df: sorted(tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in df.drop(*(f"{m}_sketch" for m in monthly.BINS)).collect())
    columns = merged.columns
    assert plain(merged) == plain(whole.select(columns)) and merged.count() == 3
    months = [r.month for r in merged.select("month").collect()]
    assert monthly.read_parts(spark, path, months[:1]).select("month").distinct().count() == 1
    # sketched quantiles: the rank of each lies within the stated error
    values = {}
    for r in trips.select(F.date_format("pickup_datetime", "yyyy-MM").alias("month"), *monthly.BINS).collect():
        for m in monthly.BINS:
            values.setdefault((r.month, m), []).append(r[m])
    for q in monthly.quantiles(merged).collect():
        x = np.sort(np.asarray(values[q.month, q.measure]))
        low, high = np.searchsorted(x, q.value, "left") / len(x), np.searchsorted(x, q.value, "right") / len(x)
        assert low - monthly.RANK_ERROR <= q.p <= high + monthly.RANK_ERROR


def test_histogram_edges(spark):
    lo, hi, n = monthly.BINS["total_amount"]
    rows = [(datetime(2024, 1, 5), x, None) for x in (-1.0, lo, hi - 1e-9, hi, 1e9, None)] + [(None, 5.0, 1.0)]
    df = spark.createDataFrame(rows, "pickup_datetime timestamp, total_amount double, trip_distance double")
    got = {r.bin: r.trips for r in monthly.histograms(monthly.summarize(df)).collect() if r.measure == "total_amount"}
    assert got == {0: 1, 1: 1, n: 1, n + 1: 2}
    assert monthly.summarize(df.filter("false")).count() == 0


def test_busiest_zones_under_skew(spark):
    """One zone holds nearly all trips; ties go to the lower id."""
    t = datetime(2024, 3, 1)
    df = spark.range(20_000).select(F.lit(t).alias("pickup_datetime"), F.when(F.col("id") % 10 > 0, 7).otherwise(F.col("id") / 10 % 40).cast("int").alias("pu_location_id"))
    got = monthly.busiest(monthly.zone_counts(df)).collect()
    assert [r.rank for r in sorted(got, key=lambda r: r.rank)] == list(range(1, 16))
    order = [r.zone for r in sorted(got, key=lambda r: r.rank)]
    assert order == [7, *[z for z in range(40) if z != 7][:14]]


EVENT = "event_id long, pickup_datetime timestamp, dropoff_datetime timestamp, passenger_count int, trip_distance double, pu_location_id int, do_location_id int, total_amount double, emitted_at timestamp"


def test_contract_reasons_and_counts(spark):
    t, late = datetime(2024, 1, 1, 10), datetime(2024, 1, 3)
    rows = [
        (1, t, t + timedelta(minutes=9), 1, 2.0, 3, 4, 9.0, t + timedelta(minutes=1)),
        (2, t, t - timedelta(minutes=1), 1, -2.0, 3, 4, 9.0, t),
        (3, None, t, None, None, 0, None, -1.0, None),
        (4, t, late, -1, float("nan"), 3, 4, 0.0, t - timedelta(seconds=1)),
        (5, t, t + timedelta(days=1), 0, 0.0, 3, 4, 0.0, t),
    ]
    df = spark.createDataFrame(rows, EVENT)
    contract = contracts.Contract()
    marked = {r.event_id: r.failed_rules for r in contract.marked(df).collect()}
    assert marked[1] == marked[5] == [] and marked[2] == ["dropoff before pickup", "distance negative"]
    assert marked[3] == ["pickup time missing", "arrival time missing", "distance missing", "amount negative", "passengers missing", "pickup zone invalid", "dropoff zone invalid"]
    assert marked[4] == ["longer than a day", "arrival before pickup", "passengers negative"]
    counts = {r.rule: (r.rows, r.failed) for r in contract.counts(df).collect()}
    assert counts["any rule"] == (5, 3) and counts["distance negative"] == (5, 1) and counts["amount missing"] == (5, 0)
    assert contracts.good(contract.marked(df)).columns == df.columns
    assert {r.rule: r.failed for r in contract.counts(df.filter("false")).collect()}["any rule"] == 0
    with pytest.raises(ValueError, match="one name"):
        contracts.Contract((contracts.Rule("a", "true"), contracts.Rule("a", "false")))


def test_contract_on_a_stream(spark, tmp_dir):
    """Batches end up in two tables, with their counts; a stream started again adds nothing."""
    t = datetime(2024, 1, 1, 10)
    df = spark.createDataFrame([(i, t, t + timedelta(minutes=9), 1, float(i % 4 - 1), 3, 4, 9.0, t) for i in range(40)], EVENT)
    source, kept, aside, ckpt = (os.path.join(tmp_dir, n) for n in ("in", "good", "bad", "ckpt"))
    df.repartition(3).write.parquet(source)
    run = lambda: contracts.run_contract_stream(spark.readStream.schema(EVENT).option("maxFilesPerTrigger", 1).parquet(source), contracts.Contract(), kept, aside, ckpt)
    seen = run()
    assert sum(x["rows"] for x in seen.values()) == 40 and sum(x["failed"] for x in seen.values()) == 10 and len(seen) == 3
    assert spark.read.parquet(kept).count() == 30 and {r.event_id % 4 for r in spark.read.parquet(aside).collect()} == {0}
    assert run() == {} and spark.read.parquet(kept).count() == 30


def test_checks_read_no_data_column(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    df = spark.range(100).select("id", (F.timestamp_seconds(1704067200 + F.col("id") * 3600)).alias("window_end"), F.lit("x" * 50).alias("pad"))
    df.withColumn("service_date", F.to_date("window_end")).write.partitionBy("service_date").parquet(path)
    as_of = F.lit("2024-01-05 03:30:00").cast("timestamp")
    plan = lambda d: d._jdf.queryExecution().toString()
    for frame in (checks.stored_rows(spark, path), checks.newest_partition(spark, path, "service_date")):
        assert "ReadSchema: struct<>" in plan(frame)
    fresh = checks.freshness(spark, path, "service_date", "window_end", as_of, 60)
    assert "ReadSchema: struct<window_end:timestamp>" in plan(fresh) and "PartitionFilters: [isnotnull(service_date" in plan(fresh)
    row = fresh.first()
    assert row.newest == datetime(2024, 1, 5, 3) and row.age_minutes == 30 and row.fresh
    assert not checks.freshness(spark, path, "service_date", "window_end", as_of, 20).first().fresh
    assert checks.row_count_check(spark, path, F.lit(100)).first().passed and not checks.row_count_check(spark, path, F.lit(99)).first().passed
