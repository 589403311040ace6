"""Distributed algorithms against brute force: global row number, grid nearest zone, model."""

import os
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from zonecast.operators.geo import nearest_zone
from zonecast.operators.select import global_row_number, label_split, split_sizes


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 6), st.integers(0, 30)), min_size=1, max_size=60, unique=True))
def test_global_row_number_equals_single_sort(spark, rows):
    df = spark.createDataFrame(rows, "g int, z int")
    got = {(r.g, r.z): r.rn for r in global_row_number(df, "g", ["z"]).collect()}
    ref = {(r.g, r.z): r.rn for r in df.withColumn("rn", F.row_number().over(Window.orderBy("g", "z"))).collect()}
    assert got == ref


def test_split_sizes_rule(spark):
    def rule(n):
        t = int(n * 0.8)
        v = min(max(5000, int(t * 0.1)), max(1, t // 3))
        return t, v

    for n in [10, 14, 100, 7833, 57667, 10_000_000]:
        r = spark.range(1).select(*[c.alias(k) for k, c in split_sizes(F.lit(n)).items()]).first()
        t, v = rule(n)
        assert (r.train, r.val, r.core) == (t, v, t - v)


def test_label_split_counts(spark):
    df = spark.range(1, 101).withColumnRenamed("id", "rn")
    parts = {r.part: r["count"] for r in label_split(df).groupBy("part").count().collect()}
    assert parts == {"core": 54, "val": 26, "test": 20}


def _great_circle(a, b, c, d):
    import math

    a, b, c, d = map(math.radians, (a, b, c, d))
    h = math.sin((c - a) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((d - b) / 2) ** 2
    return 2 * math.asin(math.sqrt(h))


def test_nearest_zone_equals_brute_force(spark, monkeypatch):
    """Any leaf size, coordinates across the antimeridian, ties and missing coordinates."""
    from zonecast.operators import zoneindex

    rnd = random.Random(7)
    places = [(i, 40.5 + rnd.random() * 0.5, -74.3 + rnd.random() * 0.8) for i in range(1, 60)]
    places += [(101, 10.0, -179.9), (102, 10.0, 179.5), (201, 0.0, 1.0), (202, 0.0, -1.0), (203, None, 3.0)]
    zones = spark.createDataFrame([(i, f"Z{i}", a, b) for i, a, b in places], "location_id int, zone_name string, latitude double, longitude double")
    points = [(i, round(40.0 + rnd.random() * 1.5, 3), round(-75.0 + rnd.random() * 2.0, 3)) for i in range(200)]
    points += [(900, 10.0, 179.95), (901, 0.0, 0.0), (902, None, 1.0), (903, 10.0, 10.0), (904, 40.7001, -74.0004)]
    pts = spark.createDataFrame(points, "id int, lat double, lon double")
    metrics = {"euclid": lambda p, z: (p[0] - z[1]) ** 2 + (p[1] - z[2]) ** 2, "haversine": lambda p, z: _great_circle(p[0], p[1], z[1], z[2])}
    for size in (16, 1):
        monkeypatch.setattr(zoneindex, "LEAF", size)
        monkeypatch.setattr(zoneindex, "LEVELS", 31 if size > 1 else 20)
        for metric, dist in metrics.items():
            got = {r.id: r.z for r in nearest_zone(pts, zones, "lat", "lon", "z", metric).collect()}
            for i, a, b in points:
                if a is None:
                    assert got[i] is None
                    continue
                p = (round(a, 3), round(b, 3))
                want = min((round(dist(p, z), 12), z[0]) for z in places if z[1] is not None)
                assert got[i] == want[1], (metric, i)
    assert {r.id: r.z for r in nearest_zone(pts, zones, "lat", "lon", "z", "haversine").collect()}[900] == 101
    assert nearest_zone(pts, zones.limit(0), "lat", "lon", "z").filter("z is not null").count() == 0


def test_zone_limit_is_loud(spark, monkeypatch):
    import pytest

    from zonecast.operators import zoneindex

    monkeypatch.setattr(zoneindex, "MAX_ZONES", 2)
    zones = spark.createDataFrame([(i, 1.0, float(i)) for i in range(3)], "location_id int, latitude double, longitude double")
    with pytest.raises(Exception, match="more than 2 zones"):
        zoneindex.ZoneIndex(zones)


def test_repeated_zone_ids_keep_the_last_name(spark):
    from zonecast.operators.dims import add_zone_labels

    zones = spark.createDataFrame([(1, "old"), (2, "b"), (1, "new"), (3, "")], "location_id int, zone_name string").coalesce(1)
    rows = spark.createDataFrame([(1, 2), (3, 1), (None, 9)], "a int, b int")
    got = {(r.x, r.y) for r in add_zone_labels(rows, zones, {"a": "x", "b": "y"}, prefix="Zone ").collect()}
    assert got == {("new", "b"), ("Zone 3", "new"), (None, "Zone 9")}


def test_staged_model_beats_baseline_and_reloads(spark, tmp_dir):
    from zonecast.ml.model import load_model, mae_mape_frame, save_model, train_staged

    rnd = random.Random(3)
    rows = []
    for rn in range(1, 1201):
        zone, hour = rnd.randint(1, 6), rnd.randint(0, 23)
        dist = rnd.uniform(0.5, 10)
        tip = 0.3 * dist + (1.0 if hour >= 18 else 0.0) + 0.1 * zone
        rows.append((rn, zone, hour, hour % 7, int(hour % 7 >= 5), dist, dist * 3, 20.0, 1, tip))
    df = spark.createDataFrame(
        rows,
        "rn long, pu_location_id int, hour int, day_of_week int, is_weekend int, avg_trip_distance double,"
        " avg_duration_min double, avg_speed_mph double, trip_count int, avg_tip_amount double",
    )
    core, val, test = df.filter("rn <= 800"), df.filter("rn > 800 and rn <= 1000"), df.filter("rn > 1000")
    model, history = train_staged(core, val, rows_per_batch=400, init_trees=15, trees_per_batch=8)
    assert len(history) == 2 and 1 <= len(model.stages) <= 2
    scored = model.predict(test, "p")
    mae = mae_mape_frame(scored, "avg_tip_amount", "p").first().mae
    base_mean = core.agg(F.avg("avg_tip_amount")).first()[0]
    base = mae_mape_frame(test.withColumn("p", F.lit(base_mean)), "avg_tip_amount", "p").first().mae
    assert mae < base
    path = os.path.join(tmp_dir, "model")
    save_model(spark, model, path)
    again = load_model(spark, path).predict(test, "p")
    a = sorted((r.rn, r.p) for r in scored.select("rn", "p").collect())
    b = sorted((r.rn, r.p) for r in again.select("rn", "p").collect())
    assert a == b


def test_scoring_cycle_skips_without_model_or_aggregates(spark, tmp_dir):
    from zonecast.ml.cycle import score_latest
    from zonecast.ml.model import StagedModel, save_model, train_staged
    from zonecast.operators.aggregate import sliding_traffic_agg
    from zonecast.plans.traffic import clean_stream_trips
    from zonecast.sinks.tables import upsert_latest
    from tests.conftest import SF_SMALL

    agg_path, model_path = os.path.join(tmp_dir, "agg"), os.path.join(tmp_dir, "model")
    assert score_latest(spark, agg_path, model_path).count() == 0  # nothing yet
    upsert_latest(spark, sliding_traffic_agg(clean_stream_trips(spark, SF_SMALL)), 0, agg_path)
    assert score_latest(spark, agg_path, model_path).count() == 0  # no model yet
    rows = [(i, 1 + i % 5, i % 24, i % 7, int(i % 7 >= 5), 2.0, 10.0, 12.0, 3, 0.5 + (i % 5) * 0.1) for i in range(1, 101)]
    df = spark.createDataFrame(
        rows,
        "rn long, pu_location_id int, hour int, day_of_week int, is_weekend int, avg_trip_distance double,"
        " avg_duration_min double, avg_speed_mph double, trip_count int, avg_tip_amount double",
    )
    model, _ = train_staged(df.filter("rn <= 80"), df.filter("rn > 80"), 100, 5, 3)
    save_model(spark, model, model_path)
    out = score_latest(spark, agg_path, model_path, F.lit("2024-01-01 12:00:00").cast("timestamp"))
    zones = spark.read.parquet(agg_path).select("pu_location_id").distinct().count()
    assert out.count() == zones
    assert out.filter("predicted_tip_low > predicted_tip_high or predicted_tip_low < 0").count() == 0


def test_size_guards_raise():
    import pytest

    from zonecast.ml.model import NotEnoughData, check_sizes

    check_sizes({"train": 10, "test": 5, "core": 10, "val": 5})
    for short in ({"train": 9}, {"test": 4}, {"core": 0}, {"val": 4}):
        with pytest.raises(NotEnoughData, match=next(iter(short))):
            check_sizes({"train": 10, "test": 5, "core": 10, "val": 5} | short)


def test_metrics_document_rounds_and_keeps_the_first_best_batch():
    from zonecast.ml.model import metrics_document

    names = [f"{n}_{m}" for n in ("baseline", "train", "val", "test") for m in ("mae", "mape")]
    doc = metrics_document(
        {n: 1.23456 for n in names} | {"training_rows": 8, "testing_rows": 2, "test_period_start": "2024-01-05"},
        [{"batch": 1, "val_mae": 0.5, "val_mape": 3.14159}, {"batch": 2, "val_mae": 0.5, "val_mape": 3.0}], 250_000, 120, 40, "now",
    )
    assert doc["baseline"] == {"mae": 1.2346, "mape": 1.23} and doc["improvement_mae"] == 0.0
    run = doc["model"]["continued_training"]
    assert run["selected_best_batch"] == 1 and run["history"][0] == {"batch": 1, "val_mae": 0.5, "val_mape": 3.14}


def test_missing_feature_column_scores_as_zero(spark):
    from zonecast.ml.model import ensure_features

    df = spark.createDataFrame([(1, 3)], "pu_location_id int, hour int")
    out = ensure_features(df).first()
    assert out.trip_count == 0.0 and out.avg_speed_mph == 0.0 and out.pu_location_id == 1
