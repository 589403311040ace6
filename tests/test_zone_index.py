"""The nearest-zone index against all zones, its work per point, its plan, and its use on a stream."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from zonecast.operators.geo import nearest_zone
from zonecast.operators.zoneindex import LEAF, ZoneIndex, build

ZONES = "location_id int, latitude double, longitude double"


def plain_distances(lat, lon, zlat, zlon, metric):
    if metric == "euclid":
        d = (zlat - lat) * (zlat - lat) + (zlon - lon) * (zlon - lon)
    else:
        p, q = np.radians(lat), np.radians(zlat)
        a = np.sin((q - p) / 2) ** 2 + np.cos(p) * np.cos(q) * np.sin((np.radians(zlon) - np.radians(lon)) / 2) ** 2
        d = 2 * np.arcsin(np.sqrt(a))
    return np.rint(d * 1e12) / 1e12


def check(spark, zones, points, metric):
    """Every point's zone against all zones; a zone as near as the nearest but for the last digits of a cosine passes too."""
    ids, zlat, zlon = (np.asarray(x) for x in zip(*zones))
    index = spark.createDataFrame(zones, ZONES)
    pts = spark.createDataFrame([(n, float(a), float(b)) for n, (a, b) in enumerate(points)], "n int, lat double, lon double")
    got = {r.n: r.z for r in nearest_zone(pts, index, "lat", "lon", "z", metric).collect()}
    place = dict(zip(ids.tolist(), range(len(ids))))
    other = 0
    for n, (a, b) in enumerate(points):
        d = plain_distances(round(a, 3), round(b, 3), zlat, zlon, metric)
        want = ids[np.lexsort((ids, d))[0]]
        if got[n] != want:
            other += 1
            assert abs(d[place[got[n]]] - d.min()) <= 2e-12 * max(1.0, d.min()), (metric, a, b, got[n], want)
    assert other <= len(points) // 100


@pytest.fixture(scope="module")
def many():
    rng = np.random.default_rng(5)
    n = 100_000
    lat = np.r_[rng.normal(40.7, 0.2, n // 2), np.degrees(np.arcsin(rng.uniform(-1, 1, n // 2 - 6))), 90.0, -90.0, 89.99, 0.0, 0.0, 10.0]
    lon = np.r_[rng.normal(-74.0, 0.2, n // 2), rng.uniform(-180, 180, n // 2 - 6), 0.0, 50.0, 123.0, 179.999, -179.999, -180.0]
    zones = list(zip(range(1, n + 1), np.clip(lat, -90, 90).tolist(), lon.tolist()))
    points = [(float(a), float(b)) for a, b in zip(rng.normal(40.7, 0.3, 150), rng.normal(-74, 0.3, 150))]
    points += [(float(a), float(b)) for a, b in zip(rng.uniform(-90, 90, 150), rng.uniform(-180, 180, 150))]
    points += [(90, 0), (90, 77), (-90, 3), (89.999, -170), (-89.995, 100), (0, 180), (0, -180), (0, 179.9995), (10, 180), (10, -179.998)]
    points += [(-40.7, 106.0), (-40.695, 105.99)]  # opposite to the dense half
    return zones, points


@pytest.mark.parametrize("metric", ["euclid", "haversine"])
def test_hundred_thousand_zones(spark, many, metric):
    check(spark, *many, metric)


def test_beyond_the_usual_ranges(spark):
    rng = np.random.default_rng(6)
    zones = [(i, float(a), float(b)) for i, (a, b) in enumerate(zip(rng.uniform(40, 41, 50), rng.uniform(-75, -73, 50)), 1)]
    zones += [(60, 10.0, -179.9), (61, 10.0, 179.9), (62, 80.0, 0.0), (63, 80.0, 180.0)]
    odd = [(95, 0), (100, 170), (-95, 10), (270, 5), (400.5, -74), (40.5, 286.0), (40.5, -434.0), (10, 540.2), (10, -539.9), (0, 721)]
    check(spark, zones, odd, "haversine")
    check(spark, zones, odd + [(3e6, 5e6), (-2e6, 1.0), (1048575.9, 0), (-1048576, 2.5)], "euclid")


def test_ties_take_the_lowest_id(spark):
    zones = [(9, 0.0, 1.0), (4, 0.0, -1.0), (7, 1.0, 0.0), (5, -1.0, 0.0), (2, 50.0, 50.0), (3, 50.0, 50.0), (1, 50.0, 50.002)]
    zones += [(100 + i, 20 + float(np.cos(i)), 20 + float(np.sin(i))) for i in range(40)]  # a circle
    check(spark, zones, [(0, 0), (50, 50), (50, 50.001), (20, 20), (0.5, 0.5)], "euclid")
    index = spark.createDataFrame(zones, ZONES)
    pts = spark.createDataFrame([(0, 0.0, 0.0), (1, 50.0, 50.0), (2, 50.0, 50.001), (3, None, 1.0), (4, 1.0, None)], "n int, lat double, lon double")
    for metric in ("euclid", "haversine"):
        got = {r.n: r.z for r in nearest_zone(pts, index, "lat", "lon", "z", metric).collect()}
        assert got == {0: 4, 1: 2, 2: 1 if metric == "euclid" else got[2], 3: None, 4: None}


def test_nothing_to_find(spark):
    pts = spark.createDataFrame([(0, 1.0, 2.0)], "n int, lat double, lon double")
    for zones in ([], [(1, None, 2.0), (2, 3.0, float("nan"))]):
        assert nearest_zone(pts, spark.createDataFrame(zones, ZONES), "lat", "lon", "z").first().z is None
    assert nearest_zone(pts, spark.createDataFrame([(1, None, 2.0), (8, 3.0, 4.0)], ZONES), "lat", "lon", "z").first().z == 8


@pytest.mark.parametrize("metric", ["euclid", "haversine"])
def test_work_per_point_does_not_grow_with_the_zones(metric):
    """A point meets at most ``LEAF`` candidates, with 100 zones or with 20,000."""
    rng = np.random.default_rng(7)
    for n in (100, 2_000, 20_000):
        lat, lon = rng.normal(40.7, 0.3, n), rng.normal(-74, 0.3, n)
        arrays = build(np.arange(n), lat, lon, metric)
        sizes = np.diff(arrays["first"])
        assert np.quantile(sizes, 0.99) <= 2 * LEAF and sizes.mean() < LEAF and sizes.min() >= 1 and (np.diff(arrays["starts"]) > 0).all() and arrays["starts"][0] == 0
        assert len(sizes) < 20 * n


def test_zones_on_a_line_or_a_grid():
    """Their strips of the plane never end: the index stays small, and near points still meet few zones."""
    line = build(np.arange(1000), 40 + np.arange(1000) / 1000, np.full(1000, -74.0), "euclid")
    grid = build(np.arange(900), 40 + np.arange(900) % 30 / 50, -74 + np.arange(900) // 30 / 50, "euclid")
    for arrays in (line, grid):
        assert len(arrays["starts"]) < 20_000 and np.median(np.diff(arrays["first"])) <= LEAF


def test_lookup_is_a_projection(spark):
    """No join, no exchange, no aggregate: the index is a constant of the plan."""
    zones = spark.createDataFrame([(i, 40 + i / 10, -74.0) for i in range(30)], ZONES)
    pts = spark.range(5).select(F.col("id").alias("n"), (F.col("id") + 38.0).alias("lat"), F.lit(-74.0).alias("lon"))
    plan = nearest_zone(pts, zones, "lat", "lon", "z")._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Join", "Exchange", "HashAggregate", "Python", "Generate"))


def test_stream_equals_batch(spark, tmp_dir):
    zones = spark.createDataFrame([(i, 40 + (i * 7 % 30) / 40, -74 - (i * 11 % 30) / 40) for i in range(30)], ZONES)
    pts = spark.range(400).select(
        F.col("id").alias("n"), (39.9 + F.col("id") % 37 / 40).alias("lat"), (-74.9 + F.col("id") % 41 / 40).alias("lon")
    )
    source, out, ckpt = (os.path.join(tmp_dir, x) for x in ("in", "out", "ckpt"))
    pts.repartition(4).write.parquet(source)
    stream = spark.readStream.schema(pts.schema).option("maxFilesPerTrigger", 1).parquet(source)
    q = nearest_zone(stream, zones, "lat", "lon", "z", "haversine").writeStream.format("parquet").option("checkpointLocation", ckpt)
    q.trigger(availableNow=True).start(out).awaitTermination()
    want = nearest_zone(pts, zones, "lat", "lon", "z", "haversine")
    assert sorted(spark.read.parquet(out).collect()) == sorted(want.collect())


def test_index_is_checked(spark):
    with pytest.raises(ValueError, match="unknown metric"):
        ZoneIndex(spark.createDataFrame([], ZONES), "taxi")
