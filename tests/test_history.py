"""Incremental history against a full rebuild: files added, replaced, deleted, unusable, and an update that died half way."""

import os
import time

from pyspark.sql import functions as F

from zonecast import schema as S
from zonecast.operators.aggregate import tumbling_partials
from zonecast.operators.quality import clean_training
from zonecast.sinks import history
from zonecast.sources.files import list_trip_files, training_trips_from_files

ZONES = "location_id int, zone_name string, latitude double, longitude double"


def write_file(spark, path, rows, seed):
    """``rows`` trips with a zone id column, or with coordinates where ``seed`` is even."""
    i = F.col("id") + seed * 1000
    df = spark.range(rows).select(
        F.timestamp_seconds(1704067200 + i * 37).alias("pickup_datetime"), F.timestamp_seconds(1704067200 + i * 37 + 600 + i % 500).alias("dropoff_datetime"),
        (1 + i % 5).cast("double").alias("trip_distance"), (5 + i % 40).cast("double").alias("total_amount"), (i % 7).cast("double").alias("tip_amount"),
        *([(1 + i % 3).cast("int").alias("PULocationID")] if seed % 2 else
          [(40.5 + i % 5 / 10).alias("pickup_latitude"), F.lit(-74.0).alias("pickup_longitude")]),
    )
    if os.path.exists(path):
        os.unlink(path)
    df.toPandas().to_parquet(path, coerce_timestamps="us")
    time.sleep(0.02)


def rows_of(df):
    return sorted(tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in df.select(*S.AGG_KEYS, *S.PARTIAL_SUMS).collect())


def test_add_replace_and_delete(spark, tmp_dir):
    zones = spark.createDataFrame([(i, f"Z{i}", 40.5 + i / 10, -74.0) for i in range(1, 4)], ZONES)
    trips, store = os.path.join(tmp_dir, "trips"), os.path.join(tmp_dir, "store")
    os.makedirs(trips)
    at = lambda n: os.path.join(trips, f"part {n}.parquet")  # noqa: E731  a blank in the name

    def update():
        files = list_trip_files(spark, trips)
        change = history.update_history(spark, files, zones, store)
        whole = training_trips_from_files(spark, files, zones) if files else None
        want = rows_of(tumbling_partials(clean_training(whole))) if whole is not None else []
        assert rows_of(history.read_history(spark, store)) == want
        return [len(x) for x in (change.read, change.removed, change.kept)], want

    assert update() == ([0, 0, 0], [])
    for n in range(4):
        write_file(spark, at(n), 60, n)
    counts, first = update()
    assert counts == [4, 0, 0] and len(first) > 20
    assert update() == ([0, 0, 4], first)  # nothing changed: nothing is read
    write_file(spark, at(1), 35, 1)  # replaced
    write_file(spark, at(9), 20, 9)  # added
    os.unlink(at(2))  # deleted
    counts, second = update()
    assert counts == [2, 1, 2] and second != first
    spark.range(3).toPandas().to_parquet(at("unusable"))  # no trip columns
    counts, third = update()
    assert counts == [1, 0, 4] and third == second
    for n in (0, 1, 3, 9, "unusable"):
        os.unlink(at(n))
    assert update() == ([0, 5, 0], [])


def test_an_update_that_dies_changes_nothing(spark, tmp_dir, monkeypatch):
    zones = spark.createDataFrame([(1, "Z1", 40.5, -74.0)], ZONES)
    trips, store = os.path.join(tmp_dir, "trips"), os.path.join(tmp_dir, "store")
    os.makedirs(trips)
    write_file(spark, os.path.join(trips, "a.parquet"), 50, 1)
    history.update_history(spark, list_trip_files(spark, trips), zones, store)
    before = rows_of(history.read_history(spark, store))
    write_file(spark, os.path.join(trips, "a.parquet"), 80, 3)
    write_file(spark, os.path.join(trips, "b.parquet"), 30, 5)
    with monkeypatch.context() as m:
        def dies(*_):
            raise OSError("lost")

        m.setattr(history, "_write_small", dies)
        try:
            history.update_history(spark, list_trip_files(spark, trips), zones, store)
        except OSError:
            pass
    assert rows_of(history.read_history(spark, store)) == before
    change = history.update_history(spark, list_trip_files(spark, trips), zones, store)
    assert len(change.read) == 2
    whole = training_trips_from_files(spark, list_trip_files(spark, trips), zones)
    assert rows_of(history.read_history(spark, store)) == rows_of(tumbling_partials(clean_training(whole)))
