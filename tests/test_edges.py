"""Hand-made edge rows: bounds, NaN/null, JSON shapes, aliases, zone ids, ties, medians, empty input."""

import math

import pytest
from pyspark.sql import functions as F

from zonecast.functions.numeric import parse_zone_id, round_half_even, stable_round
from zonecast.operators.geo import nearest_zone
from zonecast.operators.normalize import canonical, coalesce_alias, normalize_events
from zonecast.operators.quality import bbox_filter, clean_stream, clean_training, derive_duration_speed
from zonecast.operators.scoring import median_trip_count, surge_multiplier, with_surge
from zonecast.operators.select import dedup_first, dedup_last, latest_per_key
from zonecast.sources.events import decode_events, parse_event_times

T0 = "2024-01-01 00:00:00"


def _trips(spark, rows):
    df = spark.createDataFrame(
        rows, "id int, p string, d string, trip_distance double, total_amount double, tip_amount double"
    )
    return derive_duration_speed(
        df.select(
            "id",
            F.try_to_timestamp("p").alias("pickup_ts"),
            F.try_to_timestamp("d").alias("dropoff_ts"),
            "trip_distance",
            "total_amount",
            "tip_amount",
            F.lit(5).alias("pu_location_id"),
        )
    )


def test_stream_bounds_are_strict(spark):
    rows = [
        (1, T0, "2024-01-01 00:01:00", 1.0, 10.0, 1.0),  # exactly 1 minute
        (2, T0, "2024-01-01 03:00:00", 10.0, 10.0, 1.0),  # exactly 180 minutes
        (3, T0, "2024-01-01 00:10:00", 0.2, 10.0, 1.0),  # exactly 0.2 mi
        (4, T0, "2024-01-01 02:00:00", 100.0, 10.0, 1.0),  # exactly 100 mi
        (5, T0, "2024-01-01 01:00:00", 1.0, 10.0, 1.0),  # exactly 1 mph
        (6, T0, "2024-01-01 01:00:00", 80.0, 10.0, 1.0),  # exactly 80 mph
        (7, T0, "2024-01-01 00:30:00", 5.0, 10.0, 1.0),  # fine
        (8, "2024-01-01 00:30:00", T0, 5.0, 10.0, 1.0),  # dropoff before pickup
        (9, T0, "2024-01-01 00:30:00", float("nan"), 10.0, 1.0),  # NaN distance
        (10, "not-a-time", "2024-01-01 00:30:00", 5.0, 10.0, 1.0),  # unparsable
        (11, T0, T0, 5.0, 10.0, 1.0),  # zero duration -> null speed
        (12, T0, "2024-01-01 00:30:00", None, 10.0, 1.0),  # null distance
    ]
    kept = sorted(r.id for r in clean_stream(_trips(spark, rows)).collect())
    assert kept == [7]


def test_zero_duration_gives_null_speed(spark):
    r = _trips(spark, [(1, T0, T0, 5.0, 1.0, 1.0)]).first()
    assert r.duration_min == 0.0 and r.speed_mph is None


def test_training_rule_adds_amount_and_tip(spark):
    rows = [
        (1, T0, "2024-01-01 00:30:00", 5.0, 10.0, 0.0),  # tip 0 allowed
        (2, T0, "2024-01-01 00:30:00", 5.0, 0.0, 1.0),  # amount 0 excluded
        (3, T0, "2024-01-01 00:30:00", 5.0, 500.0, 1.0),  # amount 500 excluded
        (4, T0, "2024-01-01 00:30:00", 5.0, 10.0, 100.0),  # tip 100 excluded
        (5, T0, "2024-01-01 00:30:00", 5.0, 10.0, None),  # no tip excluded
        (6, T0, "2024-01-01 00:30:00", 5.0, 10.0, -0.5),  # negative tip excluded
        (7, T0, "2024-01-01 00:30:00", 5.0, float("nan"), 1.0),  # NaN amount excluded
    ]
    kept = sorted(r.id for r in clean_training(_trips(spark, rows)).collect())
    assert kept == [1]


def test_training_duration_keeps_fractional_seconds(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00.5", "2024-01-01 00:10:00")], "p string, d string")
    df = df.select(F.to_timestamp("p").alias("pickup_ts"), F.to_timestamp("d").alias("dropoff_ts"), F.lit(2.0).alias("trip_distance"))
    frac = derive_duration_speed(df, fractional=True).first().duration_min
    whole = derive_duration_speed(df, fractional=False).first().duration_min
    assert math.isclose(frac, 599.5 / 60)
    assert whole == 10.0


def test_json_shapes(spark):
    vals = ["{", "[]", "null", '{"passenger_count": "abc", "trip_distance": 1.5}', '{"trip_distance": 2.5}', "", None, '[{"a": 1}]',
            '{"passenger_count": 1.9, "pu_location_id": 3000000000, "do_location_id": -2.7, "total_amount": "7.5", "trip_distance": true}']
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, value string")
    out = {r.i: r for r in decode_events(df, keep=["i"]).collect()}
    assert [out[i].is_malformed for i in range(len(vals))] == [True, True, True, False, False, True, True, True, False]
    assert out[4].trip_distance == 2.5 and out[4].pickup_datetime is None
    assert out[3].passenger_count is None and out[3].trip_distance == 1.5  # a bad field is null alone
    r = out[8]
    assert (r.passenger_count, r.pu_location_id, r.do_location_id, r.total_amount, r.trip_distance) == (1, None, -2, 7.5, None)
    for i in (0, 1, 2, 5, 6, 7):
        assert all(out[i][c] is None for c in ("pickup_datetime", "trip_distance", "pu_location_id"))


def test_bad_time_text_parses_to_null(spark):
    df = spark.createDataFrame([('{"pickup_datetime": "2024-13-45 99:00:00", "dropoff_datetime": "2024-01-01 00:05:00"}',)], "value string")
    r = parse_event_times(decode_events(df)).first()
    assert r.pickup_ts is None and r.dropoff_ts is not None


def test_alias_precedence_when_both_set(spark):
    df = spark.createDataFrame(
        [("2024-01-01 01:00:00", "2024-01-01 05:00:00", 3.0, 7.0, 12.0, 6.0)],
        "tpep_pickup_datetime string, pickup_datetime string, PULocationID double, pu_location_id double, total_amount double, fare_amount double",
    )
    r = canonical(df).first()
    assert str(r.pickup_datetime) == "2024-01-01 01:00:00"
    assert r.pu_location_raw == 3.0 and r.total_amount == 12.0
    # missing alias list -> null column, no error
    assert df.select(coalesce_alias(df, ["no_such"]).alias("x")).first().x is None


def test_zone_id_parse(spark):
    z = spark.createDataFrame([(x,) for x in ["12.7", "0", "-3", "abc", "NaN", "1e12", None, "161"]], "z string")
    got = [r.p for r in z.select(parse_zone_id("z").alias("p")).collect()]
    assert got == [12, None, None, None, None, None, None, 161]


def _zones(spark):
    return spark.createDataFrame(
        [(1, "A", 40.70, -74.00), (2, "B", 40.70, -73.98), (3, "C", None, None)],
        "location_id int, zone_name string, latitude double, longitude double",
    )


def test_nearest_zone_ties_and_nulls(spark):
    pts = spark.createDataFrame(
        [(1, 40.70, -73.99), (2, None, -73.99), (3, 40.7004, -73.9804), (4, 40.70, -74.0004)],
        "id int, lat double, lon double",
    )
    for metric in ("euclid", "haversine"):
        got = {r.id: r.z for r in nearest_zone(pts, _zones(spark), "lat", "lon", "z", metric).collect()}
        assert got[1] == 1  # equidistant -> lowest id
        assert got[2] is None  # null coordinate -> no zone
        assert got[3] == 2
        assert got[4] == 1  # rounded to 3 dp first


def test_normalize_defaults_and_snap(spark):
    df = spark.createDataFrame(
        [
            (1, "2024-01-01 00:00:00", "2024-01-01 00:10:00", None, None, None, 40.7, -73.981, None),
            (2, "2024-01-01 00:00:00.250000", "2024-01-01 00:10:00", 2.0, 3.5, 0.0, None, None, 15.0),
            (3, None, "2024-01-01 00:10:00", 2.0, 3.5, 4.0, None, None, 15.0),
        ],
        "id int, pickup_datetime string, dropoff_datetime string, passenger_count double, trip_distance double,"
        " pu_location_id double, pickup_latitude double, pickup_longitude double, total_amount double",
    )
    df = df.withColumn("pickup_datetime", F.to_timestamp("pickup_datetime")).withColumn(
        "dropoff_datetime", F.to_timestamp("dropoff_datetime")
    )
    out = {r.id: r for r in normalize_events(df, _zones(spark), keep=["id"]).collect()}
    assert set(out) == {1, 2}  # row 3 lacks a pickup time
    assert out[1].pu_location_id == 2 and out[1].do_location_id == 161
    assert out[1].passenger_count == 1 and out[1].trip_distance == 1.0 and out[1].total_amount == 10.0
    assert out[2].pu_location_id == 161  # zone 0 is not a zone, no coordinates -> default
    assert out[2].pickup_datetime == "2024-01-01 00:00:00.250000"
    assert out[1].pickup_datetime == "2024-01-01 00:00:00"


def test_box_is_inclusive(spark):
    df = spark.createDataFrame(
        [(1, 40.4, -74.5), (2, 41.0, -73.5), (3, 40.39, -74.0), (4, 40.7, -73.49)],
        "id int, pickup_latitude double, pickup_longitude double",
    )
    assert sorted(r.id for r in bbox_filter(df).collect()) == [1, 2]


def test_median_and_surge(spark):
    df = spark.createDataFrame([(1, 1), (2, 2), (3, 4), (4, 10)], "pu_location_id int, trip_count long")
    got = {r.pu_location_id: r.surge_multiplier for r in with_surge(df).collect()}
    assert got == {1: 1.0, 2: 1.0, 3: 1.33, 4: 3.0}  # median 3.0 (interpolated)
    zero = spark.createDataFrame([(1, 0), (2, 0), (3, 5)], "pu_location_id int, trip_count long")
    assert {r.surge_multiplier for r in with_surge(zero).collect()} == {1.0}  # median 0 -> 1.0
    assert spark.range(1).select(surge_multiplier(F.lit(3), F.lit(None).cast("double")).alias("s")).first().s == 1.0


def test_empty_input(spark):
    empty = spark.createDataFrame([], "pu_location_id int, trip_count long")
    assert with_surge(empty).count() == 0
    assert spark.range(1).select(median_trip_count(empty).alias("m")).first().m is None


def test_dedup_and_latest(spark):
    df = spark.createDataFrame(
        [(1, 0, "a"), (1, 1, "b"), (2, 5, "c"), (2, 5, "c"), (3, 2, "d")], "k int, seq int, v string"
    )
    assert {r.k: r.v for r in dedup_first(df, ["k"], ["seq"]).collect()} == {1: "a", 2: "c", 3: "d"}
    assert {r.k: r.v for r in dedup_last(df, ["k"], ["seq"]).collect()} == {1: "b", 2: "c", 3: "d"}
    two = spark.createDataFrame([(1, 1, 2, "x"), (1, 1, 3, "y"), (1, 0, 9, "z")], "k int, a int, b int, v string")
    assert latest_per_key(two, ["k"], ["a", "b"]).first().v == "y"


def test_rounding_matches_pandas_rule(spark):
    import pandas as pd

    vals = [2.675, 1.005, 0.125, 0.375, -2.5, 33.005, 1e-9, 123456.785]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r.y for r in df.select(round_half_even("x", 2).alias("y")).collect()]
    assert got == list(pd.Series(vals).round(2))
    # stable rounding removes last-bit noise before the tie is decided
    noisy = spark.createDataFrame([(33.00499999999999,), (33.00500000000001,)], "x double")
    assert len({r.y for r in noisy.select(stable_round("x", 2).alias("y")).collect()}) == 1


def test_arrival_stamp_uses_injected_clock_whole_seconds(spark):
    from zonecast.operators.normalize import stamp_arrival, shift_time

    df = spark.createDataFrame([(1,)], "id int")
    clock = F.lit("2024-03-05 06:07:08.987654").cast("timestamp")
    assert stamp_arrival(df, clock).first().emitted_at == "2024-03-05 06:07:08"
    t = spark.createDataFrame([("2024-01-31 23:59:59.5", "2024-02-01 00:10:00")], "p string, d string").select(
        F.to_timestamp("p").alias("pickup_datetime"), F.to_timestamp("d").alias("dropoff_datetime"))
    r = shift_time(t, 1).first()
    assert (r.pickup_datetime, r.dropoff_datetime) == ("2024-03-02 23:59:59", "2024-03-03 00:10:00")


def test_scale_settings_size_the_shuffle_by_what_is_shuffled():
    from zonecast.session import scale_settings

    width = lambda shuffled, cores: int(scale_settings(shuffled, cores)["spark.sql.shuffle.partitions"])
    assert width(10 * 1024**2, 8) == 24
    assert width(100 * 1024**3, 8000) == 20_000  # aggregates of a 100 TB scan
    assert width(20 * 1024**4, 8000) == 20 * 1024**4 // (256 * 1024**2) + 1


def test_shared_folder_is_needed_off_local(monkeypatch):
    from types import SimpleNamespace

    from zonecast.session import scratch_root

    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    fake = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=context)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_root(fake)


def test_nan_first_alias_does_not_hide_the_second(spark):
    df = spark.createDataFrame([(float("nan"), 7.0), (3.0, 7.0)], "total_amount double, fare_amount double")
    assert [r.total_amount for r in canonical(df).collect()] == [7.0, 3.0]
    assert [r.total_amount for r in canonical(df, by_schema=True).collect()] == [None, 3.0]
