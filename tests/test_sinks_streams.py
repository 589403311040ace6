"""Sinks and streams: idempotent upsert / append, retention, late data, CSV export, metrics JSON."""

import os
import time
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from zonecast import schema as S
from zonecast.operators.aggregate import sliding_traffic_agg
from zonecast.plans.traffic import clean_stream_trips
from zonecast.sinks.events import to_event_json
from zonecast.sinks.tables import (
    append_batch,
    export_csv,
    prune_expired,
    read_live,
    read_snapshot,
    read_upserted,
    upsert_latest,
    within_retention,
    write_metrics_json,
    write_snapshot,
)
from zonecast.sources.events import json_file_stream
from zonecast.sources.files import read_zone_csv
from zonecast.streaming.live import replay_clock, run_live_stream
from zonecast.streaming.replay import write_time_slices
from zonecast.streaming.traffic import run_traffic_stream
from tests.conftest import SF_SMALL


def _agg(spark):
    return sliding_traffic_agg(clean_stream_trips(spark, SF_SMALL))


def _rows(df):
    return sorted(tuple(r) for r in df.select(*S.TRAFFIC_AGG_COLUMNS).collect())


def test_upsert_is_idempotent_and_last_wins(spark, tmp_dir):
    path = os.path.join(tmp_dir, "agg")
    agg = _agg(spark)
    upsert_latest(spark, agg, 0, path)
    first = _rows(read_upserted(spark, path))
    upsert_latest(spark, agg, 0, path)  # same batch delivered twice
    assert _rows(read_upserted(spark, path)) == first
    bumped = agg.withColumn("trip_count", F.col("trip_count") + 100)
    one_key = bumped.orderBy("window_start", "pu_location_id").limit(1)
    upsert_latest(spark, one_key, 1, path)
    after = read_upserted(spark, path)
    assert after.count() == len(first)
    assert after.agg(F.sum("trip_count")).first()[0] == sum(r[3] for r in first) + 100
    upsert_latest(spark, agg.limit(0), 2, path)  # empty batch: no-op
    assert after.count() == len(first)


def test_upsert_after_checkpoint_reset(spark, tmp_dir):
    """A new run's batch 0 wins over an old run's batch 7; within a run older batches undo nothing."""
    path = os.path.join(tmp_dir, "agg")
    one = _agg(spark).limit(1).cache()
    count = lambda: read_upserted(spark, path).first().trip_count
    put = lambda n, batch, run: upsert_latest(spark, one.withColumn("trip_count", F.lit(n).cast("long")), batch, path, run_id=run)
    put(5, 7, "old")
    put(99, 0, "new")
    assert count() == 99
    put(100, 1, "new")
    put(99, 0, "new")
    assert count() == 100
    twice = one.unionByName(one)
    upsert_latest(spark, twice, 0, os.path.join(tmp_dir, "first"))  # one row per key from the first write on
    assert read_upserted(spark, os.path.join(tmp_dir, "first")).count() == 1


def test_append_batch_idempotent_and_retention(spark, tmp_dir):
    path = os.path.join(tmp_dir, "live")
    rows = spark.createDataFrame(
        [(1, "2024-01-01 00:00:00"), (2, "2024-01-01 00:20:00"), (3, "2024-01-01 00:25:00"), (4, None)],
        "event_id int, t string",
    ).select("event_id", F.to_timestamp("t").alias("emitted_at"))
    append_batch(rows.filter("event_id = 1"), 0, path)
    append_batch(rows.filter("event_id > 1"), 1, path)
    append_batch(rows.filter("event_id > 1"), 1, path)  # replayed batch
    append_batch(rows.filter("event_id = 3"), 0, path, "new")  # another checkpoint's batch 0
    table = read_live(spark, path)
    assert sorted(r.event_id for r in table.collect()) == [1, 2, 3, 3, 4]
    as_of = F.lit("2024-01-01 00:25:00").cast("timestamp")
    assert sorted(r.event_id for r in within_retention(table, as_of).collect()) == [2, 3, 3]
    now = datetime(2024, 1, 1, 0, 25)
    assert prune_expired(spark, path, now) == 0  # the hour goes on, its expired row is gone for readers
    assert sorted(r.event_id for r in read_live(spark, path).collect()) == [2, 3, 3, 4]
    assert sorted(r.event_id for r in read_live(spark, path, since=datetime(2024, 1, 1, 0, 24)).collect()) == [3, 3]
    prune_expired(spark, path, datetime(2024, 1, 1, 0, 1))  # an older clock brings nothing back
    assert sorted(r.event_id for r in read_live(spark, path).collect()) == [2, 3, 3, 4]
    later = datetime(2024, 1, 1, 1, 20)
    assert prune_expired(spark, path, later) == 1 and prune_expired(spark, path, later) == 0
    assert [r.event_id for r in read_live(spark, path).collect()] == [4]
    assert prune_expired(spark, os.path.join(tmp_dir, "none"), now) == 0


def test_append_writes_a_file_an_hour(spark, tmp_dir):
    """A backfill over many minutes makes files by the hour, sorted by arrival."""
    path = os.path.join(tmp_dir, "live")
    rows = spark.range(3000).select("id", (F.timestamp_seconds(1704067200 + (F.col("id") * 7919) % 18_000)).alias("emitted_at"))
    append_batch(rows, 0, path)
    files = [os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")]
    assert len(files) == 5 and read_live(spark, path).count() == 3000
    for f in files:
        times = [r[0] for r in spark.read.parquet(f).select("emitted_at").collect()]
        assert times == sorted(times)


def _payloads(spark, directory, times):
    spark.createDataFrame([(f'{{"emitted_at": "{t:%Y-%m-%d %H:%M:%S}", "trip_distance": {n}.0}}',) for n, t in enumerate(times)], "value string").coalesce(1).write.mode("append").text(directory)
    time.sleep(1.1)


def test_stray_events_expire_nothing(spark, tmp_dir):
    """An event of 2031 or of 2001 in a batch: the other rows stay, the future one is stored, the old one goes."""
    base = datetime(2024, 1, 1, 12, 0)
    good = [base + timedelta(seconds=30 * n) for n in range(8)]
    for name, clock in (("replay", replay_clock()), ("wall", None)):
        feed, target, ckpt = (os.path.join(tmp_dir, name, n) for n in ("feed", "live", "ckpt"))
        shift = timedelta(0) if clock else datetime.now(timezone.utc).replace(tzinfo=None, microsecond=0) - good[-1]
        _payloads(spark, feed, [t + shift for t in good[:6]])
        _payloads(spark, feed, [*(t + shift for t in good[6:]), datetime(2061, 1, 1), datetime(2001, 1, 1)])
        _payloads(spark, feed, [datetime(2061, 1, 2)])  # a batch of strays alone
        run_live_stream(spark, json_file_stream(spark, feed, 1), target, ckpt, **({"clock": clock} if clock else {}))
        kept = sorted(r.emitted_at for r in read_live(spark, target).collect())
        assert kept == [*(t + shift for t in good), datetime(2061, 1, 1), datetime(2061, 1, 2)], name


def test_live_stream_deletes_expired_rows(spark, tmp_dir):
    feed, target, ckpt = (os.path.join(tmp_dir, n) for n in ("feed", "live", "ckpt"))
    times = [f"2024-01-01 {h:02d}:{m:02d}:30" for h in (10, 11) for m in range(0, 60, 5)]
    events = spark.createDataFrame([(f'{{"emitted_at": "{t}", "trip_distance": 1.0}}', t) for t in times], "value string, t string")
    assert 2 <= write_time_slices(events, "t", feed, 4) <= 4
    run_live_stream(spark, json_file_stream(spark, feed, 1), target, ckpt, clock=lambda df: df.agg(F.max("emitted_at")).first()[0])
    kept = sorted(r.t for r in read_live(spark, target).select(F.col("emitted_at").cast("string").alias("t")).collect())
    assert kept == [t for t in times if t >= "2024-01-01 11:45"]
    folders = [f for f in os.listdir(target) if f.startswith("emit_hour=")]
    assert folders == ["emit_hour=2024-01-01_11"]


def test_time_slices_are_ordered_and_disjoint(spark, tmp_dir):
    feed = os.path.join(tmp_dir, "feed")
    df = spark.range(1000).selectExpr("cast((id * 37) % 1000 as int) as t").selectExpr("t", "cast(t as string) as value")
    n = write_time_slices(df, "t", feed, 5)
    files = sorted((os.path.getmtime(os.path.join(feed, f)), f) for f in os.listdir(feed) if f.startswith("part-"))
    assert len(files) == n and len({m for m, _ in files}) == n
    rows = [int(x) for _, f in files for x in open(os.path.join(feed, f)).read().split()]
    assert rows == list(range(1000))


def test_snapshot_is_switched_whole(spark, tmp_dir):
    path = os.path.join(tmp_dir, "snap")
    for n in (3, 5, 7):
        write_snapshot(spark.range(n), path)
        assert read_snapshot(spark, path).count() == n
    os.makedirs(os.path.join(path, "v-999999999999999-half"))  # a write that never ended
    assert read_snapshot(spark, path).count() == 7
    os.unlink(os.path.join(path, "CURRENT"))
    assert read_snapshot(spark, path).count() == 7


def test_half_written_csv_is_written_anew(spark, tmp_dir):
    src, dst = os.path.join(tmp_dir, "pq"), os.path.join(tmp_dir, "csv")
    os.makedirs(src)
    spark.range(5).toPandas().to_parquet(os.path.join(src, "a.parquet"))
    os.makedirs(os.path.join(dst, "a"))
    assert export_csv(spark, src, dst) == ["a"] and export_csv(spark, src, dst) == []


def _write_file(spark, df, directory):
    df.coalesce(1).write.mode("append").text(directory)
    time.sleep(1.1)  # distinct modification times -> deterministic arrival order


def test_stream_drops_only_late_rows(spark, tmp_dir):
    """A file older than the watermark, arriving last, changes nothing."""
    feed, target, ckpt = (os.path.join(tmp_dir, n) for n in ("feed", "agg", "ckpt"))

    def payload(ts, dist, zone, drop):
        return (f'{{"pickup_datetime": "{ts}", "dropoff_datetime": "{drop}", "trip_distance": {dist},'
                f' "pu_location_id": {zone}}}')

    def events(rows):
        return spark.createDataFrame([(payload(*r),) for r in rows], "value string")

    on_time = [("2024-01-01 10:00:00", 3.0, 7, "2024-01-01 10:15:00"), ("2024-01-01 10:20:00", 3.0, 7, "2024-01-01 10:35:00")]
    later = [("2024-01-01 11:00:00", 3.0, 7, "2024-01-01 11:15:00")]
    late = [("2024-01-01 10:01:00", 3.0, 7, "2024-01-01 10:16:00")]  # older than watermark (10:55)
    _write_file(spark, events(on_time), feed)
    _write_file(spark, events(later), feed)
    run_traffic_stream(spark, json_file_stream(spark, feed, 1), target, ckpt)
    before = _rows(read_upserted(spark, target))
    _write_file(spark, events(late), feed)
    run_traffic_stream(spark, json_file_stream(spark, feed, 1), target, ckpt)
    assert _rows(read_upserted(spark, target)) == before
    assert {r[3] for r in before} == {1}


def test_stream_equals_batch_on_same_rows(spark, tmp_dir):
    feed, target, ckpt = (os.path.join(tmp_dir, n) for n in ("feed", "agg", "ckpt"))
    t = clean_stream_trips(spark, SF_SMALL).select(
        F.date_format("pickup_ts", S.TS_TEXT_FORMAT).alias("pickup_datetime"),
        F.date_format("dropoff_ts", S.TS_TEXT_FORMAT).alias("dropoff_datetime"),
        "trip_distance", "pu_location_id", "total_amount",
        F.lit(None).cast("int").alias("passenger_count"), F.lit(None).cast("int").alias("do_location_id"),
        F.lit(None).cast("string").alias("emitted_at"),
    )
    _write_file(spark, to_event_json(t), feed)  # one file: one micro-batch
    run_traffic_stream(spark, json_file_stream(spark, feed, 1), target, ckpt)
    stream = read_upserted(spark, target)
    batch = _agg(spark)
    rnd = lambda df: sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.select(*S.TRAFFIC_AGG_COLUMNS).collect())
    assert rnd(stream) == rnd(batch)


def test_export_csv_skips_existing_and_hidden(spark, tmp_dir):
    src, dst = os.path.join(tmp_dir, "pq"), os.path.join(tmp_dir, "csv")
    os.makedirs(src)
    spark.range(5).toPandas().to_parquet(os.path.join(src, "a.parquet"))
    spark.range(3).toPandas().to_parquet(os.path.join(src, "b.parquet"))
    spark.range(3).toPandas().to_parquet(os.path.join(src, "._b.parquet"))
    assert export_csv(spark, src, dst) == ["a", "b"]
    assert export_csv(spark, src, dst) == []
    assert spark.read.option("header", True).csv(os.path.join(dst, "a")).count() == 5


def test_metrics_json_document(spark, tmp_dir):
    doc = {"training_rows": 10, "baseline": {"mae": 1.5, "mape": 12.0},
           "history": [{"batch": 1, "val_mae": 1.2}, {"batch": 2, "val_mae": 1.1}]}
    path = os.path.join(tmp_dir, "metrics")
    write_metrics_json(spark, doc, path)
    back = spark.read.json(path).first()
    assert back.baseline.mae == 1.5 and [h.batch for h in back.history] == [1, 2]


def test_zone_csv_and_fallback(spark, tmp_dir):
    p = os.path.join(tmp_dir, "zones.csv")
    with open(p, "w") as f:
        f.write("location_id,zone_name,latitude,longitude\n1,Alpha,40.7,-74.0\n2,Beta,40.8,-73.9\n")
    assert read_zone_csv(spark, p).count() == 2
    fb = read_zone_csv(spark, os.path.join(tmp_dir, "missing.csv")).collect()
    assert [(r.location_id, r.latitude, r.longitude) for r in fb] == [(161, 40.7549, -73.984)]


def test_file_listing_cap_and_family_skipping(spark):
    from zonecast.plans.files import write_family_files
    from zonecast.sources.files import file_families, list_trip_files, read_trip_files

    root = write_family_files(spark, SF_SMALL)
    files = list_trip_files(spark, root)
    assert files == sorted(files) and all(f.endswith(".parquet") for f in files)
    assert list_trip_files(spark, root, max_files=3) == files[:3]
    assert list_trip_files(spark, root + "/missing") == []
    found = file_families(spark, files)
    assert len(found.groups) == 7 and not found.unreadable  # one schema per family, drifted types included
    training = read_trip_files(spark, files, need_tip=True, keep=["event_id"])
    stream = read_trip_files(spark, files, need_tip=False, keep=["event_id"])
    n = spark.read.parquet(f"{SF_SMALL}/events.parquet").count()
    yellow = sum(1 for f in files if "/yellow/" in f)
    assert yellow > 0
    assert training.count() == n  # no-tip and no-location copies skipped
    # without the tip requirement the no-tip copy of the yellow rows is read too
    extra = spark.read.parquet(*[f for f in files if "/yellow_notip/" in f]).count()
    assert stream.count() == n + extra
    assert dict(training.dtypes)["passenger_count"] == "double"


def test_listing_leaves_hidden_parts_out_and_reports_corrupt_files(spark, tmp_dir):
    from zonecast.sources.files import file_families, list_trip_files, read_trip_files

    base = os.path.join(tmp_dir, "_hidden_above", "trips")  # a hidden part above the prefix does not count
    df = spark.createDataFrame([(1, "2024-01-01 00:00:00", "2024-01-01 00:10:00", 2.0, 9.0, 1.0, 5)],
                               "id int, pickup_datetime string, dropoff_datetime string, trip_distance double, total_amount double, tip_amount double, PULocationID int")
    df.coalesce(1).write.parquet(f"{base}/ok")
    for hidden in ("_temporary/0/t", ".tmp", "x/_attempt"):
        df.coalesce(1).write.parquet(f"{base}/{hidden}/part")
    with open(f"{base}/bad.parquet", "wb") as f:
        f.write(b"PAR1 this is no parquet file PAR1")
    files = list_trip_files(spark, base)
    assert [f.split("/trips/")[1].split("/")[0] for f in files] == ["bad.parquet", "ok"]
    found = file_families(spark, files)
    assert [f.rsplit("/", 1)[1] for f in found.unreadable] == ["bad.parquet"] and len(found.groups) == 1
    assert read_trip_files(spark, files, keep=["id"]).count() == 1
    assert read_trip_files(spark, []) is None


def test_usable_files_need_every_group():
    from zonecast.sources.files import missing_groups, needed_columns

    base = {"pickup_datetime", "dropoff_datetime", "trip_distance", "fare_amount", "tip_amount", "other"}
    assert missing_groups(base) == ["pickup place"] and needed_columns(base) is None
    assert missing_groups(base | {"pickup_latitude"}) == ["pickup place"]
    assert set(needed_columns(base | {"pickup_latitude", "pickup_longitude"})) == base - {"other"} | {"pickup_latitude", "pickup_longitude"}
    no_tip = base - {"tip_amount"} | {"PULocationID"}
    assert missing_groups(no_tip) == ["tip"] and needed_columns(no_tip, need_tip=False) is not None


def test_clear_scratch_deletes_what_was_handed_out(spark):
    from zonecast.session import clear_scratch, scratch_path

    clear_scratch(spark)
    used, unused = scratch_path(spark, "a"), scratch_path(spark, "b")
    spark.range(3).write.parquet(used)
    assert used != unused and spark.read.parquet(used).count() == 3
    assert clear_scratch(spark) == 1 and clear_scratch(spark) == 0
    assert not os.path.exists(used.removeprefix("file:"))
