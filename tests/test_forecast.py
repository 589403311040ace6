"""The live comparison of predicted and actual amounts: stream against batch, model changes, replays."""

import os

import pytest
from pyspark.sql import functions as F

from zonecast import schema as S
from zonecast.ml.cycle import Scorer
from zonecast.ml.model import StagedModel, assemble, gbt, save_model
from zonecast.operators.live import trip_features
from zonecast.sinks.tables import read_live
from zonecast.sources.events import decode_events, live_rows
from zonecast.streaming import forecast as C

FIELDS = ["event_id", "emitted_at", "predicted_amount", "actual_amount", "amount_error", "model_version"]


def payloads(spark, first, n):
    i = F.col("id") + first
    at = lambda s: F.date_format(F.timestamp_seconds(1704067200 + s), S.TS_TEXT_FORMAT)
    good = F.to_json(F.struct(
        at(i * 60).alias("pickup_datetime"), at(i * 60 + 300 + i % 900).alias("dropoff_datetime"), F.lit(1).alias("passenger_count"),
        (1 + i % 9).cast("double").alias("trip_distance"), (i % 4).cast("int").alias("pu_location_id"), F.lit(1).alias("do_location_id"),
        F.when(i % 11 == 0, 0.0).when(i % 13 != 0, (5 + i % 30).cast("double")).alias("total_amount"), at(i * 60 + 20).alias("emitted_at"),
    ))
    return spark.range(n).select(F.when(i % 50 == 49, "no json").otherwise(good).alias("value"), i.alias("event_id"))


def stream_of(spark, path):
    return spark.readStream.schema("value string, event_id long").option("maxFilesPerTrigger", "1").parquet(path)


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*FIELDS).collect()), key=repr)


@pytest.fixture(scope="module")
def model_path(spark, tmp_path_factory):
    trips = live_rows(decode_events(payloads(spark, 0, 400), keep=["event_id"]), keep=["event_id"])
    data = trip_features(trips).withColumn(S.TARGET, F.col("avg_trip_distance") / 2 + F.col("pu_location_id"))
    path = str(tmp_path_factory.mktemp("model"))
    stage = gbt(4, S.TARGET).fit(assemble(data))
    save_model(spark, StagedModel([stage], trained_at="2024-01-01", training_rows=400), path)
    return path


def test_stream_equals_batch_across_a_model_change(spark, tmp_dir, model_path):
    at = lambda n: os.path.join(tmp_dir, n)
    boosted = C.trip_scorer(spark, model_path)
    flat = Scorer("flat", lambda f: f.withColumn("tip_pred", F.lit(2.0)))
    standing = {"model": boosted}
    expected = None
    for first, scorer in ((0, boosted), (200, flat), (400, flat)):
        standing["model"] = scorer
        payloads(spark, first, 200).coalesce(2).write.mode("append").parquet(at("feed"))
        C.run_compared_stream(spark, stream_of(spark, at("feed")), lambda: standing["model"], at("rows"), at("errors"), at("ckpt"))
        trips = live_rows(decode_events(payloads(spark, first, 200), keep=["event_id"]), keep=["event_id"])
        part = C.compared_trips(trips, scorer)
        expected = part if expected is None else expected.unionByName(part)
    assert rows_of(read_live(spark, at("rows"))) == rows_of(expected)
    whole = {}
    for r in expected.collect():
        n, errors, shares = whole.setdefault(r.model_version, [0, [], []])
        whole[r.model_version][0] = n + 1
        if r.actual_amount is not None:
            error = abs(r.actual_amount - r.predicted_amount)
            errors.append(error)
            shares.append(100 * error / (r.actual_amount or S.MAPE_ZERO_TRUTH))
    got = {r.model_version: r for r in C.read_errors(spark, at("errors")).collect()}
    assert set(got) == set(whole) == {boosted.version, "flat"}
    for version, (n, errors, shares) in whole.items():
        assert (got[version].trips, got[version].compared) == (n, len(errors))
        assert len(errors) < n  # malformed payloads and missing amounts have no error
        assert got[version].mae == pytest.approx(sum(errors) / len(errors))
        assert got[version].mape == pytest.approx(sum(shares) / len(shares))


def test_a_batch_delivered_again_adds_no_error(spark, tmp_dir):
    path = os.path.join(tmp_dir, "errors")
    sums = spark.createDataFrame([("v", None, 3, 2, 4.0, 0.5)], "model_version string, emit_hour timestamp, trips long, compared long, error_sum double, share_sum double")
    for run, batch in (("a", 0), ("a", 0), ("a", 1), ("a", 0), ("b", 0), ("b", 0)):
        C.add_errors(spark, sums, batch, path, run)
    r = C.read_errors(spark, path).first()
    assert (r.trips, r.compared, r.mae, r.mape) == (9, 6, 2.0, 25.0)
    nothing = os.path.join(tmp_dir, "nothing")
    C.add_errors(spark, sums.withColumn("compared", F.lit(0).cast("long")), 0, nothing, "a")
    assert C.read_errors(spark, nothing).first().mae is None
