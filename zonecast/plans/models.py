"""Model plans: staged GBT training, metrics, document, reload, zone and trip scoring
(M2, M4-M6, M11, M12, K6, K7, W10 and M7-M10 with the trained model).

Training uses the full settings of ``schema`` (250,000 rows a batch, 120 and 40
trees).  A trained model is saved in the shared folder under a fingerprint of its
feature rows and loaded from there: other data give another fingerprint, so a
stored model is never used for rows that it was not trained on.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..ml.cycle import Scorer, score_changes, score_latest, scoring_features
from ..ml.model import (
    StagedModel,
    check_sizes,
    ensure_features,
    load_history,
    load_model,
    metrics_document,
    metrics_row,
    save_model,
    split_counts,
    train_staged,
)
from ..operators import live as L
from ..operators import scoring as SC
from ..operators.aggregate import baseline_table, global_mean, sliding_traffic_agg
from ..functions.numeric import round6 as r6
from ..session import materialize, scratch_path, scratch_root
from ..sinks.tables import path_exists, upsert_latest, write_metrics_json
from ..sources import adapter
from ..sources.events import json_file_stream
from ..streaming.forecast import read_errors, run_compared_stream
from . import duck as D
from .registry import query
from ..sinks.changes import upsert_announced
from .scoring import _PRED_OUT, _round_pred, as_of, duck_scoring, latest_per_zone, traffic_raw
from .streams import replay_feed
from .traffic import clean_stream_trips
from .training import duck_train, positioned


def stored(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    """Labelled feature rows and the folder of the model trained on them."""
    pos = positioned(spark, sf_dir)
    sizes = split_counts(pos)
    check_sizes(sizes)
    mark = pos.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64("rn", "part", S.TARGET, *S.TIP_FEATURES).cast("decimal(38,0)")).alias("h"),
    ).first()
    path = f"{scratch_root(spark)}/model-{mark.n}-{int(mark.h) % (1 << 63):x}"
    if not path_exists(spark, f"{path}/meta/_SUCCESS"):
        model, history = train_staged(pos.filter(F.col("part") == "core"), pos.filter(F.col("part") == "val"))
        model.trained_at = datetime.now(timezone.utc).isoformat()
        model.training_rows = sizes["train"]
        save_model(spark, model, path, history)
    return pos, path


def trained(spark: SparkSession, sf_dir: str) -> tuple[StagedModel, list[dict], DataFrame, str]:
    """Model, batch history, labelled feature rows and the model's folder."""
    pos, path = stored(spark, sf_dir)
    return load_model(spark, path), load_history(spark, path), pos, path


def with_baseline(pos: DataFrame) -> DataFrame:
    """J3 over all rows: the (zone, hour) mean of the training rows, else their mean."""
    train = pos.filter(F.col("split") == "train")
    return pos.join(baseline_table(train), ["pu_location_id", "hour"], "left").withColumn(
        "baseline_pred", F.coalesce(F.col("baseline_pred"), global_mean(train))
    )


DUCK_BATCHES = f"""
select cast((rn - 1) // {S.TRAIN_BATCH_ROWS} + 1 as int) as batch, cast(count(*) as bigint) as rows,
  cast(case when (rn - 1) // {S.TRAIN_BATCH_ROWS} = 0 then {S.INIT_TREES} else {S.TREES_PER_BATCH} end as int) as trees,
  true as kept_prefix_ends_at_least_mae
from pos where part = 'core' group by (rn - 1) // {S.TRAIN_BATCH_ROWS}
"""


@query("stage_history", duck_train(("b", DUCK_BATCHES)) + "select * from b")
def stage_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M5: rows and trees of every boosting stage; the kept prefix ends at the first least validation MAE."""
    model, history, _, _ = trained(spark, sf_dir)
    best = min(history, key=lambda h: (h["val_mae"], h["batch"]))["batch"]
    rows = [(h["batch"], h["rows"], h["trees"], len(model.stages) == best) for h in history]
    return spark.createDataFrame(rows, "batch int, rows long, trees int, kept_prefix_ends_at_least_mae boolean")


@query("train_metrics")
def train_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M6: train / validation / test and baseline MAE + MAPE, improvement (one pass)."""
    model, _, pos, _ = trained(spark, sf_dir)
    out = metrics_row(model.predict(with_baseline(pos), "tip_pred"))
    return out.withColumn("target", F.lit(S.TARGET)).withColumn("selected_best_batch", F.lit(len(model.stages))).withColumn(
        "improvement_mae", F.col("baseline_mae") - F.col("test_mae")
    )


DUCK_DOCUMENT = f"""
select cast(count(*) filter (split = 'train') as bigint) as training_rows, cast(count(*) filter (split = 'test') as bigint) as testing_rows,
  cast(cast(min(window_start) filter (split = 'test') as date) as varchar) as test_period_start, '{S.TARGET}' as target,
  cast({S.TRAIN_BATCH_ROWS} as bigint) as batch_rows, cast({S.INIT_TREES} as bigint) as init_trees,
  cast({S.TREES_PER_BATCH} as bigint) as trees_per_batch, (select cast(count(*) as int) from b) as batches,
  (select {D.r('avg(abs(avg_tip_amount - baseline_pred))', 4)} from scored) as baseline_mae,
  (select {D.r2('avg(abs(avg_tip_amount - baseline_pred) / case when avg_tip_amount = 0 then 1e-6 else avg_tip_amount end) * 100.0')} from scored) as baseline_mape
from pos
"""


def _document_sql() -> str:
    from .training import DUCK_SCORED

    return duck_train(("b", DUCK_BATCHES), ("scored", DUCK_SCORED)) + DUCK_DOCUMENT


@query("metrics_document", _document_sql())
def metrics_document_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6: the metrics document written as JSON and read back (what SQL can state of it)."""
    model, history, pos, _ = trained(spark, sf_dir)
    metrics = metrics_row(model.predict(with_baseline(pos), "tip_pred")).first().asDict()
    document = metrics_document(metrics, history, S.TRAIN_BATCH_ROWS, S.INIT_TREES, S.TREES_PER_BATCH, model.trained_at)
    path = scratch_path(spark, "metrics")
    write_metrics_json(spark, document, path)
    run = "model.continued_training"
    return spark.read.json(path).select(
        "training_rows", "testing_rows", "test_period_start", "target", *(f"{run}.{c}" for c in ("batch_rows", "init_trees", "trees_per_batch")),
        F.size(f"{run}.history").alias("batches"), F.col("baseline.mae").alias("baseline_mae"), F.col("baseline.mape").alias("baseline_mape"),
    )


@query("model_reload", duck_train() + "select cast(count(*) as bigint) as rows, cast(0 as bigint) as differing from pos")
def model_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K7: a model saved again and loaded predicts every feature row as before."""
    model, history, pos, _ = trained(spark, sf_dir)
    path = scratch_path(spark, "model-copy")
    save_model(spark, model, path, history)
    both = load_model(spark, path).predict(model.predict(pos, "a"), "b")
    return both.agg(F.count(F.lit(1)).alias("rows"), F.count_if(~F.col("a").eqNullSafe(F.col("b"))).alias("differing"))


@query("predict_zones_gbt")
def predict_zones_gbt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M7-M10 with the boosted model: next-window tip band, fare, surge per zone."""
    model, _, _, _ = trained(spark, sf_dir)
    scored = model.predict(scoring_features(latest_per_zone(spark, sf_dir)), "tip_pred")
    return SC.zone_predictions(scored, F.col("tip_pred"), as_of(spark, sf_dir))


@query("predict_trips")
def predict_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3 + M11: per-trip tip estimate (clipped at 0, 2 dp) for every trip."""
    from ..functions.numeric import round_half_even

    model, _, _, _ = trained(spark, sf_dir)
    feats = L.trip_features(adapter.trips(spark, sf_dir))
    scored = model.predict(feats, "tip_pred")
    return scored.select(
        "event_id", round_half_even(F.greatest(F.col("tip_pred"), F.lit(0.0)), 2).alias("model_tip")
    )


@query(
    "score_cycle",
    duck_scoring()
    + """select pu_location_id, window_start, window_end, trip_count, predicted_avg_fare, surge_multiplier,
  prediction_for_window_end, prediction_generated_at, true as band_in_order from pred""",
)
def score_cycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One cycle from the stored aggregate table and the stored model to predictions."""
    _, model_path = stored(spark, sf_dir)
    table = scratch_path(spark, "traffic")
    upsert_latest(spark, sliding_traffic_agg(clean_stream_trips(spark, sf_dir)), 0, table)
    out = score_latest(spark, table, model_path, as_of(spark, sf_dir))
    return out.select(
        "pu_location_id", "window_start", "window_end", "trip_count", "predicted_avg_fare", "surge_multiplier",
        "prediction_for_window_end", "prediction_generated_at",
        ((F.col("predicted_tip_low") >= 0) & (F.col("predicted_tip_low") <= F.col("predicted_tip_high"))).alias("band_in_order"),
    )


@query("score_changed_zones", duck_scoring() + _PRED_OUT)
def score_changed_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M12, incremental: a cycle after each of three batches (stale rows of the even zones,
    the odd zones, the even zones corrected) scores the touched zones only; the last
    cycle's predictions, by the zone-hour baseline, are those of the whole table."""
    agg = traffic_raw(spark, sf_dir)
    train = positioned(spark, sf_dir).filter(F.col("split") == "train")
    base, mean = baseline_table(train), global_mean(train)

    def predict(latest: DataFrame) -> DataFrame:
        scored = latest.withColumn("hour", F.hour("window_start")).join(base, ["pu_location_id", "hour"], "left")
        return scored.withColumn("tip_pred", F.coalesce(F.col("baseline_pred"), mean))

    table, feed, state = (scratch_path(spark, n) for n in ("traffic", "changes", "zone-state"))
    even = F.col("pu_location_id") % 2 == 0
    stale = agg.filter(even).withColumn("trip_count", F.col("trip_count") + 7)
    for n, batch in enumerate((stale, agg.filter(~even), agg.filter(even))):
        upsert_announced(spark, batch, n, table, feed, run_id="r")
        out = score_changes(spark, table, feed, state, Scorer("baseline", predict), as_of(spark, sf_dir))
    return _round_pred(out)


_AMOUNT = D.r2(D.r("5.0 * greatest(" + D.r("coalesce(b.baseline_pred, g.gmean)", 9) + ", 0.0)", 9))
DUCK_LIVE_ERRORS = f"""
select 'baseline' as model_version, date_trunc('hour', t.emitted_at) as emit_hour, t.total_amount as actual, {_AMOUNT} as predicted
from trips t
left join (select pu_location_id, hour, avg(avg_tip_amount) as baseline_pred from pos
           where split = 'train' group by all) b
  on b.pu_location_id = t.pu_location_id and b.hour = hour(t.pickup_datetime),
  (select avg(avg_tip_amount) as gmean from pos where split = 'train') g
"""


@query(
    "live_prediction_errors",
    duck_scoring(("le", DUCK_LIVE_ERRORS))
    + f"""select model_version, emit_hour, cast(count(*) as bigint) as trips, cast(count(actual) as bigint) as compared,
  {D.r6('avg(abs(actual - predicted))')} as mae,
  {D.r6('avg(abs(actual - predicted) / case when actual = 0 then 1e-6 else actual end) * 100.0')} as mape
from le group by model_version, emit_hour""",
)
def live_prediction_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed replayed through the scoring stream; its amount errors by model version
    and arrival hour, with the stored zone-hour baseline as the model."""
    train = positioned(spark, sf_dir).filter(F.col("split") == "train")
    base, mean = materialize(baseline_table(train)), train.agg(F.avg(S.TARGET)).first()[0]

    def predict(features: DataFrame) -> DataFrame:
        scored = features.join(base.withColumn("pu_location_id", F.col("pu_location_id").cast("double")), ["pu_location_id", "hour"], "left")
        return scored.withColumn("tip_pred", F.coalesce(F.col("baseline_pred"), F.lit(mean)))

    feed = replay_feed(spark, sf_dir)
    rows, errors = scratch_path(spark, "compared"), scratch_path(spark, "errors")
    run_compared_stream(
        spark, json_file_stream(spark, feed, max_files_per_trigger=1), lambda: Scorer("baseline", predict), rows, errors,
        scratch_path(spark, "ckpt-compared"),
    )
    return read_errors(spark, errors, ["model_version", "emit_hour"]).withColumn("mae", r6("mae")).withColumn("mape", r6("mape"))


@query(
    "missing_feature",
    adapter.duck_with() + """select event_id, cast(pu_location_id as double) as pu_location_id, 0.0::double as avg_speed_mph,
  0.0::double as trip_count, trip_distance as avg_trip_distance from trips""",
)
def missing_feature(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2: feature columns that a scoring frame lacks are 0."""
    feats = L.trip_features(adapter.trips(spark, sf_dir)).drop("avg_speed_mph", "trip_count")
    out = ensure_features(feats)
    return out.select("event_id", "pu_location_id", "avg_speed_mph", "trip_count", "avg_trip_distance")
