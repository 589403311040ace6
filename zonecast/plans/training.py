"""Training-frame plans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.numeric import round6 as r6
from ..functions.timefn import is_weekend, weekday_mon0
from ..operators.aggregate import baseline_table as baseline_op
from ..operators.aggregate import finalize_features, global_mean, mae_mape, merge_partials, tumbling_partials
from ..operators.quality import clean_training
from ..operators.select import batch_index, dedup_last, global_row_number, label_split
from ..session import materialize
from ..sources import adapter
from . import duck as D
from .registry import query

W = adapter.duck_with
TRAIN_BASE = ("zones", "trips", "training_trips")


# ---------------------------------------------------------------------------
# Spark side
# ---------------------------------------------------------------------------


def training_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapter.training_trips(spark, sf_dir).withColumnRenamed(
        "pickup_datetime", "pickup_ts"
    ).withColumnRenamed("dropoff_datetime", "dropoff_ts")


def clean_training_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_training(training_measures(spark, sf_dir))


def partials(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tumbling_partials(clean_training_trips(spark, sf_dir))


def with_time_features(df: DataFrame) -> DataFrame:
    """M1 calendar features from window_start (Monday = 0)."""
    return (
        df.withColumn("hour", F.hour("window_start"))
        .withColumn("day_of_week", weekday_mon0("window_start"))
        .withColumn("is_weekend", is_weekend("day_of_week"))
    )


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unrounded feature frame (FIXTURES A5), one row per (zone, 10-min window)."""
    return with_time_features(finalize_features(partials(spark, sf_dir)))


def positioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature rows with their position in the (window_start, zone) order and split labels.

    The feature table (zones x windows, far smaller than the trips) is stored
    once for the numbering, and the numbered rows once more: splits, baselines
    and training read them without repeating the windows or the raw scan."""
    f = materialize(features(spark, sf_dir))
    n = f.select(F.count(F.lit(1))).scalar()  # of the stored features, not of the numbered join
    return materialize(label_split(global_row_number(f, "window_start", ["pu_location_id"]), n=n))


def train_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return positioned(spark, sf_dir).filter(F.col("split") == "train")


def test_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return positioned(spark, sf_dir).filter(F.col("split") == "test")


def baseline_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test rows scored by the (zone, hour) mean of the train rows, global mean fill."""
    pos = positioned(spark, sf_dir)
    train = pos.filter(F.col("split") == "train")
    test = pos.filter(F.col("split") == "test")
    base = baseline_op(train)
    gmean = global_mean(train)
    return test.join(base, ["pu_location_id", "hour"], "left").withColumn(
        "baseline_pred", F.coalesce(F.col("baseline_pred"), gmean)
    )


# ---------------------------------------------------------------------------
# DuckDB side
# ---------------------------------------------------------------------------

DUCK_TMEAS = f"""
select *, {D.SPEED} from (
  select event_id, pickup_datetime as pickup_ts, dropoff_datetime as dropoff_ts, trip_distance,
         pu_location_id, total_amount, tip_amount,
         (epoch_us(dropoff_datetime) - epoch_us(pickup_datetime))/60000000.0::double as duration_min
  from training_trips)
"""
DUCK_TCLEAN = f"select * from tmeas where {D.F2}"


def _duck_partials(src: str) -> str:
    return f"""
select time_bucket(interval 10 minute, pickup_ts) as window_start,
       time_bucket(interval 10 minute, pickup_ts) + interval 10 minute as window_end,
       pu_location_id, cast(count(trip_distance) as bigint) as trip_count,
       sum(trip_distance) as trip_distance_sum, sum(duration_min) as duration_min_sum,
       sum(speed_mph) as speed_mph_sum, sum(tip_amount) as tip_amount_sum
from {src} group by all
"""


DUCK_FEATS = """
select window_start, window_end, pu_location_id, trip_count,
       trip_distance_sum/trip_count as avg_trip_distance, duration_min_sum/trip_count as avg_duration_min,
       speed_mph_sum/trip_count as avg_speed_mph, tip_amount_sum/trip_count as avg_tip_amount,
       cast(hour(window_start) as int) as hour, cast(isodow(window_start) - 1 as int) as day_of_week,
       cast(isodow(window_start) - 1 >= 5 as int) as is_weekend
from partials where trip_count > 0
"""
DUCK_POS = """
select *, case when rn <= t then 'train' else 'test' end as split,
       case when rn <= t - v then 'core' when rn <= t then 'val' else 'test' end as part
from (select f.*, row_number() over (order by window_start, pu_location_id) as rn,
             cast(floor(count(*) over () * 0.8) as bigint) as t
      from feats f) x,
     lateral (select least(greatest(5000, cast(floor(x.t * 0.1) as bigint)), greatest(1, x.t // 3)) as v) y
"""


TRAIN_CTES = (
    ("tmeas", DUCK_TMEAS),
    ("tclean", DUCK_TCLEAN),
    ("partials", _duck_partials("tclean")),
    ("feats", DUCK_FEATS),
    ("pos", DUCK_POS),
)


def duck_train(*extra: tuple[str, str]) -> str:
    return W(*TRAIN_CTES, *extra, base=TRAIN_BASE)


# ---------------------------------------------------------------------------
# registered queries
# ---------------------------------------------------------------------------


@query("clean_training", duck_train() + "select event_id from tclean")
def clean_training_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ids of trips passing the training quality rule."""
    return clean_training_trips(spark, sf_dir).select("event_id")


_P_OUT = (
    f"select window_start, window_end, pu_location_id, trip_count, {D.r6('trip_distance_sum')} as trip_distance_sum,"
    f" {D.r6('duration_min_sum')} as duration_min_sum, {D.r6('speed_mph_sum')} as speed_mph_sum,"
    f" {D.r6('tip_amount_sum')} as tip_amount_sum from partials"
)


def _round_partials(df: DataFrame) -> DataFrame:
    return df.select(
        *S.AGG_KEYS,
        F.col("trip_count").cast("long").alias("trip_count"),
        *[r6(c).alias(c) for c in S.PARTIAL_SUMS[1:]],
    )


@query("train_partials", duck_train() + _P_OUT, headline=True)
def train_partials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: tumbling 10-minute count and sums per zone (real clock, F2 rows)."""
    return _round_partials(partials(spark, sf_dir))


@query("merge_partials", duck_train() + _P_OUT)
def merge_partials_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3: partials of two ingest halves (even / odd ids) re-summed = direct partials."""
    t = clean_training_trips(spark, sf_dir)
    even = tumbling_partials(t.filter(F.col("event_id") % 2 == 0))
    odd = tumbling_partials(t.filter(F.col("event_id") % 2 == 1))
    return _round_partials(merge_partials(even, odd))


_F_COLS = [
    "window_start", "window_end", "pu_location_id", "trip_count", "avg_trip_distance",
    "avg_duration_min", "avg_speed_mph", "avg_tip_amount", "hour", "day_of_week", "is_weekend",
]
_AVGS = ["avg_trip_distance", "avg_duration_min", "avg_speed_mph", "avg_tip_amount"]


def _round_feats(df: DataFrame) -> DataFrame:
    return df.select(*[r6(c).alias(c) if c in _AVGS else F.col(c) for c in _F_COLS])


_F_OUT = "select " + ", ".join(D.r6(c) + f" as {c}" if c in _AVGS else c for c in _F_COLS)


@query("train_features", duck_train() + _F_OUT + " from feats", headline=True)
def train_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4 + M1: training frame, one row per (zone, tumbling window) with calendar features."""
    return _round_feats(features(spark, sf_dir))


@query(
    "dedup_features",
    duck_train(
        ("pe", _duck_partials("tclean where event_id % 2 = 0")),
        ("po", _duck_partials("tclean where event_id % 2 = 1")),
        (
            "u",
            "select 0 as seq, * from pe union all select 1 as seq, * from po",
        ),
    )
    + f"""select pu_location_id, window_start, trip_count,
  {D.r6('tip_amount_sum/trip_count')} as avg_tip_amount from (
  select *, row_number() over (partition by pu_location_id, window_start order by seq desc) as rn from u)
where rn = 1""",
)
def dedup_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two ingests of overlapping (zone, window) rows; the later ingest wins."""
    t = clean_training_trips(spark, sf_dir)
    a = tumbling_partials(t.filter(F.col("event_id") % 2 == 0)).withColumn("seq", F.lit(0))
    b = tumbling_partials(t.filter(F.col("event_id") % 2 == 1)).withColumn("seq", F.lit(1))
    d = dedup_last(a.unionByName(b), ["pu_location_id", "window_start"], ["seq"])
    return d.select(
        "pu_location_id",
        "window_start",
        "trip_count",
        r6(F.col("tip_amount_sum") / F.col("trip_count")).alias("avg_tip_amount"),
    )


@query(
    "temporal_split",
    duck_train()
    + """select split, cast(count(*) as bigint) as rows, min(window_start) as min_window_start,
  max(window_start) as max_window_start from pos group by split""",
)
def temporal_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """80/20 split by position in (window_start, zone) order."""
    return positioned(spark, sf_dir).groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("window_start").alias("min_window_start"),
        F.max("window_start").alias("max_window_start"),
    )


@query(
    "validation_split",
    duck_train() + "select part, cast(count(*) as bigint) as rows from pos group by part",
)
def validation_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Core / validation / test row counts."""
    return positioned(spark, sf_dir).groupBy("part").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "train_batches",
    duck_train()
    + f"""select cast(floor((rn - 1) / {S.TRAIN_BATCH_ROWS}) as bigint) as batch, cast(count(*) as bigint) as rows,
  min(rn) as first_rn, max(rn) as last_rn from pos where part = 'core' group by 1""",
)
def train_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chronological batches of the core training rows."""
    core = positioned(spark, sf_dir).filter(F.col("part") == "core")
    return core.groupBy(batch_index("rn", S.TRAIN_BATCH_ROWS).alias("batch")).agg(
        F.count(F.lit(1)).alias("rows"), F.min("rn").alias("first_rn"), F.max("rn").alias("last_rn")
    )


@query(
    "baseline_table",
    duck_train()
    + f"select pu_location_id, hour, {D.r6('avg(avg_tip_amount)')} as baseline_pred"
    " from pos where split = 'train' group by pu_location_id, hour",
)
def baseline_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5: mean target per (zone, hour) over the training rows."""
    b = baseline_op(train_rows(spark, sf_dir))
    return b.select("pu_location_id", "hour", r6("baseline_pred").alias("baseline_pred"))


DUCK_SCORED = """
select t.*, coalesce(b.baseline_pred, (select avg(avg_tip_amount) from pos where split = 'train')) as baseline_pred
from (select * from pos where split = 'test') t
left join (select pu_location_id, hour, avg(avg_tip_amount) as baseline_pred from pos
           where split = 'train' group by all) b
  on b.pu_location_id = t.pu_location_id and b.hour = t.hour
"""


@query(
    "baseline_score",
    duck_train(("scored", DUCK_SCORED))
    + f"select window_start, pu_location_id, hour, {D.r6('avg_tip_amount')} as avg_tip_amount,"
    f" {D.r6('baseline_pred')} as baseline_pred from scored",
)
def baseline_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test rows with the baseline prediction (left join, global-mean fill)."""
    s = baseline_scored(spark, sf_dir)
    return s.select(
        "window_start", "pu_location_id", "hour", r6(S.TARGET).alias("avg_tip_amount"),
        r6("baseline_pred").alias("baseline_pred"),
    )


@query(
    "error_metrics",
    duck_train(("scored", DUCK_SCORED))
    + f"""select cast(count(*) as bigint) as rows,
  {D.r6('avg(abs(avg_tip_amount - baseline_pred))')} as mae,
  {D.r6('avg(abs(avg_tip_amount - baseline_pred) / case when avg_tip_amount = 0 then 1e-6 else avg_tip_amount end) * 100.0')} as mape
from scored""",
)
def error_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Baseline MAE and MAPE on the test rows."""
    s = baseline_scored(spark, sf_dir)
    m = s.agg(F.count(F.lit(1)).alias("rows"), *mae_mape(S.TARGET, "baseline_pred"))
    return m.select("rows", r6("mae").alias("mae"), r6("mape").alias("mape"))
