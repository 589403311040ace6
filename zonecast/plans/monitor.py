"""Monitoring and planning plans: demand frame (D5), monthly distributions and busiest
zones (D2, D1), data-quality contracts (D4), freshness and row-count checks (D3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import round6 as r6
from ..functions.numeric import stable_round
from ..operators import checks, contracts, demand, monthly
from ..operators.aggregate import sliding_traffic_agg
from ..session import materialize, scratch_path
from ..sinks.tables import upsert_latest
from ..sources import adapter
from ..sources.events import decode_events, json_file_stream, live_rows
from . import duck as D
from .ingest import DUCK_LIVE_ROWS, DUCK_PAYLOAD_FIELDS, event_payloads
from .registry import query
from .traffic import clean_stream_trips, duck_stream, duck_traffic_body

W = adapter.duck_with

# ---------------------------------------------------------------------------
# demand
# ---------------------------------------------------------------------------

_LAG_COLUMNS = ", ".join(
    f"case when c.w - interval {10 * k} minute >= first then coalesce(l{k}.n, 0) end as lag_{k}" for k in demand.LAGS
)
_LAG_JOINS = " ".join(f"left join k l{k} on l{k}.z = c.z and l{k}.w = c.w - interval {10 * k} minute" for k in demand.LAGS)
DUCK_DEMAND = (
    ("k", "select pu_location_id as z, time_bucket(interval 10 minute, pickup_ts) as w, count(*) as n from clean group by all"),
    ("b", "select min(w) as first, max(w) as last, cast(date_diff('minute', min(w), max(w)) // 10 + 1 as bigint) as total from k"),
    ("d", "select first, last, first + to_minutes(10 * cast(floor(total * 0.8::double) as int)) as border from b"),
    ("c", "select z, unnest(generate_series(first, last, interval 10 minute)) as w from (select distinct z from k), b"),
    ("frame", f"""select c.z as pu_location_id, c.w as window_start, cast(coalesce(x.n, 0) as bigint) as trip_count, {_LAG_COLUMNS},
  case when c.w + interval 10 minute <= last then coalesce(y.n, 0) end as label, cast(hour(c.w) as int) as hour_of_day,
  cast(isodow(c.w) - 1 as int) as day_of_week,
  case when c.w + interval 10 minute > last then 'future' when c.w + interval 10 minute < border then 'train'
       when c.w >= border then 'test' else 'gap' end as split
from c cross join d left join k x on x.z = c.z and x.w = c.w left join k y on y.z = c.z and y.w = c.w + interval 10 minute {_LAG_JOINS}"""),
)


def _demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = materialize(demand.window_counts(clean_stream_trips(spark, sf_dir)), "demand-counts")
    return demand.demand_frame(counts)


@query("demand_frame", duck_stream(*DUCK_DEMAND) + "select * from frame")
def demand_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every zone and window with its count, lagged counts, the next window's count and its split."""
    return _demand(spark, sf_dir)


@query(
    "demand_errors",
    duck_stream(
        *DUCK_DEMAND,
        ("m", "select pu_location_id, hour(window_start + interval 10 minute) as h, avg(label) as mean_demand from frame where split = 'train' group by all"),
        ("g", "select avg(label) as everywhere from frame where split = 'train'"),
        ("t", """select label, trip_count as last_value, coalesce(mean_demand, everywhere) as zone_hour
  from frame cross join g left join m on m.pu_location_id = frame.pu_location_id and m.h = hour(window_start + interval 10 minute)
  where split = 'test'"""),
    )
    + f"""select 'last value' as model, cast(count(*) as bigint) as "rows", {D.r6('avg(abs(label - last_value))')} as mae from t
union all select 'zone-hour mean', cast(count(*) as bigint), {D.r6('avg(abs(label - zone_hour))')} from t""",
)
def demand_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors of the two plain forecasts (last value, training mean by zone and hour) on the test windows."""
    frame = _demand(spark, sf_dir)
    means = demand.zone_hour_mean(frame)
    everywhere = frame.filter("split = 'train'").select(F.avg("label")).scalar()
    hour = F.hour(F.col("window_start") + F.expr("interval 10 minutes"))
    joined = frame.withColumn("target_hour", hour).join(means, ["pu_location_id", "target_hour"], "left")
    errors = demand.demand_errors(
        joined.withColumn("zone_hour", F.coalesce("mean_demand", everywhere)), **{"last value": "trip_count", "zone-hour mean": "zone_hour"}
    )
    return errors.select("model", "rows", r6("mae").alias("mae"))


# ---------------------------------------------------------------------------
# Monthly distributions and busiest zones
# ---------------------------------------------------------------------------


def _monthly_parts(spark: SparkSession, sf_dir: str, part) -> DataFrame:
    """Summaries of three loads in one store, one of them delivered twice."""
    trips = adapter.training_trips(spark, sf_dir)
    path = scratch_path(spark, "monthly")
    for load in (0, 1, 2, 1):
        monthly.store_part(part(trips.filter(F.col("event_id") % 3 == load)), path, f"load-{load}")
    return monthly.read_parts(spark, path)


_MONTH = "strftime(pickup_datetime, '%Y-%m')"


def _duck_bins(measure: str) -> str:
    lo, hi, n = monthly.BINS[measure]
    return (
        f"select {_MONTH} as month, '{measure}' as measure, cast(case when {measure} < {lo} then 0 when {measure} >= {hi} then {n + 1}"
        f" else floor(({measure} - {lo}) / (({hi} - {lo}) / {n})) + 1 end as int) as bin, count(*) as trips"
        f" from training_trips where {measure} is not null group by all"
    )


_TRAINING = ("zones", "trips", "training_trips")


@query("monthly_histograms", W(base=_TRAINING) + " union all ".join(f"select * from ({_duck_bins(m)})" for m in monthly.BINS))
def monthly_histograms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fare and distance histograms per month, merged from stored summaries of several loads."""
    return monthly.histograms(monthly.merge_summaries(_monthly_parts(spark, sf_dir, monthly.summarize)))


@query(
    "monthly_volume",
    W(base=_TRAINING)
    + f"""select {_MONTH} as month, count(*) as trips, {D.r2(D.r('sum(total_amount)', 5))} as total_amount,
  {D.r6('avg(trip_distance)')} as avg_distance, min(total_amount) as least_amount, max(total_amount) as most_amount
from training_trips group by all""",
)
def monthly_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips, turnover, mean distance and the range of fares per month, from the merged summaries."""
    s = monthly.merge_summaries(_monthly_parts(spark, sf_dir, monthly.summarize))
    return s.select(
        "month", "trips", stable_round("total_amount_sum", 2).alias("total_amount"),
        r6(F.try_divide(F.col("trip_distance_sum"), F.col("trip_distance_n"))).alias("avg_distance"),
        F.col("total_amount_min").alias("least_amount"), F.col("total_amount_max").alias("most_amount"),
    )


@query("monthly_quantiles")
def monthly_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketched quantiles of fare and distance per month, merged from several loads (approximate: no oracle)."""
    return monthly.quantiles(monthly.merge_summaries(_monthly_parts(spark, sf_dir, monthly.summarize)))


@query(
    "busiest_zones_monthly",
    W(base=_TRAINING)
    + f"""select month, cast(rank as int) as rank, zone, trips from (
  select *, row_number() over (partition by month order by trips desc, zone) as rank from (
    select {_MONTH} as month, pu_location_id as zone, count(*) as trips from training_trips where pu_location_id is not null group by all))
where rank <= 15""",
)
def busiest_zones_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fifteen busiest pickup zones of each month, from stored zone counts of several loads."""
    return monthly.busiest(_monthly_parts(spark, sf_dir, monthly.zone_counts))


# ---------------------------------------------------------------------------
# contracts
# ---------------------------------------------------------------------------

#: the rules' conditions once more, as DuckDB text over the decoded payloads
_DUCK_RULES = [(r.name, r.fails) for r in contracts.TRIP_CONTRACT]
_DUCK_ROWS = W(("p", DUCK_PAYLOAD_FIELDS), ("live", DUCK_LIVE_ROWS))
_DUCK_REASONS = "array_to_string(list_filter([" + ", ".join(f"case when {c} then '{n}' end" for n, c in _DUCK_RULES) + "], lambda x: x is not null), '; ')"
QUARANTINE_SQL = _DUCK_ROWS + f"select * from (select *, {_DUCK_REASONS} as failed_rules from live) where failed_rules <> ''"


def _event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return live_rows(decode_events(event_payloads(spark, sf_dir), keep=["event_id"]), keep=["event_id"])


def _reasons_text(df: DataFrame) -> DataFrame:
    return df.withColumn(contracts.REASONS, F.array_join(contracts.REASONS, "; "))


@query(
    "contract_counts",
    _DUCK_ROWS
    + f"""select 'any rule' as rule, (select count(*) from live) as "rows", count(*) as failed from live where {" or ".join(f"coalesce({c}, false)" for _, c in _DUCK_RULES)}
union all """
    + " union all ".join(f"""select '{n}', (select count(*) from live), count(*) from live where {c}""" for n, c in _DUCK_RULES),
)
def contract_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that break each rule, observed while the rows are written."""
    contract, counted = contracts.Contract(), contracts.Observation("trip-contract")
    contract.observed(_event_rows(spark, sf_dir), counted).write.parquet(scratch_path(spark, "contract-rows"))
    return contract.counts_of(spark, counted.get)


@query("quarantined_events", QUARANTINE_SQL)
def quarantined_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every failing event, whole, with all rules that it breaks."""
    return _reasons_text(contracts.quarantined(contracts.Contract().marked(_event_rows(spark, sf_dir))))


@query("quarantine_stream", QUARANTINE_SQL)
def quarantine_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D4 on a stream: events replayed through the contract into a good table and a quarantine; the quarantine."""
    feed = scratch_path(spark, "contract-feed")
    event_payloads(spark, sf_dir).select(F.concat_ws("\t", "event_id", "value").alias("value")).repartition(4).write.text(feed)
    lines = json_file_stream(spark, feed, max_files_per_trigger=2)
    raw = lines.select(F.split_part("value", F.lit("\t"), F.lit(1)).cast("long").alias("event_id"), F.expr("substring(value, locate('\\t', value) + 1)").alias("value"))
    rows = live_rows(decode_events(raw, keep=["event_id"]), keep=["event_id"])
    kept, aside = scratch_path(spark, "contract-good"), scratch_path(spark, "contract-quarantine")
    contracts.run_contract_stream(rows, contracts.Contract(), kept, aside, scratch_path(spark, "ckpt-contract"))
    return _reasons_text(spark.read.parquet(aside).drop("batch"))


# ---------------------------------------------------------------------------
# D3: freshness and row counts
# ---------------------------------------------------------------------------

_FRESH_MINUTES = 15


@query(
    "stored_table_checks",
    duck_stream(("traffic", duck_traffic_body(True, "clean")), ("now", "select max(emitted_at) as t from trips"))
    + f"""select 'traffic_agg' as "table", (select count(*) from traffic) as "rows", max(window_end) as newest,
  cast(max(service_date) as varchar) as newest_partition,
  {D.r6("(epoch_us(max(now.t)) - epoch_us(max(window_end))) / 6e7")} as age_minutes,
  coalesce((epoch_us(max(now.t)) - epoch_us(max(window_end))) / 6e7 <= {_FRESH_MINUTES}, false) as fresh
from traffic, now""",
)
def stored_table_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D3: rows (from footers), newest partition (from folder names) and freshness of the stored aggregate table."""
    path = scratch_path(spark, "checked-agg")
    upsert_latest(spark, sliding_traffic_agg(clean_stream_trips(spark, sf_dir)), 0, path)
    as_of = adapter.newest_arrival(spark, sf_dir)
    rows = checks.stored_rows(spark, path).scalar()
    newest = checks.newest_partition(spark, path, "service_date").scalar()
    fresh = checks.freshness(spark, path, "service_date", "window_end", as_of, _FRESH_MINUTES)
    return fresh.select(
        F.lit("traffic_agg").alias("table"), rows.alias("rows"), "newest", newest.cast("string").alias("newest_partition"),
        r6("age_minutes").alias("age_minutes"), "fresh",
    )
