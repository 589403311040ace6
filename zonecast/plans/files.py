"""File-family plans (S1, S2): trip files of drifting schemas, derived from the
test tables, listed, checked and unioned into the canonical trip frame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources import adapter
from ..sinks.history import read_history, update_history
from ..sinks.tables import export_csv
from ..operators.aggregate import finalize_features, tumbling_partials
from ..operators.quality import clean_training
from ..sources.files import (
    file_families,
    list_trip_files,
    needed_columns,
    read_trip_files,
    training_trips_from_files,
)
from . import duck as D
from .registry import query

# Column set of each written family (the schema of its files).  Two extra
# families re-publish the yellow rows without a tip / without any location
# and must be skipped by the training reader.
FAMILY_FILE_COLUMNS = {
    "yellow": ["tpep_pickup_datetime", "tpep_dropoff_datetime", "passenger_count", "trip_distance",
               "PULocationID", "DOLocationID", "total_amount", "tip_amount"],
    "green": ["lpep_pickup_datetime", "lpep_dropoff_datetime", "passenger_count", "trip_distance",
              "PULocationID", "DOLocationID", "total_amount", "tip_amount"],
    "generic": ["pickup_datetime", "dropoff_datetime", "passenger_count", "trip_distance",
                "pu_location_id", "do_location_id", "fare_amount", "tip_amount"],
    "legacy": ["pickup_datetime", "dropoff_datetime", "passenger_count", "trip_distance",
               "pickup_latitude", "pickup_longitude", "dropoff_latitude", "dropoff_longitude",
               "total_amount", "tip_amount"],
    "mixed": ["tpep_pickup_datetime", "tpep_dropoff_datetime", "pickup_datetime", "dropoff_datetime",
              "passenger_count", "trip_distance", "PULocationID", "DOLocationID", "pu_location_id",
              "do_location_id", "total_amount", "fare_amount", "tip_amount"],
    "yellow_notip": ["tpep_pickup_datetime", "tpep_dropoff_datetime", "passenger_count", "trip_distance",
                     "PULocationID", "DOLocationID", "total_amount"],
    "yellow_noloc": ["tpep_pickup_datetime", "tpep_dropoff_datetime", "passenger_count", "trip_distance",
                     "total_amount", "tip_amount"],
}
SOURCE_FAMILY = {"yellow_notip": "yellow", "yellow_noloc": "yellow"}
# Type drift between families (as between years of real files).
DRIFT = {"green": {"passenger_count": "bigint"}, "generic": {"pu_location_id": "int", "do_location_id": "int"}}


def write_family_files(spark: SparkSession, sf_dir: str) -> str:
    """Write each family's rows with only that family's columns; returns the root."""
    raw = adapter.raw_wide(spark, sf_dir)
    root = scratch_path(spark, "tripfiles")
    for fam, cols in FAMILY_FILE_COLUMNS.items():
        src = SOURCE_FAMILY.get(fam, fam)
        drift = DRIFT.get(fam, {})
        sel = [F.col("event_id")] + [F.col(c).cast(drift[c]).alias(c) if c in drift else F.col(c) for c in cols]
        raw.filter(F.col("family") == src).select(*sel).write.mode("overwrite").parquet(f"{root}/{fam}")
    return root


def _family_of(path_col):
    return F.regexp_extract(path_col, r"/([A-Za-z_]+)/[^/]+\.parquet$", 1)


DUCK_SCAN = (
    adapter.duck_with(
        ("fams", """select family as fam from raw_wide
                    union all select 'yellow_notip' from raw_wide where family = 'yellow'
                    union all select 'yellow_noloc' from raw_wide where family = 'yellow'"""),
        base=("zones", "trips", "raw_wide"),
    )
    + """select fam as family, cast(count(*) as bigint) as rows,
  fam in ('green', 'generic', 'legacy', 'mixed', 'yellow') as usable
from fams group by fam"""
)


@query("scan_trips", DUCK_SCAN)
def scan_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 + S2 check: rows per file family, and whether the training reader can use it."""
    root = write_family_files(spark, sf_dir)
    files = list_trip_files(spark, root)
    usable = sorted({
        f.rsplit("/", 2)[-2] for key, group in file_families(spark, files).groups.items()
        if needed_columns({n for n, _ in key} - {"event_id"}) is not None for f in group
    })
    rows = (
        spark.read.parquet(*files)
        .select(_family_of(F.input_file_name()).alias("family"))
        .groupBy("family")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    return rows.withColumn("usable", F.col("family").isin(usable))


DUCK_UNION = (
    adapter.duck_with(base=("zones", "trips", "raw_wide"))
    + """select event_id,
  coalesce(tpep_pickup_datetime, lpep_pickup_datetime, pickup_datetime) as pickup_datetime,
  coalesce(tpep_dropoff_datetime, lpep_dropoff_datetime, dropoff_datetime) as dropoff_datetime,
  passenger_count, trip_distance,
  coalesce(PULocationID, pu_location_id) as pu_location_raw,
  coalesce(DOLocationID, do_location_id) as do_location_raw,
  pickup_latitude, pickup_longitude, dropoff_latitude, dropoff_longitude,
  coalesce(total_amount, fare_amount) as total_amount, tip_amount
from raw_wide"""
)


@query("schema_family_union", DUCK_UNION)
def schema_family_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Usable files of all families in the canonical columns (unusable skipped)."""
    root = write_family_files(spark, sf_dir)
    out = read_trip_files(spark, list_trip_files(spark, root), need_tip=True, keep=["event_id"])
    return out.select(
        "event_id", "pickup_datetime", "dropoff_datetime", "passenger_count", "trip_distance",
        F.col("pu_location_raw").cast("double").alias("pu_location_raw"),
        F.col("do_location_raw").cast("double").alias("do_location_raw"),
        "pickup_latitude", "pickup_longitude", "dropoff_latitude", "dropoff_longitude",
        "total_amount", "tip_amount",
    )


DUCK_FILE_TRIPS = f"""
select event_id, family,
  case when family in ('yellow', 'mixed') then tpep_pickup_datetime when family = 'green' then lpep_pickup_datetime
       else pickup_datetime end as pickup_ts,
  case when family in ('yellow', 'mixed') then tpep_dropoff_datetime when family = 'green' then lpep_dropoff_datetime
       else dropoff_datetime end as dropoff_ts,
  trip_distance, case when family = 'generic' then fare_amount else total_amount end as total_amount, tip_amount,
  case when family = 'generic' then cast(trunc(pu_location_id) as int) else cast(trunc(PULocationID) as int) end as zone_id,
  {D.r('pickup_latitude', 3)} as lat, {D.r('pickup_longitude', 3)} as lon,
  pickup_latitude between 40.4 and 41.0 and pickup_longitude between -74.5 and -73.5 as in_box
from raw_wide
"""
DUCK_FILE_SNAP = """
select lat, lon, location_id from (
  select c.lat, c.lon, z.location_id, row_number() over (partition by c.lat, c.lon order by
    round_even(2 * asin(sqrt(pow(sin((radians(z.latitude) - radians(c.lat)) / 2), 2)
      + cos(radians(c.lat)) * cos(radians(z.latitude)) * pow(sin((radians(z.longitude) - radians(c.lon)) / 2), 2))) * 1e12, 0),
    z.location_id) as rn
  from (select distinct lat, lon from t where family = 'legacy' and in_box) c, zones z) where rn = 1
"""
DUCK_FILE_ROWS = f"""
select *, {D.SPEED} from (
  select event_id, pickup_ts, dropoff_ts, trip_distance, total_amount, tip_amount,
    case when family = 'legacy' then s.location_id else zone_id end as pu_location_id,
    (epoch_us(dropoff_ts) - epoch_us(pickup_ts)) / 60000000.0::double as duration_min
  from t left join snap s on family = 'legacy' and t.in_box and s.lat = t.lat and s.lon = t.lon)
"""
DUCK_FILE_FEATURES = (
    adapter.duck_with(("t", DUCK_FILE_TRIPS), ("snap", DUCK_FILE_SNAP), ("m", DUCK_FILE_ROWS), base=("zones", "trips", "raw_wide"))
    + f"""select time_bucket(interval 10 minute, pickup_ts) as window_start,
  time_bucket(interval 10 minute, pickup_ts) + interval 10 minute as window_end, pu_location_id,
  cast(count(*) as bigint) as trip_count, {D.r6('avg(trip_distance)')} as avg_trip_distance,
  {D.r6('avg(duration_min)')} as avg_duration_min, {D.r6('avg(speed_mph)')} as avg_speed_mph,
  {D.r6('avg(tip_amount)')} as avg_tip_amount
from m where {D.F2} group by all"""
)


@query("train_features_from_files", DUCK_FILE_FEATURES)
def train_features_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 + S2 + F3 + J2 + F2 + A2 + A4: from trip files of all schema families to the feature frame."""
    files = list_trip_files(spark, write_family_files(spark, sf_dir))
    trips = training_trips_from_files(spark, files, adapter.zones(spark, sf_dir))
    return finalize_features(tumbling_partials(clean_training(trips)), digits=6)


@query("incremental_history", DUCK_FILE_FEATURES)
def incremental_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3: the same features from partials kept per file: a first load of every other file and of
    one that later vanishes, then an update that reads the other files only."""
    files, zones = list_trip_files(spark, write_family_files(spark, sf_dir)), adapter.zones(spark, sf_dir)
    extra, store = scratch_path(spark, "extra-trips"), scratch_path(spark, "history")
    spark.read.parquet(files[0]).write.parquet(extra)
    gone = list_trip_files(spark, extra)
    update_history(spark, files[::2] + gone, zones, store)
    change = update_history(spark, files, zones, store)
    if change.read != sorted(files[1::2]) or change.removed != sorted(gone):
        raise RuntimeError(f"the update read {len(change.read)} files, {len(change.removed)} went")
    return finalize_features(read_history(spark, store), digits=6)


@query(
    "csv_export",
    adapter.duck_with(base=("zones", "trips", "raw_wide"))
    + "select family, cast(count(*) as bigint) as rows, cast(sum(event_id) as double) as id_sum from raw_wide group by family",
)
def csv_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5: every parquet file of a folder exported once as CSV, read back per source file."""
    raw = adapter.raw_wide(spark, sf_dir)
    source, target = scratch_path(spark, "to-csv"), scratch_path(spark, "csv")
    raw.select("event_id", "family", "trip_distance").write.parquet(source)
    stems = export_csv(spark, source, target)
    if export_csv(spark, source, target):
        raise RuntimeError("finished files were exported again")
    back = spark.read.schema("event_id long, family string, trip_distance double").option("header", True).csv([f"{target}/{x}" for x in stems])
    return back.groupBy("family").agg(F.count(F.lit(1)).alias("rows"), F.sum("event_id").cast("double").alias("id_sum"))
