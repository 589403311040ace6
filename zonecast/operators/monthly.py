"""Monthly distributions (D2, D1): mergeable summaries of trips, stored per month and load, merged on read.

A summary row has counts and sums, fixed-bin histograms, exact zone counts (a bounded
domain) and KLL quantile sketches.  Every part is algebraic: summaries of loads merge to
the summary of all, so a new load reads only its own trips.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: measure -> (lower bound, upper bound, bins); a bin below and one above are added
BINS = {"total_amount": (0.0, 200.0, 40), "trip_distance": (0.0, 40.0, 40)}
#: KLL with its default size: rank error of a quantile with 99 % confidence
SKETCH_K, RANK_ERROR = 200, 0.0165
QUANTILES = (0.05, 0.25, 0.5, 0.75, 0.95)


def _bin(measure: str):
    lo, hi, n = BINS[measure]
    return F.width_bucket(measure, F.lit(lo), F.lit(hi), F.lit(n))


def summarize(trips: DataFrame, time_col: str = "pickup_datetime") -> DataFrame:
    """One summary per calendar month of ``time_col``; trips without that time are left out."""
    aggregates = [F.count("*").alias("trips")]
    for m, (_, _, n) in BINS.items():
        value = F.col(m)
        aggregates += [
            F.count(value).alias(f"{m}_n"), F.sum(value).alias(f"{m}_sum"), F.min(value).alias(f"{m}_min"), F.max(value).alias(f"{m}_max"),
            F.array(*(F.count_if(F.col(f"__{m}") == b) for b in range(n + 2))).alias(f"{m}_bins"),
            F.kll_sketch_agg_double(value, F.lit(SKETCH_K)).alias(f"{m}_sketch"),
        ]
    binned = trips.filter(F.col(time_col).isNotNull()).withColumns({f"__{m}": _bin(m) for m in BINS})
    return binned.groupBy(F.date_format(time_col, "yyyy-MM").alias("month")).agg(*aggregates)


def zone_counts(trips: DataFrame, time_col: str = "pickup_datetime", zone: str = "pu_location_id") -> DataFrame:
    """(month, zone, trips): the busiest-zone summary; zones x months rows, pre-aggregated, however skewed the trips are."""
    rows = trips.filter(F.col(time_col).isNotNull() & F.col(zone).isNotNull())
    return rows.groupBy(F.date_format(time_col, "yyyy-MM").alias("month"), F.col(zone).alias("zone")).agg(F.count("*").alias("trips"))


def merge_summaries(parts: DataFrame) -> DataFrame:
    """One summary per month from any number of partial ones."""
    aggregates = [F.sum("trips").alias("trips")]
    for m, (_, _, n) in BINS.items():
        aggregates += [
            F.sum(f"{m}_n").alias(f"{m}_n"), F.sum(f"{m}_sum").alias(f"{m}_sum"), F.min(f"{m}_min").alias(f"{m}_min"),
            F.max(f"{m}_max").alias(f"{m}_max"),
            F.array(*(F.sum(F.col(f"{m}_bins")[b]) for b in range(n + 2))).alias(f"{m}_bins"),
            F.kll_merge_agg_double(f"{m}_sketch").alias(f"{m}_sketch"),
        ]
    return parts.groupBy("month").agg(*aggregates)


def store_part(part: DataFrame, path: str, load_id: str) -> None:
    """Write one load's summaries under ``month=/load=``; a load that is delivered again replaces its own rows only."""
    (
        part.withColumn("load", F.lit(load_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("month", "load").parquet(path)
    )


def read_parts(spark: SparkSession, path: str, months: list[str] | None = None) -> DataFrame:
    """Stored summaries of all loads; ``months`` prunes the folders read."""
    parts = spark.read.option("basePath", path).parquet(path).withColumn("month", F.col("month").cast("string"))
    return parts.filter(F.col("month").isin(months)) if months else parts


def histograms(summaries: DataFrame) -> DataFrame:
    """(month, measure, bin, trips): bin 0 is below the first edge, the last above the last one; empty bins are left out."""
    each = F.array(*(F.struct(F.lit(m).alias("measure"), F.col(f"{m}_bins").alias("bins")) for m in BINS))
    rows = summaries.select("month", F.explode(each).alias("h"))
    return rows.select("month", "h.measure", F.posexplode("h.bins").alias("bin", "trips")).filter("trips > 0")


def quantiles(summaries: DataFrame, points: tuple[float, ...] = QUANTILES) -> DataFrame:
    """(month, measure, p, value): sketched quantiles, off by at most ``RANK_ERROR`` in rank (99 % of the time)."""
    each = F.array(*(
        F.struct(F.lit(m).alias("measure"), F.lit(p).alias("p"), F.kll_sketch_get_quantile_double(F.col(f"{m}_sketch"), F.lit(p)).alias("value"))
        for m in BINS for p in points
    ))
    return summaries.select("month", F.explode(each).alias("q")).select("month", "q.measure", "q.p", "q.value")


def busiest(counts: DataFrame, top: int = 15) -> DataFrame:
    """(month, rank, zone, trips): the ``top`` zones of each month, ties to the lower zone id."""
    total = counts.groupBy("month", "zone").agg(F.sum("trips").alias("trips"))
    order = Window.partitionBy("month").orderBy(F.desc("trips"), "zone")
    return total.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top).select("month", "rank", "zone", "trips")
