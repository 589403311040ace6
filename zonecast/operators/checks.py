"""Freshness and row-count checks (D3) that read no table data.

The newest partition comes from folder names, row counts from file footers (a count over
a Parquet scan with an empty read schema); only where a time inside the newest partition
is wanted, that one column of that one partition is read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def stored_rows(spark: SparkSession, path: str) -> DataFrame:
    """(rows) of a Parquet table, from its footers."""
    return spark.read.parquet(path).agg(F.count("*").alias("rows"))


def newest_partition(spark: SparkSession, path: str, partition: str) -> DataFrame:
    """(value) of the newest ``partition``, from folder names: the scan has no data column."""
    return spark.read.parquet(path).select(partition).agg(F.max(partition).alias("value"))


def newest_time(spark: SparkSession, path: str, partition: str, time_col: str) -> DataFrame:
    """(value): the newest ``time_col``, read from the newest partition alone (which holds it, as partitions follow time)."""
    newest = newest_partition(spark, path, partition).scalar()
    return spark.read.parquet(path).filter(F.col(partition) == newest).agg(F.max(time_col).alias("value"))


def freshness(spark: SparkSession, path: str, partition: str, time_col: str, as_of: Column, limit_minutes: int) -> DataFrame:
    """(newest, age_minutes, fresh) of a table whose ``partition`` follows ``time_col``; an empty table is not fresh."""
    age = (F.unix_micros(as_of) - F.unix_micros("value")) / 6e7
    return newest_time(spark, path, partition, time_col).select(
        F.col("value").alias("newest"), age.alias("age_minutes"), F.coalesce(age <= limit_minutes, F.lit(False)).alias("fresh")
    )


def row_count_check(spark: SparkSession, path: str, expected: Column, name: str = "rows") -> DataFrame:
    """(check, rows, expected, passed): whether a stored table has exactly the rows that it should have."""
    return stored_rows(spark, path).select(
        F.lit(name).alias("check"), "rows", expected.cast("long").alias("expected"), (F.col("rows") == expected).alias("passed")
    )
