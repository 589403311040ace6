"""Trip files of drifting schemas (S1, S2) and the zone dimension CSV (S3).

* S1 ``list_trip_files``: parquet files under a prefix, sorted by path, optionally
  capped to the first ``max_files``; paths with a hidden part (``_temporary``,
  ``.tmp``) hold uncommitted data and are left out.
* S2: footers are read by executor tasks; only the distinct schemas with their
  file names and the names of unreadable files come back.  A file is usable when
  every required group has an alternative among its columns.  Files of one schema
  are read in one scan that prunes to the columns needed, projected to the
  canonical columns, and the families are unioned by name.  ``mergeSchema`` is
  not used: the same field changes type between years.
* S3 ``read_zone_csv``: explicit schema; a missing file falls back to the one
  default zone.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.numeric import parse_zone_id
from ..operators.geo import nearest_zone
from ..operators.normalize import canonical
from ..operators.quality import bbox_filter
from ..sinks.tables import _fs, path_exists


def list_trip_files(spark: SparkSession, root: str, max_files: int | None = None) -> list[str]:
    """Sorted parquet paths below ``root`` (recursive), first ``max_files``."""
    fs, p = _fs(spark, root)
    if not fs.exists(p):
        return []
    base = fs.getFileStatus(p).getPath().toString().rstrip("/")
    it = fs.listFiles(p, True)
    out = []
    while it.hasNext():
        path = it.next().getPath().toString()
        parts = path[len(base):].strip("/").split("/")
        if path.endswith(".parquet") and not any(x.startswith(("_", ".")) for x in parts):
            out.append(path)
    out.sort()
    return out[:max_files] if max_files is not None else out


# ---------------------------------------------------------------------------
# Which files are usable
# ---------------------------------------------------------------------------


def _any_of(names: list[str]) -> list[tuple[str, ...]]:
    return [(n,) for n in names]


#: a usable file has, for every group, all columns of at least one alternative
REQUIRED: dict[str, list[tuple[str, ...]]] = {
    "pickup time": _any_of(S.PICKUP_ALIASES),
    "dropoff time": _any_of(S.DROPOFF_ALIASES),
    "distance": _any_of(S.DISTANCE_ALIASES),
    "amount": _any_of(S.AMOUNT_ALIASES),
    "pickup place": _any_of(S.PU_LOCATION_ALIASES) + [(S.PICKUP_LAT_ALIASES[0], S.PICKUP_LON_ALIASES[0])],
}
TRAINING = {"tip": _any_of(S.TIP_ALIASES)}
OPTIONAL = S.PASSENGER_ALIASES + S.DO_LOCATION_ALIASES + S.DROPOFF_LAT_ALIASES + S.DROPOFF_LON_ALIASES + S.TIP_ALIASES


def missing_groups(names: set[str], need_tip: bool = True) -> list[str]:
    """The required groups that no alternative among ``names`` fills."""
    groups = REQUIRED | (TRAINING if need_tip else {})
    return [g for g, ways in groups.items() if not any(names.issuperset(w) for w in ways)]


def needed_columns(names: set[str], need_tip: bool = True) -> list[str] | None:
    """The columns to read from a file, or None when it is unusable."""
    if missing_groups(names, need_tip):
        return None
    known = [c for ways in REQUIRED.values() for way in ways for c in way] + OPTIONAL
    return [c for c in dict.fromkeys(known) if c in names]


@dataclass
class FileFamilies:
    """Files by schema ((name, type) pairs), and the files whose footer cannot be read."""

    groups: dict[tuple[tuple[str, str], ...], list[str]]
    unreadable: list[str]


_FOOTER = pa.schema([("path", pa.string()), ("columns", pa.string()), ("status", pa.string())])


def _footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import pyarrow.parquet as pq
    from pyarrow import fs as pafs

    for b in batches:
        rows = []
        for path in b.column("path").to_pylist():
            columns, status = None, "ok"
            try:
                if path.startswith("file:"):
                    store, inner = pafs.LocalFileSystem(), "/" + path[len("file:"):].lstrip("/")
                else:
                    store, inner = pafs.FileSystem.from_uri(path)
            except (pa.ArrowInvalid, OSError):
                status = "store"  # a store that only Spark's readers open
            else:
                try:
                    columns = json.dumps([[f.name, str(f.type)] for f in pq.read_schema(inner, filesystem=store)])
                except (pa.ArrowInvalid, OSError):
                    status = "unreadable"
            rows.append((path, columns, status))
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows)] if rows else
                                         [pa.array([], pa.string())] * 3, schema=_FOOTER)


def file_families(spark: SparkSession, files: list[str], files_per_task: int = 200) -> FileFamilies:
    """Group ``files`` by footer schema; footers are read in executor tasks.

    Files in a store that Arrow cannot open are read one by one through Spark,
    with its credentials.  Unreadable files are reported, never fatal.
    """
    if not files:
        return FileFamilies({}, [])
    paths = spark.createDataFrame([(f,) for f in files], "path string")
    tasks = max(1, min(len(files), -(-len(files) // files_per_task), 10_000), min(len(files), spark.sparkContext.defaultParallelism))
    read = paths.repartition(tasks).mapInArrow(_footers, "path string, columns string, status string")
    # one row per distinct schema: its text comes to the driver once, with the paths that have it
    rows = read.groupBy("status", "columns").agg(F.collect_list("path").alias("paths")).collect()
    groups: dict[tuple, list[str]] = {}
    unreadable = []
    for r in rows:
        if r.status == "store":
            for path in r.paths:
                try:
                    fields = spark.read.parquet(path).schema.fields
                    groups.setdefault(tuple((f.name, f.dataType.simpleString()) for f in fields), []).append(path)
                except Exception:  # noqa: BLE001 - any unreadable file is reported
                    unreadable.append(path)
        elif r.status == "unreadable":
            unreadable += r.paths
        else:
            groups.setdefault(tuple(map(tuple, json.loads(r.columns))), []).extend(r.paths)
    groups = {key: sorted(group) for key, group in groups.items()}
    unreadable.sort()
    return FileFamilies(groups, unreadable)


def _usable(families: FileFamilies, need_tip: bool):
    for key, group in sorted(families.groups.items(), key=lambda kv: kv[1][0]):
        names = {n for n, _ in key}
        columns = needed_columns(names, need_tip)
        if columns is not None:
            yield names, columns, group


def _union(frames: list[DataFrame]) -> DataFrame | None:
    out = None
    for f in frames:
        out = f if out is None else out.unionByName(f, allowMissingColumns=True)
    return out


def read_trip_files(
    spark: SparkSession,
    files: list[str],
    need_tip: bool = True,
    keep: list[str] | None = None,
    by_schema: bool = False,
) -> DataFrame | None:
    """Usable files of every schema family as one canonical frame (None if none).

    Aliases are resolved row by row, or with ``by_schema`` once per file, as the
    trainer does.
    """
    keep = keep or []
    frames = []
    for names, columns, group in _usable(file_families(spark, files), need_tip):
        own = [c for c in keep if c in names]
        frames.append(canonical(spark.read.parquet(*group).select(*own, *columns), own, by_schema))
    return _union(frames)


def training_trips_from_files(
    spark: SparkSession, files: list[str], zones: DataFrame, keep: list[str] | None = None, file_col: str | None = None
) -> DataFrame | None:
    """S2 + F3 + J2: trips of the usable files with a pickup zone, in the trainer's columns.

    A file with a zone id column uses it (rows without a valid id have none and
    fail F2); a file with coordinates only is cut to the city box and snapped to
    the nearest zone by great-circle distance.  ``file_col``: name of a column with the
    path of each row's file.
    """
    keep = keep or []
    frames = []
    for names, columns, group in _usable(file_families(spark, files), need_tip=True):
        own = [c for c in keep if c in names]
        source = [F.col("_metadata.file_path").alias(file_col)] if file_col else []
        raw = spark.read.parquet(*group).select(*own, *source, *columns)
        own += [file_col] if file_col else []
        rows = canonical(raw, own, by_schema=True)
        if names.intersection(S.PU_LOCATION_ALIASES):
            rows = rows.withColumn("pu_location_id", parse_zone_id("pu_location_raw"))
        else:
            rows = nearest_zone(bbox_filter(rows), zones, "pickup_latitude", "pickup_longitude", "pu_location_id", "haversine")
        frames.append(rows.select(
            *own, F.col("pickup_datetime").alias("pickup_ts"), F.col("dropoff_datetime").alias("dropoff_ts"),
            "trip_distance", F.col("pu_location_id").cast("int").alias("pu_location_id"), "total_amount", "tip_amount",
        ))
    return _union(frames)


def read_zone_csv(spark: SparkSession, path: str) -> DataFrame:
    """S3: zone dimension CSV; a missing file gives the single default zone."""
    if not path_exists(spark, path):
        return spark.range(1).select(
            F.lit(S.DEFAULT_ZONE).cast("int").alias("location_id"),
            F.lit(None).cast("string").alias("zone_name"),
            F.lit(S.DEFAULT_ZONE_LAT).alias("latitude"),
            F.lit(S.DEFAULT_ZONE_LON).alias("longitude"),
        )
    return spark.read.schema(S.ZONE_SCHEMA).option("header", True).csv(path)
