"""Incremental training history (A3): window partials kept per file, so that only new or changed files are read.

Partials lie under ``file=<key of the path>/stamp=<length and time>``.  A list of the files
that count is published by a rename when their partials are written; readers take what
it names, so an update that dies half way changes nothing.  Files that vanished or changed
leave the list, which subtracts their trips, and their partials are deleted.
"""

from __future__ import annotations

import hashlib
import json
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..operators.aggregate import merge_partials, tumbling_partials
from ..operators.quality import clean_training
from ..sources.files import training_trips_from_files
from .tables import _fs, _read_small, _write_small, delete_path, path_exists

FILES = "_files"
_FILE = "__file"
_LOCAL = r"^file:/+"


@dataclass(frozen=True)
class Change:
    """Files whose trips were read, files whose trips left, and files that stayed as they were."""

    read: list[str]
    removed: list[str]
    kept: list[str]


def _key(path: str) -> str:
    return hashlib.sha256(re.sub(_LOCAL, "/", path).encode()).hexdigest()[:16]


def identities(spark: SparkSession, files: list[str]) -> dict[str, str]:
    """path -> length and modification time, from the file system alone."""
    out = {}
    for f in files:
        fs, p = _fs(spark, f)
        status = fs.getFileStatus(p)
        out[f] = f"{status.getLen()}-{status.getModificationTime()}"
    return out


def known_files(spark: SparkSession, path: str) -> dict[str, str]:
    file = f"{path.rstrip('/')}/{FILES}"
    return json.loads(_read_small(spark, file)) if path_exists(spark, file) else {}


def update_history(spark: SparkSession, files: list[str], zones: DataFrame, path: str) -> Change:
    """Bring the stored partials at ``path`` to the state of ``files``, reading new and changed files only."""
    now, before = identities(spark, files), known_files(spark, path)
    fresh = sorted(f for f, stamp in now.items() if before.get(f) != stamp)
    trips = training_trips_from_files(spark, fresh, zones, file_col=_FILE) if fresh else None
    if trips is not None:
        stamps = spark.createDataFrame([(_key(f), now[f]) for f in fresh], "file string, stamp string")
        partials = tumbling_partials(clean_training(trips), by=[_FILE])
        plain = F.url_decode(F.regexp_replace(_FILE, r"\+", "%2B"))  # Spark reports paths as URLs
        keyed = partials.withColumn("file", F.substring(F.sha2(F.regexp_replace(plain, _LOCAL, "/"), 256), 1, 16)).drop(_FILE)
        (
            keyed.join(stamps, "file").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("file", "stamp").parquet(path)
        )
    fs, root = _fs(spark, path)
    fs.mkdirs(root)
    _write_small(spark, path, FILES, json.dumps(now))
    stale = sorted(f for f, stamp in before.items() if now.get(f) != stamp)
    for f in stale:
        gone = f"{path.rstrip('/')}/file={_key(f)}"
        delete_path(spark, f"{gone}/stamp={before[f]}" if f in now else gone)
    return Change(fresh, sorted(set(before) - set(now)), sorted(set(now) - set(fresh)))


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """(window, zone) partials merged over the files that count."""
    known = known_files(spark, path)
    counted = spark.createDataFrame([(_key(f), stamp) for f, stamp in known.items()], "file string, stamp string")
    fs, root = _fs(spark, path)
    if not any(st.getPath().getName().startswith("file=") for st in fs.listStatus(root)):
        shape = ", ".join(["window_start timestamp", "window_end timestamp", "pu_location_id int", "trip_count long", *(f"{c} double" for c in S.PARTIAL_SUMS[1:])])
        return spark.createDataFrame([], shape)
    stored = spark.read.parquet(path)
    stored = stored.withColumns({c: F.col(c).cast("string") for c in ("file", "stamp")})
    return merge_partials(stored.join(counted, ["file", "stamp"], "left_semi"))
