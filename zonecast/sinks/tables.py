"""Table sinks: keyed upsert (K1), live append by emit hour + retention (K2),
versioned snapshot (K3), CSV export (K5), metrics document (K6).

All writers are Spark jobs over DataFrames; nothing is collected to the driver
except file-system metadata (paths, partition values).
"""

from __future__ import annotations

import json
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..operators.select import latest_per_key


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def list_files(spark: SparkSession, directory: str, suffix: str) -> list[str]:
    """Sorted file paths under ``directory`` ending in ``suffix`` (skips '._*' and hidden)."""
    fs, p = _fs(spark, directory)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isFile() and name.endswith(suffix) and not name.startswith(("._", ".", "_")):
            out.append(st.getPath().toString())
    return sorted(out)


def list_folders(spark: SparkSession, directory: str, prefix: str) -> list[str]:
    """Sorted paths of the folders in ``directory`` whose names start with ``prefix``."""
    fs, p = _fs(spark, directory)
    if not fs.exists(p):
        return []
    return sorted(
        f"{directory.rstrip('/')}/{st.getPath().getName()}" for st in fs.listStatus(p)
        if st.isDirectory() and st.getPath().getName().startswith(prefix)
    )


# ---------------------------------------------------------------------------
# K1: keyed upsert, last write wins
# ---------------------------------------------------------------------------


def run_id_of(spark: SparkSession, checkpoint: str) -> str:
    """The id that Structured Streaming gave to a checkpoint when it was first started."""
    line = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()
    return json.loads(line[0])["id"]


def upsert_latest(
    spark: SparkSession,
    batch_df: DataFrame,
    batch_id: int,
    path: str,
    keys: list[str] | None = None,
    partition: str = "service_date",
    run_id: str = "",
) -> None:
    """Merge ``batch_df`` into the parquet table at ``path`` by ``keys``: the last write wins.

    * empty batch -> no-op;
    * only partitions touched by the batch are read (partition filter on the
      batch's distinct partition values) and rewritten (dynamic partition
      overwrite);
    * a batch's row replaces the stored row of its key.  Batch numbers are
      compared only within one ``run_id`` (one checkpoint), where an older batch
      that is delivered again does not undo a newer one; a new checkpoint, whose
      numbers start at 0 again, always wins.  Delivering a batch twice changes
      nothing;
    * dynamic partition overwrite writes into a staging folder and replaces
      the touched partitions only at job commit, after every task has read
      the old rows; a task lost mid-job is retried against unchanged files.
    """
    keys = keys or S.AGG_KEYS
    new = batch_df.withColumn("batch_id", F.lit(int(batch_id)).cast("long")).withColumn("run_id", F.lit(run_id))
    new.persist()  # read twice: for its partition values and for the merge
    try:
        _merge(spark, new, batch_id, path, keys, partition, run_id)
    finally:
        new.unpersist()


def _merge(spark: SparkSession, new: DataFrame, batch_id: int, path: str, keys: list[str], partition: str, run_id: str) -> None:
    # partition values touched by this micro-batch: a few dates, metadata sized;
    # none means an empty batch.  As a literal IN-list they prune the scan below.
    touched = [r[0] for r in new.select(partition).distinct().toLocalIterator()]
    if not touched:
        return
    both = new.withColumn("__rank", F.lit(1))
    if path_exists(spark, path):
        old = spark.read.parquet(path).filter(F.col(partition).isin(touched)).select(*new.columns)
        later = (F.col("run_id") == run_id) & (F.col("batch_id") > int(batch_id))
        both = both.unionByName(old.withColumn("__rank", F.when(later, 2).otherwise(0)))
    merged = latest_per_key(both, keys, ["__rank"]).drop("__rank")
    (
        merged.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )


def read_upserted(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("batch_id", "run_id")


# ---------------------------------------------------------------------------
# K2: live rows appended by emit hour, bounded by retention
# ---------------------------------------------------------------------------

HOUR_FORMAT = "yyyy-MM-dd_HH"
_LIVE_PARTITIONS = ["emit_hour", "run_id", "batch_id"]
#: file with the arrival time (epoch microseconds) before which rows have expired
CUTOFF = "_cutoff"


def append_batch(batch_df: DataFrame, batch_id: int, path: str, run_id: str = "0", time_col: str = "emitted_at") -> None:
    """Write one micro-batch under ``emit_hour=/run_id=/batch_id=`` (dynamic overwrite).

    A batch that is delivered again replaces its own rows only; a new checkpoint
    has another ``run_id``, so its batch 0 replaces nothing.  Rows are rebalanced by
    hour: one file an hour, more where an hour holds many rows, each sorted by
    arrival, so that a bound on the arrival time skips row groups inside an hour.
    """
    (
        batch_df.withColumn("emit_hour", F.date_format(time_col, HOUR_FORMAT))
        .hint("rebalance", F.col("emit_hour"))
        .withColumn("run_id", F.lit(run_id))
        .withColumn("batch_id", F.lit(int(batch_id)).cast("long"))
        .sortWithinPartitions(*_LIVE_PARTITIONS, time_col)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*_LIVE_PARTITIONS)
        .parquet(path)
    )


def _utc(moment: datetime) -> datetime:
    """A naive datetime is taken as UTC."""
    return moment.astimezone(timezone.utc) if moment.tzinfo else moment.replace(tzinfo=timezone.utc)


def _hour(moment: datetime) -> str:
    """Folder text of a moment; folders are named in UTC."""
    return _utc(moment).strftime("%Y-%m-%d_%H")


def retention_cutoff(spark: SparkSession, path: str) -> datetime | None:
    """The arrival time before which the table's rows have expired; None if it was never pruned."""
    file = f"{path.rstrip('/')}/{CUTOFF}"
    if not path_exists(spark, file):
        return None
    return datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(microseconds=int(_read_small(spark, file)))


def read_live(spark: SparkSession, path: str, since: datetime | None = None, time_col: str = "emitted_at") -> DataFrame:
    """The live rows: expired ones are left out, wherever their hour's folder still stands.

    ``since`` restricts the scan to newer arrivals (rows without an arrival time
    are then left out; retention alone keeps them, as no time comparison reaches them).
    """
    table = spark.read.parquet(path)
    cutoff = retention_cutoff(spark, path)
    if cutoff is not None:
        fresh = (F.col("emit_hour") >= _hour(cutoff)) & (F.col(time_col) >= F.lit(cutoff))
        table = table.filter(F.col(time_col).isNull() | fresh)
    if since is not None:
        table = table.filter((F.col("emit_hour") >= _hour(since)) & (F.col(time_col) >= F.lit(_utc(since))))
    return table.drop(*_LIVE_PARTITIONS)


def within_retention(df: DataFrame, as_of, minutes: int = S.LIVE_RETENTION_MIN, col: str = "emitted_at") -> DataFrame:
    """Rows no older than ``minutes`` before ``as_of`` (a Column or timestamp literal)."""
    cutoff = as_of - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes))
    return df.filter(F.col(col) >= cutoff)


def prune_expired(spark: SparkSession, path: str, as_of: datetime, minutes: int = S.LIVE_RETENTION_MIN) -> int:
    """Expire rows that arrived over ``minutes`` before ``as_of``; how many hour folders went.

    The cutoff is noted beside the table (it never moves back) and holds for every
    reader at once; folders whose whole hour lies before it are deleted.  Only folder
    names are read, and retention itself bounds their number.  Rows without an
    arrival time stay, and so do rows of the future.
    """
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return 0
    cutoff = max(filter(None, (_utc(as_of) - timedelta(minutes=minutes), retention_cutoff(spark, path))))
    since = cutoff - datetime(1970, 1, 1, tzinfo=timezone.utc)
    _write_small(spark, path, CUTOFF, str(since // timedelta(microseconds=1)))
    oldest = _hour(cutoff)
    gone = 0
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        hour = name.removeprefix("emit_hour=")
        if name != hour and hour[:1].isdigit() and hour < oldest:
            gone += bool(fs.delete(st.getPath(), True))
    return gone


def _read_small(spark: SparkSession, file: str) -> str:
    """The text of a small file, hidden or not."""
    fs, p = _fs(spark, file)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").strip()
    finally:
        stream.close()


def _write_small(spark: SparkSession, folder: str, name: str, text: str) -> None:
    """Put a small file in place by a rename, so that no reader sees half of it."""
    jvm = spark.sparkContext._jvm
    fs, root = _fs(spark, folder)
    temporary, final = jvm.org.apache.hadoop.fs.Path(root, f"_{name}.{uuid.uuid4().hex[:8]}"), jvm.org.apache.hadoop.fs.Path(root, name)
    out = fs.create(temporary, True)
    out.write(bytearray(text.encode()))
    out.close()
    if fs.exists(final):
        fs.delete(final, False)
    fs.rename(temporary, final)


# ---------------------------------------------------------------------------
# K3 / K5 / K6
# ---------------------------------------------------------------------------


CURRENT = "CURRENT"


def write_snapshot(df: DataFrame, path: str) -> None:
    """K3: replace the whole table.

    Rows go to a new version folder; then a pointer file is switched to it by one
    rename.  Readers see the old version until then, and a crash leaves it whole.
    Versions older than the one before are deleted.
    """
    spark = df.sparkSession
    version = f"v-{int(time.time() * 1000):015d}-{uuid.uuid4().hex[:8]}"
    df.write.parquet(f"{path.rstrip('/')}/{version}")
    jvm = spark.sparkContext._jvm
    fs, root = _fs(spark, path)
    _write_small(spark, path, CURRENT, version)
    old = sorted(st.getPath().getName() for st in fs.listStatus(root) if st.getPath().getName().startswith("v-"))
    for name in old[:-2]:
        fs.delete(jvm.org.apache.hadoop.fs.Path(root, name), True)


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The current version; while the pointer is being switched, the newest complete one."""
    fs, root = _fs(spark, path)
    jvm = spark.sparkContext._jvm
    if fs.exists(jvm.org.apache.hadoop.fs.Path(root, CURRENT)):
        version = _read_small(spark, f"{path.rstrip('/')}/{CURRENT}")
    else:
        version = max(
            st.getPath().getName() for st in fs.listStatus(root)
            if st.getPath().getName().startswith("v-")
            and fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS"))
        )
    return spark.read.parquet(f"{path.rstrip('/')}/{version}")


def export_csv(spark: SparkSession, input_dir: str, output_dir: str, at_once: int = 8) -> list[str]:
    """K5: one CSV directory per parquet file stem; finished stems are skipped;
    '._*' files are ignored.  A target counts as finished only with its
    ``_SUCCESS`` mark; a half-written one is written anew.  Files may differ in
    schema, so each is a job of its own, ``at_once`` of them side by side."""
    target = lambda f: f"{output_dir.rstrip('/')}/{f.rsplit('/', 1)[-1][: -len('.parquet')]}"
    todo = [f for f in list_files(spark, input_dir, ".parquet") if not path_exists(spark, f"{target(f)}/_SUCCESS")]

    def export(f: str) -> str:
        spark.read.parquet(f).write.mode("overwrite").option("header", True).csv(target(f))
        return target(f).rsplit("/", 1)[-1]

    with ThreadPoolExecutor(max_workers=at_once) as pool:
        return list(pool.map(export, todo))


def write_metrics_json(spark: SparkSession, metrics: dict, path: str) -> DataFrame:
    """K6: a metrics document as one JSON row (nested structs / arrays kept)."""
    doc = spark.createDataFrame([(json.dumps(metrics),)], "doc string")
    schema = spark.range(1).select(F.schema_of_json(F.lit(json.dumps(metrics)))).first()[0]
    out = doc.select(F.from_json("doc", schema).alias("m")).select("m.*")
    out.coalesce(1).write.mode("overwrite").json(path)
    return out
