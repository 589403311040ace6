"""Session construction and shared scratch locations."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "zonecast",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session with the settings every plan in this package assumes.

    * UTC session clock (window bounds, dates and text formats are UTC).
    * AQE on: partition coalescing, skew-join splitting and runtime broadcast
      choice are made from measured sizes rather than guesses.
    * UI off (no server ports).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the runtime settings our plans rely on, on any (e.g. driver-provided) session."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for written tables and stream checkpoints.

    Reads ``spark.checkpoint.dir`` (or the SparkContext checkpoint dir) from the
    session.  Only where neither is set and everything runs in this process
    (``local`` masters: tests) a local temp folder is created and registered; on a
    cluster that would be a folder the executors cannot see, so it is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if master.split("[")[0] != "local":
            raise RuntimeError(f"set spark.checkpoint.dir to a folder shared by all executors (master {master})")
        root = tempfile.mkdtemp(prefix="zonecast-")
        spark.sparkContext.setCheckpointDir(root)
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


#: folders handed out per application, for ``clear_scratch``
_HANDED_OUT: dict[str, list[str]] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-path of the shared scratch root."""
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    _HANDED_OUT.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def clear_scratch(spark: SparkSession) -> int:
    """Delete the folders that this application got from ``scratch_path``; how many existed.

    Frames that still read them stop working: call it when a job's results are
    written.
    """
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    gone = 0
    for path in _HANDED_OUT.pop(spark.sparkContext.applicationId, []):
        p = jvm.org.apache.hadoop.fs.Path(path)
        gone += bool(p.getFileSystem(conf).delete(p, True))
    return gone


def materialize(df, name: str = "stage"):
    """Compute a small intermediate once into reliable storage
    (``spark.checkpoint.dir``) and return a frame reading it back.

    For aggregates and feature tables (zones x windows), never for whole inputs.
    Lineage is cut: later uses (scalar subqueries, self-joins, iterations) read
    the stored rows instead of rescanning the raw input, and a lost executor
    recomputes from that copy.  With
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` Spark deletes the files
    once the frame is no longer referenced.
    """
    root = scratch_root(df.sparkSession)
    if not df.sparkSession.sparkContext.getCheckpointDir():
        df.sparkSession.sparkContext.setCheckpointDir(root)
    return df.checkpoint(eager=True)


def scale_settings(shuffle_bytes: int, total_cores: int, target_partition_mb: int = 256) -> dict[str, str]:
    """Session settings for a job whose largest exchange moves ``shuffle_bytes``.

    * file splits of 256 MB: a 100 TB scan becomes about 400,000 tasks, several
      waves on 1,000 executors, each split small enough to decode in memory;
    * initial shuffle width from what is shuffled, not from what is read:
      aggregates here shrink to zones x windows before the exchange, and
      mappers x reducers blocks must be tracked.  Three waves of the cores at
      least, and AQE coalesces small partitions toward the advisory size;
    * skew join / skewed partition splitting above 4x the median and 1 GB;
    * stateful streaming: RocksDB state store (state larger than executor heap).
    """
    mb = 1024 * 1024
    parts = max(min(total_cores * 3, 20_000), int(shuffle_bytes // (target_partition_mb * mb)) + 1)
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_mb * mb),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_mb * mb),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1024 * mb),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * mb),
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
