"""Helpers shared by the operators: shared-folder files, Arrow rows, code shipping."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructField, StructType

from ..session import scratch_path

_SHIPPED: set[str] = set()


def ready(spark: SparkSession, rows_per_batch: int = 1000) -> None:
    """Small Arrow batches, in rows and bytes (whole texts can be long), and our code on the executors.

    Where the package folder is on PYTHONPATH the workers import it from there;
    otherwise it is sent along once per application.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows_per_batch))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    app = spark.sparkContext.applicationId
    if app in _SHIPPED or root in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    _SHIPPED.add(app)
    target = os.path.join(tempfile.mkdtemp(prefix="zonecast-code-"), "zonecast_code.zip")
    with zipfile.ZipFile(target, "w") as z:
        for top, _, names in os.walk(os.path.join(root, "zonecast")):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(top, name)
                    z.write(full, os.path.relpath(full, root))
    spark.sparkContext.addPyFile(target)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    The committed files fix the row order and every task's partition number, so
    retried or speculative tasks downstream always see the same rows.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def key_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the two columns an operator needs, under fixed names; null text is empty.

    Any other column of ``docs``, whatever its name, is left out here, so it
    cannot clash with the columns the operator adds.
    """
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )


def hash_sample(rows: DataFrame, key: str, n: int) -> list:
    """At most ``n`` rows of distinct ``key``, those of smallest hash of the key, in that order.

    Only about 1.2 n rows leave the tasks, whatever the table's size.
    """
    span = 1 << 40
    hashed = rows.withColumn("__hash", F.pmod(F.xxhash64(key), F.lit(span)))
    total = rows.count()
    if total > 2 * n:
        hashed = hashed.filter(F.col("__hash") < int(span * 1.2 * n / total))
    return sorted(hashed.collect(), key=lambda r: (r["__hash"], r[key]))[:n]


def one_text_each(rows: DataFrame) -> DataFrame:
    """(id, text) with one row per id, its text of smallest hash: what a sample of ids brings to the driver is bounded by the ids."""
    least = F.min(F.struct(F.xxhash64("text").alias("h"), F.col("text").alias("text")))
    return rows.groupBy("id").agg(least.alias("t")).select("id", F.col("t.text").alias("text"))


def batch(schema: pa.Schema, columns: dict[str, object]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, type=schema.field(n).type)
         for n, c in ((n, columns[n]) for n in schema.names)],
        schema=schema,
    )


def annotate(docs: DataFrame, text_col: str, make, fields: list[StructField]) -> DataFrame:
    """``docs`` as one struct column ``whole`` beside new ``fields``, computed from the text.

    ``make()`` is called once in each task and gives a function from a list of
    texts as UTF-8 bytes (null stays None) to a dict of arrays.  The input's
    columns stay inside the struct, so none of them can clash with a new one.
    """
    ready(docs.sparkSession)
    schema = StructType([StructField("whole", docs.schema, False), *fields])
    position = docs.columns.index(text_col)
    inner = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("whole"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = make()
        for b in slices(batches):
            whole = b.column(0)
            new = compute(whole.field(position).cast(pa.binary()).to_pylist())
            kinds = [to_arrow_type(f.dataType) for f in fields]
            yield pa.RecordBatch.from_arrays(
                [whole, *(pa.array(new[f.name], type=k) for f, k in zip(fields, kinds))],
                names=["whole", *(f.name for f in fields)],
            )

    return inner.mapInArrow(run, schema)


def unwrapped(docs: DataFrame) -> list:
    """The columns of ``docs`` out of ``whole``, to select from an annotated frame."""
    return [F.col(f"whole.`{c}`").alias(c) for c in docs.columns]


def slices(batches: Iterable[pa.RecordBatch], max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in pieces of at most about ``max_bytes`` (one row at least)."""
    for b in batches:
        if b.num_rows <= 1 or b.nbytes <= max_bytes:
            if b.num_rows:
                yield b
            continue
        half = b.num_rows // 2
        yield from slices([b.slice(0, half)], max_bytes)
        yield from slices([b.slice(half)], max_bytes)


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a shared folder; a plain path is a mounted folder."""
    if "://" not in uri and not uri.startswith("file:"):
        return pafs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[len("file:"):].lstrip("/")
    return pafs.FileSystem.from_uri(uri)


class RollingFiles:
    """Binary files of one task in a shared folder, a new one after ``roll_bytes``.

    Names carry the task attempt, so a retried or speculative attempt never
    touches another's files.  Only files named in rows that Spark commits (the
    index) count; what a lost attempt left behind is never read.
    """

    def __init__(self, folder: str, suffix: str, roll_bytes: int):
        from pyspark import TaskContext

        ctx = TaskContext.get()
        self.part = ctx.partitionId()
        self.fs, self.folder = open_fs(folder)
        self.fs.create_dir(self.folder, recursive=True)
        self.stem = f"part-{self.part:07d}-{ctx.taskAttemptId()}"
        self.suffix, self.roll_bytes = suffix, roll_bytes
        self.number, self.at, self.out, self.name = -1, 0, None, ""

    def write(self, data: bytes) -> tuple[str, int]:
        """Append ``data`` whole to one file; the file's name and the offset there."""
        if self.out is None or (self.at and self.at + len(data) > self.roll_bytes):
            self.close()
            self.number += 1
            self.name, self.at = f"{self.stem}-{self.number:05d}{self.suffix}", 0
            self.out = self.fs.open_output_stream(f"{self.folder}/{self.name}", compression=None)
        at = self.at
        self.out.write(data)
        self.at += len(data)
        return self.name, at

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None


def with_offsets(parts: DataFrame, order: list[str], totals: list[str]) -> DataFrame:
    """Exclusive prefix sums of ``totals`` over a table of one row per partition.

    The single-task window is over partition totals only: its row count is the
    number of partitions or files, never the number of records.
    """
    from pyspark.sql import Window

    w = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return parts.select(
        "*", *(F.coalesce(F.sum(t).over(w), F.lit(0)).cast("long").alias(f"{t}_before") for t in totals)
    )
