"""Token sequences as length-delimited binary records with a separate offset index.

Record: 8-byte length, masked CRC-32C of the length, payload, masked CRC-32C of
the payload (all little-endian).  Payload: document id (8 bytes), flags (4 bytes,
1: the id is null), bytes per token id (4 bytes), then the ids.  The index, a
Parquet table written by Spark's committer, has one row per record with file and
offset; only what it names is part of the data set, so files of lost task
attempts are harmless, and a shuffled reader can fetch any record alone.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import RollingFiles, batch, key_and_text, open_fs, ready, slices, with_offsets
from .crc32c import crc32c, masked
from .tokens import tokenizer

_HEAD = struct.Struct("<qII")
_LENGTH = struct.Struct("<Q")
_CHECK = struct.Struct("<I")
FRAME = _LENGTH.size + 2 * _CHECK.size

_INDEX = pa.schema([
    ("part", pa.int32()), ("record", pa.int64()), ("doc_id", pa.int64()), ("file", pa.string()),
    ("offset", pa.int64()), ("length", pa.int64()), ("n_tokens", pa.int64()),
])
_INDEX_DDL = "part int, record long, doc_id long, file string, offset long, length long, n_tokens long"
_READ = pa.schema([
    ("file", pa.string()), ("offset", pa.int64()), ("doc_id", pa.int64()), ("local_start", pa.int64()),
    ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("ids", pa.binary()),
])
_READ_DDL = "file string, offset long, doc_id long, local_start long, n_tokens long, ids_crc32 long, ids binary"


class DamagedRecord(ValueError):
    """A length or payload checksum of a record file does not hold."""


def payload(key: int | None, ids: bytes, width: int) -> bytes:
    body = ids if width == 4 else np.frombuffer(ids, "<u4").astype("<u2").tobytes()
    return _HEAD.pack(0 if key is None else key, key is None, width) + body


def frame(payloads: list[bytes]) -> list[bytes]:
    lengths = [_LENGTH.pack(len(p)) for p in payloads]
    checks = masked(crc32c(lengths + payloads)).tolist()
    k = len(payloads)
    return [b"".join((length, _CHECK.pack(checks[i]), p, _CHECK.pack(checks[k + i])))
            for i, (length, p) in enumerate(zip(lengths, payloads))]


def unframe(stream, name: str, chunk: int = 4 << 20) -> Iterator[tuple[list[int], list[bytes]]]:
    """Offsets and payloads of a record file, checked, some megabytes at a time."""
    offsets, heads, payloads, checks, held, at = [], [], [], [], 0, 0

    def checked():
        found = masked(crc32c(heads + payloads)).tolist()
        if found != checks[0::2] + checks[1::2]:
            raise DamagedRecord(f"{name}: a record from offset {offsets[0]} to {offsets[-1]}")
        return offsets, payloads

    while head := stream.read(_LENGTH.size + _CHECK.size):
        if len(head) != _LENGTH.size + _CHECK.size:
            raise DamagedRecord(f"{name}: cut short at offset {at}")
        length, check = _LENGTH.unpack(head[:8])[0], _CHECK.unpack(head[8:])[0]
        if length > chunk and int(masked(crc32c([head[:8]]))[0]) != check:
            raise DamagedRecord(f"{name}: length at offset {at}")  # before memory is taken for it
        body = stream.read(length + _CHECK.size)
        if len(body) != length + _CHECK.size:
            raise DamagedRecord(f"{name}: cut short at offset {at}")
        offsets.append(at)
        heads.append(head[:8])
        payloads.append(body[:length])
        checks += [check, _CHECK.unpack(body[length:])[0]]
        at += length + FRAME
        held += length
        if held >= chunk:
            yield checked()
            offsets, heads, payloads, checks, held = [], [], [], [], 0
    if offsets:
        yield checked()


def _write(folder: str, tokenizer_path: str, style: str, end_id: int, width: int, roll_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, files, record = tokenizer(tokenizer_path, style), RollingFiles(folder, ".rec", roll_bytes), 0
        end = np.asarray([end_id], "<u4").tobytes()
        try:
            for b in slices(batches, 4 << 20):
                keys = b.column("doc_id").to_pylist()
                ids = [x + end for x in tok.encode(b.column("text").to_pylist())]
                framed = frame([payload(key, x, width) for key, x in zip(keys, ids)])
                at = [files.write(x) for x in framed]
                yield batch(_INDEX, {
                    "part": np.full(len(keys), files.part, np.int32), "record": np.arange(record, record + len(keys)),
                    "doc_id": keys, "file": [a for a, _ in at], "offset": [a for _, a in at],
                    "length": [len(x) for x in framed], "n_tokens": [len(x) // 4 for x in ids],
                })
                record += len(keys)
        finally:
            files.close()

    return run


def write_records(
    docs: DataFrame, folder: str, tokenizer_path: str, *, style: str = "dropped", end_id: int = 2,
    vocab_size: int = 49408, roll_bytes: int = 64 << 20, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Write every document's ids as records in ascending ``id_col`` order; the index.

    ``folder`` gets ``records/`` and ``index/`` and must be visible to all
    executors.  Rows are range-partitioned by id, with a row number behind it so
    that one id on many rows is still dealt over several tasks; within a task
    they are sorted.  Null ids come first (and read back as null), equal ids
    stand together in any order, null text is empty (one record with the end
    id).  Other columns are ignored; an empty table gives an empty index.
    """
    spark = docs.sparkSession
    ready(spark)
    width = 2 if vocab_size <= 1 << 16 else 4
    ordered = (
        key_and_text(docs, id_col, text_col)
        .withColumn("row", F.monotonically_increasing_id())
        .repartitionByRange("doc_id", "row")
        .sortWithinPartitions("doc_id", "row")
        .select("doc_id", "text")
    )
    index = ordered.mapInArrow(
        _write(f"{folder}/records", tokenizer_path, style, end_id, width, roll_bytes), _INDEX_DDL
    )
    index.write.option("compression", "zstd").parquet(f"{folder}/index")
    return read_index(spark, folder)


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(_INDEX_DDL).parquet(f"{folder}/index")


def parse(data: bytes) -> tuple[int | None, np.ndarray]:
    key, null, width = _HEAD.unpack_from(data)
    return None if null else key, np.frombuffer(data, f"<u{width}", offset=_HEAD.size).astype("<u4")


def _read(folder: str, keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = open_fs(f"{folder}/records")
        for b in batches:
            for name in b.column("file").to_pylist():
                start = 0
                with fs.open_input_stream(f"{path}/{name}", compression=None, buffer_size=1 << 20) as stream:
                    for offsets, payloads in unframe(stream, name):
                        rows = [parse(p) for p in payloads]
                        n = np.asarray([len(x) for _, x in rows], np.int64)
                        yield batch(_READ, {
                            "file": [name] * len(rows), "offset": offsets, "doc_id": [k for k, _ in rows],
                            "local_start": start + np.cumsum(n) - n, "n_tokens": n,
                            "ids_crc32": [zlib.crc32(x.tobytes()) for _, x in rows],
                            "ids": [x.tobytes() if keep_ids else None for _, x in rows],
                        })
                        start += int(n.sum())

    return run


def read_records(spark: SparkSession, folder: str, *, keep_ids: bool = True) -> DataFrame:
    """Every record, read sequentially and checked: doc_id, start, n_tokens, ids_crc32, ids.

    ``start`` counts the ids of all records before it in file order (prefix sums
    over one row per file).  A damaged or shortened file raises ``DamagedRecord``.
    """
    ready(spark)
    index = read_index(spark, folder)
    files = index.groupBy("part", "file").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("records"))
    files = with_offsets(files, ["part", "file"], ["tokens"])
    # a task per file: a number that is given is not coalesced at run time, small as these rows are
    per_task = files.select("file").repartition(max(1, files.count()))
    rows = per_task.mapInArrow(_read(folder, keep_ids), _READ_DDL)
    # one row per file: bounded by data bytes / roll_bytes plus the number of tasks
    return rows.join(F.broadcast(files.select("file", "tokens_before")), "file").select(
        "doc_id", (F.col("local_start") + F.col("tokens_before")).alias("start"), "n_tokens", "ids_crc32", "ids"
    )


def fetch(folder: str, file: str, offset: int, length: int) -> tuple[int | None, np.ndarray]:
    """One record by its index entry: the document id and its token ids."""
    fs, path = open_fs(f"{folder}/records")
    with fs.open_input_file(f"{path}/{file}") as f:
        f.seek(offset)
        data = f.read(length)
    size = _LENGTH.unpack_from(data)[0]
    body = data[12:12 + size]
    checks = masked(crc32c([data[:8], body])).tolist()
    if size + FRAME != length or checks != [_CHECK.unpack_from(data, 8)[0], _CHECK.unpack_from(data, 12 + size)[0]]:
        raise DamagedRecord(f"{file}: record at offset {offset}")
    return parse(body)


def documents_as_records(docs: DataFrame, tokenizer_path: str, **options) -> DataFrame:
    """Write ``docs`` to a fresh shared folder and read them back from the files."""
    spark = docs.sparkSession
    folder = scratch_path(spark, "token-records")
    write_records(docs, folder, tokenizer_path, **options)
    return read_records(spark, folder, keep_ids=False)
