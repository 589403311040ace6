"""Packing by concatenate and cut.

Pass 1 tokenises every document once and stores its ids with the running token
count inside its partition.  Prefix sums over the partition totals turn those
counts into global offsets.  Pass 2 cuts the one long id stream into fixed
windows: each document yields one boundary record per window that it touches.
Nothing but the partition totals (one row per partition) meets in one task.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch, key_and_text, ready, slices, stored, with_offsets
from .tokens import tokenizer

_TOKENS = pa.schema([
    ("part", pa.int32()), ("doc_id", pa.int64()), ("local_start", pa.int64()),
    ("n_tokens", pa.int64()), ("ids", pa.binary()),
])
_PIECES = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary()),
])
_TOKENS_DDL = "part int, doc_id long, local_start long, n_tokens long, ids binary"
_PIECES_DDL = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"
)


def _tokenise(path: str, style: str, end_id: int, width: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, at, tok = TaskContext.get().partitionId(), 0, tokenizer(path, style)
        end = np.asarray([end_id], "<u4").tobytes()
        for b in slices(batches):
            ids = [np.frombuffer(x + end, "<u4") for x in tok.encode(b.column("text").to_pylist())]
            n = np.asarray([len(x) for x in ids], np.int64)
            starts = at + np.cumsum(n) - n
            at += int(n.sum())
            yield batch(_TOKENS, {
                "part": np.full(len(n), part, np.int32), "doc_id": b.column("doc_id"), "local_start": starts,
                "n_tokens": n, "ids": [x.astype(width).tobytes() for x in ids],
            })

    return run


def _cut(window: int, width: str, keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 2 << 20):
            out: dict[str, list] = {n: [] for n in _PIECES.names}
            rows = zip(*(b.column(n).to_pylist() for n in ("doc_id", "global_start", "n_tokens", "ids")))
            for doc_id, first, n, data in rows:
                ids = np.frombuffer(data, width).astype("<u4")
                edges = [0, *range(window - first % window, n, window), n]
                for a, z in zip(edges, edges[1:]):
                    piece = ids[a:z].tobytes()
                    for name, value in zip(_PIECES.names, (
                        doc_id, a, z - a, zlib.crc32(piece), n, (first + a) // window, (first + a) % window,
                        piece if keep_ids else None,
                    )):
                        out[name].append(value)
            yield batch(_PIECES, out)

    return run


def pack(
    docs: DataFrame, tokenizer_path: str, *, style: str = "leading", end_id: int = 0, window: int = 1024,
    vocab_size: int = 50257, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = True,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids.

    Null or empty text: one piece holding only ``end_id``.  Repeated rows and
    repeated or null ids are packed once each.  An empty table gives no rows.
    Other columns of ``docs`` are ignored.  A text of any length is cut into as
    many windows as it needs.  ``ids`` are little-endian unsigned 32-bit ids
    (null with ``keep_ids=False``).
    """
    ready(docs.sparkSession)
    width = "<u2" if vocab_size <= 1 << 16 else "<u4"
    tokens = stored(
        key_and_text(docs, id_col, text_col).mapInArrow(_tokenise(tokenizer_path, style, end_id, width), _TOKENS_DDL),
        "pack-tokens",
    )
    totals = tokens.groupBy("part").agg(F.sum("n_tokens").alias("tokens"))
    # one row per input partition, so the broadcast side is bounded by the task count
    offsets = with_offsets(totals, ["part"], ["tokens"]).select("part", "tokens_before")
    placed = tokens.join(F.broadcast(offsets), "part").select(
        "doc_id", (F.col("local_start") + F.col("tokens_before")).alias("global_start"), "n_tokens", "ids"
    )
    return placed.mapInArrow(_cut(window, width, keep_ids), _PIECES_DDL)


def sequences(pieces: DataFrame, window: int = 1024, pad_id: int = 0) -> DataFrame:
    """Packed sequences of ``window`` ids from the pieces of ``pack`` (ids kept).

    sequence_id, input_ids (binary, unsigned 32-bit), n_tokens, boundaries
    (array of doc_id, start, offset, length in order).  Each group is at most
    ``window`` ids.  The last sequence is filled up with ``pad_id``.
    """
    filler = F.unhex(F.lit(np.asarray([pad_id], "<u4").tobytes().hex()))
    grouped = pieces.groupBy("sequence_id").agg(
        F.sort_array(F.collect_list(F.struct("offset", "doc_id", "start", "length", "ids"))).alias("p"),
        F.sum("length").alias("n_tokens"),
    )
    joined = F.aggregate("p", F.lit(b""), lambda acc, x: F.concat(acc, x["ids"]))
    fill = F.aggregate(
        F.array_repeat(filler, (F.lit(window) - F.col("n_tokens")).cast("int")), F.lit(b""), lambda acc, x: F.concat(acc, x)
    )
    return grouped.select(
        "sequence_id", F.concat(joined, fill).alias("input_ids"), "n_tokens",
        F.transform("p", lambda x: F.struct(x["doc_id"], x["start"], x["offset"], x["length"])).alias("boundaries"),
    )
