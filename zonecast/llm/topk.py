"""Exact top-k inner products from an impact-ordered index, score at a time.

Index: vectors lie in shards of bounded size.  In a shard each dimension's components
are quantised to a few signed impact levels; a posting segment holds the rows of one
dimension and level with the least and the greatest component among them.

Search: a query takes a shard's segments score at a time and keeps one number per row,
an upper bound of the score.  Before any segment that is (s |q|^2 + |x|^2 / s) / 2; a
segment replaces its dimension's share of it by the most that its level can contribute.
What that takes off the bound is the segment's impact for the query, the same for all
its rows; segments are processed by descending impact.  The search stops only
on proof: when nearly all rows have a bound below the k-th best exact score known so
far.  All others are possible members and are rescored exactly; should proof never come,
every segment is read and every possible member rescored.  Nothing is approximate.

Queries pass in blocks of bounded size, each broadcast to all shards.  A task keeps its
best k of every query, and their merge is a window over (tasks x k) rows a query.

Results in special cases: see ``vectors.integers`` for vectors that take no part and
those that are an error; of vectors of different lengths the shorter one counts as
zero beyond its end; an empty vector scores 0; a query's own rows are all rows with
its id; repeated query rows are answered each, repeated candidates take a rank each;
a null id is no query, and as a candidate comes last among ties; an empty table gives
no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import ready, stored
from .vectors import integers, products

#: components in a shard, impact levels of a sign, components in a block of queries, checks for proof in a full pass
CELLS, LEVELS, BLOCK_CELLS, CHECKS = 1 << 20, 16, 1 << 18, 16
SHARD = "ids array<long>, width int, cells binary, docs binary, segments binary"
RESULT = "query_id long, rank int, vec_id long, score long"


def _blocks(batches: Iterator[pa.RecordBatch], cells: int) -> Iterator[tuple[list, np.ndarray]]:
    """(ids, matrix padded with zeros) of consecutive rows, at most about ``cells`` components each."""
    ids: list = []
    rows: list[np.ndarray] = []
    width = 0

    def done():
        out = np.zeros((len(rows), width), np.int32)
        for i, r in enumerate(rows):
            out[i, :r.size] = r
        return list(ids), out

    for b in batches:
        lists = b.column(1)
        flat, ends = lists.flatten().to_numpy(zero_copy_only=False), lists.value_lengths().to_numpy(zero_copy_only=False).cumsum()
        for key, lo, hi in zip(b.column(0).to_pylist(), [0, *ends[:-1]], ends):
            wider = max(width, int(hi - lo))
            if rows and ((len(rows) + 1) * max(wider, 1) > cells or len(rows) >= 1 << 16):
                yield done()
                ids, rows, wider = [], [], int(hi - lo)
            ids.append(key)
            rows.append(flat[lo:hi])
            width = wider
    if rows:
        yield done()


def _segments(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Posting lists of one shard: rows by (dimension, level), and (dimension, begin, end, least, greatest) of each segment."""
    docs, table, at = [], [], 0
    top = np.abs(x).max(initial=0) + 1
    for d in range(x.shape[1]):
        v = x[:, d]
        rows = np.flatnonzero(v)  # a zero contributes nothing
        level = np.sign(v[rows]) * (1 + np.abs(v[rows]).astype(np.int64) * LEVELS // top)
        order = np.argsort(level, kind="stable")
        rows, level = rows[order], level[order]
        begin = np.flatnonzero(np.r_[True, level[1:] != level[:-1]]) if rows.size else np.zeros(0, np.int64)
        for lo, hi in zip(begin, [*begin[1:], rows.size]):
            part = v[rows[lo:hi]]
            table.append((d, at + lo, at + hi, part.min(), part.max()))
        docs.append(rows)
        at += rows.size
    joined = np.concatenate(docs) if docs else np.zeros(0, np.int64)
    return joined.astype(np.uint16), np.asarray(table, np.int32).reshape(-1, 5)


def build(vectors: DataFrame) -> DataFrame:
    """The index of a (vec_id, q) table: one row per shard, with its vectors and their posting segments."""
    ready(vectors.sparkSession, 8192)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x in _blocks(batches, CELLS):
            docs, table = _segments(x)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([ids], pa.list_(pa.int64())), pa.array([x.shape[1]], pa.int32()), pa.array([x.tobytes()]),
                    pa.array([docs.tobytes()]), pa.array([table.tobytes()]),
                ],
                names=["ids", "width", "cells", "docs", "segments"],
            )

    return vectors.mapInArrow(run, SHARD)


class Shard:
    """One shard of the index, ready to be searched."""

    def __init__(self, ids: list, x: np.ndarray, docs: np.ndarray, segments: np.ndarray):
        self.x = x
        self.known = np.asarray([i is not None for i in ids], bool)
        self.ids = np.asarray([i or 0 for i in ids], np.int64)
        self.docs = docs.astype(np.int64)
        self.dim, self.begin, self.end, self.least, self.most = segments.astype(np.int64).T
        self.norms = (x.astype(np.int64) ** 2).sum(axis=1).astype(np.float64)
        self.read = 0

    def search(self, query_id: int, q: np.ndarray, k: int, floor: float = -np.inf) -> tuple[np.ndarray, np.ndarray]:
        """(rows, scores): every row that can be among the k best, and no less than ``floor``, with its exact score."""
        width = min(len(q), self.x.shape[1])
        own = self.known & (self.ids == query_id)
        few = max(4 * k, len(self.x) // 16)
        q = q[:width].astype(np.int64)
        x = self.x[:, :width]
        if len(self.x) - own.sum() <= few:
            rows = np.flatnonzero(~own)
            return rows, products(x[rows], q)
        weight = np.zeros(self.x.shape[1], np.int64)
        weight[:width] = q
        w = weight[self.dim]
        size = float((q * q).sum())
        s = np.sqrt(max(float(np.median(self.norms)), 1.0) / max(size, 1.0))
        near = np.where(self.least > 0, self.least, np.where(self.most < 0, -self.most, 0)).astype(np.float64)
        impact = (s * w.astype(np.float64) ** 2 + near * near / s) / 2 - np.maximum(w * self.least, w * self.most)
        used = np.flatnonzero(impact > 0)  # a segment that tells nothing may stay unread: the bound holds without it
        used = used[np.argsort(-impact[used], kind="stable")]
        bound = (s * size + self.norms / s) / 2
        slack = 1 + 1e-9 * float(bound.max())
        bound[own] = -np.inf
        step = max(1, self.docs.size // CHECKS)
        since = 0
        for n, g in enumerate(used):
            lo, hi = self.begin[g], self.end[g]
            bound[self.docs[lo:hi]] -= impact[g]
            since += hi - lo
            if since >= step or n + 1 == len(used):
                self.read += since
                since = 0
                best = np.argpartition(bound, bound.size - 4 * k)[-4 * k:]
                best = best[~own[best]]
                known = np.sort(products(x[best], q))[::-1]
                floor = max(floor, float(known[k - 1])) if known.size >= k else floor
                if np.count_nonzero(bound >= floor - slack) <= few:
                    break
        rows = np.flatnonzero(bound >= floor - slack)
        rows = rows[~own[rows]]
        return rows, products(x[rows], q)


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[Shard]:
    for b in batches:
        for i in range(b.num_rows):
            cells, docs, segments = (np.frombuffer(b.column(c)[i].as_buffer(), t) for c, t in ((2, np.int32), (3, np.uint16), (4, np.int32)))
            ids = b.column(0)[i].as_py()
            yield Shard(ids, cells.reshape(len(ids), b.column(1)[i].as_py()), docs, segments.reshape(-1, 5))


def _best(ids, known, scores, k):
    order = np.lexsort((ids, ~known, -scores))[:k]
    return ids[order], known[order], scores[order]


def _searched(index: DataFrame, ids: list, queries, k: int) -> DataFrame:
    """(number, query_id, vec_id, score): the k best of every task, for each query of one block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = queries.value
        none = np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)
        best = [none] * len(ids)
        for shard in _shards(batches):
            for n, query_id in enumerate(ids):
                floor = float(best[n][2][-1]) if len(best[n][2]) == k else -np.inf
                rows, scores = shard.search(query_id, block[n], k, floor)
                mine = shard.ids[rows], shard.known[rows], scores
                best[n] = _best(*(np.concatenate(p) for p in zip(best[n], mine)), k)
        sizes = [len(b[0]) for b in best]
        if sum(sizes):
            vec, known, score = (np.concatenate(p) for p in zip(*best))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(np.arange(len(ids)), sizes)), pa.array(np.repeat(np.asarray(ids, np.int64), sizes)),
                    pa.array(vec, pa.int64(), mask=~known), pa.array(score, pa.int64()),
                ],
                names=["number", "query_id", "vec_id", "score"],
            )

    return index.mapInArrow(run, "number long, query_id long, vec_id long, score long")


def search(
    df: DataFrame, is_query: Column, k: int = 10, scale: int = 1024, id_col: str = "vec_id", vec_col: str = "embedding",
    block_cells: int = BLOCK_CELLS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query row's k best other rows by integer inner product, ties to smaller ids.

    ``is_query`` is a condition on ``vec_id``.  The queries come to the driver one
    partition of packed blocks at a time, each block of at most ``block_cells``
    components is broadcast, answered, written and released.
    """
    spark = df.sparkSession
    ready(spark, 8192)
    vectors = stored(integers(df, id_col, vec_col, scale), "vectors")
    index = stored(build(vectors), "impact-index")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x in _blocks(batches, block_cells):
            yield pa.RecordBatch.from_arrays(
                [pa.array([ids], pa.list_(pa.int64())), pa.array([x.shape[1]], pa.int32()), pa.array([x.tobytes()])],
                names=["ids", "width", "cells"],
            )

    blocks = stored(vectors.filter(is_query).mapInArrow(pack, "ids array<long>, width int, cells binary"), "query-blocks")
    folder = scratch_path(spark, "answers")
    best = Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    number = -1
    for number, block in enumerate(blocks.toLocalIterator()):
        x = np.frombuffer(block["cells"], np.int32).reshape(len(block["ids"]), block["width"])
        sent = spark.sparkContext.broadcast(x)
        found = _searched(index, block["ids"], sent, k).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
        found.select("query_id", "rank", "vec_id", "score").write.parquet(f"{folder}/block={number}")
        sent.destroy()
    if number < 0:
        return spark.createDataFrame([], RESULT)
    return spark.read.schema(RESULT).parquet(folder).select("query_id", "rank", "vec_id", "score")
