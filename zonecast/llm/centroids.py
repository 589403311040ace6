"""Exact integer k-means whose assignments are filtered by an n-simplex projection.

A few pivots are chosen among the start centroids.  The distances of a vector to the
pivots, computed once and stored with it, are the sides of a simplex over the pivots'
base; its apex coordinates y and height h bound the distance of any two vectors:

    |y - y'|^2 + (h - h')^2  <=  distance^2  <=  |y - y'|^2 + (h + h')^2

Each round projects the centroids, drops every centroid whose lower bound is over the
least upper bound (or the exact distance of the most promising one), and compares the
rest in exact integers.  Bounds are widened by far more than a double's rounding, so
the result is the plain one, ties included.

Results in special cases: see ``vectors.integers`` for vectors that take no part and
those that are an error; other lengths than ``size`` take no part; with fewer vectors
than ``k`` every vector starts a centroid; equal start centroids leave the later one
empty, where it stays; repeated rows count each; a null id is a row like any other but
starts a centroid only where ids run out; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ready, stored
from .vectors import integers, matrix, products, squared

#: a pivot must stand this far off the others' base, as a share of the largest distance
FLAT = 1e-3
SLACK = 1e-6
RESULT = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


class Simplex:
    """Base simplex over pivots; ``apex`` maps distances to coordinates over it."""

    def __init__(self, points: np.ndarray, most: int):
        """Picks at most ``most`` pivots, each the point farthest off the base so far (pivoted Cholesky)."""
        between = squared(points, points).astype(np.float64)
        gram = (between[0][None, :] + between[0][:, None] - between) / 2
        left, chosen, rows = gram.diagonal().copy(), [0], np.zeros((0, len(points)))
        least = FLAT * FLAT * left.max(initial=0)
        while len(chosen) < most and left.max() > max(least, 0.5):
            k = int(left.argmax())
            row = (gram[k] - rows.T @ rows[:, k]) / np.sqrt(left[k])
            rows, chosen = np.vstack([rows, row]), [*chosen, k]
            left = np.maximum(left - row * row, 0)
            left[chosen] = 0
        self.pivots = points[chosen]
        self.base = rows[:, chosen[1:]].T  # lower triangular: a pivot's coordinates over those before it
        self.norms = between[0][chosen[1:]]

    def apex(self, vectors: np.ndarray) -> np.ndarray:
        """Coordinates over the base, then the height, from exact squared distances to the pivots."""
        d = squared(vectors, self.pivots).astype(np.float64)
        y = np.zeros((len(vectors), 0))
        if len(self.norms):
            y = np.linalg.solve(self.base, ((d[:, :1] - d[:, 1:] + self.norms) / 2).T).T
        h = np.sqrt(np.maximum(d[:, 0] - (y * y).sum(axis=1), 0))
        return np.c_[y, h]


def bounds(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the squared distances between two sets of apexes."""
    flat = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * (a[:, :-1] @ b[:, :-1].T)
    both = 2 * a[:, -1:] * b[:, -1][None, :]
    slack = SLACK * ((a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :]) + 1e-3
    return flat - both - slack, flat + both + slack


def nearest(vectors: np.ndarray, apexes: np.ndarray, centroids: np.ndarray, over: np.ndarray):
    """(number of the nearest centroid, squared distance, exact comparisons made), ties to the smaller number.

    ``over``: the centroids' apexes.
    """
    low, high = bounds(apexes, over)
    first = low.argmin(axis=1)
    gap = vectors - centroids[first]
    most = np.minimum(high.min(axis=1), (gap * gap).sum(axis=1))
    maybe = low <= most[:, None]
    norms, best = (vectors * vectors).sum(axis=1), np.full(len(vectors), np.iinfo(np.int64).max)
    which = np.zeros(len(vectors), np.int64)
    for c, centre in enumerate(centroids):
        rows = np.flatnonzero(maybe[:, c])
        if rows.size:
            d = norms[rows] + (centre * centre).sum() - 2 * products(vectors[rows], centre)
            closer = d < best[rows]
            best[rows[closer]], which[rows[closer]] = d[closer], c
    return which, best, int(maybe.sum()) + len(vectors)


def _apexed(vectors: DataFrame, simplex: Simplex, size: int) -> DataFrame:
    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                a = simplex.apex(matrix(b.column(1), size))
                flat = pa.FixedSizeListArray.from_arrays(pa.array(a.ravel()), a.shape[1])
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), flat.cast(pa.list_(pa.float64()))], names=["vec_id", "q", "apex"])

    return vectors.mapInArrow(project, "vec_id long, q array<int>, apex array<double>")


def _parts(b: pa.RecordBatch, size: int) -> tuple[np.ndarray, np.ndarray]:
    apexes = b.column(2).flatten().to_numpy(zero_copy_only=False)
    return matrix(b.column(1), size), apexes.reshape(b.num_rows, -1)


def _moved(vectors: DataFrame, centroids: np.ndarray, simplex: Simplex) -> np.ndarray:
    """Each centroid's exact floor of the mean of its vectors; an empty one stays.

    A task sends one row of sums per centroid, however many vectors are nearest to it.
    """
    k, size = centroids.shape
    over = simplex.apex(centroids)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((k, size), np.int64), np.zeros(k, np.int64)
        for b in batches:
            if b.num_rows:
                q, apexes = _parts(b, size)
                which, _, _ = nearest(q, apexes, centroids, over)
                order = np.argsort(which, kind="stable")
                present, first = np.unique(which[order], return_index=True)
                sums[present] += np.add.reduceat(q[order], first, axis=0)
                counts += np.bincount(which, minlength=k)
        full = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(full, pa.int32()), pa.array(counts[full]), pa.array(list(sums[full]), pa.list_(pa.int64()))],
            names=["cluster", "n", "sums"],
        )

    total = vectors.mapInArrow(add, "cluster int, n long, sums array<long>").groupBy("cluster").agg(
        F.sum("n").alias("n"), F.array(*(F.sum(F.col("sums")[i]) for i in range(size))).alias("sums")
    )
    after = centroids.copy()
    for r in total.collect():  # at most one row per centroid
        after[r["cluster"]] = [s // r["n"] for s in r["sums"]]
    return after


def cluster(
    df: DataFrame, k: int = 40, rounds: int = 5, scale: int = 256, size: int = 64, salt: str = "2:", pivots: int = 40,
    id_col: str = "vec_id", vec_col: str = "embedding",
) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256), one row per vector that takes part.

    Centroids start as the ``k`` vectors of smallest SHA-256 of ``salt`` and id (ties,
    which only repeated ids can have: the smaller vector).
    """
    spark = df.sparkSession
    ready(spark, 8192)
    vectors = stored(integers(df, id_col, vec_col, scale, size), "vectors")
    start = F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")), 256)
    first = vectors.orderBy(start.asc_nulls_last(), "q").limit(k).select("q").collect()
    if not first:
        return spark.createDataFrame([], RESULT)
    centroids = np.asarray([r["q"] for r in first], np.int64)
    simplex = Simplex(centroids, pivots)
    vectors = stored(_apexed(vectors, simplex, size), "apexes")
    for _ in range(rounds):
        centroids = _moved(vectors, centroids, simplex)
    over = simplex.apex(centroids)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                which, best, _ = nearest(*_parts(b, size), centroids, over)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array(which, pa.int32()), pa.array(best)], names=["vec_id", "cluster", "distance"]
                )

    assigned = stored(vectors.mapInArrow(assign, "vec_id long, cluster int, distance long"), "assigned")
    inertia = {r["cluster"]: r["d"] for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}
    digest = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    about = spark.createDataFrame(
        [(c, d, sum(inertia.values()), digest[c]) for c, d in inertia.items()],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    return assigned.join(F.broadcast(about), "cluster").select(*(c.split()[0] for c in RESULT.split(", ")))  # at most k rows
