"""Centroid clustering and exact top-k against plain loops over all pairs."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from zonecast.llm import centroids, topk

from .helpers import collected

VECS = "vec_id long, embedding array<double>, label int, cluster string, q string, score double"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0, "c", "q", 0.5) for i, v in rows], VECS)


def random_rows(n, size, seed, spread=1.0):
    rng = random.Random(seed)
    return [(i, [rng.gauss(0, spread) for _ in range(size)]) for i in range(n)]


def finite(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def plain_clusters(rows, k, rounds, scale, size, salt="2:"):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if finite(v) and len(v) == size]
    digest = lambda i: hashlib.sha256(f"{salt}{i}".encode()).hexdigest()
    centers = [v for i, v in sorted(kept, key=lambda r: (r[0] is None, digest(r[0]) if r[0] is not None else "", r[1]))[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centers))
    for _ in range(rounds):
        own = [near(v)[1] for _, v in kept]
        for n in range(len(centers)):
            mine = [v for (_, v), o in zip(kept, own) if o == n]
            if mine:
                centers[n] = [sum(x) // len(mine) for x in zip(*mine)]
    out = [(i, near(v)[1], near(v)[0]) for i, v in kept]
    sums = {n: sum(d for _, c, d in out if c == n) for n in range(len(centers))}
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers]
    return sorted(((i, c, d, sums[c], sum(sums.values()), sha[c]) for i, c, d in out), key=str)


def clustered(df, **settings):
    rows = collected(centroids.cluster(df, **settings))
    return sorted(((r["vec_id"], r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"], r["centroid_sha256"]) for r in rows), key=str)


ODD = [(900, None), (901, []), (902, [1.0]), (903, [1.0, None, 2.0, 3.0]), (904, [1.0, float("nan"), 2.0, 3.0]), (905, [float("inf"), 0.0, 0.0, 0.0])]


@pytest.mark.parametrize("k, pivots", [(6, 6), (6, 1), (6, 3), (40, 40)])
def test_clusters_equal_plain_loops(spark, k, pivots):
    rows = random_rows(300, 4, k) + ODD + [(None, [0.1, 0.2, 0.3, 0.4]), (7, [0.1, 0.2, 0.3, 0.4]), (7, [0.5, 0.2, 0.3, 0.4])]
    rows += [(500 + i, [1.0, 1.0, 1.0, 1.0]) for i in range(30)]  # equal vectors, and equal start centroids
    got = clustered(vectors(spark, rows), k=k, rounds=3, scale=256, size=4, pivots=pivots)
    assert got == plain_clusters(rows, k, 3, 256, 4)


def test_few_equal_and_no_vectors(spark):
    for rows in ([], ODD, [(1, [1.0, 2.0, 3.0, 4.0])], [(i, [2.0, 2.0, 2.0, 2.0]) for i in range(5)], [(None, [1.0, 2.0, 3.0, 4.0])], random_rows(5, 4, 3)):
        df = centroids.cluster(vectors(spark, rows), k=4, rounds=2, size=4)
        assert df.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
        assert clustered(vectors(spark, rows), k=4, rounds=2, size=4) == plain_clusters(rows, 4, 2, 256, 4)


def test_ties_go_to_the_smaller_number(spark):
    """Vectors on a coarse grid are often equally far from several centroids."""
    rng = random.Random(2)
    rows = [(i, [float(rng.randint(-2, 2)) for _ in range(3)]) for i in range(200)]
    assert clustered(vectors(spark, rows), k=9, rounds=4, scale=1, size=3) == plain_clusters(rows, 9, 4, 1, 3)


def test_large_components_stay_exact(spark):
    rows = [(i, [x * 10_000 for x in v]) for i, v in random_rows(60, 5, 4)]
    assert clustered(vectors(spark, rows), k=5, rounds=3, size=5) == plain_clusters(rows, 5, 3, 256, 5)
    with pytest.raises(Exception, match="beyond"):
        centroids.cluster(vectors(spark, [(1, [1e30, 0.0, 0.0])]), k=2, size=3).collect()


def test_bounds_hold_and_filter():
    rng = np.random.default_rng(3)
    x, c = rng.integers(-300, 300, (400, 12)), rng.integers(-300, 300, (15, 12))
    exact = ((x[:, None] - c[None]) ** 2).sum(axis=2)
    for most in (1, 4, 9, 15):
        s = centroids.Simplex(c, most)
        low, high = centroids.bounds(s.apex(x), s.apex(c))
        assert (low <= exact).all() and (exact <= high).all()
        which, best, looked = centroids.nearest(x, s.apex(x), c, s.apex(c))
        assert (which == exact.argmin(axis=1)).all() and (best == exact.min(axis=1)).all()
    assert looked < exact.size / 4  # all centroids are pivots: the bounds are the distances


def plain_top(rows, k, scale, step):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if finite(v)]
    out = []
    for i, v in kept:
        if i is None or i % step:
            continue
        found = sorted((-sum(a * b for a, b in zip(v, w)), j is None, j) for j, w in kept if j != i)[:k]
        out += [(i, n, j, -s) for n, (s, _, j) in enumerate(found, 1)]
    return sorted(out, key=str)


def searched(df, k, scale, step, **settings):
    rows = collected(topk.search(df, F.col("vec_id") % step == 0, k=k, scale=scale, **settings))
    return sorted(((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in rows), key=str)


@pytest.mark.parametrize("cells, block", [(1 << 20, 1 << 18), (1500, 40)])
def test_top_k_equals_all_pairs(spark, monkeypatch, cells, block):
    """In one shard, and in many shards and query blocks."""
    monkeypatch.setattr(topk, "CELLS", cells)
    rng = random.Random(6)
    rows = random_rows(700, 8, 1) + [(1000 + i, [x * 40 for x in v]) for i, v in random_rows(20, 8, 2)]
    rows += [(2000, [0.0] * 8), (2001, []), (2010, []), (2003, [1.0]), (2020, [0.5] * 12), (2005, None), (2006, [1.0, None]), (2030, [1.0, float("nan")])]
    rows += [(None, rows[3][1]), (40, rows[40][1]), (41, rows[40][1]), (42, rows[40][1])]  # repeated rows and ties
    rows += [(3000 + i, [float(rng.randint(-1, 1)) for _ in range(8)]) for i in range(60)]
    df = vectors(spark, rows)
    assert searched(df, 10, 64, 20, block_cells=block) == plain_top(rows, 10, 64, 20)


def test_few_candidates_and_empty_tables(spark):
    for rows in ([], [(100, [1.0, 2.0])], [(100, [1.0, 2.0]), (3, [0.5, -2.0]), (None, [9.0])], [(7, [1.0])]):
        assert searched(vectors(spark, rows), 10, 1024, 100) == plain_top(rows, 10, 1024, 100)
    assert topk.search(vectors(spark, []), F.lit(True)).columns == ["query_id", "rank", "vec_id", "score"]


def test_search_stops_on_proof_only():
    """A close group is found without reading every segment; the rows left are rescored, and none of the best is missing."""
    rng = np.random.default_rng(8)
    x = rng.normal(0, 1, (6000, 32))
    x /= np.linalg.norm(x, axis=1)[:, None]
    x[:40] = x[0] + rng.normal(0, 0.02, (40, 32))
    q = np.floor(1024 * x).astype(np.int32)
    shard = topk.Shard(list(range(len(q))), q, *topk._segments(q))
    rows, scores = shard.search(0, q[0].astype(np.int64), 10)
    exact = q.astype(np.int64) @ q[0].astype(np.int64)
    exact[0] = -(10 ** 12)
    best = np.lexsort((np.arange(len(q)), -exact))[:10]
    assert set(best) <= set(rows.tolist()) and (scores == exact[rows]).all()
    assert shard.read < 0.8 * shard.docs.size and len(rows) < len(q) / 10
