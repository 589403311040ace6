"""Quality classifier: linear support vectors over log-count-ratio scaled indicators.

A bounded sample of labelled documents is turned into sets of hashed n-grams on
the executors; the driver fits the log-count ratios, a hinge-loss model by dual
coordinate descent, and a logistic map from margins to scores.  Scoring reads
every whole text once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, StructField

from .common import annotate, hash_sample, one_text_each, stored, unwrapped
from .ngrams import indicators

#: fixed by the contract: rows whose remainder is 2 are held out
FOLDS, HELD_OUT = 4, 2


def held_out(key: Column) -> Column:
    """True where crc32 of the id as text leaves remainder 2; false for a null id."""
    return F.coalesce(F.crc32(key.cast("string")) % FOLDS == HELD_OUT, F.lit(False))


@dataclass
class Model:
    """score = logistic(slope * margin + shift), margin over bucket weights; no weights: constant, nothing was fitted."""

    bits: int
    weights: np.ndarray | None
    bias: float
    slope: float
    shift: float

    def score(self, text: bytes | None) -> float:
        if self.weights is None:
            return self.shift
        seen = indicators(text or b"", self.bits)
        margin = self.bias + (float(self.weights[seen].sum()) / np.sqrt(len(seen)) if len(seen) else 0.0)
        return float(1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -500, 500))))


def log_count_ratio(rows: list[np.ndarray], y: np.ndarray, size: int, smooth: float = 1.0) -> np.ndarray:
    """log of each bucket's share among class-1 indicators over its share among class-0 indicators."""
    p, q = np.full(size, smooth), np.full(size, smooth)
    for seen, label in zip(rows, y):
        (p if label > 0 else q)[seen] += 1
    return np.log((p / p.sum()) / (q / q.sum()))


def dual_coordinate_descent(
    rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, cost: np.ndarray, size: int,
    epochs: int = 40, tolerance: float = 1e-3, seed: int = 0,
) -> tuple[np.ndarray, float]:
    """Weights and bias of the L2-regularised hinge-loss model: one dual variable at a time.

    The bias is the weight of a constant feature.  Each step moves one row's
    dual variable to its optimum within [0, cost] and updates the weights.
    """
    w, b = np.zeros(size), 0.0
    alpha = np.zeros(len(rows))
    norm = np.asarray([float(v @ v) + 1.0 for v in values])
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        most = 0.0
        for i in rng.permutation(len(rows)):
            seen, v = rows[i], values[i]
            gradient = y[i] * (float(w[seen] @ v) + b) - 1.0
            new = min(max(alpha[i] - gradient / norm[i], 0.0), cost[i])
            step = (new - alpha[i]) * y[i]
            if step:
                w[seen] += step * v
                b += step
                alpha[i] = new
                most = max(most, abs(step))
        if most < tolerance:
            break
    return w, b


def _logistic(margin: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope (not negative) and shift by regularised Newton steps on smoothed targets."""
    n1, n0 = max(1.0, (label > 0).sum()), max(1.0, (label <= 0).sum())
    target = np.where(label > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x, beta = np.stack([margin, np.ones(len(margin))], 1), np.asarray([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        g = x.T @ (weight * (p - target)) + 1e-3 * beta
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(h, g)
        beta -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return max(0.0, float(beta[0])), float(beta[1])


def fit_rows(rows: list[np.ndarray], label: np.ndarray, bits: int, share_good: float, c: float = 10.0) -> Model:
    """Fit on indicator sets; every fifth row is kept back for the logistic map.

    Both parts hold both classes where two rows of each exist: a class that every
    fifth row misses gives its last row, one that it takes up gets it back.  With
    fewer rows nothing is fitted.
    """
    size = 1 << bits
    y = np.where(label > 0, 1.0, -1.0)
    if min((y > 0).sum(), (y <= 0).sum()) < 2:
        return Model(bits, None, 0.0, 0.0, share_good)
    back = np.arange(len(rows)) % 5 == 4
    for sign in (1.0, -1.0):
        of_class = np.flatnonzero(y == sign)
        if len({*back[of_class]}) < 2:
            back[of_class[-1]] = not back[of_class[-1]]
    fit = np.flatnonzero(~back)
    ratio = log_count_ratio([rows[i] for i in fit], y[fit], size)
    scale = [1 / np.sqrt(max(1, len(r))) for r in rows]
    values = [ratio[r] * s for r, s in zip(rows, scale)]
    # both classes weigh alike while fitting
    cost = np.where(y > 0, c * len(fit) / (2 * (y[fit] > 0).sum()), c * len(fit) / (2 * (y[fit] <= 0).sum()))
    w, b = dual_coordinate_descent([rows[i] for i in fit], [values[i] for i in fit], y[fit], cost[fit], size)
    margin = np.asarray([float(w[r] @ v) + b for r, v in zip(rows, values)])
    # the logistic map sees the classes in the share they have among all labelled rows
    weight = np.where(y > 0, share_good / max(1e-9, (y[back] > 0).mean()), (1 - share_good) / max(1e-9, (y[back] <= 0).mean()))
    slope, shift = _logistic(margin[back], y[back], weight[back])
    return Model(bits, (w * ratio).astype(np.float32), b, slope, shift)


def _indicator_sets(bits: int):
    def make():
        def compute(texts):
            return {"seen": [indicators(t or b"", bits).astype("<u4").tobytes() for t in texts]}

        return compute

    return make


def train(
    docs: DataFrame, labels: DataFrame, *, bits: int = 16, rows_per_class: int = 1500, id_col: str = "doc_id",
    text_col: str = "text", label_col: str = "quality",
) -> Model:
    """Fit on at most ``rows_per_class`` labelled documents of each class (the documented bound).

    The sample is every class's rows of smallest hash of the id, held-out rows
    excluded.  Null labels and labels without a document are left out; a repeated
    id counts once, with its text of smallest hash.  With fewer than two rows of either class nothing is fitted:
    the score is the smoothed share of label 1, and ``accepted`` keeps every row.
    """
    spark = docs.sparkSession
    marked = stored(
        labels.select(F.col(id_col).cast("long").alias("id"), (F.col(label_col) > 0).alias("good")).filter("id is not null and good is not null")
        .filter(~held_out(F.col("id"))).groupBy("id").agg(F.max("good").alias("good"))
        .join(docs.select(F.col(id_col).cast("long").alias("id")), "id", "left_semi"),
        "quality-labels",
    )
    share = {r.good: r["count"] for r in marked.groupBy("good").count().collect()}
    chosen = [
        r for good in (True, False)
        for r in hash_sample(marked.filter(F.col("good") == good), "id", rows_per_class)
    ]
    n = sum(share.values())
    share_good = (share.get(True, 0) + 1) / (n + 2)
    if len(share) < 2:
        return Model(bits, None, 0.0, 0.0, share_good)
    # bounded by 2 * rows_per_class rows
    sample = F.broadcast(spark.createDataFrame([(r.id, r.good) for r in chosen], "id long, good boolean"))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    texts = one_text_each(texts.join(sample.select("id"), "id")).join(sample, "id")
    found = annotate(texts, "text", _indicator_sets(bits), [StructField("seen", BinaryType())])
    rows = sorted(((r.id, r.good, r.seen) for r in found.select("whole.id", "whole.good", "seen").collect()), key=lambda r: (hash_order(r[0]), r[2]))
    return fit_rows([np.frombuffer(r[2], "<u4").astype(np.int32) for r in rows], np.asarray([r[1] for r in rows]), bits, share_good)


def hash_order(key: int) -> int:
    """A fixed order that mixes the classes and is independent of arrival."""
    return (key * 0x9E3779B97F4A7C15) >> 7 & 0xFFFFFFFF


def _scores(model: Model):
    def make():
        return lambda texts: {"score": [model.score(t) for t in texts]}

    return make


def score(docs: DataFrame, model: Model, *, text_col: str = "text") -> DataFrame:
    """``whole`` (the row of ``docs``) and ``score`` (0 to 1) of every row; null text counts as empty.

    An empty text has no indicators, so its score comes from the bias alone.
    Equal texts score alike; an empty table gives no rows.
    """
    return annotate(docs, text_col, _scores(model), [StructField("score", DoubleType())])


def accepted(docs: DataFrame, model: Model, threshold: float = 0.7, *, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose score reaches ``threshold``, with their own columns.

    All rows where nothing could be fitted: a constant says nothing about a text.
    """
    if model.weights is None:
        return docs
    return score(docs, model, text_col=text_col).filter(F.col("score") >= threshold).select(*unwrapped(docs))
