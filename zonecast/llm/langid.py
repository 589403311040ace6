"""Language identification by the nearest of several TF-IDF centroids per language.

Document frequencies of hashed letter n-grams are counted over every learning
row.  A bounded sample per language is clustered into centroids on the driver
(spherical k-means).  A text goes to the language of the centroid with the largest
cosine; it is marked rejected where that cosine is below what nearly all sample
rows of the centroid reach.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, DoubleType, StringType, StructField

from .common import annotate, batch, ready, slices, stored
from .ngrams import letter_counts

UNDETERMINED = "und"
_LETTER = regex.compile(r"\p{L}")
_DF = pa.schema([("bucket", pa.int32()), ("n", pa.int64())])


@dataclass
class Model:
    """Unit centroids (rows) with their languages and rejection cosines."""

    bits: int
    idf: np.ndarray
    centroids: np.ndarray
    languages: list[str]
    least: np.ndarray

    def vector(self, text: bytes) -> np.ndarray:
        return weigh(letter_counts(text, self.bits), self.idf)

    def predict(self, text: bytes | None) -> tuple[str, float, bool]:
        """Language, cosine (0 to 1) and whether the nearest centroid is too far."""
        if text is None or not self.languages or not _LETTER.search(text.decode("utf-8", "replace")):
            return UNDETERMINED, 0.0, True
        cosine = self.centroids @ self.vector(text)
        best = int(np.argmax(cosine))
        value = float(min(1.0, max(0.0, cosine[best])))
        return self.languages[best], value, bool(cosine[best] < self.least[best])


def weigh(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Unit vector of (1 + log count) * idf; zero for a text without grams."""
    used = np.flatnonzero(counts)
    v = np.zeros(len(counts), np.float32)
    v[used] = (1 + np.log(counts[used])) * idf[used]
    length = np.linalg.norm(v)
    return v / length if length else v


def _document_frequencies(bits: int):
    def run(batches):
        total, rows = np.zeros(1 << bits, np.int64), 0
        for b in slices(batches):
            for text in b.column("text").cast(pa.binary()).to_pylist():
                total += letter_counts(text, bits) > 0
                rows += 1
        used = np.flatnonzero(total)
        # bucket -1 carries the number of documents
        yield batch(_DF, {"bucket": np.append(used, -1).astype(np.int32), "n": np.append(total[used], rows)})

    return run


def cluster(vectors: np.ndarray, k: int, rounds: int = 20, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means: unit centroids and each row's centroid; at most as many as rows."""
    rng = np.random.default_rng(seed)
    chosen = [int(rng.integers(len(vectors)))]
    far = np.maximum(1 - vectors @ vectors[chosen[0]], 0).astype(np.float64)
    while len(chosen) < min(k, len(vectors)) and far.max() > 1e-6:
        # the next start is drawn in proportion to the distance from the nearest one
        chosen.append(int(rng.choice(len(vectors), p=far / far.sum())))
        far = np.minimum(far, np.maximum(1 - vectors @ vectors[chosen[-1]], 0))
    centroids, own = vectors[chosen].copy(), None
    for _ in range(rounds):
        new = np.argmax(vectors @ centroids.T, axis=1)
        if own is not None and (new == own).all():
            break
        own = new
        for c in range(len(centroids)):
            if (own == c).any():
                mean = vectors[own == c].mean(axis=0)
                centroids[c] = mean / max(1e-12, np.linalg.norm(mean))
    return centroids, own


def _gram_rows(bits: int):
    def make():
        def compute(texts):
            out = []
            for t in texts:
                counts = letter_counts(t, bits)
                used = np.flatnonzero(counts)
                out.append(used.astype("<u4").tobytes() + counts[used].astype("<f4").tobytes())
            return {"grams": out}

        return compute

    return make


def _sample(rows: DataFrame, n: int) -> list[tuple]:
    """At most ``n`` distinct (id, lang, key) of each language, those of smallest hash.

    Repeated rows count once, in the sample and in the counts: a language's threshold
    follows from its distinct rows, so about 1.2 n of them leave the tasks.  The counts
    come to the driver, one per language.
    """
    span = 1 << 40
    rows = stored(rows.distinct(), "langid-rows")
    total = {r.lang: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not total:
        return []
    share = F.create_map(*(x for lang, t in total.items() for x in (F.lit(lang), F.lit(span if t <= 2 * n else int(span * 1.2 * n / t)))))
    hashed = rows.withColumn("place", F.pmod(F.xxhash64("id", "key"), F.lit(span)))
    near = hashed.filter(F.col("place") < share[F.col("lang")]).collect()
    out, taken = [], dict.fromkeys(total, 0)
    for r in sorted(near, key=lambda r: (r.place, str(r.id), r.key)):
        if taken[r.lang] < n:
            taken[r.lang] += 1
            out.append((r.id, r.lang, r.key))
    return out


def train(
    docs: DataFrame, *, bits: int = 13, rows_per_language: int = 400, centroids: int = 4, reject_share: float = 0.005,
    id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
) -> Model:
    """Learn from rows with text and language.

    Document frequencies come from all of them; centroids from at most
    ``rows_per_language`` rows of each language, those of smallest hash of the id
    and text (the documented bound).  A text without a gram teaches nothing.
    """
    spark = docs.sparkSession
    ready(spark)
    learn = docs.select(
        F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")
    ).filter("text is not null and lang is not null")
    counted = (
        learn.select("text").mapInArrow(_document_frequencies(bits), "bucket int, n long")
        .groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    )  # at most 2**bits + 1 rows
    frequency = np.zeros((1 << bits) + 1)
    for r in counted:
        frequency[r.bucket] = r.n
    documents = frequency[-1]
    idf = np.log((1 + documents) / (1 + frequency[:-1])).astype(np.float32) + 1
    chosen = _sample(learn.select("id", "lang", F.xxhash64("text").alias("key")), rows_per_language)
    # rows_per_language rows a language: the broadcast and the collected vectors have that bound
    sample = F.broadcast(spark.createDataFrame(chosen, "id string, lang string, key long"))
    texts = learn.withColumn("key", F.xxhash64("text")).join(sample, ["id", "lang", "key"]).dropDuplicates(["id", "lang", "key"])
    found = annotate(texts, "text", _gram_rows(bits), [StructField("grams", BinaryType())])
    rows = sorted((r.lang, r.id, r.grams) for r in found.select("whole.lang", "whole.id", "grams").collect())
    centers, names, least = [], [], []
    for lang in sorted({r[0] for r in rows}):
        vectors = np.stack([weigh(_dense(g, bits), idf) for name, _, g in rows if name == lang])
        vectors = vectors[np.linalg.norm(vectors, axis=1) > 0]
        if not len(vectors):
            continue
        found_centers, own = cluster(vectors, centroids)
        nearest = (vectors @ found_centers.T)[np.arange(len(vectors)), own]
        for c in range(len(found_centers)):
            members = nearest[own == c]
            if len(members):
                centers.append(found_centers[c])
                names.append(lang)
                least.append(float(np.quantile(members, reject_share)))
    stack = np.stack(centers).astype(np.float32) if centers else np.zeros((0, 1 << bits), np.float32)
    return Model(bits, idf, stack, names, np.asarray(least, np.float32))


def _dense(grams: bytes, bits: int) -> np.ndarray:
    half = len(grams) // 2
    v = np.zeros(1 << bits, np.float32)
    v[np.frombuffer(grams[:half], "<u4")] = np.frombuffer(grams[half:], "<f4")
    return v


def _predictions(model: Model):
    def make():
        def compute(texts):
            got = [model.predict(t) for t in texts]
            return {"lang_pred": [g[0] for g in got], "score": [g[1] for g in got], "rejected": [g[2] for g in got]}

        return compute

    return make


def identify(docs: DataFrame, model: Model, *, text_col: str = "text") -> DataFrame:
    """``whole`` (the row of ``docs``), lang_pred, score (cosine) and rejected, for every row.

    Null text, text without a letter, or a model without languages: ``und``, 0,
    rejected.  Equal cosines go to the first centroid (languages in order).
    """
    fields = [StructField("lang_pred", StringType()), StructField("score", DoubleType()), StructField("rejected", BooleanType())]
    return annotate(docs, text_col, _predictions(model), fields)
