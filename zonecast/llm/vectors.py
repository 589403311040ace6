"""Integer vectors: quantising an array column, and exact arithmetic on blocks of them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: largest magnitude of a quantised component, and most components of a vector: 64-bit sums of their products are exact
LARGEST, LONGEST = 1 << 24, 1 << 14


def integers(df: DataFrame, id_col: str, vec_col: str, scale: int, size: int | None = None) -> DataFrame:
    """(vec_id long, q array<int>): floor(scale * x) of each component, as a double.

    Left out: null vectors, vectors with a null, NaN or infinite component and, where
    ``size`` is given, those of another length.  A component that would leave +-2^24,
    or a vector of over 2^14 components, is an error that says so: no exact 64-bit
    result exists for it.
    """
    raw, inf = F.col(f"`{vec_col}`"), F.lit(float("inf"))
    finite = ~F.exists(raw, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == inf))
    keep = raw.isNotNull() & finite & (F.size(raw) == size if size is not None else F.lit(True))
    checked = F.when(F.size(raw) > LONGEST, F.raise_error(F.lit(f"a vector has more than {LONGEST} components"))).otherwise(raw)

    def floor(x):
        y = x.cast("double") * F.lit(float(scale))
        return F.when(
            F.abs(y) > LARGEST, F.raise_error(F.lit(f"a component times {scale} is beyond {LARGEST}")).cast("int")
        ).otherwise(F.floor(y).cast("int"))

    return df.filter(keep).select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.transform(checked, floor).alias("q"))


def matrix(lists: pa.Array, size: int) -> np.ndarray:
    """The rows of a list array, all of ``size`` components, as 64-bit integers."""
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(lists), size)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b of integer arrays, exactly; through doubles where no sum can pass 2^53."""
    if not a.size or not b.size:
        return np.zeros(a.shape[:-1] + b.shape[1:], np.int64)
    most = a.shape[-1] * int(np.abs(a).max()) * int(np.abs(b).max())
    if most < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared Euclidean distances of the rows of ``a`` to the rows of ``b``, exactly."""
    return (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * products(a, b.T)
