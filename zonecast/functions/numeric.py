"""Numeric Column helpers (all JVM-side, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_even(c: str | Column, digits: int) -> Column:
    """Scale -> rint -> unscale: the rounding a pandas ``Series.round(d)`` performs.

    Differs from ``F.round`` (decimal HALF_UP) and ``F.bround`` on doubles whose
    decimal expansion sits near a tie; this form agrees with pandas bit for bit.
    """
    scale = float(10**digits)
    return F.rint(col_of(c) * F.lit(scale)) / F.lit(scale)


def nan_to_null(c: str | Column) -> Column:
    """NaN -> null (Spark orders NaN above every number; pandas treats it as missing)."""
    x = col_of(c)
    return F.when(~F.isnan(x), x)


def to_double(c: str | Column) -> Column:
    """Coerce anything numeric-like to double; unparsable and NaN become null."""
    x = col_of(c).try_cast("double")
    return nan_to_null(x)


def parse_zone_id(c: str | Column) -> Column:
    """Zone id: read as number, truncate toward zero, keep only ids > 0."""
    z = to_double(c)
    zi = F.when(F.abs(z) < F.lit(2147483648.0), z).cast("int")
    return F.when(zi > 0, zi)


def clip(c: str | Column, lower: float | None = None, upper: float | None = None) -> Column:
    """pandas ``clip``: nulls stay null."""
    x = col_of(c)
    out = x
    if lower is not None:
        out = F.when(out < F.lit(lower), F.lit(lower)).otherwise(out)
    if upper is not None:
        out = F.when(out > F.lit(upper), F.lit(upper)).otherwise(out)
    return F.when(x.isNotNull(), out)


def safe_mean(sum_col: str | Column, count_col: str | Column) -> Column:
    """sum / count, null when count is zero or null."""
    return F.try_divide(col_of(sum_col), F.nullif(col_of(count_col), F.lit(0)).cast("double"))


def stable_round(c: str | Column, digits: int) -> Column:
    """Round to ``digits`` after first rounding to ``digits + 3``.

    Sums and means of the same values computed in a different order differ in
    the last bits; the first rounding removes that noise so exact decimal ties
    (frequent for means over 2, 4, 8 values) resolve the same way everywhere.
    """
    return round_half_even(round_half_even(c, digits + 3), digits)


def round6(c: str | Column) -> Column:
    return stable_round(c, 6)
