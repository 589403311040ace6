"""Distance expressions between a point and a zone centroid (degrees in, JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Distances are rounded before comparison so that ties resolve identically on
# every engine (last-bit differences of sin/cos/sqrt would otherwise decide).
DISTANCE_DIGITS = 12


def euclid_sq(lat: Column, lon: Column, zlat: Column, zlon: Column) -> Column:
    """Squared Euclidean distance in degree space."""
    return (zlat - lat) * (zlat - lat) + (zlon - lon) * (zlon - lon)


def haversine(lat: Column, lon: Column, zlat: Column, zlon: Column) -> Column:
    """Great-circle central angle (radians) between two lat/lon points given in degrees."""
    p1, p2 = F.radians(lat), F.radians(zlat)
    dlat = p2 - p1
    dlon = F.radians(zlon) - F.radians(lon)
    a = F.pow(F.sin(dlat / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlon / 2), 2)
    return F.lit(2.0) * F.asin(F.sqrt(a))


def rounded(c: Column, digits: int = DISTANCE_DIGITS) -> Column:
    return F.rint(c * F.lit(float(10**digits))) / F.lit(float(10**digits))
