"""Nearest-zone lookup (J1 Euclidean, J2 haversine).

Coordinates are rounded to 3 dp (about 100 m) and looked up in a ``ZoneIndex``: a
projection of each row, with no join, no shuffle and no state.  A row meets its leaf's
candidates (16 at most, but for points far from all zones or equally near to many),
however many zones there are.  The same expression serves batch and streaming frames.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import round_half_even
from .zoneindex import ZoneIndex

COORD_DIGITS = 3


def nearest_zone(
    df: DataFrame,
    zones: DataFrame,
    lat: str,
    lon: str,
    out: str = "location_id",
    metric: str = "euclid",
) -> DataFrame:
    """Add column ``out`` = nearest zone id of (lat, lon) rounded to 3 dp."""
    return nearest_zones(df, zones, [(lat, lon, out)], metric)


def nearest_zones(
    df: DataFrame,
    zones: DataFrame,
    points: list[tuple[str, str, str]],
    metric: str = "euclid",
    unless: dict[str, Column] | None = None,
) -> DataFrame:
    """Add one nearest-zone column per (lat, lon, out); null without coordinates.

    ``unless``: out column -> condition under which a row needs no lookup.
    """
    unless = unless or {}
    index = ZoneIndex(zones, metric)
    found = {}
    for lat, lon, out in points:
        wanted = F.col(lat).isNotNull() & F.col(lon).isNotNull()
        if out in unless:
            wanted = wanted & ~F.coalesce(unless[out], F.lit(False))
        key = lambda c, wanted=wanted: F.when(wanted, round_half_even(F.col(c), COORD_DIGITS))
        found[out] = index.nearest(key(lat), key(lon))
    return df.withColumns(found)
