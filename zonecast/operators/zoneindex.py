"""Exact nearest-zone index: a quadtree whose leaves list every zone that can be nearest there.

Build (driver, over the zone dimension only): a cell starts with its parent's candidates.
A zone is dropped from a cell when another zone is nearer for *every* point of the cell,
by more than the rounding of distances; cells are quartered until few candidates remain.
So the nearest zone of any point is among its leaf's candidates, ties included.

* Euclidean: |p - z|^2 - |p - z'|^2 is linear in p, its least value over a box is at a corner.
* Haversine: on unit vectors the nearer zone has the larger dot product with p, again linear;
  its least value over a box of latitudes and longitudes has a closed form.  Vectors know
  neither an antimeridian nor poles.

Lookup (row-local, JVM expressions only): a point's cell number on the finest grid, with
the bits of both axes interleaved, lies between the first numbers of two leaves; a binary
search over the sorted leaf starts finds its leaf, and the metric itself decides among the
leaf's candidates.  The index is a constant of the plan, which Spark sends once to each
executor, with no join, no shuffle and no copy per row; it works on streams as well.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import euclid_sq, haversine, rounded

#: candidates at which a cell is no longer quartered, and the finest grid: 2^31 cells an axis
LEAF, LEVELS = 16, 31
#: how often a cell with no zone within twice its side is still quartered.  Zones on a line share endless
#: parallel strips of the plane; far off, a leaf may list a longer piece of the line instead of being cut on and on
FAR_LEVELS = 3
#: side of the root square in degrees, around the origin; points outside meet all zones (no place on earth is there)
SPAN = 512.0
METRICS = {"euclid": euclid_sq, "haversine": haversine}
#: proven bound of the index; a larger dimension is an error
MAX_ZONES = 1_000_000
#: cells are taken this much wider than they are, in degrees
WIDER = 1e-9


def _unit(lat: np.ndarray, lon: np.ndarray) -> np.ndarray:
    la, lo = np.radians(lat), np.radians(lon)
    return np.stack([np.cos(la) * np.cos(lo), np.cos(la) * np.sin(lo), np.sin(la)], axis=-1)


def _shrunk(c: np.ndarray, places: np.ndarray, seen_from: list, nearest, beaten) -> np.ndarray:
    """Candidates left after each of a few points of the cell has had its nearest one rule others out."""
    ruled: set[int] = set()
    for point in seen_from:
        b = int(nearest(places, point))
        if int(c[b]) not in ruled:
            ruled.add(int(c[b]))
            keep = ~beaten(places, places[b])
            c, places = c[keep], places[keep]
            if len(c) <= 2:
                break
    return c


class _Euclid:
    """Dominance in the plane of degrees."""

    def __init__(self, lat: np.ndarray, lon: np.ndarray):
        self.place = np.stack([lat, lon], axis=1)

    def kept(self, c: np.ndarray, center: tuple[float, float], half: float) -> tuple[np.ndarray, float]:
        """The candidates that can be nearest somewhere in the box around ``center``, and the least distance from there."""
        at = self.place[c] - np.asarray(center)
        square = at[:, 0] ** 2 + at[:, 1] ** 2
        closest = float(np.sqrt(square.min()))
        near = closest + 2 * np.sqrt(2) * half
        keep = square <= near * near * (1 + 1e-9) + 1e-9
        c, at, square = c[keep], at[keep], square[keep]
        margin = 1e-11 + 1e-14 * float(square.max() + 2 * half * half)

        def beaten(z, by):
            # |p - z|^2 - |p - by|^2 at the corner where it is least
            return (z * z).sum(axis=1) - (by * by).sum() - 2 * half * np.abs(z - by).sum(axis=1) > margin

        points = [np.asarray([x, y]) * half for x, y in ((0, 0), (-1, -1), (-1, 1), (1, -1), (1, 1))]
        return _shrunk(c, at, points, lambda z, p: ((z * z).sum(axis=1) - 2 * z @ p).argmin(), beaten), closest


class _Haversine:
    """Dominance on the sphere."""

    def __init__(self, lat: np.ndarray, lon: np.ndarray):
        self.place = _unit(lat, lon)

    def kept(self, c: np.ndarray, center: tuple[float, float], half: float) -> tuple[np.ndarray, float]:
        lat, lon = center
        if abs(lat) - half > 90 or abs(lon) - half > 180:
            return c[:1], 0.0  # no place of the earth is there
        south, north = max(-90.0, lat - half), min(90.0, lat + half)
        west, east = max(-180.0, lon - half), min(180.0, lon + half)
        s, n, w, e = np.radians([south, north, west, east])
        # angles from the box's center: to its points at most ``reach``, to the nearest zone ``closest``
        reach = np.radians(half) * (1 + np.cos(np.radians(max(0.0, abs(lat) - half))))
        dots = self.place[c] @ _unit(np.asarray(lat), np.asarray(lon))
        closest = np.arccos(min(1.0, dots.max()))
        c = c[dots >= np.cos(min(np.pi, closest + 2 * reach + 1e-7)) - 1e-12]
        # so much of a dot product is a difference of 4e-12 in angle; the formula that decides in the end is good
        # to 1e-8 only where every zone is almost opposite
        margin = 1e-7 if closest > 3 else 2e-15 + 4e-12 * min(1.0, closest + 3 * reach)

        def beaten(z, by):
            # p . v = cos(lat) (r cos(lon - l)) + v_z sin(lat): least over the box's longitudes, then over its latitudes
            v = by - z
            r, turn = np.hypot(v[:, 0], v[:, 1]), np.arctan2(v[:, 1], v[:, 0])
            across = np.minimum(np.cos(w - turn), np.cos(e - turn))
            away = np.mod(turn + np.pi - w, 2 * np.pi) <= e - w
            m = r * np.where(away, -1.0, across)
            least = np.minimum(np.cos(s) * m + np.sin(s) * v[:, 2], np.cos(n) * m + np.sin(n) * v[:, 2])
            low = np.arctan2(v[:, 2], m) + np.pi  # where the sum is least of all
            low -= 2 * np.pi * (low > np.pi)
            least = np.where((low > s) & (low < n), -np.hypot(m, v[:, 2]), least)
            return least > margin

        points = [_unit(np.asarray(a), np.asarray(b)) for a, b in (((south + north) / 2, (west + east) / 2), (south, west), (south, east), (north, west), (north, east))]
        return _shrunk(c, self.place[c], points, lambda z, p: (z @ p).argmax(), beaten), float(np.degrees(closest))


def build(ids: np.ndarray, lat: np.ndarray, lon: np.ndarray, metric: str) -> dict[str, np.ndarray]:
    """Arrays of the index: ``starts`` (first cell number of each leaf), ``first`` (its place in ``candidates``), and the zones.

    Zones at one place are one (the lowest id, which wins every tie).
    """
    order = np.lexsort((ids, lon, lat))
    ids, lat, lon = ids[order], lat[order], lon[order]
    one = np.r_[True, (lat[1:] != lat[:-1]) | (lon[1:] != lon[:-1])] if len(ids) else np.zeros(0, bool)
    ids, lat, lon = ids[one], lat[one], lon[one]
    space = (_Euclid if metric == "euclid" else _Haversine)(lat, lon)
    starts, first, candidates = [], [0], []
    stack = [(0, 0, 0, np.arange(len(ids)), 0)] if len(ids) else []
    while stack:
        level, x, y, c, far = stack.pop()
        width = SPAN / (1 << level)
        if len(c) > 1:
            center = (x + 0.5) * width - SPAN / 2, (y + 0.5) * width - SPAN / 2
            c, closest = space.kept(c, center, width / 2 + WIDER)
            far += closest > 2 * width
        if len(c) <= LEAF or level == LEVELS or far > FAR_LEVELS:
            starts.append(_interleaved(x, y) << (2 * (LEVELS - level)))
            candidates.append(c)
            first.append(first[-1] + len(c))
        else:  # the last pushed comes first: starts ascend
            stack += [(level + 1, 2 * x + a, 2 * y + b, c, far) for a, b in ((1, 1), (1, 0), (0, 1), (0, 0))]
    return {
        "starts": np.asarray(starts, np.int64), "first": np.asarray(first, np.int32),
        "candidates": np.concatenate(candidates).astype(np.int32) if candidates else np.zeros(0, np.int32),
        "ids": ids, "lat": lat, "lon": lon,
    }


def _interleaved(x: int, y: int) -> int:
    """Bits of both numbers in turns, ``x`` first."""
    return sum((x >> k & 1) << (2 * k + 1) | (y >> k & 1) << (2 * k) for k in range(LEVELS))


_SPREAD = ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555))


def let(value: Column, body) -> Column:
    """``body(value)``, where the value is computed once per row however often the body names it (a lambda's argument)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _spread(x: Column) -> Column:
    def stage(shift: int, mask: int):
        return lambda v: v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(mask))

    for shift, mask in _SPREAD:
        x = let(x, stage(shift, mask))
    return x


def _canonical(lat: Column, lon: Column) -> tuple[Column, Column]:
    """The same place with latitude in -90..90 and longitude in -180..180, as the sphere sees it."""
    turn = F.pmod(lat + 90, F.lit(360.0))
    over = turn > 180
    return F.when(over, 360 - turn).otherwise(turn) - 90, F.pmod(lon + F.when(over, 360.0).otherwise(180.0), F.lit(360.0)) - 180


class ZoneIndex:
    """The index of a zone dimension; ``nearest(lat, lon)`` is an expression of one row."""

    def __init__(self, zones: DataFrame, metric: str = "euclid"):
        if metric not in METRICS:
            raise ValueError(f"unknown metric {metric!r}")
        spark = zones.sparkSession
        z = zones.select(
            F.col("location_id").alias("id"), F.col("latitude").cast("double").alias("lat"), F.col("longitude").cast("double").alias("lon")
        ).filter("lat is not null and lon is not null and not isnan(lat) and not isnan(lon)")
        got = z.limit(MAX_ZONES + 1).toArrow()  # a dimension, its size is checked
        if got.num_rows > MAX_ZONES:
            raise ValueError(f"more than {MAX_ZONES} zones")
        self.metric, self.id_type = metric, z.schema["id"].dataType
        self.arrays = build(*(got.column(c).to_numpy() for c in ("id", "lat", "lon")), metric)
        self.leaves = len(self.arrays["starts"])
        row = spark.createDataFrame(pa.table({k: pa.array([v]) for k, v in self.arrays.items()}))._jdf.head()
        lit = spark._jvm.org.apache.spark.sql.functions.lit
        self.value = {k: Column(lit(row.getAs(k))) for k in self.arrays}

    def leaf(self, lat: Column, lon: Column) -> Column:
        """Number of the leaf with the point; null outside the root square."""
        a, b = (lat, lon) if self.metric == "euclid" else _canonical(lat, lon)
        half = SPAN / 2
        cell = lambda x: _spread(F.least(F.floor((x + half) * F.lit((1 << LEVELS) / (2 * half))), F.lit((1 << LEVELS) - 1)))
        starts = self.value["starts"]
        steps = F.array(*(F.lit(1 << k) for k in reversed(range(self.leaves.bit_length()))))
        last = lambda code: F.aggregate(  # noqa: E731  the last leaf that starts at or before the cell
            steps, F.lit(0), lambda at, s: F.when(F.coalesce(F.get(starts, at + s) <= code, F.lit(False)), at + s).otherwise(at)
        )
        inside = lambda p: (F.abs(p["a"]) < half) & (F.abs(p["b"]) < half)
        code = lambda p: F.shiftleft(cell(p["a"]), 1).bitwiseOR(cell(p["b"]))
        return let(F.struct(a.alias("a"), b.alias("b")), lambda p: F.when(inside(p), let(code(p), last)))

    def nearest(self, lat: Column, lon: Column) -> Column:
        """Id of the nearest zone, the lowest id on ties of the distance rounded to 12 digits; null without coordinates."""
        if not self.leaves:
            return F.lit(None).cast(self.id_type)
        metric = METRICS[self.metric]
        index, ids, zlat, zlon = self.value, self.value["ids"], self.value["lat"], self.value["lon"]

        def best(p: Column, which: Column) -> Column:
            by = lambda i: F.struct(rounded(metric(p["lat"], p["lon"], F.get(zlat, i), F.get(zlon, i))).alias("d"), F.get(ids, i).alias("id"))
            return F.array_min(F.transform(which, by))["id"]

        def found(p: Column) -> Column:
            of_leaf = lambda n: F.slice(index["candidates"], F.get(index["first"], n) + 1, F.get(index["first"], n + 1) - F.get(index["first"], n))
            everywhere = F.sequence(F.lit(0), F.lit(len(self.arrays["ids"]) - 1))
            return let(self.leaf(p["lat"], p["lon"]), lambda n: best(p, F.when(n.isNotNull(), of_leaf(n)).otherwise(everywhere)))

        point = F.when(lat.isNotNull() & lon.isNotNull(), F.struct(lat.alias("lat"), lon.alias("lon")))
        return let(point, lambda p: F.when(p.isNotNull(), found(p))).cast(self.id_type)

    def candidates_per_leaf(self) -> np.ndarray:
        return np.diff(self.arrays["first"])
