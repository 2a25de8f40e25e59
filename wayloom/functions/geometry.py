"""Rings of points: area, centroid, containment, simplification and clipping.

A ring is an array of (lat, lng) structs, open: its last point does not repeat the
first. Area, centroid and containment are built from array functions; simplification and
clipping, which are sequential, run in Arrow functions that treat all rings of a batch in step.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .grid import M_PER_DEG, TILE_DEG

RING = T.ArrayType(T.StructType([T.StructField("lat", T.DoubleType()), T.StructField("lng", T.DoubleType())]))
# Tolerances and least areas, fine and coarse.
SIMPLIFY_M, COARSE_SIMPLIFY_M = 10.0, 50.0
LEAST_M2, LEAST_CLIPPED_M2 = 2000.0, 1000.0
COARSE_LEAST_M2, COARSE_LEAST_CLIPPED_M2 = 50_000.0, 25_000.0
COARSE_PAD_M = 40.0
SAMPLE_OFFSETS = [(0.25, 0.25), (0.25, 0.75), (0.75, 0.25), (0.75, 0.75)]  # (south-north, west-east): SW, SE, NW, NE


def _next(ring: Column) -> Column:
    return F.concat(F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 1, 1))


def cross_sum(ring: Column, x: str = "lng", y: str = "lat") -> Column:
    """Twice the signed area of a ring in its own units."""
    return F.aggregate(F.zip_with(ring, _next(ring), lambda a, b: a[x] * b[y] - b[x] * a[y]), F.lit(0).cast("double"), lambda s, v: s + v)


def area_m2(ring: Column) -> Column:
    """Area of a ring, on a plane true at its first point's latitude."""
    scale = F.cos(F.radians(F.element_at(ring, 1)["lat"])) * (M_PER_DEG * M_PER_DEG / 2)
    return F.abs(cross_sum(ring)) * scale


def centroid(ring: Column) -> Column:
    """(lat, lng) of a ring's centroid, relative to its first point for accuracy."""
    first = F.element_at(ring, 1)
    local = F.transform(ring, lambda p: F.struct((p["lat"] - first["lat"]).alias("lat"), (p["lng"] - first["lng"]).alias("lng")))
    zero = F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))
    pairs = F.zip_with(local, _next(local), lambda p, q: F.struct(p["lng"].alias("x1"), p["lat"].alias("y1"), q["lng"].alias("x2"), q["lat"].alias("y2")))

    def add(s: Column, e: Column) -> Column:
        c = e["x1"] * e["y2"] - e["x2"] * e["y1"]
        return F.struct((s["a"] + c).alias("a"), (s["x"] + (e["x1"] + e["x2"]) * c).alias("x"), (s["y"] + (e["y1"] + e["y2"]) * c).alias("y"))

    total = F.aggregate(pairs, zero, add)
    part = lambda k: F.coalesce(F.try_divide(total[k], total["a"] * 3), F.lit(0.0))
    return F.struct((first["lat"] + part("y")).alias("lat"), (first["lng"] + part("x")).alias("lng"))


def crossings_at(rings: Column, lat: Column) -> Column:
    """Array of the longitudes at which edges of any ring cross a latitude: edges half open."""

    def crossings(ring: Column) -> Column:
        def crosses(a: Column, b: Column) -> Column:
            spans = (a["lat"] > lat) != (b["lat"] > lat)
            return F.when(spans, F.try_divide((b["lng"] - a["lng"]) * (lat - a["lat"]), b["lat"] - a["lat"]) + a["lng"])

        return F.filter(F.zip_with(ring, _next(ring), crosses), lambda x: x.isNotNull())

    return F.flatten(F.transform(rings, crossings))


def between(crossings: Column, lng: Column) -> Column:
    """Even-odd rule: whether an odd number of crossings lies east of a longitude, strictly."""
    return F.size(F.filter(crossings, lambda x: lng < x)) % 2 == 1


def contains(rings: Column, lat: Column, lng: Column) -> Column:
    """Even-odd containment over all rings, holes included: edges half open, strictly above."""
    return between(crossings_at(rings, lat), lng)


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())


def simplified(lat: np.ndarray, lng: np.ndarray, size: np.ndarray, tolerance_m: float) -> np.ndarray:
    """Whether each point of open rings, one behind another, is kept by Douglas-Peucker.

    A ring is closed over its two mutually far points; fewer than four points stay. All
    stretches of all rings that may lose points are halved in step.
    """
    start = np.cumsum(size) - size
    keep = np.repeat(size < 4, size)
    ring = np.flatnonzero(size >= 4)
    if not len(ring):
        return keep
    n, head = size[ring], start[ring]
    # Points on a plane true at the first latitude, each ring with its first point again at the end.
    first = np.cumsum(n + 1) - (n + 1)
    at = _ranges(first, n + 1)
    nth = at - np.repeat(first, n + 1)
    source = np.repeat(head, n + 1) + np.where(nth == np.repeat(n, n + 1), 0, nth)
    x, y = lng[source] * np.repeat(np.cos(np.radians(lat[head])) * M_PER_DEG, n + 1), lat[source] * M_PER_DEG
    away = (x - np.repeat(x[first], n + 1)) ** 2 + (y - np.repeat(y[first], n + 1)) ** 2
    far = first + _first_of(away, first, np.maximum.reduceat(away, first), n + 1)
    keep[source[first]] = keep[source[far]] = True
    a, b = np.concatenate([first, far]), np.concatenate([far, first + n])
    while True:
        open_ = b - a > 1
        a, b = a[open_], b[open_]
        if not len(a):
            return keep
        many = b - a - 1
        begin = np.cumsum(many) - many
        k = _ranges(a + 1, many)
        each = lambda v: np.repeat(v, many)  # noqa: B023, E731
        dx, dy = x[b] - x[a], y[b] - y[a]
        length = dx * dx + dy * dy
        along = (x[k] - each(x[a])) * each(dx) + (y[k] - each(y[a])) * each(dy)
        t = np.clip(np.divide(along, each(length), out=np.zeros(len(k)), where=each(length) > 0), 0.0, 1.0)
        off = (x[k] - each(x[a]) - t * each(dx)) ** 2 + (y[k] - each(y[a]) - t * each(dy)) ** 2
        worst = np.maximum.reduceat(off, begin)
        split = a + 1 + _first_of(off, begin, worst, many)
        beyond = worst > tolerance_m * tolerance_m
        a, b, split = a[beyond], b[beyond], split[beyond]
        keep[source[split]] = True
        a, b = np.concatenate([a, split]), np.concatenate([split, b])


def _first_of(values: np.ndarray, begin: np.ndarray, wanted: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Where in its group each wanted value stands first."""
    hit = np.flatnonzero(values == np.repeat(wanted, size))
    return hit[np.searchsorted(hit, begin)] - begin


def clipped(lat: np.ndarray, lng: np.ndarray, size: np.ndarray, box: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sutherland-Hodgman clipping of open rings, one behind another, each to its box (south, north, west, east)."""
    points = [lat, lng]
    for bound, axis, sign in zip(box, (0, 0, 1, 1), (1, -1, 1, -1), strict=True):
        x, other = points[axis], points[1 - axis]
        row = np.repeat(np.arange(len(size)), size)
        edge = bound[row]
        before = np.arange(len(x)) - 1
        some = size > 0
        before[(np.cumsum(size) - size)[some]] = (np.cumsum(size) - 1)[some]
        inside = (x - edge) * sign >= 0
        cross = inside != inside[before]
        t = np.divide(edge - x[before], x - x[before], out=np.zeros(len(x)), where=cross)
        cut = other[before] + t * (other - other[before])
        many = cross.astype(np.int64) + inside
        place = np.cumsum(many) - many
        new = [np.empty(many.sum()), np.empty(many.sum())]
        new[axis][place[cross]], new[1 - axis][place[cross]] = edge[cross], cut[cross]
        own = place[inside] + cross[inside]
        new[axis][own], new[1 - axis][own] = x[inside], other[inside]
        points, size = new, np.bincount(row, many, len(size)).astype(np.int64)
    return points[0], points[1], size


def simplify_points(points: list[tuple[float, float]], tolerance_m: float) -> list[tuple[float, float]]:
    """One open ring simplified."""
    lat, lng = np.array(points, float).reshape(-1, 2).T
    return [p for p, k in zip(points, simplified(lat, lng, np.array([len(points)]), tolerance_m), strict=True) if k]


def clip_points(points: list[tuple[float, float]], south: float, north: float, west: float, east: float) -> list[tuple[float, float]]:
    """One open ring clipped to a box."""
    lat, lng = np.array(points, float).reshape(-1, 2).T
    a, o, _ = clipped(lat, lng, np.array([len(points)]), [np.array([float(x)]) for x in (south, north, west, east)])
    return list(zip(a.tolist(), o.tolist(), strict=True))


def _open(rings: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Latitudes, longitudes and sizes of an array of rings; a null ring has no points."""
    lat, lng = (c.to_numpy(zero_copy_only=False) for c in rings.flatten().flatten())
    return lat, lng, pc.fill_null(pc.list_value_length(rings), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def _close(lat: np.ndarray, lng: np.ndarray, size: np.ndarray, like: pa.Array) -> pa.Array:
    """An array of rings, null where another is."""
    offsets = pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32())
    points = pa.StructArray.from_arrays([pa.array(lat, pa.float64()), pa.array(lng, pa.float64())], names=["lat", "lng"])
    return pa.ListArray.from_arrays(offsets, points, mask=like.is_null())


def simplify(tolerance_m: float = SIMPLIFY_M):
    """Arrow function: a ring simplified to a tolerance in metres."""

    @F.arrow_udf(RING)
    def run(rings: pa.Array) -> pa.Array:
        lat, lng, size = _open(rings)
        keep = simplified(lat, lng, size, tolerance_m)
        return _close(lat[keep], lng[keep], np.bincount(np.repeat(np.arange(len(size)), size), keep, len(size)).astype(np.int64), rings)

    return run


@F.arrow_udf(RING)
def clip(rings: pa.Array, south: pa.Array, north: pa.Array, west: pa.Array, east: pa.Array) -> pa.Array:
    """Arrow function: a ring clipped to a box; empty if nothing is left."""
    lat, lng, size = _open(rings)
    return _close(*clipped(lat, lng, size, [x.to_numpy(zero_copy_only=False).astype(float) for x in (south, north, west, east)]), rings)


@F.arrow_udf(T.ArrayType(RING))
def clip_all(rings: pa.Array, south: pa.Array, north: pa.Array, west: pa.Array, east: pa.Array) -> pa.Array:
    """Arrow function: `clip` for all rings of an array, of which each row has one."""
    many = pc.list_value_length(rings).to_numpy(zero_copy_only=False).astype(np.int64)
    every = rings.flatten()
    lat, lng, size = _open(every)
    cut = _close(*clipped(lat, lng, size, [np.repeat(x.to_numpy(zero_copy_only=False).astype(float), many) for x in (south, north, west, east)]), every)
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(many)]), pa.int32()), cut)


def coarse_box(i: Column, j: Column) -> tuple[Column, Column, Column, Column]:
    """A tile's own rectangle with the pad of coarse tiles: south, north, west, east."""
    dy = F.lit(COARSE_PAD_M / M_PER_DEG)
    dx = F.lit(COARSE_PAD_M / M_PER_DEG) / F.cos(F.radians((i + 0.5) * TILE_DEG))
    return i * TILE_DEG - dy, (i + 1) * TILE_DEG + dy, j * TILE_DEG - dx, (j + 1) * TILE_DEG + dx


def area_km2(rings: list[list[tuple[float, float]]], step: float = 0.0015) -> float:
    """Area inside rings by scanlines under the even-odd rule, so it agrees with `contains`."""
    points = [p for r in rings for p in r]
    if not points:
        return 0.0
    lat = (math.floor(min(p[0] for p in points) / step) + 0.5) * step
    top, total = max(p[0] for p in points), 0.0
    while lat < top:
        xs = sorted(a[1] + (b[1] - a[1]) * (lat - a[0]) / (b[0] - a[0]) for r in rings for a, b in zip(r, [*r[1:], r[0]], strict=True) if (a[0] > lat) != (b[0] > lat))
        total += sum(b - a for a, b in zip(xs[::2], xs[1::2], strict=True)) * math.cos(math.radians(lat)) * step
        lat += step
    return total * (M_PER_DEG / 1000.0) ** 2
