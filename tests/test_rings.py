"""Rings simplified and clipped in step are those of the plain algorithms, one ring at a time."""

import math
import random

from pyspark.sql import functions as F

from wayloom.functions import geometry


def slow_simplify(points: list[tuple[float, float]], tolerance_m: float) -> list[tuple[float, float]]:
    """Douglas-Peucker on an open ring, closed over its two mutually far points; fewer than four stay."""
    n = len(points)
    if n < 4:
        return points
    kx = math.cos(math.radians(points[0][0])) * geometry.M_PER_DEG
    xy = [(lng * kx, lat * geometry.M_PER_DEG) for lat, lng in points]
    far = max(range(n), key=lambda k: (xy[k][0] - xy[0][0]) ** 2 + (xy[k][1] - xy[0][1]) ** 2)
    closed = [*xy, xy[0]]
    keep = {0, far}
    todo = [(0, far), (far, n)]
    while todo:
        a, b = todo.pop()
        (x1, y1), (x2, y2) = closed[a], closed[b]
        dx, dy = x2 - x1, y2 - y1
        length = dx * dx + dy * dy
        worst, at = -1.0, -1
        for k in range(a + 1, b):
            x, y = closed[k]
            t = max(0.0, min(1.0, ((x - x1) * dx + (y - y1) * dy) / length)) if length else 0.0
            d = (x - x1 - t * dx) ** 2 + (y - y1 - t * dy) ** 2
            if d > worst:
                worst, at = d, k
        if worst > tolerance_m * tolerance_m:
            keep.add(at)
            todo += [(a, at), (at, b)]
    return [points[k] for k in sorted(keep)]


def slow_clip(points: list[tuple[float, float]], south: float, north: float, west: float, east: float) -> list[tuple[float, float]]:
    """Sutherland-Hodgman clipping of an open ring to a box."""
    for axis, bound, sign in ((0, south, 1), (0, north, -1), (1, west, 1), (1, east, -1)):
        out: list[tuple[float, float]] = []
        for k, q in enumerate(points):
            p = points[k - 1]
            p_in, q_in = (p[axis] - bound) * sign >= 0, (q[axis] - bound) * sign >= 0
            if p_in != q_in:
                t = (bound - p[axis]) / (q[axis] - p[axis])
                other = p[1 - axis] + t * (q[1 - axis] - p[1 - axis])
                out.append((bound, other) if axis == 0 else (other, bound))
            if q_in:
                out.append(q)
        points = out
        if not points:
            break
    return points


def rings(r, n):
    out = [[], [(1.0, 1.0)], [(0.0, 0.0), (1.0, 1.0), (0.0, 1.0)], [(2.0, 2.0)] * 6]
    for _ in range(n):
        k = r.randint(3, 40)
        out.append([(42 + math.sin(2 * math.pi * i / k) * r.uniform(0.001, 0.01), -71 + math.cos(2 * math.pi * i / k) * r.uniform(0.001, 0.01)) for i in range(k)])
    return out


def test_both_are_the_plain_algorithms(spark):
    r = random.Random(3)
    own = rings(r, 300)
    boxes = [(42 + r.uniform(-0.01, 0.0), 42 + r.uniform(0, 0.01), -71 + r.uniform(-0.01, 0), -71 + r.uniform(0, 0.01)) for _ in own]
    rows = [(k, [{"lat": a, "lng": b} for a, b in ring], *box) for k, (ring, box) in enumerate(zip(own, boxes, strict=True))] + [(9999, None, 0.0, 1.0, 0.0, 1.0)]
    df = spark.createDataFrame(rows, "k int, ring array<struct<lat:double,lng:double>>, s double, n double, w double, e double").repartition(3)
    got = {x.k: x for x in df.select("k", geometry.simplify(10.0)("ring").alias("simple"), geometry.clip("ring", "s", "n", "w", "e").alias("cut")).collect()}
    plain = lambda ring: [(p.lat, p.lng) for p in ring]
    for k, (ring, box) in enumerate(zip(own, boxes, strict=True)):
        assert plain(got[k].simple) == slow_simplify(ring, 10.0)
        assert plain(got[k].cut) == slow_clip(ring, *box)
        assert geometry.simplify_points(ring, 200.0) == slow_simplify(ring, 200.0)
    assert got[9999].simple is None and got[9999].cut is None
    assert df.limit(0).select(geometry.simplify()(F.col("ring"))).count() == 0
