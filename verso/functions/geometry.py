"""Outlines and distances as column expressions over arrays of points (structs x, y)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from .noise import noise


def point(x: Column, y: Column) -> Column:
    return F.struct(x.alias("x"), y.alias("y"))


def balloon(x0: Column, y0: Column, x1: Column, y1: Column, pad: float = 6, wobble: float = 0.12, freq: float = 0.45, samples: int = 32, seed: int = 0) -> Column:
    """A wobbly loop of points around a box."""

    def at(i: Column) -> Column:
        angle = i.cast("double") / float(samples) * math.pi * 2
        step = i.cast("double") * freq
        swell = 1 + (noise(step, F.lit(seed)) + noise(step * 2.3 + 100, F.lit(seed)) * 0.5) * wobble
        return point((x0 + x1) / 2 + F.cos(angle) * ((x1 - x0) / 2 + pad) * swell, (y0 + y1) / 2 + F.sin(angle) * ((y1 - y0) / 2 + pad) * swell)

    return F.transform(F.sequence(F.lit(0), F.lit(samples - 1)), at)


def catmull_rom(points: Column, tension: float = 0.5, samples: int = 12) -> Column:
    """A smooth line through points; with under three points the points themselves."""
    n = F.size(points)
    get = lambda i: F.element_at(points, i)
    beyond = lambda a, b: point(2 * a["x"] - b["x"], 2 * a["y"] - b["y"])
    padded = F.concat(F.array(beyond(get(1), get(2))), points, F.array(beyond(get(-1), get(-2))))

    def segment(i: Column) -> Column:
        p = F.slice(padded, i, 4)

        def at(k: Column) -> Column:
            t = k.cast("double") / float(samples)

            def along(c: str) -> Column:
                a, b, d, e = (F.element_at(p, j)[c] for j in (1, 2, 3, 4))
                return 0.5 * (2 * b + (d - a) * t * tension + (2 * a - 5 * b + 4 * d - e) * (t * t) + (3 * b - a - 3 * d + e) * (t * t * t))

            return point(along("x"), along("y"))

        return F.transform(F.sequence(F.lit(1), F.lit(samples)), at)

    curve = F.concat(F.array(get(1)), F.flatten(F.transform(F.sequence(F.lit(1), n - 1), segment)))
    return F.when(n < 3, points).otherwise(curve)


def polygon_area(points: Column) -> Column:
    """Signed, by the sum of cross products around the loop."""
    n = F.size(points)
    cross = F.transform(points, lambda p, i: p["x"] * F.element_at(points, (i + 1) % n + 1)["y"] - F.element_at(points, (i + 1) % n + 1)["x"] * p["y"])
    return F.aggregate(cross, F.lit(0.0), lambda s, c: s + c) / 2


def path_length(points: Column) -> Column:
    n = F.size(points)
    steps = F.transform(F.slice(points, 1, n - 1), lambda p, i: F.sqrt((F.element_at(points, i + 2)["x"] - p["x"]) ** 2 + (F.element_at(points, i + 2)["y"] - p["y"]) ** 2))
    return F.when(n < 2, 0.0).otherwise(F.aggregate(steps, F.lit(0.0), lambda s, c: s + c))


def sdf_rect(x: Column, y: Column, cx: Column, cy: Column, hx: Column, hy: Column, r: Column) -> Column:
    """Signed distance to a rounded rectangle with centre c and half sizes h."""
    dx, dy = F.abs(x - cx) - hx, F.abs(y - cy) - hy
    ox, oy = F.greatest(dx, F.lit(0.0)), F.greatest(dy, F.lit(0.0))
    return F.sqrt(ox * ox + oy * oy) + F.least(F.greatest(dx, dy), F.lit(0.0)) - r


def smooth_min(a: Column, b: Column, k: float) -> Column:
    if k <= 0:
        return F.least(a, b)
    h = F.least(F.greatest(0.5 + 0.5 * (b - a) / k, F.lit(0.0)), F.lit(1.0))
    return b * (1 - h) + a * h - k * h * (1 - h)


def radius_at(first: Column, middle: Column, last: Column, t: Column) -> Column:
    """Half-width of a neck at t from 0 to 1."""
    ease = lambda u: u * u * (3 - 2 * u)
    return F.when(t < 0.5, first + (middle - first) * ease(t / 0.5)).otherwise(middle + (last - middle) * ease((t - 0.5) / 0.5)) / 2


def neck_anchors(a: dict[str, Column], b: dict[str, Column]) -> Column:
    """struct(ax, ay, bx, by): where a neck between two boxes is attached, by how they lie to each other."""
    mid = lambda c, k: (c[k + "0"] + c[k + "1"]) / 2.0

    def within(v: Column, c: dict[str, Column], k: str, margin: int) -> Column:
        low, high = c[k + "0"] + margin, c[k + "1"] - margin
        return F.when(low > high, (low + high) / 2.0).otherwise(F.least(F.greatest(v, low.cast("double")), high.cast("double")))

    def ends(ax: Column, ay: Column, bx: Column, by: Column) -> Column:
        return F.struct(*(v.cast("double").alias(n) for v, n in ((ax, "ax"), (ay, "ay"), (bx, "bx"), (by, "by"))))

    upright = lambda ya, yb: ends(within(mid(b, "x"), a, "x", 4), ya, within(mid(a, "x"), b, "x", 4), yb)
    level = lambda xa, xb: ends(xa, within(mid(b, "y"), a, "y", 3), xb, within(mid(a, "y"), b, "y", 3))
    below, above = b["y0"] - a["y1"] >= -4, a["y0"] - b["y1"] >= -4
    return F.when(below, upright(a["y1"], b["y0"])).when(above, upright(a["y0"], b["y1"])).when(a["x1"] <= b["x0"], level(a["x1"], b["x0"])).otherwise(level(a["x0"], b["x1"]))


def box_smooth(points: Column, passes: int = 1) -> Column:
    """Weights 1, 2, 1 around a closed loop, so many times."""
    for _ in range(passes):
        n, now = F.size(points), points
        around = lambda i, now=now, n=n: F.element_at(now, (i + n) % n + 1)
        points = F.transform(now, lambda p, i: point((around(i - 1)["x"] + 2 * p["x"] + around(i + 1)["x"]) / 4, (around(i - 1)["y"] + 2 * p["y"] + around(i + 1)["y"]) / 4))
    return points
