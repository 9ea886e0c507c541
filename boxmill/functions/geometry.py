"""Oriented boxes as Columns: corners, rectangles, areas and overlaps.

Corners are array<struct<x:double,y:double>> of four points. y points down, so the
order made by order_corners is clockwise on the screen. A null in any argument gives
null unless a docstring says otherwise.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import add, and_

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

CORNERS = "array<struct<x:double,y:double>>"
#: Sides shorter than this count as flat.
FLAT = 1e-9


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once."""
    return F.transform(F.array(value), body)[0]


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def each(corners: Column, f: Callable[[Column], Column]) -> Column:
    """f of every point; four of them are written out, as Spark does not compile a lambda."""
    return F.when(F.size(corners) == 4, F.array(*[f(F.get(corners, F.lit(i))) for i in range(4)])).otherwise(F.transform(corners, f))


def order_corners(corners: Column) -> Column:
    """The points by angle about their mean, from the one with the least x + y on.

    Angles ascend; equal angles keep the given order; of equal sums the first in that
    order leads. Empty stays empty.
    """
    return let(corners, lambda c: order_four([_xy(F.get(c, F.lit(i))) for i in range(4)], _order_any(c), F.size(c) == 4))


def _xy(p: Column) -> tuple[Column, Column]:
    return p["x"], p["y"]


def _order_any(corners: Column) -> Column:
    """order_corners of any number of points."""

    def by_angle(c: Column) -> Column:
        n = F.size(c)
        mean = F.struct(
            (F.aggregate(c, F.lit(0.0), lambda s, p: s + p["x"]) / n).alias("x"),
            (F.aggregate(c, F.lit(0.0), lambda s, p: s + p["y"]) / n).alias("y"),
        )
        return let(
            mean,
            lambda m: F.sort_array(F.transform(c, lambda p, i: F.struct(F.atan2(p["y"] - m["y"], p["x"] - m["x"]).alias("a"), i.alias("i"), p["x"].alias("x"), p["y"].alias("y")))),
        )

    def rotate(c: Column) -> Column:
        sums = F.transform(c, lambda p: F.round(p["x"] + p["y"], 9))
        points = F.transform(c, lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y")))
        return let(
            F.array_position(sums, F.array_min(sums)).cast("int"),
            lambda k: F.when(F.size(c) == 0, points).otherwise(F.concat(F.slice(points, k, F.size(c)), F.slice(points, F.lit(1), k - 1))),
        )

    return F.when(F.size(corners) == 0, corners).otherwise(let(let(corners, by_angle), rotate))


def order_four(points: list[tuple[Column, Column]], otherwise: Column | None = None, sure: Column | None = None) -> Column:
    """order_corners of four points, given as x and y.

    Each number is written many times: give columns, or terms of a few operations.
    Those that go round a clearly convex quadrilateral stand in the order of their angles
    already, forwards or backwards, so only the first is looked for. This takes no
    lambda, which Spark would not compile. What is not clearly convex, has no clear
    least x + y or is not `sure` (a condition) goes the long way: otherwise.
    """
    if otherwise is None:
        otherwise = _order_any(F.array(*[point(*p) for p in points]))
    x, y = [p[0] for p in points], [p[1] for p in points]
    side = [(x[(i + 1) % 4] - x[i], y[(i + 1) % 4] - y[i]) for i in range(4)]
    turns = [side[i][0] * side[(i + 1) % 4][1] - side[i][1] * side[(i + 1) % 4][0] for i in range(4)]
    sums = [x[i] + y[i] for i in range(4)]
    # Far more than rounding moves anything; sums count rounded to nine digits.
    room = 1e-9 * reduce(add, [x[i] * x[i] + y[i] * y[i] for i in range(4)])
    least = F.least(*sums)
    alone = reduce(add, [(t - least < 1e-8).cast("int") for t in sums]) == 1
    sure = alone if sure is None else sure & alone

    def from_first(order: tuple[int, ...]) -> Column:
        first = F.when(sums[order[0]] == least, 1).when(sums[order[1]] == least, 2).when(sums[order[2]] == least, 3).otherwise(4)
        return F.slice(F.array(*[point(x[i], y[i]) for i in (*order, *order[:3])]), first, F.lit(4))

    forwards, backwards = from_first((0, 1, 2, 3)), from_first((0, 3, 2, 1))
    return F.when(sure & (F.least(*turns) > room), forwards).when(sure & (F.greatest(*turns) < -room), backwards).otherwise(otherwise)


def rect_points(cx: Column, cy: Column, w: Column, h: Column, degrees: Column) -> list[tuple[Column, Column]]:
    """x and y of the four corners of rect_to_corners."""
    c, s = F.cos(F.radians(degrees)), F.sin(F.radians(degrees))
    u, v = w / 2, h / 2
    at = lambda a, b: (cx + a * u * c - b * v * s, cy + a * u * s + b * v * c)
    return [at(-1, -1), at(1, -1), at(1, 1), at(-1, 1)]


def rect_corners(cx: Column, cy: Column, w: Column, h: Column, degrees: Column) -> Column:
    """Ordered corners of a rectangle with its sides turned by degrees."""
    return order_four(rect_points(cx, cy, w, h, degrees))


def rect_to_corners(cx: Column, cy: Column, w: Column, h: Column, degrees: Column) -> Column:
    """Corners of a rectangle with its sides turned by degrees, not yet ordered."""
    return F.array(*[point(*p) for p in rect_points(cx, cy, w, h, degrees)])


def box_to_corners(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Ordered corners of an axis-aligned box."""
    return order_corners(F.array(point(x1, y1), point(x2, y1), point(x2, y2), point(x1, y2)))


def normalize_corners(corners: Column, width: Column, height: Column, clip: bool = True) -> Column:
    """Corners over the image's size; clip holds them in 0..1. A size of 0 gives null points."""
    share = lambda value, size: F.try_divide(value, size.cast("double"))
    held = (lambda v: F.greatest(F.lit(0.0), F.least(F.lit(1.0), v))) if clip else (lambda v: v)
    return each(corners, lambda p: point(held(share(p["x"], width)), held(share(p["y"], height))))


def denormalize_corners(corners: Column, width: Column, height: Column) -> Column:
    """Ordered corners in pixels."""
    return order_corners(each(corners, lambda p: point(p["x"] * width, p["y"] * height)))


def polygon_area(corners: Column) -> Column:
    """Absolute shoelace area; 0 for fewer than three points."""

    def area(c: Column) -> Column:
        following = F.concat(F.slice(c, 2, F.greatest(F.size(c) - 1, F.lit(0))), F.slice(c, 1, 1))
        crosses = F.zip_with(c, following, lambda p, q: p["x"] * q["y"] - q["x"] * p["y"])
        return F.abs(F.aggregate(crosses, F.lit(0.0), lambda s, x: s + x)) / 2

    p = [F.get(corners, F.lit(i)) for i in range(4)]
    of_four = F.abs(reduce(add, [p[i]["x"] * p[(i + 1) % 4]["y"] - p[(i + 1) % 4]["x"] * p[i]["y"] for i in range(4)])) / 2
    return F.when(F.size(corners) == 4, of_four).otherwise(let(corners, area))


def smallest_rects(points: np.ndarray) -> tuple[np.ndarray, ...]:
    """cx, cy, w, h, angle of the smallest rectangles round n x 4 x 2 points (see min_area_rect); NaN where there is none."""
    first, second = np.triu_indices(4, 1)
    d = points[:, second] - points[:, first]
    angle = np.mod(np.degrees(np.arctan2(d[:, :, 1], d[:, :, 0])), 90.0)
    # A turn within rounding of 90 is 0; equal points give no line.
    angle = np.where(angle > 90 - 1e-9, 0.0, angle)
    c, s = np.cos(np.radians(angle))[:, :, None], np.sin(np.radians(angle))[:, :, None]
    x, y = points[:, None, :, 0], points[:, None, :, 1]
    u, v = x * c + y * s, y * c - x * s
    u0, u1, v0, v1 = u.min(axis=2), u.max(axis=2), v.min(axis=2), v.max(axis=2)
    w, h = u1 - u0, v1 - v0
    area = np.where((d == 0).all(axis=2) | np.isnan(w * h), np.inf, np.round(w * h, 9))
    least = area.min(axis=1, keepdims=True)
    best = np.where(area == least, angle, np.inf).argmin(axis=1)
    rows = np.arange(len(points))
    w, h, angle, c, s = w[rows, best], h[rows, best], angle[rows, best], c[rows, best, 0], s[rows, best, 0]
    mid_u, mid_v = (u0 + u1)[rows, best] / 2, (v0 + v1)[rows, best] / 2
    ok = np.isfinite(least[:, 0]) & (w > FLAT) & (h > FLAT)
    return tuple(np.where(ok, a, np.nan) for a in (mid_u * c - mid_v * s, mid_u * s + mid_v * c, w, h, angle))


def min_area_rect(corners: Column) -> Column:
    """struct<cx,cy,w,h,angle> of the smallest rectangle round four points.

    One of its sides lies along a line through two of the points, so the six lines are
    tried. angle is in [0, 90) degrees and w runs along it; of equal areas the least
    angle wins. Null if a side is flat.
    """

    @F.pandas_udf("cx double, cy double, w double, h double, angle double")
    def smallest(*numbers: pd.Series) -> pd.DataFrame:
        points = np.stack([n.to_numpy(float) for n in numbers], axis=1).reshape(-1, 4, 2)
        return pd.DataFrame(dict(zip(("cx", "cy", "w", "h", "angle"), smallest_rects(points), strict=True)))

    found = smallest(*[F.get(corners, F.lit(i))[k] for i in range(4) for k in ("x", "y")])
    return let(found, lambda r: F.when((F.size(corners) == 4) & (r["w"] > FLAT) & ~F.isnan(r["w"]), r))


def aspect_ratio(w: Column, h: Column) -> Column:
    """Long over short side."""
    return F.greatest(w, h) / (F.least(w, h) + 1e-6)


def rectangularity(area: Column, w: Column, h: Column) -> Column:
    """Share of the rectangle that the area fills."""
    return area / (w * h + 1e-6)


def candidate_score(area: Column, aspect: Column, rect: Column) -> Column:
    """Rank of a proposal: large, long and rectangular ones first."""
    return area + 800.0 * aspect + 1200.0 * rect


def point_in_obb(x: Column, y: Column, corners: Column) -> Column:
    """Whether the point lies inside or on the convex polygon of ordered corners."""

    def inside(c: Column) -> Column:
        following = F.concat(F.slice(c, 2, F.greatest(F.size(c) - 1, F.lit(0))), F.slice(c, 1, 1))
        sides = F.zip_with(c, following, lambda p, q: (q["x"] - p["x"]) * (y - p["y"]) - (q["y"] - p["y"]) * (x - p["x"]))
        return let(sides, lambda s: F.forall(s, lambda v: v >= 0) | F.forall(s, lambda v: v <= 0))

    c = [F.get(corners, F.lit(i)) for i in range(4)]
    sides = [(q["x"] - p["x"]) * (y - p["y"]) - (q["y"] - p["y"]) * (x - p["x"]) for p, q in zip(c, c[1:] + c[:1], strict=True)]
    of_four = reduce(and_, [s >= 0 for s in sides]) | reduce(and_, [s <= 0 for s in sides])
    return F.when(F.size(corners) == 4, of_four).otherwise(let(corners, inside))


def point_in_rect(x: Column, y: Column, cx: Column, cy: Column, w: Column, h: Column, degrees: Column) -> Column:
    """Whether the point lies inside or on the rectangle with its sides turned by degrees.

    Measured along the sides: a point on an edge is not moved off it by the rounding of corners.
    """
    c, s = F.cos(F.radians(degrees)), F.sin(F.radians(degrees))
    return (F.abs((x - cx) * c + (y - cy) * s) <= w / 2) & (F.abs((y - cy) * c - (x - cx) * s) <= h / 2)


def gaussian_iou(a: dict[str, Column], b: dict[str, Column]) -> Column:
    """Overlap of two rotated rectangles as Gaussians (ProbIoU, Llerena et al. 2021).

    a and b have the Columns cx, cy, w, h and deg. Rectangles with a flat side give null.
    """

    def shape(r: dict[str, Column]) -> tuple[Column, Column, Column]:
        along, across = r["w"] * r["w"] / 12, r["h"] * r["h"] / 12
        c, s = F.cos(F.radians(r["deg"])), F.sin(F.radians(r["deg"]))
        return along * c * c + across * s * s, along * s * s + across * c * c, (along - across) * s * c

    (a1, b1, c1), (a2, b2, c2) = shape(a), shape(b)
    dx, dy = b["cx"] - a["cx"], a["cy"] - b["cy"]
    sa, sb, sc = a1 + a2, b1 + b2, c1 + c2
    det = sa * sb - sc * sc
    far = F.try_divide(0.25 * (sa * dy * dy + sb * dx * dx), det) + F.try_divide(0.5 * sc * dx * dy, det)
    size = F.sqrt(F.greatest(F.lit(0.0), a1 * b1 - c1 * c1) * F.greatest(F.lit(0.0), a2 * b2 - c2 * c2))
    apart = F.greatest(F.lit(0.0), far + 0.5 * F.ln(F.try_divide(det, 4 * size)))
    return F.when((size > 0) & (det > 0), 1 - F.sqrt(1 - F.exp(-apart)))


def clip_polygons(subject: np.ndarray, clip: np.ndarray) -> np.ndarray:
    """Area of the intersection of convex polygons (Sutherland and Hodgman 1974), pair by pair.

    Both are n x 4 x 2 with the same sense of rotation. All rows take each clipping side
    together; a row's polygon has up to 8 points, the rest repeat its last one.
    """
    n = len(subject)
    points, count = np.concatenate([subject, np.repeat(subject[:, -1:], 6, axis=1)], axis=1), np.full(n, subject.shape[1])
    area2 = lambda p: (p[:, :, 0] * np.roll(p[:, :, 1], -1, 1) - np.roll(p[:, :, 0], -1, 1) * p[:, :, 1]).sum(axis=1)
    turn = np.sign(area2(clip))
    rows = np.arange(n)
    for side in range(clip.shape[1]):
        a, b = clip[:, side], clip[:, (side + 1) % clip.shape[1]]
        depth = turn[:, None] * ((b - a)[:, None, 0] * (points[:, :, 1] - a[:, None, 1]) - (b - a)[:, None, 1] * (points[:, :, 0] - a[:, None, 0]))
        out, size = np.zeros_like(points), np.zeros(n, int)
        for k in range(points.shape[1]):
            nxt = np.where(k + 1 < count, k + 1, 0)
            here, there, d0, d1 = points[:, k], points[rows, nxt], depth[:, k], depth[rows, nxt]
            live = k < count
            take = live & (d0 >= 0)
            out[rows[take], size[take]] = here[take]
            size += take
            cross = live & ((d0 >= 0) != (d1 >= 0))
            with np.errstate(divide="ignore", invalid="ignore"):
                cut = here + (d0 / (d0 - d1))[:, None] * (there - here)
            cross &= size < points.shape[1]
            out[rows[cross], size[cross]] = cut[cross]
            size += cross
        last = out[rows, np.maximum(size - 1, 0)]
        filler = np.arange(points.shape[1])[None, :] >= size[:, None]
        points, count = np.where(filler[:, :, None], last[:, None, :], out), size
    return np.where(count > 2, np.abs(area2(points)) / 2, 0.0)


def polygon_iou(a: Column, b: Column) -> Column:
    """Exact overlap of two convex four-cornered boxes: intersection over union; 0 for flat ones."""

    @F.pandas_udf("double")
    def overlap(*numbers: pd.Series) -> pd.Series:
        p, q = (np.stack([n.to_numpy(float) for n in side], axis=1).reshape(-1, 4, 2) for side in (numbers[:8], numbers[8:]))
        area = lambda s: np.abs((s[:, :, 0] * np.roll(s[:, :, 1], -1, 1) - np.roll(s[:, :, 0], -1, 1) * s[:, :, 1]).sum(axis=1)) / 2
        shared = np.zeros(len(p))
        touch = ((p.min(axis=1) <= q.max(axis=1)) & (p.max(axis=1) >= q.min(axis=1))).all(axis=1)
        shared[touch] = clip_polygons(p[touch], q[touch])
        union = area(p) + area(q) - shared
        return pd.Series(np.where(union > 0, shared / np.where(union > 0, union, 1), 0.0))

    # Numbers go to Python as they are, not as structs in lists.
    numbers = [F.get(c, F.lit(i))[k] for c in (a, b) for i in range(4) for k in ("x", "y")]
    return F.when((F.size(a) == 4) & (F.size(b) == 4), overlap(*numbers))
