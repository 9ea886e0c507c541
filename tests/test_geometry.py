"""Properties of corners, rectangles and overlaps."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from boxmill.functions import geometry as g


def corners(cx, cy, w, h, deg):
    c, s = math.cos(math.radians(deg)), math.sin(math.radians(deg))
    return [(cx + u * c - v * s, cy + u * s + v * c) for u, v in ((-w / 2, -h / 2), (w / 2, -h / 2), (w / 2, h / 2), (-w / 2, h / 2))]


def some_boxes(n=40, seed=3):
    r = random.Random(seed)
    return [(r.uniform(0, 20), r.uniform(0, 20), r.uniform(4, 12), r.uniform(1, 5), r.uniform(0, 180)) for _ in range(n)]


def test_order_is_the_same_for_every_permutation(spark):
    rows = []
    for k, box in enumerate(some_boxes(10)):
        c = corners(*box)
        rows += [(k, [c[i] for i in order]) for order in ((0, 1, 2, 3), (3, 1, 0, 2), (2, 3, 0, 1))]
    df = spark.createDataFrame(rows, f"k int, c {g.CORNERS}")
    got = df.select("k", g.order_corners(F.col("c")).alias("c")).collect()
    by = {}
    for r in got:
        by.setdefault(r.k, set()).add(tuple((round(p.x, 9), round(p.y, 9)) for p in r.c))
    assert all(len(v) == 1 for v in by.values())
    for v in by.values():
        (c,) = v
        assert min(x + y for x, y in c) == pytest.approx(c[0][0] + c[0][1])


def test_smallest_rectangle_holds_its_points_and_is_no_larger_than_the_box(spark):
    r = random.Random(5)
    rows = [(k, [(r.uniform(0, 9), r.uniform(0, 9)) for _ in range(4)]) for k in range(60)]
    df = spark.createDataFrame(rows, f"k int, c {g.CORNERS}")
    for x in df.select("c", g.min_area_rect(F.col("c")).alias("r")).collect():
        c, s = math.cos(math.radians(x.r.angle)), math.sin(math.radians(x.r.angle))
        for p in x.c:
            u, v = (p.x - x.r.cx) * c + (p.y - x.r.cy) * s, (p.y - x.r.cy) * c - (p.x - x.r.cx) * s
            assert abs(u) <= x.r.w / 2 + 1e-6 and abs(v) <= x.r.h / 2 + 1e-6
        xs, ys = [p.x for p in x.c], [p.y for p in x.c]
        assert x.r.w * x.r.h <= (max(xs) - min(xs)) * (max(ys) - min(ys)) + 1e-6


def test_flat_points_have_no_rectangle(spark):
    df = spark.createDataFrame([([(0.0, 0.0), (1.0, 1.0), (2.0, 2.0), (3.0, 3.0)],), ([(1.0, 1.0)] * 4,)], f"c {g.CORNERS}")
    assert [r[0] for r in df.select(g.min_area_rect(F.col("c"))).collect()] == [None, None]


def test_normalize_and_back(spark):
    rows = [(k, corners(300 + b[0], 200 + b[1], *b[2:])) for k, b in enumerate(some_boxes())]
    df = spark.createDataFrame(rows, f"k int, c {g.CORNERS}").withColumn("c", g.order_corners(F.col("c")))
    back = g.denormalize_corners(g.normalize_corners(F.col("c"), F.lit(640), F.lit(480)), F.lit(640), F.lit(480))
    for r in df.select("c", back.alias("b")).collect():
        for p, q in zip(r.c, r.b, strict=True):
            assert (p.x, p.y) == (pytest.approx(q.x), pytest.approx(q.y))


def sampled_iou(a, b, n=400):
    def inside(box, x, y):
        cx, cy, w, h, deg = box
        c, s = math.cos(math.radians(deg)), math.sin(math.radians(deg))
        return (np.abs((x - cx) * c + (y - cy) * s) <= w / 2) & (np.abs((y - cy) * c - (x - cx) * s) <= h / 2)

    x, y = np.meshgrid(np.linspace(-10, 32, n), np.linspace(-10, 32, n))
    p, q = inside(a, x, y), inside(b, x, y)
    return (p & q).sum() / max(1, (p | q).sum())


def test_polygon_overlap_against_sampling(spark):
    boxes = some_boxes(30)
    rows = [(i, j, corners(*boxes[i]), corners(*boxes[j])) for i in range(30) for j in (i, (i + 1) % 30, (i + 2) % 30)]
    df = spark.createDataFrame(rows, f"i int, j int, a {g.CORNERS}, b {g.CORNERS}")
    got = df.select("i", "j", g.polygon_iou(F.col("a"), F.col("b")).alias("p"), g.polygon_iou(F.col("b"), F.col("a")).alias("q")).collect()
    for r in got:
        assert r.p == pytest.approx(r.q, abs=1e-9)
        assert r.p == pytest.approx(sampled_iou(boxes[r.i], boxes[r.j]), abs=0.03)
        if r.i == r.j:
            assert r.p == pytest.approx(1.0)


def test_polygon_overlap_of_null_is_null(spark):
    df = spark.createDataFrame([(None, corners(0, 0, 2, 2, 0))], f"a {g.CORNERS}, b {g.CORNERS}")
    assert df.select(g.polygon_iou(F.col("a"), F.col("b"))).first()[0] is None


def test_gaussian_overlap_is_symmetric_and_one_on_itself(spark):
    boxes = some_boxes(12)
    rows = [(*a, *b) for a in boxes for b in boxes]
    names = [f"{s}_{c}" for s in "ab" for c in ("cx", "cy", "w", "h", "deg")]
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names))
    side = lambda s: {c: F.col(f"{s}_{c}") for c in ("cx", "cy", "w", "h", "deg")}
    for r in df.select("*", g.gaussian_iou(side("a"), side("b")).alias("p"), g.gaussian_iou(side("b"), side("a")).alias("q")).collect():
        assert r.p == pytest.approx(r.q, abs=1e-9) and -1e-9 <= r.p <= 1
        if r[:5] == r[5:10]:
            assert r.p == pytest.approx(1.0, abs=1e-6)
