"""Mask helpers against plain loops and hand-worked shapes."""

from __future__ import annotations

import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from boxmill.functions import masks as m

SHAPES = {
    "block": (["#####"] * 3, 15, 8.0),
    "line": (["######"], 6, 0.0),
    "plus": ([".#.", "###", ".#."], 5, 2.0),
    "ring": ([".#.", "#.#", ".#."], 4, 2.0),
    "two": (["##.###", "##.###", "...###"], 13, 4.0),
    "border": (["##", "##"], 4, 1.0),
}


def pixels(rows):
    return np.array([[c == "#" for c in row] for row in rows])


def row(p):
    return (int(p.shape[0]), int(p.shape[1]), [int(x) for x in m.pack(p)])


@pytest.mark.parametrize("name", SHAPES)
def test_pixels_and_contour_area(spark, name):
    shape, count, area = SHAPES[name]
    df = spark.createDataFrame([(row(pixels(shape)),)], f"mask {m.MASK}")
    got = df.select(m.mask_area(F.col("mask")).alias("n"), m.mask_to_obb(F.col("mask"), 0.5).alias("o")).first()
    assert got.n == count
    if area >= 0.5:
        assert got.o.area == pytest.approx(area)
    else:
        assert got.o is None


def test_null_and_empty_masks_have_no_box(spark):
    df = spark.createDataFrame([(1, None), (2, row(np.zeros((3, 3), bool)))], f"k int, mask {m.MASK}")
    got = df.select("k", m.mask_to_obb(F.col("mask")).alias("o"), m.mask_area(F.col("mask")).alias("n")).orderBy("k").collect()
    assert [(r.o, r.n) for r in got] == [(None, None), (None, 0)]


@given(st.integers(1, 9), st.integers(1, 20), st.randoms(use_true_random=False))
@settings(max_examples=50, deadline=None)
def test_pack_round_trip_and_components(h, w, random):
    p = np.array([[random.random() < 0.5 for _ in range(w)] for _ in range(h)])
    assert (m.unpack({"h": h, "w": w, "words": m.pack(p)}) == p).all()
    for diagonal in (False, True):
        labels, n = m.label_components(p, diagonal)
        seen, number = np.zeros((h, w), int), 0
        for y in range(h):
            for x in range(w):
                if p[y, x] and not seen[y, x]:
                    number += 1
                    todo = [(y, x)]
                    while todo:
                        a, b = todo.pop()
                        if 0 <= a < h and 0 <= b < w and p[a, b] and not seen[a, b]:
                            seen[a, b] = number
                            todo += [(a + i, b + j) for i in (-1, 0, 1) for j in (-1, 0, 1) if diagonal or not (i and j)]
        assert number == n
        pairs = set(zip(labels[p].tolist(), seen[p].tolist(), strict=True))
        assert len(pairs) == n


def by_component(p, min_area):
    """The box of the largest contour, each component by itself: its holes filled by a flood of the whole mask."""
    seen, best = np.zeros(p.shape, bool), (-1.0, None)

    def flood(start, free, steps):
        mine, todo = np.zeros(free.shape, bool), [start]
        mine[start] = True
        while todo:
            y, x = todo.pop()
            for a, b in steps:
                q = (y + a, x + b)
                if 0 <= q[0] < free.shape[0] and 0 <= q[1] < free.shape[1] and free[q] and not mine[q]:
                    mine[q] = True
                    todo.append(q)
        return mine

    straight = [(0, 1), (1, 0), (0, -1), (-1, 0)]
    for y, x in zip(*np.nonzero(p), strict=True):
        if not seen[y, x]:
            mine = flood((y, x), p, straight + [(1, 1), (1, -1), (-1, 1), (-1, -1)])
            seen |= mine
            filled = ~flood((0, 0), ~np.pad(mine, 1), straight)
            cells = filled[:-1, :-1].astype(int) + filled[1:, :-1] + filled[:-1, 1:] + filled[1:, 1:]
            area = (cells == 4).sum() + (cells == 3).sum() / 2
            if area > best[0]:
                best = (area, filled[1:-1, 1:-1])
    if best[1] is None or best[0] < min_area:
        return None
    ys, xs = np.nonzero(best[1])
    rect = m.smallest_rectangle(m.hull(np.column_stack([xs, ys])))
    return rect and (*rect, float(best[0]))


def test_largest_contours_of_random_masks():
    """Noise of many densities, rings in rings, and blobs: as component by component."""
    r = np.random.default_rng(1)
    for k in range(1000):
        h, w = r.integers(1, 15, 2)
        p = r.random((h, w)) < r.choice([0.05, 0.3, 0.5, 0.7, 0.95])
        if k % 4 == 0:
            p = np.kron(p, np.ones((2, 2), bool))
        if k % 7 == 0:
            y, x = np.indices(p.shape)
            p = (np.maximum(abs(y - p.shape[0] // 2), abs(x - p.shape[1] // 2)) % 2 == k % 2) ^ (r.random(p.shape) < 0.03)
        got, expected = m.obb_of(p, 0.5), by_component(p, 0.5)
        assert (got and got[:6]) == (expected and pytest.approx(expected)), p.astype(int)


def test_a_large_mask_with_specks_takes_linear_time():
    p = np.random.default_rng(2).random((1024, 1024)) < 0.02
    p[200:700, 300:900] = True
    began = time.perf_counter()
    found = m.obb_of(p, 20)
    assert time.perf_counter() - began < 1 and found[5] == pytest.approx(599 * 499, rel=0.01)
    assert m.obb_of(np.zeros((1024, 1024), bool), 20) is None


def test_iou_union_and_resize(spark):
    a, b = pixels(["##..", "##.."]), pixels([".##.", ".##."])
    df = spark.createDataFrame([(row(a), row(b))], f"a {m.MASK}, b {m.MASK}")
    got = df.select(
        m.mask_iou(F.col("a"), F.col("b")).alias("iou"),
        m.mask_iou(F.col("a"), F.col("a")).alias("same"),
        m.mask_area(m.mask_union(F.col("a"), F.col("b"))).alias("u"),
        m.resize_mask(F.col("a"), F.lit(4), F.lit(6)).alias("r"),
    ).first()
    assert (got.iou, got.same, got.u) == (pytest.approx(2 / 6), 1.0, 6)
    expected = np.array([[a[y * 2 // 4, x * 4 // 6] for x in range(6)] for y in range(4)])
    assert (m.unpack(got.r.asDict()) == expected).all()


def test_iou_of_empty_masks_is_zero(spark):
    z = row(np.zeros((2, 2), bool))
    df = spark.createDataFrame([(z, z)], f"a {m.MASK}, b {m.MASK}")
    assert df.select(m.mask_iou(F.col("a"), F.col("b"))).first()[0] == 0.0
