"""Steps that many queries share: computed once a row, many groups at a time, exact on edges."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from boxmill.functions import geometry as g
from boxmill.operators import datasets, detections, review, suppression


def corners_of(rng, n):
    """n x 4 x 2 turned rectangles that often overlap."""
    cx, cy, w, h, a = rng.uniform(0, 60, n), rng.uniform(0, 60, n), rng.uniform(5, 40, n), rng.uniform(5, 40, n), rng.uniform(0, np.pi, n)
    p, q = np.array([-1, 1, 1, -1]) * w[:, None] / 2, np.array([-1, -1, 1, 1]) * h[:, None] / 2
    return np.stack([cx[:, None] + p * np.cos(a)[:, None] - q * np.sin(a)[:, None], cy[:, None] + p * np.sin(a)[:, None] + q * np.cos(a)[:, None]], axis=2)


def test_small_groups_side_by_side_keep_what_each_keeps_alone():
    rng = np.random.default_rng(3)
    sizes = rng.integers(1, 12, 200)
    boxes = corners_of(rng, sizes.sum())
    starts = np.cumsum(sizes) - sizes
    kept = suppression.keep_side_by_side(boxes, np.arange(len(boxes)) - np.repeat(starts, sizes), np.repeat(sizes, sizes), 0.3)
    expected = [low + k for low, n in zip(starts, sizes, strict=True) for k in suppression.greedy_keep(boxes[low : low + n], np.arange(n), 0.3)]
    assert np.flatnonzero(kept).tolist() == sorted(expected)
    assert 0 < len(expected) < len(boxes)


def test_suppression_of_small_and_large_groups_in_one_batch(spark):
    rng = np.random.default_rng(5)
    sizes = [1, 40, 3, 2, 70, 5, 1]
    boxes = corners_of(rng, sum(sizes))
    rows, expected, low = [], set(), 0
    for image, n in enumerate(sizes):
        rows += [(image, 0, k, float(n - k), [tuple(map(float, p)) for p in boxes[low + k]]) for k in range(n)]
        expected |= {(image, k) for k in suppression.greedy_keep(boxes[low : low + n], np.arange(n), 0.3)}
        low += n
    df = spark.createDataFrame(rows, f"image_id long, class_id long, det_id long, score double, corners {g.CORNERS}")
    for size in ("7", "10000"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        try:
            got = {(r.image_id, r.det_id) for r in suppression.nms(df.coalesce(1), 0.3, corners_col="corners").collect()}
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        assert got == expected


def filters_of(df) -> list[str]:
    return [line for line in df._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Filter" in line]


def test_areas_of_augmented_labels_are_not_computed_again_by_their_filter(spark):
    corners = [(0.2, 0.2), (0.4, 0.2), (0.4, 0.3), (0.2, 0.3)]
    df = spark.createDataFrame([(i, corners) for i in range(20)], f"image_id long, corners {g.CORNERS}")
    made = datasets.augment_labels(df, copies=2)
    assert not any("xxhash64" in line or "corners" in line for line in filters_of(made))
    large = detections.keep_large_obbs(df.withColumn("area", g.polygon_area(F.col("corners"))), 0.001, "corners")
    assert not any("* " in line for line in filters_of(large))
    assert large.count() == 20


@pytest.mark.parametrize("flip", [False, True])
def test_clear_quadrilaterals_are_ordered_as_any_points(spark, flip):
    rng = np.random.default_rng(7)
    boxes = corners_of(rng, 300)
    boxes = np.concatenate([boxes, np.array([[[0, 0], [4, 0], [4, 2], [0, 2]], [[0, 0], [2, -2], [6, 2], [4, 4]], [[1, 1], [1, 1], [3, 1], [3, 1]], [[0, 0], [0, 9], [0, 0], [0, 9]]], float)])
    boxes = boxes[:, ::-1] if flip else boxes
    df = spark.createDataFrame([(i, [tuple(map(float, p)) for p in b]) for i, b in enumerate(boxes)], f"k int, c {g.CORNERS}")
    xy = [(F.get("c", F.lit(i))["x"], F.get("c", F.lit(i))["y"]) for i in range(4)]
    for r in df.select(g.order_corners(F.col("c")).alias("a"), g._order_any(F.col("c")).alias("b"), g.order_four(xy).alias("d")).collect():
        assert r.a == r.b == r.d


def test_rectangles_hold_the_points_of_their_edges(spark):
    """At 30 degrees the point w below the middle is on an edge, off which the rounding of corners may move it."""
    rows = [(k, k, float(20 + k * 37 % 601), float(20 + k * 53 % 441), float(10 + k % 90), float(20 + 2 * (k % 90)), 30.0) for k in range(400)]
    boxes = spark.createDataFrame(rows, "image_id long, object_index long, cx double, cy double, w double, h double, deg double").withColumn("area", F.col("w") * F.col("h"))
    points = boxes.select("image_id", F.col("object_index").alias("point_id"), F.col("cx").alias("x"), (F.col("cy") + F.col("w")).alias("y"))
    assert review.hit_test(points, boxes).filter("object_index is null").count() == 0
    by_corners = boxes.select("image_id", "object_index", "area", g.rect_corners(*[F.col(c) for c in ("cx", "cy", "w", "h", "deg")]).alias("corners"))
    assert review.hit_test(points, by_corners).filter("object_index is null").count() > 0


def test_boxes_keep_the_points_they_were_made_of(spark):
    """The corners of a rectangle that is added, and whole numbers that were clicked, are those of the box."""
    clicked = [[10.0, 20.0], [50.0, 20.0], [50.0, 90.0], [10.0, 90.0]]
    assert review.box_of_four(clicked) == clicked
    df = spark.createDataFrame([("add", 100.0 + k, 50.0, 31.0 + k % 7, 20.0, float(k)) for k in range(180)], "action string, x double, y double, w double, h double, deg double")
    rect = [F.col(c) for c in ("x", "y", "w", "h", "deg")]
    rows = review.with_boxes(df.withColumn("corners", g.rect_to_corners(*rect)).withColumn("own", review._numbers(g.rect_corners(*rect)))).collect()
    assert all(r.box == r.own for r in rows)


def test_counts_of_images_that_are_listed_under_several_splits(spark):
    images = [(1, "train", "sim"), (1, "val", "sim"), (1, "val", "real"), (2, "train", "real"), (3, None, "real"), (3, None, "sim")]
    labels = [(1, 0), (1, 0), (1, 4), (2, 4), (2, None)]
    i = spark.createDataFrame(images, "image_id long, split string, domain string")
    lab = spark.createDataFrame(labels, "image_id long, class_id long")
    joined = i.join(lab.withColumn("one", F.lit(1)), "image_id", "left")
    plain = joined.cube("split", "domain", "class_id").agg(F.grouping_id().alias("level"), F.count("one").alias("n_objects"), F.countDistinct("image_id").alias("n_images"))
    made = datasets.count_objects(lab, i)
    assert sorted(map(str, made.collect())) == sorted(map(str, plain.collect()))
    assert "Expand" not in made._jdf.queryExecution().optimizedPlan().toString().split("Window")[1]
