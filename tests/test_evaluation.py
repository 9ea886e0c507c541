"""Fusion, suppression, matching and average precision against plain loops."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from boxmill.functions import masks as m
from boxmill.jobs.auto_label import auto_label
from boxmill.jobs.evaluate import evaluate, evaluate_by_domain
from boxmill.operators import detections, evaluation, fusion, suppression
from boxmill.queries import QUERIES
from boxmill.sources import derived

BOX = "cx double, cy double, w double, h double, deg double"
CLASSES = [(0, "sam"), (1, "buoy"), (2, "lolo")]


def mask(*columns, h=4, w=8):
    p = np.zeros((h, w), bool)
    p[:, list(columns)] = True
    return (h, w, [int(x) for x in m.pack(p)])


def test_one_mask_may_join_two_and_is_compared_with_the_original(spark):
    schema = f"image_id long, class_id long, det_id long, score double, mask {m.MASK}"
    first = spark.createDataFrame([(1, 0, 1, 0.5, mask(0, 1, 2)), (1, 0, 2, 0.6, mask(3, 4, 5)), (1, 1, 3, 0.9, mask(0))], schema)
    second = spark.createDataFrame([(1, 0, 10, 0.9, mask(2, 3)), (1, 0, 11, 0.7, mask(7)), (1, 0, 12, 0.2, mask(1, 2)), (1, 2, 13, 0.3, mask(0))], schema)
    got = {(r.det_id, r.part): (r.score, r.n) for r in fusion.fuse_masks(first, second, 0.2).withColumn("n", m.mask_area(F.col("mask"))).collect()}
    assert got == {(1, 0): (0.9, 16), (2, 0): (0.9, 16), (3, 0): (0.9, 4), (11, 1): (0.7, 4), (13, 1): (0.3, 4)}
    pairs = fusion.match_masks(first, second, 0.2)
    assert sorted(r.det_id for r in fusion.unmatched(second, pairs).collect()) == [11, 13]


def test_tiles_rule_pairs_out_and_change_none(spark):
    """Blobs and noise at sizes that 64 does not divide: the same pairs and masks, far fewer compared."""
    r = np.random.default_rng(8)
    schema = f"image_id long, class_id long, det_id long, score double, mask {m.MASK}"

    def rows(start, h, w, image):
        out = []
        for k in range(30):
            p = np.zeros((h, w), bool)
            y, x = r.integers(0, h - 20), r.integers(0, w - 20)
            p[y : y + r.integers(5, 40), x : x + r.integers(5, 40)] = True
            p &= r.random((h, w)) < 0.95
            out.append((image, k % 2, start + k, float(r.random()), (h, w, [int(v) for v in m.pack(p)])))
        return out

    first = spark.createDataFrame(rows(0, 90, 150, 1) + rows(30, 64, 128, 2) + [(3, 0, 60, 0.5, None), (3, 0, 61, 0.5, (90, 150, [0] * 211))], schema)
    second = spark.createDataFrame(rows(100, 90, 150, 1) + rows(130, 64, 128, 2) + [(3, 0, 160, 0.5, None), (3, 0, 161, 0.5, (90, 150, [0] * 211))], schema)
    tiled = fusion.with_tiles(first), fusion.with_tiles(second)
    for iou in (0.15, 0.5):
        plain, quick = (sorted(map(tuple, fusion.match_masks(*given, iou).collect())) for given in ((first, second), tiled))
        assert plain == quick and plain
        fused = [sorted((x.det_id, x.part, x.score, tuple(x.mask.words) if x.mask else None) for x in fusion.fuse_masks(*given, iou).collect()) for given in ((first, second), tiled)]
        assert fused[0] == fused[1]
        n = fusion.compared_pairs(*tiled, iou).first()
        assert n.n_pairs == 904 and n.n_matched == len(plain) <= n.n_by_tiles < n.n_by_area / 2
    assert fusion.compared_pairs(first, second).first().n_by_tiles == fusion.compared_pairs(first, second).first().n_by_area


def test_greedy_suppression_against_a_loop(spark):
    r = random.Random(1)
    rows = [(i % 3, i % 2, i, round(r.random(), 2), x := r.uniform(0, 30), y := r.uniform(0, 30), x + r.uniform(2, 15), y + r.uniform(2, 15)) for i in range(120)]
    df = spark.createDataFrame(rows, "image_id long, class_id long, det_id long, score double, x1 double, y1 double, x2 double, y2 double")

    def iou(a, b):
        w, h = min(a[6], b[6]) - max(a[4], b[4]), min(a[7], b[7]) - max(a[5], b[5])
        s = max(w, 0) * max(h, 0)
        return s / ((a[6] - a[4]) * (a[7] - a[5]) + (b[6] - b[4]) * (b[7] - b[5]) - s)

    kept = []
    for a in sorted(rows, key=lambda a: (-a[3], a[2])):
        if all(a[:2] != b[:2] or iou(a, b) <= 0.45 for b in kept):
            kept.append(a)
    assert sorted(x.det_id for x in suppression.nms(df).collect()) == sorted(a[2] for a in kept)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")  # groups that span batches
    assert sorted(x.det_id for x in suppression.nms(df).collect()) == sorted(a[2] for a in kept)
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    corners = F.array(*[F.struct(F.col(x).alias("x"), F.col(y).alias("y")) for x, y in (("x1", "y1"), ("x2", "y1"), ("x2", "y2"), ("x1", "y2"))])
    turned = suppression.nms(df.withColumn("corners", corners), corners_col="corners")
    assert sorted(x.det_id for x in turned.collect()) == sorted(a[2] for a in kept)


@pytest.mark.parametrize("turned", [False, True])
def test_suppression_in_blocks_is_that_of_the_whole_group(monkeypatch, turned):
    """Small blocks, boxes of many sizes and ties: kept as by one pass over all, whatever is held at once."""
    r = np.random.default_rng(5)
    low, size = r.uniform(0, 200, (1500, 2)), np.exp(r.uniform(0, 4.5, (1500, 2)))
    boxes = np.concatenate([low, low + size], axis=1)
    boxes[100:120] = boxes[100]
    boxes[120:125, 2] = boxes[120:125, 0]  # flat ones
    if turned:
        angle = r.uniform(0, np.pi, 1500)
        c, s = np.cos(angle)[:, None], np.sin(angle)[:, None]
        u, v = size[:, :1] / 2 * np.array([-1, 1, 1, -1]), size[:, 1:] / 2 * np.array([-1, -1, 1, 1])
        boxes = np.stack([low[:, :1] + u * c - v * s, low[:, 1:] + u * s + v * c], axis=2)
    whole = suppression.greedy_keep(boxes, np.arange(1500), 0.4)
    monkeypatch.setattr(suppression.Kept, "PIECE", 50)
    kept, places = suppression.Kept(), []
    for start in range(0, 1500, 64):
        at = np.arange(start, min(start + 64, 1500))
        at = at[~kept.reaches(boxes[at], 0.4)]
        own = at[suppression.greedy_keep(boxes[at], np.arange(len(at)), 0.4)]
        places += own.tolist()
        kept.add(boxes[own])
    assert places == whole and 100 < len(whole) < 1450


def test_a_crowd_of_one_class_in_one_image(spark):
    """100,000 boxes in one group: what is kept overlaps nothing that is kept, and what is not overlaps something better."""
    rows = spark.range(100_000).selectExpr("1L AS image_id", "2L AS class_id", "id AS det_id", "hash(id) % 1000 / 1000D AS score", "pmod(hash(id, 1), 40000) / 10D AS x1", "pmod(hash(id, 2), 40000) / 10D AS y1", "8 + pmod(hash(id, 3), 300) / 10D AS w", "8 + pmod(hash(id, 4), 300) / 10D AS h")
    df = rows.selectExpr("*", "x1 + w AS x2", "y1 + h AS y2").drop("w", "h")
    ids = {r.det_id for r in suppression.nms(df).collect()}
    table = df.toPandas().sort_values(["score", "det_id"], ascending=[False, True])
    boxes, kept = table[["x1", "y1", "x2", "y2"]].to_numpy(), table.det_id.isin(ids).to_numpy()
    place = np.flatnonzero(kept)
    index = suppression.Kept()
    wrong = 0
    for low in range(0, len(boxes), 20_000):
        high = low + 20_000
        mine = np.arange(low, min(high, len(boxes)))
        better = index.reaches(boxes[mine], 0.45)
        wrong += (better & kept[mine]).sum()
        index.add(boxes[place[(place >= low) & (place < high)]])
        wrong += (~index.reaches(boxes[mine], 0.45) & ~kept[mine]).sum()
    assert wrong == 0 and 50_000 < len(ids) < 95_000


def crowd(n, seed):
    r = np.random.default_rng(seed)
    rows = np.column_stack([r.uniform(-300, 300, (n, 2)), np.exp(r.uniform(-1, 5, (n, 2))), r.uniform(0, 180, n)])
    rows[:3, 2] = 0  # flat
    return [(1, int(k), k % 2, *map(float, row)) for k, row in enumerate(rows)]


@pytest.mark.parametrize("least", [0.3, 0.5, 0.8])
def test_pairs_by_grid_are_those_of_the_product(spark, least):
    given = crowd(500, 1)
    r = random.Random(3)
    near = [(i, k, c, x + r.gauss(0, w / 6 + 0.01), y + r.gauss(0, h / 6 + 0.01), w * r.uniform(0.6, 1.6), h * r.uniform(0.6, 1.6), d + r.gauss(0, 10)) for i, k, c, x, y, w, h, d in given]
    truth = spark.createDataFrame(given, f"image_id long, gt_id long, class_id long, {BOX}")
    preds = spark.createDataFrame(near + [(1, 5000 + k, *row[2:]) for k, row in enumerate(crowd(300, 2))], f"image_id long, pred_id long, class_id long, {BOX}").withColumn("score", F.lit(0.5))
    key = lambda rows: sorted((x.pred_id, x.gt_id, x.iou) for x in rows.collect())
    expected = key(evaluation.pair_predictions(preds, truth).filter(F.col("iou") >= least))
    assert key(evaluation.pair_predictions(preds, truth, least, dense=0)) == expected == key(evaluation.pair_predictions(preds, truth, least))
    assert len(expected) > 15
    flags = lambda pairs: sorted(map(tuple, evaluation.match_predictions(pairs, preds).collect()))
    if least == 0.5:
        assert flags(evaluation.pair_predictions(preds, truth)) == flags(evaluation.pair_predictions(preds, truth, 0.5, dense=0))


def test_a_crowded_image_is_not_multiplied(spark):
    """20,000 predictions and truths of one class in one image."""
    spread = lambda name, shift: spark.range(20_000).selectExpr("1L AS image_id", f"id AS {name}", "0L AS class_id", f"(id % 150) * 40D + {shift} AS cx", "floor(id / 150) * 30D AS cy", "20D AS w", "10D AS h", "id % 180D AS deg")
    preds, truth = spread("pred_id", 1).withColumn("score", F.lit(0.5)), spread("gt_id", 0)
    got = evaluation.pair_predictions(preds, truth, 0.5).agg(F.count("*"), F.sum((F.col("pred_id") == F.col("gt_id")).cast("int"))).first()
    assert tuple(got) == (20_000, 20_000)


def test_matching_by_groups_is_that_of_the_pairs(spark):
    """Rivals, misses, other classes, flat boxes, images and classes without truth, a null image; with and without crowds."""
    r = random.Random(8)
    given = [(k % 9, k, r.randrange(3), r.uniform(0, 60), r.uniform(0, 60), r.choice([0.0, 9.0, 30.0]), r.uniform(5, 20), r.uniform(0, 180)) for k in range(150)]
    near = [(i, 1000 * j + k, c, x + r.gauss(0, 1 + j), y + r.gauss(0, 1), w * r.uniform(0.8, 1.3), h, d) for j in range(3) for i, k, c, x, y, w, h, d in given]
    lone = [(i, 9000 + k, c, 5.0, 5.0, 9.0, 9.0, 0.0) for k, (i, c) in enumerate([(None, 1), (50, 1), (1, 7)])]
    truth = spark.createDataFrame(given, f"image_id long, gt_id long, class_id long, {BOX}")
    preds = spark.createDataFrame(near + lone, f"image_id long, pred_id long, class_id long, {BOX}").withColumn("score", F.col("pred_id") % 7 / 10)
    key = lambda rows: sorted(map(str, rows.collect()))
    expected = key(evaluation.match_predictions(evaluation.pair_predictions(preds, truth), preds))
    assert len(expected) == 453 and 40 < sum("tp50=1" in x for x in expected) < 150
    assert key(evaluation.match_truth(preds, truth)) == expected == key(evaluation.match_truth(preds, truth, dense=15))


def test_matching_deals_out_each_side_once(spark):
    truth = spark.range(50).selectExpr("id % 5 AS image_id", "id AS gt_id", "id % 2 AS class_id", *[f"5D AS {c}" for c in ("cx", "cy", "w", "h", "deg")])
    preds = truth.withColumnRenamed("gt_id", "pred_id").withColumn("score", F.lit(0.5))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = evaluation.match_truth(preds, truth)._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert plan.count("Exchange hashpartitioning") == 2


@pytest.mark.parametrize("name", ["q10_report_rows", "q53_pr_curve", "q54_average_precision", "q55_overall_metrics"])
def test_evaluations_make_their_detections_once(spark, sf_dir, monkeypatch, name):
    made, plain = [], derived.table
    monkeypatch.setattr(derived, "table", lambda s, d, n: made.append(n) or plain(s, d, n))
    QUERIES[name](spark, sf_dir)
    assert made.count("lineitem") == 1


def test_batches_of_a_model(spark):
    """A NumPy model: loaded once a worker, given arrays of bounded size, one output and several."""

    def make():
        import numpy as np

        weights = np.arange(12).reshape(3, 4)

        def predict(pixels):
            assert pixels.shape[1:] == (3, 4) and len(pixels) <= 16
            return {"mass": (pixels * weights).sum(axis=(1, 2)), "first": pixels[:, 0]}

        return predict

    images = spark.range(100).select("id", F.transform(F.sequence(F.lit(0), F.lit(11)), lambda k: (k + F.col("id")).cast("double")).alias("pixels"))
    rows = detections.predict_batches(images, make, {"pixels": (3, 4)}, "struct<mass:double,first:array<double>>", batch_size=16).collect()
    assert len(rows) == 100
    for r in rows:
        assert r.prediction.mass == sum(k * (k + r.id) for k in range(12)) and r.prediction.first == [r.id + k for k in range(4)]
    doubled = detections.predict_batches(spark.range(9), lambda: lambda x: x * 2.0, {"id": ()}, "double").collect()
    assert [r.prediction for r in doubled] == [2.0 * r.id for r in doubled]


def plain_ap(points, n_truth):
    """101-point average precision of (tp, rank) pairs."""
    return sum(max((tp / rank for tp, rank in points if tp * 100 // n_truth >= k), default=0) for k in range(101)) / 101


@pytest.mark.parametrize("parts", ["1", "5"])
def test_curve_and_average_precision_against_one_window(spark, parts):
    r = random.Random(4)
    names = [evaluation.flag(t) for t in evaluation.THRESHOLDS]
    rows = [(i % 11, i % 2, i, round(r.random(), 2), *[int(r.random() < 0.6 - 0.05 * k) for k in range(10)]) for i in range(500)]
    df = spark.createDataFrame(rows, "image_id long, class_id long, pred_id long, score double, " + ", ".join(f"{n} int" for n in names))
    counts = spark.createDataFrame([(0, 300), (1, 200)], "class_id long, n_truth long")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    curve = evaluation.pr_curve(df, counts, buckets=7)
    got = {(x.class_id, x.pred_id): (x["rank"], x.tp50, x.tp95) for x in curve.collect()}
    per = {x.class_id: (x.ap50, x.ap) for x in evaluation.average_precision(curve, spark.createDataFrame(CLASSES, "class_id long, label string")).collect()}
    spark.conf.set("spark.sql.shuffle.partitions", old)
    expected = {}
    for c, n in ((0, 300), (1, 200)):
        sums, points = [0] * 10, [[] for _ in range(10)]
        for rank, x in enumerate(sorted((x for x in rows if x[1] == c), key=lambda x: (-x[3], x[0], x[2])), 1):
            sums = [a + b for a, b in zip(sums, x[4:], strict=True)]
            expected[c, x[2]] = (rank, sums[0], sums[9])
            for k in range(10):
                points[k].append((sums[k], rank))
        aps = [plain_ap(p, n) for p in points]
        assert per[c] == (pytest.approx(aps[0]), pytest.approx(sum(aps) / 10))
    assert got == expected
    assert per[2] == (None, None)


def test_averages_run_compiled_and_all_metrics_in_one_pass(spark):
    """No lambda for each prediction; what all metrics need is one row a class and step."""
    names = [evaluation.flag(t) for t in evaluation.THRESHOLDS]
    rows = [(i, i % 2, i, i % 5 / 5, *[int(i % 3 > 0)] * 5, *[0] * 5) for i in range(60)]
    df = spark.createDataFrame(rows, "image_id long, class_id long, pred_id long, score double, " + ", ".join(f"{n} int" for n in names))
    curve = evaluation.pr_curve(df, spark.createDataFrame([(0, 30), (1, 40)], "class_id long, n_truth long"))
    classes = spark.createDataFrame(CLASSES, "class_id long, label string")
    assert "lambda" not in evaluation.average_precision(curve, classes)._jdf.queryExecution().optimizedPlan().toString()
    points = evaluation.curve_points(curve)
    assert points.filter("place = -1").groupBy("class_id").count().orderBy("class_id").collect() == [(0, 5), (1, 5)]
    assert {r.place for r in points.collect()} == {-1, 0, 1, 2, 3, 4}
    last = points.filter("place = -1 and step = 0").orderBy("class_id").select("rank", "tp50", "n_truth").collect()
    assert last == [(30, 20, 30), (30, 20, 40)]
    per = evaluation.average_precision(curve, classes)
    assert evaluation.overall_metrics(curve, per).collect() == evaluation.overall_points(points, per).collect()


def test_overall_metrics_of_a_query_make_one_curve(spark, sf_dir):
    plan = QUERIES["q55_overall_metrics"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "pred_id" not in plan


def test_curve_of_one_score(spark):
    """Every row has the same score: it is dealt out, and ranks are still 1 to n."""
    names = [evaluation.flag(t) for t in evaluation.THRESHOLDS]
    rows = [(i, 0, i, 0.5, *[1] * 10) for i in range(300)]
    df = spark.createDataFrame(rows, "image_id long, class_id long, pred_id long, score double, " + ", ".join(f"{n} int" for n in names))
    curve = evaluation.pr_curve(df, spark.createDataFrame([(0, 300)], "class_id long, n_truth long"))
    got = curve.select("rank", "tp50").orderBy("rank").collect()
    assert [(r["rank"], r.tp50) for r in got] == [(i, i) for i in range(1, 301)]
    assert evaluation.pr_curve(df.limit(0), spark.createDataFrame([(0, 300)], "class_id long, n_truth long")).collect() == []


def boxes(n=30, seed=9):
    r = random.Random(seed)
    return [(i % 5, i, i % 2, 50.0 * (i // 5), 40.0 * (i % 5), r.uniform(10, 30), r.uniform(5, 9), r.uniform(0, 180)) for i in range(n)]


def test_perfect_and_hopeless_predictions(spark):
    truth = spark.createDataFrame(boxes(), f"image_id long, gt_id long, class_id long, {BOX}")
    classes = spark.createDataFrame(CLASSES, "class_id long, label string")
    perfect = truth.withColumnRenamed("gt_id", "pred_id").withColumn("score", F.lit(0.9) - F.col("pred_id") / 100)
    got = evaluate(perfect, truth, classes, iou=0.7)
    assert {r.class_name: r.ap for r in got.per_class.collect()} == {"sam": pytest.approx(1.0), "buoy": pytest.approx(1.0), "lolo": None}
    overall = got.overall.first()
    assert (overall.mp, overall.mr, overall.map50, overall.map) == tuple(pytest.approx(1.0) for _ in range(4))
    far = perfect.withColumn("cx", F.col("cx") + 5000)
    assert {r.ap for r in evaluate(far, truth, classes).per_class.collect()} == {0.0, None}


def test_second_prediction_of_a_truth_is_wrong(spark):
    truth = spark.createDataFrame(boxes(1), f"image_id long, gt_id long, class_id long, {BOX}")
    preds = truth.drop("gt_id").crossJoin(spark.createDataFrame([(1, 0.9), (2, 0.8)], "pred_id long, score double"))
    got = evaluation.match_predictions(evaluation.pair_predictions(preds, truth), preds)
    assert {r.pred_id: (r.tp50, r.tp95) for r in got.collect()} == {1: (1, 1), 2: (0, 0)}


def test_published_class_averages(spark):
    table = {"five": {"sam": 0.951, "buoy": 0.829, "lolo": 0.995, "catamaran": 0.962, "boat": 0.989}, "six": {"sam": 0.957, "buoy": 0.709, "lolo": 0.995, "catamaran": 0.995, "boat": 0.992, "person": 0.863}}
    rows = [(k, c, v, v) for k, t in table.items() for c, v in t.items()]
    df = spark.createDataFrame(rows, "model string, label string, ap50 double, ap double")
    means = {r.model: r.m for r in df.groupBy("model").agg(F.avg("ap50").alias("m")).collect()}
    assert means["five"] == pytest.approx(0.945, abs=5e-4) and means["six"] == pytest.approx(0.918, abs=1e-3)
    got = {r.label: r for r in evaluation.compare_models(df, ["five", "six"], "five").collect()}
    assert got["buoy"].best == "five" and got["buoy"].six_rank == 2 and got["buoy"].six_delta == pytest.approx(-0.12)
    assert got["person"].five_ap is None and got["person"].best == "six"


def test_auto_label_puts_fused_rows_first(spark):
    schema = f"image_id long, det_id long, source string, label string, score double, mask {m.MASK}"
    first = spark.createDataFrame([(1, 5, "yolo26_seg", " Sam", 0.5, mask(0, 1, 2, 3))], schema)
    second = spark.createDataFrame([(1, 6, "sam3", "buoy", 0.9, mask(4, 5, 6)), (1, 7, "sam3", "kite", 0.9, mask(0)), (1, 8, "sam3", "sam", 0.4, mask(0))], schema)
    corners = [(2.0, 1.0), (6.0, 1.0), (6.0, 3.0), (2.0, 3.0)]
    outputs = f"image_id long, det_id long, source string, label string, score double, kind string, mask {m.MASK}, corners array<struct<x:double,y:double>>, x1 double, y1 double, x2 double, y2 double"
    extra = spark.createDataFrame([(1, 9, "yolo11", "lolo", 0.3, "obb", None, corners, None, None, None, None), (1, 10, "yolo11", "lolo", 0.9, "box", None, None, 1.0, 1.0, 2.0, 2.0)], outputs)
    images = spark.createDataFrame([(1, 8, 4)], "image_id long, width int, height int")
    got = auto_label(first, second, extra, images, spark.createDataFrame(CLASSES, "class_id long, label string"), min_area=4).orderBy("object_index").collect()
    assert [(r.object_index, r.class_id) for r in got] == [(0, 0), (1, 1), (2, 2)]
    assert got[0].line == "0 0.000000 0.000000 0.375000 0.000000 0.375000 0.750000 0.000000 0.750000"


def test_auto_label_sizes_whitelists_and_kinds(spark):
    """Masks of other sizes are fitted to the image; a class that a model is not asked for goes; boxes count where there is nothing better."""
    schema = f"image_id long, det_id long, source string, label string, score double, mask {m.MASK}"
    small = mask(0, 1, h=2, w=4)  # the left half
    first = spark.createDataFrame([(1, 5, "yolo26_seg", "sam", 0.5, small), (1, 6, "yolo26_seg", "lolo", 0.9, small)], schema)
    second = spark.createDataFrame([(1, 7, "sam3", "sam", 0.9, mask(2, 3, 4, 5, h=8, w=8))], schema)
    outputs = "image_id long, det_id long, source string, label string, score double, kind string, x1 double, y1 double, x2 double, y2 double"
    aux = spark.createDataFrame([(1, 9, "yolo11", "buoy", 0.3, "box", 4.0, 4.0, 8.0, 8.0), (2, 9, "yolo11", "buoy", 0.3, "box", 4.0, 4.0, 8.0, 8.0)], outputs)
    aux = aux.withColumns({"mask": F.lit(None).cast(m.MASK), "corners": F.lit(None).cast("array<struct<x:double,y:double>>")})
    images = spark.createDataFrame([(1, 16, 8)], "image_id long, width int, height int")
    asked = spark.createDataFrame([("yolo26_seg", "sam"), ("sam3", "sam"), ("yolo11", "buoy")], "source string, label string")
    got = auto_label(first, second, aux, images, spark.createDataFrame(CLASSES, "class_id long, label string"), asked, min_area=4).orderBy("object_index").collect()
    # 8 of 16 columns and 4 to 11 overlap by a third, so they are one object of 12 columns: 11 wide through pixel centres.
    assert [(r.class_id, [round(p.x * 16) for p in r.corners]) for r in got] == [(0, [0, 11, 11, 0]), (1, [4, 8, 8, 4])]


def test_masks_of_different_sizes_are_not_compared(spark):
    df = spark.createDataFrame([(mask(0), mask(0, h=8, w=4))], f"a {m.MASK}, b {m.MASK}")
    assert df.select(m.mask_iou(F.col("a"), F.col("b"))).first()[0] is None
    fitted = df.select(m.fit_mask(F.col("b"), F.lit(4), F.lit(8)).alias("b"), m.fit_mask(F.col("a"), F.lit(4), F.lit(8)).alias("a")).first()
    assert (fitted.b.h, fitted.b.w, fitted.a.words) == (4, 8, mask(0)[2])


def test_evaluation_of_a_split_is_written(spark, tmp_path):
    truth = spark.createDataFrame(boxes(), f"image_id long, gt_id long, class_id long, {BOX}")
    classes = spark.createDataFrame(CLASSES, "class_id long, label string")
    images = spark.createDataFrame([(i, "test" if i < 2 else "train", "ab"[i % 2]) for i in range(5)], "image_id long, split string, domain string")
    predictions = truth.withColumnRenamed("gt_id", "pred_id").withColumn("score", F.lit(0.9) - F.col("pred_id") / 100)
    wrong = predictions.withColumn("cx", F.when(F.col("image_id") < 2, F.col("cx")).otherwise(F.col("cx") + 5000))
    got = evaluate(wrong, truth, classes, images=images)
    assert {r.class_name: r.ap for r in got.per_class.collect()} == {"sam": pytest.approx(1.0), "buoy": pytest.approx(1.0), "lolo": None}
    got.write(str(tmp_path / "e"))
    assert spark.read.text(str(tmp_path / "e" / "report")).collect()[-1].value == "mean & 1.000 & 1.000"
    assert spark.read.json(str(tmp_path / "e" / "predictions")).count() == 12
    assert spark.read.json(str(tmp_path / "e" / "metrics")).first()["map"] == pytest.approx(1.0)
    assert spark.read.option("header", True).csv(str(tmp_path / "e" / "per_class")).count() == 3
    domains = evaluate_by_domain(wrong, truth, images, classes).collect()
    assert {(r.domain, r.class_name): r.ap for r in domains} == {(x, c): pytest.approx(1.0) for x in "ab" for c in ("sam", "buoy")}
