"""Predictions against ground truth: pairing, matching, curves and average precision.

Overlap is the Gaussian one by default, assignment follows Everingham et al. (2010),
and average precision takes 101 recall points (Lin et al. 2014).
"""

from __future__ import annotations

import math
from collections import Counter
from functools import reduce
from operator import add

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import gaussian_iou
from ..scratch import materialise
from .detections import small

THRESHOLDS = tuple(t / 100 for t in range(50, 100, 5))
BUCKETS = 200
SUBS = 64
#: Flags in one whole number.
WORD = 62


def flag(threshold: float) -> str:
    """Name of the true-positive column of a threshold."""
    return f"tp{round(threshold * 100)}"


def _side(prefix: str) -> dict[str, Column]:
    return {k: F.col(f"{prefix}_{k}") for k in ("cx", "cy", "w", "h", "deg")}


def reach(least: float) -> tuple[float, float]:
    """(share, ratio): what an overlap of `least` asks of two rectangles with the longer sides L and M.

    Their centres are at most sqrt(share * (L * L + M * M)) apart, and L is at most ratio
    times M. The overlap is 1 - sqrt(1 - exp(-d)), so d is bounded; d is the sum of
    x' (S + T)^-1 x / 4 with x between the centres, of which the greatest eigenvalue of
    S + T, at most (L * L + M * M) / 12, gives the first bound, and of
    ln(det(S + T) / (4 sqrt(det S det T))) / 2. For eigenvalues of given size det(S + T)
    is least where the axes agree (Fiedler 1971), and then at least (L/M + M/L) / 2 times
    the root: the second bound. Both leave room for rounding.
    """
    d = -math.log(2 * least - least * least)
    q = math.exp(2 * d)
    return d / 3 * (1 + 1e-6), (q + math.sqrt(q * q - 1)) * (1 + 1e-6)


def _near(p: DataFrame, g: DataFrame, least: float) -> DataFrame:
    """p joined with g on image and class where an overlap of least is possible, and some more.

    A truth lies in one cell of the grid for its size (the power of two below its longer
    side), whose cells are as wide as the reach there; a prediction looks into the one to
    four cells that its reach touches, in the grids of all sizes that fit.
    """
    share, ratio = reach(least)
    side = lambda k: F.greatest(f"{k}_w", f"{k}_h")
    up = lambda k: F.pow(F.lit(2.0), F.col(k) + 1)
    # Two of the greatest reach that a truth of the size has.
    width = up("size") * (2 * math.sqrt(share * (1 + ratio * ratio)))
    cell = lambda c: F.floor(c / width)
    sized = g.filter((F.col("g_w") > 0) & (F.col("g_h") > 0)).withColumn("size", F.floor(F.log2(side("g"))))
    placed = sized.withColumns({"ix": cell(F.col("g_cx")), "iy": cell(F.col("g_cy"))})
    looks = p.filter((F.col("p_w") > 0) & (F.col("p_h") > 0))
    looks = looks.withColumn("size", F.explode(F.sequence(F.floor(F.log2(side("p") / ratio)), F.floor(F.log2(side("p") * ratio)))))
    far = F.sqrt(share * (up("size") * up("size") + side("p") * side("p")))
    looks = looks.withColumn("ix", F.explode(F.sequence(cell(F.col("p_cx") - far), cell(F.col("p_cx") + far))))
    looks = looks.withColumn("iy", F.explode(F.sequence(cell(F.col("p_cy") - far), cell(F.col("p_cy") + far))))
    return looks.join(placed, ["image_id", "class_id", "size", "ix", "iy"]).drop("size", "ix", "iy")


def _crowded(predictions: DataFrame, dense: int) -> DataFrame | None:
    """image_id, class_id of over dense predictions; None if there are none."""
    keys = ["image_id", "class_id"]
    crowded = materialise(predictions.groupBy(keys).agg(F.count("*").alias("n")).filter(F.col("n") > dense).select(keys))
    return None if crowded.isEmpty() else small(crowded)


def pair_predictions(predictions: DataFrame, truth: DataFrame, least: float | None = None, dense: int = 2_000) -> DataFrame:
    """image_id, class_id, pred_id, score, gt_id, iou of all pairs of one image and class.

    least: only pairs of this overlap or more. Then images and classes of over `dense`
    predictions are paired by a grid, so that a crowded image makes no product of its
    objects; the pairs are the same. The score is carried along so that matching need not look it
    up again.
    """
    shape, keys = ("cx", "cy", "w", "h", "deg"), ["image_id", "class_id"]
    p = predictions.select(*keys, "pred_id", "score", *[F.col(c).alias(f"p_{c}") for c in shape])
    g = truth.select(*keys, "gt_id", *[F.col(c).alias(f"g_{c}") for c in shape])
    overlap = [*keys, "pred_id", "score", "gt_id", gaussian_iou(_side("p"), _side("g")).alias("iou")]
    if least is None:
        return p.join(g, keys).select(*overlap)
    few = _crowded(predictions, dense)
    if few is None:
        both = p.join(g, keys)
    else:
        both = p.join(few, keys, "left_anti").join(g, keys).unionByName(_near(p.join(few, keys, "left_semi"), g.join(few, keys, "left_semi"), least))
    # A plain filter would move into the join, where the terms of the overlap are computed over and over.
    far_enough = F.explode(F.filter(F.array("iou"), lambda v: v >= least)).alias("iou")
    return both.select(*overlap).select(*overlap[:-1], far_enough)


def match_predictions(pairs: DataFrame, predictions: DataFrame, thresholds: tuple[float, ...] = THRESHOLDS) -> DataFrame:
    """image_id, class_id, pred_id, score and one 0/1 column per threshold for every prediction.

    A prediction goes to its truth of greatest overlap. At each threshold the best of a
    truth's predictions that reach it is right: those before it by score must all have
    stayed below the threshold, so one running maximum answers every threshold. Pairs
    below the least threshold decide nothing and may be missing.
    """
    best = Window.partitionBy("image_id", "pred_id").orderBy(F.desc("iou"), "gt_id")
    taken = pairs.withColumn("rank", F.row_number().over(best)).filter("rank = 1").drop("rank")
    before = Window.partitionBy("image_id", "gt_id").orderBy(F.desc("score"), "pred_id").rowsBetween(Window.unboundedPreceding, -1)
    ranked = taken.withColumn("before", F.coalesce(F.max("iou").over(before), F.lit(-1.0)))
    flags = {flag(t): ((F.col("before") < t) & (F.col("iou") >= t)).cast("int") for t in thresholds}
    hits = ranked.select("image_id", "pred_id", *[c.alias(n) for n, c in flags.items()])
    every = predictions.select("image_id", "class_id", "pred_id", "score").join(hits, ["image_id", "pred_id"], "left")
    return every.select("image_id", "class_id", "pred_id", "score", *[F.coalesce(n, F.lit(0)).alias(n) for n in flags])


def match_truth(predictions: DataFrame, truth: DataFrame, thresholds: tuple[float, ...] = THRESHOLDS, dense: int = 2_000) -> DataFrame:
    """match_predictions() of the pairs of predictions and truth, in one exchange of each by image and class.

    A prediction keeps a row through the join, so none is looked up afterwards, and
    truths have their class in the key, so both windows stay where the join was. Ids are
    unique in an image. Images and classes of over `dense` predictions are paired by a
    grid and matched by match_predictions().
    """
    few = _crowded(predictions, dense)
    if few is None:
        return _match_groups(predictions, truth, thresholds)
    keys = ["image_id", "class_id"]
    crowd = predictions.join(few, keys, "left_semi")
    pairs = pair_predictions(crowd, truth.join(few, keys, "left_semi"), min(thresholds), dense)
    return _match_groups(predictions.join(few, keys, "left_anti"), truth, thresholds).unionByName(match_predictions(pairs, crowd, thresholds))


def _match_groups(predictions: DataFrame, truth: DataFrame, thresholds: tuple[float, ...]) -> DataFrame:
    """match_truth() where no image and class is crowded."""
    shape, keys = ("cx", "cy", "w", "h", "deg"), ["image_id", "class_id"]
    p = predictions.select(*keys, "pred_id", "score", *[F.col(c).alias(f"p_{c}") for c in shape])
    # Pairs that decide nothing leave after the join, all but those with one of the truths.
    lead = (F.row_number().over(Window.partitionBy(*keys).orderBy("gt_id")) == 1).alias("lead")
    g = truth.select(*keys, "gt_id", *[F.col(c).alias(f"g_{c}") for c in shape], lead)
    pairs = p.join(g, keys, "left").select(*keys, "pred_id", "score", "gt_id", "lead", gaussian_iou(_side("p"), _side("g")).alias("iou"))
    reached = F.coalesce(F.col("iou") >= min(thresholds), F.lit(False))
    held = F.when(reached, F.array("iou")).when(F.coalesce("lead", F.lit(True)), F.array(F.lit(None).cast("double")))
    rows = pairs.select(*keys, "pred_id", "score", "gt_id", F.explode(held).alias("iou"))
    best = Window.partitionBy(*keys, "pred_id").orderBy(F.desc_nulls_last("iou"), "gt_id")
    taken = rows.withColumn("rank", F.row_number().over(best)).filter("rank = 1")
    before = Window.partitionBy(*keys, "gt_id").orderBy(F.desc("score"), "pred_id").rowsBetween(Window.unboundedPreceding, -1)
    ranked = taken.withColumn("before", F.coalesce(F.max("iou").over(before), F.lit(-1.0)))
    flags = [F.coalesce(((F.col("before") < t) & (F.col("iou") >= t)).cast("int"), F.lit(0)).alias(flag(t)) for t in thresholds]
    return ranked.select("image_id", "class_id", "pred_id", "score", *flags)


def pr_curve(matches: DataFrame, truth_counts: DataFrame, thresholds: tuple[float, ...] = THRESHOLDS, buckets: int = BUCKETS, by: tuple[str, ...] = ()) -> DataFrame:
    """class_id, pred_id, score, rank, n_truth, the running number of right predictions per threshold, and hits.

    hits: the places in thresholds at which this very prediction is right. by: further
    columns of matches and truth_counts, such as a domain, with curves of their own.

    Classes are few, so a window per class would hold all the data. Scores are cut into
    buckets at their own quantiles; sums per class and bucket give offsets, and the
    windows run inside class and bucket. Ties in score are ordered by image and
    prediction; ties at a score that more than one bucket's share of all rows have, by
    a hash of the image first. Precision is tp / rank, recall tp / n_truth. Classes without truth have
    no rows; a table without predictions gives none.
    """
    flags, keys = [flag(t) for t in thresholds], [*by, "class_id"]
    # Flags are written and dealt out as bits of whole numbers.
    words = [flags[i : i + WORD] for i in range(0, len(flags), WORD)]
    packed = [reduce(add, [F.when(F.col(f) > 0, F.lit(1 << i).cast("long")).otherwise(0) for i, f in enumerate(w)]).alias(f"_word{k}") for k, w in enumerate(words)]
    bits = {f: F.shiftright(f"_word{k}", i).bitwiseAND(F.lit(1).cast("long")) for k, w in enumerate(words) for i, f in enumerate(w)}
    matches = materialise(matches.select(*keys, "image_id", "pred_id", "score", *packed))  # read for quantiles, sums and windows
    cuts = matches.agg(F.percentile_approx("score", [i / buckets for i in range(1, buckets)], 10_000)).first()[0] or [0.0]
    # A score that is several quantiles gets a bucket of its own, dealt out by a hash of the image.
    heavy = {float(c) for c, n in Counter(cuts).items() if n > 1}
    splits = [float("-inf"), *sorted({float(c) for c in cuts} | {math.nextafter(c, math.inf) for c in heavy}), float("inf")]
    cut = Bucketizer(splits=splits, inputCol="score", outputCol="place", handleInvalid="keep")
    sub = F.when(F.col("score").isin(*heavy), F.pmod(F.xxhash64("image_id"), F.lit(SUBS))).otherwise(0) if heavy else F.lit(0)
    # Numbered from the best scores on; equal scores share a bucket.
    rows = cut.transform(matches).withColumn("bucket", ((len(splits) - F.col("place")) * SUBS + sub).cast("int")).drop("place")
    sums = rows.groupBy(*keys, "bucket").agg(F.count("*").alias("n"), *[F.sum(c).alias(f) for f, c in bits.items()])
    ahead = Window.partitionBy(*keys).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*keys, "bucket", *[F.coalesce(F.sum(c).over(ahead), F.lit(0)).alias(f"o_{c}") for c in ["n", *flags]])
    # At most one row per class and bucket.
    truths = materialise(truth_counts.select(*keys, "n_truth"))  # counted, then joined
    offsets = small(materialise(offsets.join(small(truths), keys)), 1_000_000)
    inside = Window.partitionBy(*keys, "bucket").orderBy(F.desc("score"), "image_id", "pred_id").rowsBetween(Window.unboundedPreceding, 0)
    # Dealt out with the bits; the flags and the offsets are made behind the exchange.
    dealt = rows.repartition(*keys, "bucket").select(*keys, "bucket", "image_id", "pred_id", "score", *[c.alias(f) for f, c in bits.items()])
    # Pieces put together, as Spark does not compile a lambda.
    hits = F.concat(*[F.when(F.col(f) > 0, F.array(F.lit(i))).otherwise(F.array().cast("array<int>")) for i, f in enumerate(flags)])
    summed = dealt.withColumns({"s_n": F.count("*").over(inside)} | {f"s_{f}": F.sum(f).over(inside) for f in flags})
    joined = summed.join(offsets, [*keys, "bucket"])
    running = [(F.col(f"o_{f}") + F.col(f"s_{f}")).alias(f) for f in flags]
    return joined.select(*keys, "image_id", "pred_id", "score", (F.col("o_n") + F.col("s_n")).alias("rank"), "n_truth", *running, hits.alias("hits"))


def curve_points(curve: DataFrame, thresholds: tuple[float, ...] = THRESHOLDS, by: tuple[str, ...] = (), scores: int = 1000) -> DataFrame:
    """class_id, place, step, precision, rank, tp50, n_truth: all that averages and means need of a curve, in one pass.

    place: in thresholds; then step is one of recall, 101 at most, and precision its best.
    Precision is greatest where a right prediction comes in, so a row is carried only for
    the thresholds that it is a hit of. Place -1: of all predictions, steps of score.
    """
    keys, names = [*by, "class_id"], [flag(t) for t in thresholds]
    at50 = F.col(flag(0.5)) if flag(0.5) in names else F.lit(None).cast("long")
    rows = curve.select(*keys, "rank", "n_truth", "score", *names, F.explode(F.concat("hits", F.array(F.lit(-1)))).alias("place"))
    tp, hit = F.get(F.array(*names), F.col("place")), F.col("place") >= 0
    step = F.when(hit, F.expr("tp * 100 div n_truth")).otherwise(F.floor(F.col("score") * scores))
    rows = rows.select(*keys, "place", "rank", "n_truth", "score", at50.alias("at50"), tp.alias("tp"))
    best = F.max(F.when(hit, F.col("tp") / F.col("rank"))).alias("precision")
    return rows.groupBy(*keys, "place", step.cast("int").alias("step")).agg(best, F.max("rank").alias("rank"), F.max("at50").alias("tp50"), F.max("n_truth").alias("n_truth"))


def average_precision(curve: DataFrame, classes: DataFrame, thresholds: tuple[float, ...] = THRESHOLDS, by: tuple[str, ...] = ()) -> DataFrame:
    """class_id, ap50, ap for every class of the table; null for a class without predictions or truth.

    Per threshold the best precision at or beyond each of 101 recalls, averaged. by: as
    in pr_curve(); then also these columns, and only classes that have predictions and
    truth there.
    """
    return average_points(curve_points(curve, thresholds, by), classes, thresholds, by)


def average_points(points: DataFrame, classes: DataFrame, thresholds: tuple[float, ...] = THRESHOLDS, by: tuple[str, ...] = ()) -> DataFrame:
    """average_precision() of curve_points()."""
    keys = [*by, "class_id"]
    beyond = Window.partitionBy(*keys, "place").orderBy(F.desc("step")).rowsBetween(Window.unboundedPreceding, 0)
    below = Window.partitionBy(*keys, "place").orderBy("step")
    # The envelope holds from the step below (exclusive) up to this one.
    hull = points.withColumns({"envelope": F.max("precision").over(beyond), "width": F.col("step") - F.coalesce(F.lag("step").over(below), F.lit(-1))})
    per = hull.groupBy(*keys, "place").agg((F.sum(F.col("envelope") * F.col("width")) / 101).alias("ap"))
    # A threshold without a hit has no row, and counts 0; place -1, which every class has, is without an average.
    at50 = F.sum(F.when(F.col("place").isin(*[i for i, t in enumerate(thresholds) if abs(t - 0.5) < 1e-9]), F.col("ap")))
    ap = per.groupBy(*keys).agg(at50.alias("ap50"), (F.sum("ap") / len(thresholds)).alias("ap")).fillna(0.0, ["ap50", "ap"])
    return ap.select(*keys, "ap50", "ap") if by else classes.select("class_id").join(ap, "class_id", "left")


def overall_metrics(curve: DataFrame, per_class: DataFrame, steps: int = 1000) -> DataFrame:
    """One row: mp, mr (means at the score of best mean F1), map50, map.

    The curve at overlap 0.5 is read at steps + 1 fixed scores: a class's point at a
    score is that of its last prediction at or over it.
    """
    return overall_points(curve_points(curve, scores=steps), per_class, steps)


def overall_points(points: DataFrame, per_class: DataFrame, steps: int = 1000) -> DataFrame:
    """overall_metrics() of curve_points() with as many steps of score."""
    last = points.filter("place = -1").select("class_id", "step", "rank", F.col("tp50").alias("tp"), "n_truth")
    grid = last.select("class_id").distinct().withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(steps))))
    over = Window.partitionBy("class_id").orderBy(F.desc("step")).rowsBetween(Window.unboundedPreceding, 0)
    points = grid.join(last, ["class_id", "step"], "left").select("class_id", "step", *[F.max(c).over(over).alias(c) for c in ("rank", "tp", "n_truth")])
    points = points.withColumns({"p": F.coalesce(F.col("tp") / F.col("rank"), F.lit(1.0)), "r": F.coalesce(F.col("tp") / F.col("n_truth"), F.lit(0.0))})
    points = points.withColumn("f1", 2 * F.col("p") * F.col("r") / (F.col("p") + F.col("r") + 1e-16))
    means = points.groupBy("step").agg(F.avg("p").alias("p"), F.avg("r").alias("r"), F.avg("f1").alias("f1"))
    # Rounded, so that the order of additions cannot move the best score; the lowest of equal ones.
    best = means.agg(F.max_by(F.struct("p", "r"), F.struct(F.round("f1", 9), -F.col("step"))).alias("b"))
    maps = per_class.agg(F.avg("ap50").alias("map50"), F.avg("ap").alias("map"))
    return best.crossJoin(maps).select(F.col("b.p").alias("mp"), F.col("b.r").alias("mr"), "map50", "map")


def stage_times(predictions: DataFrame, times_col: str = "speed_ms") -> DataFrame:
    """One row with the mean milliseconds per stage as a map; null maps are left out."""
    means = predictions.select(F.explode(times_col).alias("stage", "ms")).groupBy("stage").agg(F.avg("ms").alias("ms"))
    return means.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("stage", "ms")))).alias("speed_ms"))


def compare_models(model_ap: DataFrame, models: list[str], baseline: str, metric: str = "ap50") -> DataFrame:
    """One row per class: a column per model, its rank and its gap to the baseline, and the best model."""
    rank = F.rank().over(Window.partitionBy("label").orderBy(F.desc_nulls_last(metric)))
    ranked = model_ap.withColumn("rank", rank)
    wide = ranked.groupBy("label").pivot("model", models).agg(F.first(metric).alias("ap"), F.first("rank").alias("rank"))
    gaps = [F.round(F.col(f"`{m}_ap`") - F.col(f"`{baseline}_ap`"), 6).alias(f"{m}_delta") for m in models]
    best = ranked.groupBy("label").agg(F.max_by("model", F.struct(metric, F.col("model"))).alias("best"))
    return wide.select("label", *[f"`{m}_{c}`" for m in models for c in ("ap", "rank")], *gaps).join(best, "label")
