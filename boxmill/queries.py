"""Registered queries of the detection operators, each with its DuckDB counterpart."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import geometry as g
from .functions import masks as m
from .functions.text import clean_label
from .jobs import assemble_dataset, review_labels
from .jobs.auto_label import auto_label, label_boxes
from .jobs.evaluate import evaluate, evaluate_by_domain
from .operators import datasets, detections as d, evaluation, fusion, review, suppression
from .oracle import EDITED_CORNERS, HAND_BOXES, OUTLINES, OVERLAPS, REPLAY, REPLAY_BOXES, half_even
from .scratch import materialise
from .sources import files
from .sources.derived import derived, table, with_tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its name, with the SQL that gives the same rows."""

    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return register


def rect(prefix: str = "") -> list[Column]:
    return [F.col(prefix + c) for c in ("cx", "cy", "w", "h", "deg")]


def with_corners(rows: DataFrame) -> DataFrame:
    """Rows with the ordered corners of their rectangle."""
    return rows.withColumn("corners", g.rect_corners(*rect()))


def flat(corners: Column, digits: int = 4) -> list[Column]:
    """x1, y1 .. x4, y4, rounded."""
    return [F.round(corners[i][k], digits).alias(f"{k}{i + 1}") for i in range(4) for k in ("x", "y")]


CORNER_LIST = ", ".join(f"max(CASE WHEN k = {i} THEN round({{{k}}}, {{d}}) END) AS {k}{i}" for i in range(1, 5) for k in ("x", "y"))


def sql_corners(x: str = "x", y: str = "y", digits: int = 4) -> str:
    """Eight columns from the rows (k, x, y) of a group."""
    return CORNER_LIST.format(x=x, y=y, d=digits)


POINTS = """pts AS (SELECT image_id, det_id, i, cx + a * (w / 2) * cos(radians(deg)) - b * (h / 2) * sin(radians(deg)) AS x,
  cy + a * (w / 2) * sin(radians(deg)) + b * (h / 2) * cos(radians(deg)) AS y
  FROM detections, (VALUES (1, -1, -1), (2, 1, -1), (3, 1, 1), (4, -1, 1)) v(i, a, b))"""


def ordered(points: str, name: str) -> str:
    """A CTE that numbers a table's points (image_id, det_id, i, x, y) from the first corner on."""
    return f"""{name} AS (SELECT image_id, det_id, x, y, (r - s + 4) % 4 + 1 AS k FROM (
  SELECT *, min(CASE WHEN t = lowest THEN r END) OVER (PARTITION BY image_id, det_id) AS s FROM (
    SELECT *, row_number() OVER (PARTITION BY image_id, det_id ORDER BY atan2(y - my, x - mx), i) AS r, min(t) OVER (PARTITION BY image_id, det_id) AS lowest FROM (
      SELECT *, round(x + y, 9) AS t, avg(x) OVER (PARTITION BY image_id, det_id) AS mx, avg(y) OVER (PARTITION BY image_id, det_id) AS my FROM {points}))))"""


CORNERS_OF = f"{with_tables('detections', 'images', 'classes')}, {POINTS}, {ordered('pts', 'crn')}"
AREA = "(SELECT image_id, det_id, abs(sum(x * ny - nx * y)) / 2 AS area FROM (SELECT *, lead(x, 1, x1) OVER w AS nx, lead(y, 1, y1) OVER w AS ny FROM (SELECT *, first_value(x) OVER w AS x1, first_value(y) OVER w AS y1 FROM crn WINDOW w AS (PARTITION BY image_id, det_id ORDER BY k)) WINDOW w AS (PARTITION BY image_id, det_id ORDER BY k)) GROUP BY ALL)"

# ---- sources and text -----------------------------------------------------------------


@query(with_tables("files") + " SELECT DISTINCT path, stem, ext, split FROM files WHERE lower(ext) IN ('jpg', 'jpeg', 'png', 'bmp', 'webp')")
def q01_list_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.images_among(table(spark, sf_dir, "files"))


@query(
    with_tables("label_lines", "images")
    + " SELECT CAST(i.image_id AS VARCHAR) AS stem, coalesce(string_agg(l.line, chr(10) ORDER BY l.line_no), '') AS content FROM (SELECT DISTINCT image_id FROM images) i LEFT JOIN label_lines l ON i.image_id = l.image_id GROUP BY 1"
)
def q05_label_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    stem = F.col("image_id").cast("string").alias("stem")
    return files.label_texts(table(spark, sf_dir, "label_lines").select(stem, "line_no", "line"), table(spark, sf_dir, "images").select(stem))


@query(with_tables("detections") + " SELECT image_id, det_id, lower(trim(label)) AS label FROM detections")
def q12_clean_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "detections").select("image_id", "det_id", clean_label(F.col("label")).alias("label"))


WHITELIST = [("yolo11_obb", x) for x in ("sam", "buoy", "boat")] + [("yolo26_seg", x) for x in ("sam", "lolo", "person")] + [("sam3", x) for x in ("boat", "person", "kite")]


@query(
    with_tables("detections", "classes")
    + f" SELECT image_id, det_id, source, lower(trim(d.label)) AS label FROM detections d JOIN (VALUES {', '.join(map(str, WHITELIST))}) w(s, l) ON w.s = d.source AND w.l = lower(trim(d.label)) WHERE w.l IN (SELECT label FROM classes)"
)
def q13_known_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    whitelist = spark.createDataFrame(WHITELIST, "source string, label string")
    kept = d.keep_known_classes(table(spark, sf_dir, "detections"), whitelist, table(spark, sf_dir, "classes"))
    return kept.select("image_id", "det_id", "source", "label")


@query(with_tables("detections") + " SELECT image_id, det_id, score FROM detections WHERE score >= CASE WHEN source LIKE 'yolo%' THEN CAST(0.25 AS DOUBLE) ELSE CAST(0.45 AS DOUBLE) END")
def q14_confident(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.keep_confident(table(spark, sf_dir, "detections"), d.CONFIDENCE).select("image_id", "det_id", "score")


def packed_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """mask_dets with their 8 x 8 mask of values over 0."""
    rows = table(spark, sf_dir, "mask_dets")
    return rows.withColumn("mask", m.binarize_mask(F.col("pixels"), F.lit(8), F.lit(8), 0.0)).drop("pixels")


SET = "list_transform(pixels, lambda p: CASE WHEN p > 0 THEN 1 ELSE 0 END)"
MASKS = with_tables("mask_dets") + f", m AS (SELECT image_id, det_id, source, class_id, score, {SET} AS b, list_sum({SET}) AS area FROM mask_dets)"


@query(MASKS + " SELECT image_id, det_id FROM m WHERE area >= 30")
def q15_large_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.keep_large_masks(packed_masks(spark, sf_dir), 30).select("image_id", "det_id")


@query(CORNERS_OF + f" SELECT image_id, det_id, round(area, 4) AS area FROM {AREA} WHERE area >= 400.5")
def q16_large_obbs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_corners(table(spark, sf_dir, "detections")).withColumn("area", g.polygon_area(F.col("corners")))
    return d.keep_large_obbs(rows, 400.5, "corners").select("image_id", "det_id", F.round("area", 4).alias("area"))


@query(
    with_tables("label_lines")
    + """, t AS (SELECT *, regexp_split_to_array(trim(line), '\\s+') AS tok FROM label_lines)
 SELECT image_id, line_no, CAST(trunc(TRY_CAST(tok[1] AS DOUBLE)) AS BIGINT) AS class_id, """
    + ", ".join(f"round(TRY_CAST(tok[{2 * i + j}] AS DOUBLE), 6) AS {k}{i}" for i in range(1, 5) for j, k in enumerate("xy"))
    + " FROM t WHERE len(tok) = 9 AND TRY_CAST(tok[1] AS DOUBLE) IS NOT NULL"
)
def q17_parse_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = files.parse_label_lines(table(spark, sf_dir, "label_lines"))
    return good.select("image_id", "line_no", "class_id", *flat(F.col("corners"), 6))


@query(
    CORNERS_OF
    + f", z AS (SELECT c.image_id, det_id, k, greatest(0, least(1, x / width)) AS x, greatest(0, least(1, y / height)) AS y FROM crn c JOIN images i ON c.image_id = i.image_id) SELECT image_id, det_id, {sql_corners(digits=9)} FROM z GROUP BY 1, 2"
)
def q18_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_corners(d.attach_image_size(table(spark, sf_dir, "detections"), table(spark, sf_dir, "images")))
    return rows.select("image_id", "det_id", *flat(g.normalize_corners(F.col("corners"), F.col("width"), F.col("height")), 9))


@query(
    CORNERS_OF
    + f", z AS (SELECT c.image_id, det_id, k AS i, x / width * width AS x, y / height * height AS y FROM crn c JOIN images i ON c.image_id = i.image_id), {ordered('z', 'zz')} SELECT image_id, det_id, {sql_corners()} FROM zz GROUP BY 1, 2"
)
def q19_denormalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_corners(d.attach_image_size(table(spark, sf_dir, "detections"), table(spark, sf_dir, "images")))
    shares = rows.withColumn("corners", g.normalize_corners(F.col("corners"), F.col("width"), F.col("height"), clip=False))
    pixels = datasets.order_moved(shares, lambda p: (p["x"] * F.col("width"), p["y"] * F.col("height")))
    return pixels.select("image_id", "det_id", *flat(F.col("corners")))


KIND = "CASE WHEN det_id % 13 = 0 THEN 'seg' WHEN det_id % 3 = 0 THEN 'obb' ELSE 'box' END"


@query(
    with_tables("detections")
    + f", k AS (SELECT *, {KIND} AS kind FROM detections), r AS (SELECT *, CASE kind WHEN 'seg' THEN 0 WHEN 'obb' THEN 1 ELSE 2 END AS n FROM k) SELECT image_id, det_id, concat('yolo11_', kind) AS source FROM (SELECT *, min(n) OVER (PARTITION BY image_id) AS best FROM r) WHERE n = best AND score >= 0.25"
)
def q20_output_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "detections").withColumn("kind", F.expr(KIND))
    return d.pick_output_kind(rows, F.col("score") >= 0.25).select("image_id", "det_id", "source")


SHAPE = "greatest(w, h) / (least(w, h) + CAST(1e-6 AS DOUBLE)) AS aspect, area / (w * h + CAST(1e-6 AS DOUBLE)) AS rectangularity"


def shaped(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "candidates")
    return rows.withColumns({"aspect": g.aspect_ratio(F.col("w"), F.col("h")), "rectangularity": g.rectangularity(F.col("area"), F.col("w"), F.col("h"))})


@query(with_tables("candidates") + f" SELECT image_id, mask_idx FROM (SELECT *, {SHAPE} FROM candidates) WHERE aspect >= 2 AND rectangularity BETWEEN 0.45 AND 1.05")
def q21_shape_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.shape_filter(shaped(spark, sf_dir)).select("image_id", "mask_idx")


# ---- geometry -------------------------------------------------------------------------


@query(CORNERS_OF + f" SELECT image_id, det_id, {sql_corners()} FROM crn GROUP BY 1, 2")
def q22_order_corners(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_corners(table(spark, sf_dir, "detections")).select("image_id", "det_id", *flat(F.col("corners")))


@query(
    with_tables("detections")
    + " SELECT image_id, det_id, round(cx - w / 2, 4) AS x1, round(cy - h / 2, 4) AS y1, round(cx + w / 2, 4) AS x2, round(cy - h / 2, 4) AS y2, round(cx + w / 2, 4) AS x3, round(cy + h / 2, 4) AS y3, round(cx - w / 2, 4) AS x4, round(cy + h / 2, 4) AS y4 FROM detections"
)
def q23_box_corners(spark: SparkSession, sf_dir: str) -> DataFrame:
    cx, cy, w, h, _ = rect()
    return table(spark, sf_dir, "detections").select("image_id", "det_id", *flat(g.box_to_corners(cx - w / 2, cy - h / 2, cx + w / 2, cy + h / 2)))


@query(CORNERS_OF + f" SELECT image_id, det_id, round(area, 4) AS area FROM {AREA}")
def q24_polygon_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_corners(table(spark, sf_dir, "detections")).select("image_id", "det_id", F.round(g.polygon_area(F.col("corners")), 4).alias("area"))


SKEW = "x + det_id * (i + 1) % 7 AS x, y - det_id * (i + 2) % 5 AS y"




def smallest(points: str) -> str:
    """CTEs that end in best: angle and bounds u0, u1, v0, v1 of the smallest rectangle round a table's points (image_id, det_id, i, x, y)."""
    return f"""
 li AS (SELECT a.image_id, a.det_id, degrees(atan2(b.y - a.y, b.x - a.x)) AS d FROM {points} a JOIN {points} b ON a.image_id = b.image_id AND a.det_id = b.det_id AND a.i < b.i WHERE a.x <> b.x OR a.y <> b.y),
 an AS (SELECT DISTINCT image_id, det_id, CASE WHEN m > 90 - 1e-9 THEN 0 ELSE m END AS angle FROM (SELECT *, ((d % 90) + 90) % 90 AS m FROM li)),
 re AS (SELECT image_id, det_id, angle, min(u) AS u0, max(u) AS u1, min(v) AS v0, max(v) AS v1 FROM (SELECT p.*, angle, x * cos(radians(angle)) + y * sin(radians(angle)) AS u, y * cos(radians(angle)) - x * sin(radians(angle)) AS v FROM {points} p JOIN an ON p.image_id = an.image_id AND p.det_id = an.det_id) GROUP BY 1, 2, 3),
 best AS (SELECT * FROM re QUALIFY row_number() OVER (PARTITION BY image_id, det_id ORDER BY round((u1 - u0) * (v1 - v0), 6), angle) = 1)"""


@query(
    f"""{with_tables('detections')}, {POINTS}, sk AS (SELECT image_id, det_id, i, {SKEW} FROM pts),{smallest('sk')}
 SELECT image_id, det_id, round((u1 - u0) * (v1 - v0), 3) AS area FROM best WHERE u1 - u0 > 1e-9 AND v1 - v0 > 1e-9"""
)
def q25_min_area_rect(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes with their corners moved apart, so that they are quadrilaterals of any kind."""
    corners = g.rect_to_corners(*rect())
    moved = F.array(*[g.point(corners[i]["x"] + F.col("det_id") * (i + 2) % 7, corners[i]["y"] - F.col("det_id") * (i + 3) % 5) for i in range(4)])
    rows = table(spark, sf_dir, "detections").select("image_id", "det_id", g.min_area_rect(moved).alias("r"))
    return d.keep(rows, F.col("r").isNotNull()).select("image_id", "det_id", F.round(F.col("r.w") * F.col("r.h"), 3).alias("area"))


@query(with_tables("candidates") + f" SELECT image_id, mask_idx, round(aspect, 6) AS aspect, round(rectangularity, 6) AS rectangularity FROM (SELECT *, {SHAPE} FROM candidates)")
def q26_obb_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shaped(spark, sf_dir).select("image_id", "mask_idx", F.round("aspect", 6).alias("aspect"), F.round("rectangularity", 6).alias("rectangularity"))


@query(with_tables("candidates") + f" SELECT image_id, mask_idx, round(area + 800 * aspect + 1200 * rectangularity, 4) AS rank_score FROM (SELECT *, {SHAPE} FROM candidates)")
def q27_candidate_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    score = g.candidate_score(F.col("area"), F.col("aspect"), F.col("rectangularity"))
    return shaped(spark, sf_dir).select("image_id", "mask_idx", F.round(score, 4).alias("rank_score"))


# ---- masks ----------------------------------------------------------------------------


@query(MASKS + " SELECT image_id, det_id, CAST(area AS BIGINT) AS area FROM m")
def q28_mask_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_masks(spark, sf_dir).select("image_id", "det_id", m.mask_area(F.col("mask")).alias("area"))


def mask_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = packed_masks(spark, sf_dir)
    a = rows.filter("source = 'yolo26_seg'").select("image_id", F.col("det_id").alias("first_id"), F.col("mask").alias("a"))
    b = rows.filter("source = 'sam3'").select("image_id", F.col("det_id").alias("second_id"), F.col("mask").alias("b"))
    return a.join(b, "image_id")


BOTH = "list_sum(list_transform(list_zip(a.b, b.b), lambda z: z[1] * z[2]))"
EITHER = "list_sum(list_transform(list_zip(a.b, b.b), lambda z: greatest(z[1], z[2])))"
PAIRS = MASKS + f", p AS (SELECT a.image_id, a.det_id AS first_id, b.det_id AS second_id, a.class_id AS ca, b.class_id AS cb, {BOTH} AS i, {EITHER} AS u FROM m a JOIN m b ON a.image_id = b.image_id AND a.source = 'yolo26_seg' AND b.source = 'sam3'), q AS (SELECT *, CASE WHEN u = 0 THEN 0 ELSE CAST(i AS DOUBLE) / u END AS iou FROM p)"


@query(PAIRS + " SELECT image_id, first_id, second_id, round(iou, 6) AS iou FROM q")
def q29_mask_iou(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mask_pairs(spark, sf_dir).select("image_id", "first_id", "second_id", F.round(m.mask_iou(F.col("a"), F.col("b")), 6).alias("iou"))


@query(PAIRS + " SELECT image_id, first_id, second_id, CAST(u AS BIGINT) AS area FROM q")
def q30_mask_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mask_pairs(spark, sf_dir).select("image_id", "first_id", "second_id", m.mask_area(m.mask_union(F.col("a"), F.col("b"))).alias("area"))


@query(MASKS + " SELECT image_id, det_id, array_to_string(b, '') AS bits FROM m")
def q31_binarize(spark: SparkSession, sf_dir: str) -> DataFrame:
    bits = F.reverse(F.lpad(F.bin(F.col("mask.words")[0]), 64, "0"))
    return packed_masks(spark, sf_dir).select("image_id", "det_id", bits.alias("bits"))


@query(
    MASKS
    + " SELECT image_id, det_id, CAST(list_sum(list_transform(range(0, 12 * 20), lambda t: b[1 + ((t // 20) * 8 // 12) * 8 + ((t % 20) * 8 // 20)])) AS BIGINT) AS area FROM m"
)
def q32_resize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_masks(spark, sf_dir).select("image_id", "det_id", m.mask_area(m.resize_mask(F.col("mask"), F.lit(12), F.lit(20))).alias("area"))


@query(f"{MASKS.replace('WITH ', 'WITH RECURSIVE ', 1)}, px AS (SELECT det_id AS key, k - 1 AS pos, 8 AS h, 8 AS w FROM (SELECT det_id, unnest(b) AS v, generate_subscripts(b, 1) AS k FROM m) WHERE v > 0){OUTLINES.format(min_area=2)} SELECT m.image_id, m.det_id, round(obb.area, 4) AS area, round(box, 3) AS box FROM m LEFT JOIN obb ON m.det_id = obb.key")
def q33_mask_to_obb(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = packed_masks(spark, sf_dir).select("image_id", "det_id", m.mask_to_obb(F.col("mask"), 2.0).alias("o"))
    return rows.select("image_id", "det_id", F.round("o.area", 4).alias("area"), F.round(F.col("o.w") * F.col("o.h"), 3).alias("box"))


@query(
    with_tables("detections")
    + " SELECT image_id, det_id, abs((px - cx) * cos(radians(deg)) + (py - cy) * sin(radians(deg))) <= w / 2 AND abs((py - cy) * cos(radians(deg)) - (px - cx) * sin(radians(deg))) <= h / 2 AS inside FROM (SELECT *, cx + det_id % 23 - CAST(11.3 AS DOUBLE) AS px, cy + det_id % 17 - CAST(8.7 AS DOUBLE) AS py FROM detections)"
)
def q34_point_in_obb(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_corners(table(spark, sf_dir, "detections"))
    x, y = F.col("cx") + F.col("det_id") % 23 - F.lit(11.3), F.col("cy") + F.col("det_id") % 17 - F.lit(8.7)
    return rows.select("image_id", "det_id", g.point_in_obb(x, y, F.col("corners")).alias("inside"))


# ---- joins ----------------------------------------------------------------------------


@query(with_tables("detections", "classes") + " SELECT image_id, det_id, class_id FROM detections d JOIN classes c ON lower(trim(d.label)) = c.label")
def q35_class_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.attach_class_id(table(spark, sf_dir, "detections"), table(spark, sf_dir, "classes")).select("image_id", "det_id", "class_id")


@query(with_tables("detections", "classes") + " SELECT image_id, det_id, coalesce(c.label, CAST(det_id % 9 AS VARCHAR)) AS class_name FROM detections d LEFT JOIN classes c ON d.det_id % 9 = c.class_id")
def q36_class_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "detections").withColumn("class_id", F.col("det_id") % 9)
    return d.attach_class_name(rows, table(spark, sf_dir, "classes")).select("image_id", "det_id", "class_name")


def by_model(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = packed_masks(spark, sf_dir)
    return rows.filter("source = 'yolo26_seg'"), rows.filter("source = 'sam3'")


IOU = 0.31


@query(PAIRS + f" SELECT image_id, first_id, second_id FROM q WHERE ca = cb AND iou >= {IOU}")
def q37_match_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fusion.match_masks(*by_model(spark, sf_dir), IOU).select("image_id", "first_id", "second_id")


@query(PAIRS + f" SELECT image_id, det_id FROM m WHERE source = 'sam3' AND det_id NOT IN (SELECT second_id FROM q WHERE ca = cb AND iou >= {IOU})")
def q38_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = by_model(spark, sf_dir)
    return fusion.unmatched(second, fusion.match_masks(first, second, IOU)).select("image_id", "det_id")


@query(with_tables("detections", "images") + " SELECT d.image_id, det_id, width, height FROM detections d JOIN images i ON d.image_id = i.image_id")
def q39_image_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.attach_image_size(table(spark, sf_dir, "detections"), table(spark, sf_dir, "images")).select("image_id", "det_id", "width", "height")


@query(
    with_tables("detections", "images")
    + " SELECT image_id, det_id, CASE WHEN image_id % 3 = 0 THEN 'file' ELSE 'sam2_amg' END AS source FROM detections WHERE image_id IN (SELECT image_id FROM images) AND CASE WHEN image_id % 3 = 0 THEN image_id % 2 = 0 AND det_id % 2 = 0 ELSE det_id % 2 = 1 END"
)
def q40_initial_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, images = table(spark, sf_dir, "detections"), table(spark, sf_dir, "images")
    label_files = images.filter("image_id % 3 = 0")  # those of odd images are empty
    labels = rows.filter("image_id % 6 = 0 and det_id % 2 = 0").select("image_id", "det_id", F.lit("file").alias("source"))
    proposals = rows.filter("det_id % 2 = 1").select("image_id", "det_id", F.lit("sam2_amg").alias("source"))
    return review.initial_objects(images, label_files, labels, proposals)


HITS = """, pt AS (SELECT image_id, det_id AS point_id, cx + 3 AS x, cy - 2 AS y FROM detections),
 h AS (SELECT p.image_id, point_id, d.det_id AS object_index, round(d.w * d.h, 6) AS area FROM pt p JOIN detections d ON p.image_id = d.image_id
  WHERE abs((p.x - cx) * cos(radians(deg)) + (p.y - cy) * sin(radians(deg))) <= w / 2 AND abs((p.y - cy) * cos(radians(deg)) - (p.x - cx) * sin(radians(deg))) <= h / 2),
 best AS (SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY image_id, point_id ORDER BY area, object_index) = 1)"""


def hit_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = table(spark, sf_dir, "detections")
    points = rows.select("image_id", F.col("det_id").alias("point_id"), (F.col("cx") + 3).alias("x"), (F.col("cy") - 2).alias("y"))
    objects = rows.select("image_id", F.col("det_id").alias("object_index"), *rect(), F.round(F.col("w") * F.col("h"), 6).alias("area"))
    return points, objects


@query(with_tables("detections") + HITS + " SELECT p.image_id, p.point_id, b.object_index FROM pt p LEFT JOIN best b ON p.image_id = b.image_id AND p.point_id = b.point_id")
def q41_hit_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review.hit_test(*hit_inputs(spark, sf_dir)).select("image_id", "point_id", "object_index")


GAUSS = """, ab AS (SELECT p.image_id, p.class_id, pred_id, gt_id, p.cx AS x1, p.cy AS y1, t.cx AS x2, t.cy AS y2,
  p.w * p.w / 12 * cos(radians(p.deg)) ** 2 + p.h * p.h / 12 * sin(radians(p.deg)) ** 2 AS a1, p.w * p.w / 12 * sin(radians(p.deg)) ** 2 + p.h * p.h / 12 * cos(radians(p.deg)) ** 2 AS b1, (p.w * p.w - p.h * p.h) / 12 * sin(radians(p.deg)) * cos(radians(p.deg)) AS c1,
  t.w * t.w / 12 * cos(radians(t.deg)) ** 2 + t.h * t.h / 12 * sin(radians(t.deg)) ** 2 AS a2, t.w * t.w / 12 * sin(radians(t.deg)) ** 2 + t.h * t.h / 12 * cos(radians(t.deg)) ** 2 AS b2, (t.w * t.w - t.h * t.h) / 12 * sin(radians(t.deg)) * cos(radians(t.deg)) AS c2
  FROM predictions p JOIN truth t ON p.image_id = t.image_id AND p.class_id = t.class_id),
 dd AS (SELECT *, (a1 + a2) * (b1 + b2) - (c1 + c2) ** 2 AS det FROM ab),
 pairs AS (SELECT image_id, class_id, pred_id, gt_id, 1 - sqrt(1 - exp(-greatest(0, ((a1 + a2) * (y1 - y2) ** 2 + (b1 + b2) * (x2 - x1) ** 2) / det / 4 + (c1 + c2) * (x2 - x1) * (y1 - y2) / det / 2 + 0.5 * ln(det / (4 * sqrt(greatest(0, a1 * b1 - c1 ** 2) * greatest(0, a2 * b2 - c2 ** 2))))))) AS iou FROM dd)"""
PAIRED = with_tables("truth", "predictions", "classes") + GAUSS


def paired(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.pair_predictions(table(spark, sf_dir, "predictions"), table(spark, sf_dir, "truth"))


@query(PAIRED + " SELECT image_id, class_id, pred_id, gt_id, round(iou, 5) AS iou FROM pairs")
def q42_pair_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paired(spark, sf_dir).drop("score").withColumn("iou", F.round("iou", 5))


# ---- datasets -------------------------------------------------------------------------

FILES = with_tables("files") + ", f AS (SELECT DISTINCT path, stem, ext, split FROM files WHERE lower(ext) IN ('jpg', 'jpeg', 'png', 'bmp', 'webp')), lab AS (SELECT DISTINCT stem, split FROM files WHERE ext IN ('txt', 'png', 'bmp'))"


def image_and_label_files(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    every = table(spark, sf_dir, "files")
    return files.images_among(every), every.filter("ext in ('txt', 'png', 'bmp')")


@query(
    FILES
    + " SELECT split, stem, 'image without label' AS reason FROM (SELECT DISTINCT split, stem FROM f) a ANTI JOIN lab USING (split, stem) UNION ALL SELECT split, stem, 'label without image' FROM lab ANTI JOIN f USING (split, stem)"
)
def q43_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return datasets.dataset_orphans(*image_and_label_files(spark, sf_dir))


@query(FILES + " SELECT stem, string_agg(DISTINCT split, ',' ORDER BY split) AS splits FROM f GROUP BY stem HAVING count(DISTINCT split) > 1")
def q44_split_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    leaks = datasets.split_leaks(image_and_label_files(spark, sf_dir)[0])
    return leaks.select("stem", F.array_join("splits", ",").alias("splits"))


@query(FILES + " SELECT split, stem, count(*) AS n_files, max(path) AS winner FROM f GROUP BY ALL HAVING count(*) > 1")
def q45_stem_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return datasets.stem_collisions(image_and_label_files(spark, sf_dir)[0])


@query(
    with_tables("truth", "images")
    + ", n AS (SELECT image_id, count(*) AS n FROM truth WHERE class_id IN (4, 1, 0) GROUP BY 1) SELECT i.image_id, coalesce(n, 0) AS n FROM images i LEFT JOIN n ON i.image_id = n.image_id"
)
def q46_remapped_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapping = datasets.subset_mapping(table(spark, sf_dir, "classes"), ["boat", "buoy", "sam"])
    return datasets.remapped_images(table(spark, sf_dir, "images"), table(spark, sf_dir, "truth"), mapping)


@query(with_tables("truth") + " SELECT image_id, gt_id, CASE class_id WHEN 4 THEN 0 WHEN 1 THEN 1 ELSE 2 END AS class_id FROM truth WHERE class_id IN (4, 1, 0)")
def q46_remap_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapping = datasets.subset_mapping(table(spark, sf_dir, "classes"), ["boat", "buoy", "sam"])
    return datasets.remap_classes(table(spark, sf_dir, "truth"), mapping).select("image_id", "gt_id", F.col("class_id").cast("int").alias("class_id"))


@query(with_tables("truth") + " SELECT image_id, gt_id, class_id FROM truth WHERE class_id > 4")
def q47_invalid_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return datasets.invalid_classes(table(spark, sf_dir, "truth"), table(spark, sf_dir, "classes").filter("class_id <= 4")).select("image_id", "gt_id", "class_id")


SCHEME_B = "b AS (SELECT lower(trim(label)) AS label, min(det_id % 6) AS class_id FROM detections GROUP BY 1)"


def found_scheme(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of the detections with the least id they occur with."""
    return table(spark, sf_dir, "detections").groupBy(clean_label(F.col("label")).alias("label")).agg(F.min(F.col("det_id") % 6).alias("class_id"))


@query(
    with_tables("detections", "classes")
    + f", {SCHEME_B} SELECT coalesce(a.class_id, b.class_id) AS class_id, a.label AS left_label, b.label AS right_label FROM classes a FULL OUTER JOIN b ON a.class_id = b.class_id WHERE a.label IS DISTINCT FROM b.label"
)
def q48_scheme_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return datasets.scheme_conflicts(table(spark, sf_dir, "classes"), found_scheme(spark, sf_dir))


LISTS = f"{ordered('pts', 'crn')}, cl AS (SELECT image_id, det_id, list(x ORDER BY k) AS px, list(y ORDER BY k) AS py FROM crn GROUP BY 1, 2)"
CORNERS_LISTED = f"{with_tables('detections', 'predictions', 'truth')}, {POINTS}, {LISTS}"


@query(
    f"""{CORNERS_LISTED.replace('WITH ', 'WITH RECURSIVE ', 1)}, o AS (SELECT p.image_id, class_id, pred_id, w * h AS area, px, py, row_number() OVER (PARTITION BY p.image_id, class_id ORDER BY score DESC, pred_id) AS rn FROM predictions p JOIN cl ON p.image_id = cl.image_id AND p.pred_id = cl.det_id),
 pr AS (SELECT a.image_id, a.class_id, a.pred_id AS first_id, b.pred_id AS second_id, a.area AS area_a, b.area AS area_b, a.px AS fx, a.py AS fy, b.px AS gx, b.py AS gy FROM o a JOIN o b ON a.image_id = b.image_id AND a.class_id = b.class_id AND a.rn < b.rn){OVERLAPS},
 ov AS (SELECT image_id, second_id AS pred_id, list(first_id) AS better FROM overlap WHERE iou > 0.3 GROUP BY 1, 2),
 st AS (SELECT o.image_id, class_id, rn, o.pred_id, coalesce(better, []) AS better FROM o LEFT JOIN ov ON o.image_id = ov.image_id AND o.pred_id = ov.pred_id),
 run AS (SELECT image_id, class_id, rn, [pred_id] AS kept FROM st WHERE rn = 1
  UNION ALL SELECT st.image_id, st.class_id, st.rn, CASE WHEN list_has_any(kept, better) THEN kept ELSE list_append(kept, st.pred_id) END FROM run JOIN st ON run.image_id = st.image_id AND run.class_id = st.class_id AND st.rn = run.rn + 1)
 SELECT image_id, class_id, unnest(kept) AS det_id FROM (SELECT * FROM run QUALIFY rn = max(rn) OVER (PARTITION BY image_id, class_id))"""
)
def q49_nms(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_corners(table(spark, sf_dir, "predictions")).withColumnRenamed("pred_id", "det_id")
    return suppression.nms(rows, 0.3, corners_col="corners")


@query(
    f"""{CORNERS_LISTED}, tc AS (SELECT image_id, gt_id, det_id, i, cx2 + a * (w / 2) * cos(radians(deg)) - b * (h / 2) * sin(radians(deg)) AS x, cy2 + a * (w / 2) * sin(radians(deg)) + b * (h / 2) * cos(radians(deg)) AS y
  FROM (SELECT *, gt_id AS det_id, cx AS cx2, cy AS cy2 FROM truth), (VALUES (1, -1, -1), (2, 1, -1), (3, 1, 1), (4, -1, 1)) v(i, a, b)), {ordered('tc', 'td')}, tl AS (SELECT image_id, det_id, list(x ORDER BY k) AS px, list(y ORDER BY k) AS py FROM td GROUP BY 1, 2),
 pr AS (SELECT p.image_id, pred_id AS first_id, gt_id AS second_id, p.w * p.h AS area_a, t.w * t.h AS area_b, a.px AS fx, a.py AS fy, b.px AS gx, b.py AS gy
  FROM predictions p JOIN truth t ON p.image_id = t.image_id AND p.class_id = t.class_id JOIN cl a ON a.image_id = p.image_id AND a.det_id = pred_id JOIN tl b ON b.image_id = t.image_id AND b.det_id = gt_id){OVERLAPS}
 SELECT image_id, first_id AS pred_id, second_id AS gt_id, round(iou, 5) AS iou FROM overlap"""
)
def q51_polygon_iou(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = with_corners(table(spark, sf_dir, "predictions")).select("image_id", "class_id", "pred_id", F.col("corners").alias("a"))
    b = with_corners(table(spark, sf_dir, "truth")).select("image_id", "class_id", "gt_id", F.col("corners").alias("b"))
    pairs = a.join(b, ["image_id", "class_id"])
    return pairs.select("image_id", "pred_id", "gt_id", F.round(g.polygon_iou(F.col("a"), F.col("b")), 5).alias("iou"))


@query(
    PAIRS
    + f""", j AS (SELECT image_id, first_id, second_id FROM q WHERE ca = cb AND iou >= {IOU}),
 x AS (SELECT a.image_id, a.det_id, a.class_id, a.score, a.b, 0 AS part, a.det_id AS src FROM m a WHERE a.source = 'yolo26_seg'
  UNION ALL SELECT j.image_id, j.first_id, a.class_id, s.score, s.b, 0, s.det_id FROM j JOIN m s ON s.det_id = j.second_id JOIN m a ON a.det_id = j.first_id
  UNION ALL SELECT image_id, det_id, class_id, score, b, 1, det_id FROM m WHERE source = 'sam3' AND det_id NOT IN (SELECT second_id FROM j)),
 y AS (SELECT image_id, det_id, class_id, part, max(score) OVER (PARTITION BY det_id) AS score, unnest(b) AS v, generate_subscripts(b, 1) AS k FROM x),
 z AS (SELECT image_id, det_id, class_id, part, score, k, max(v) AS v FROM y GROUP BY ALL)
 SELECT image_id, det_id, class_id, part, round(max(score), 6) AS score, CAST(sum(v) AS BIGINT) AS area FROM z GROUP BY image_id, det_id, class_id, part"""
)
def q52_fuse_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    fused = fusion.fuse_masks(*by_model(spark, sf_dir), IOU)
    return fused.select("image_id", "det_id", "class_id", "part", F.round("score", 6).alias("score"), m.mask_area(F.col("mask")).alias("area"))


# ---- evaluation -----------------------------------------------------------------------

NAMES = [evaluation.flag(t) for t in evaluation.THRESHOLDS]
MATCHED = (
    PAIRED
    + """, o AS (SELECT *, row_number() OVER (PARTITION BY image_id, pred_id ORDER BY iou DESC, gt_id) AS rn FROM pairs),
 s AS (SELECT o.*, p.score FROM o JOIN predictions p ON o.image_id = p.image_id AND o.pred_id = p.pred_id WHERE rn = 1),
 b AS (SELECT *, coalesce(max(iou) OVER (PARTITION BY image_id, gt_id ORDER BY score DESC, pred_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1) AS prev FROM s),
 mt AS (SELECT p.image_id, p.class_id, p.pred_id, p.score, """
    + ", ".join(f"CASE WHEN prev < CAST({t} AS DOUBLE) AND iou >= CAST({t} AS DOUBLE) THEN 1 ELSE 0 END AS {n}" for t, n in zip(evaluation.THRESHOLDS, NAMES, strict=True))
    + " FROM predictions p LEFT JOIN b ON p.image_id = b.image_id AND p.pred_id = b.pred_id)"
)


def measured(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Predictions and truth, both read several times, over detections that are made once."""
    detections = materialise(table(spark, sf_dir, "detections").drop("source", "label"))
    return derived(spark, ("predictions", "truth"), detections=detections)


@query(MATCHED + f" SELECT image_id, class_id, pred_id, {', '.join(NAMES)} FROM mt")
def q63_match_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.match_truth(*measured(spark, sf_dir)).drop("score")


CURVE = (
    MATCHED
    + ", nt AS (SELECT class_id, count(*) AS n_truth FROM truth GROUP BY 1), cu AS (SELECT mt.class_id, image_id, pred_id, score, n_truth, row_number() OVER w AS rank, "
    + ", ".join(f"CAST(sum({n}) OVER w AS BIGINT) AS {n}" for n in NAMES)
    + " FROM mt JOIN nt ON mt.class_id = nt.class_id WINDOW w AS (PARTITION BY mt.class_id ORDER BY score DESC, image_id, pred_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"
)


def curve_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    predictions, truth = measured(spark, sf_dir)
    return evaluation.pr_curve(evaluation.match_truth(predictions, truth), truth.groupBy("class_id").agg(F.count("*").alias("n_truth")))


@query(CURVE + f" SELECT class_id, image_id, pred_id, rank, {', '.join(NAMES)} FROM cu")
def q53_pr_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curve_of(spark, sf_dir).drop("score", "n_truth", "hits")


PER_CLASS = (
    CURVE
    + ", th AS (SELECT class_id, t, "
    + "tp, rank, n_truth FROM cu UNPIVOT (tp FOR t IN ("
    + ", ".join(NAMES)
    + """))), st AS (SELECT class_id, t, CAST(k AS BIGINT) AS k, coalesce(max(CASE WHEN tp * 100 // n_truth >= k THEN CAST(tp AS DOUBLE) / rank END), 0) AS p FROM th, range(0, 101) r(k) GROUP BY 1, 2, 3),
 pt AS (SELECT class_id, t, sum(p) / 101 AS ap FROM st GROUP BY 1, 2), pc AS (SELECT c.class_id, c.label, max(CASE WHEN t = 'tp50' THEN ap END) AS ap50, avg(ap) AS ap FROM classes c LEFT JOIN pt ON c.class_id = pt.class_id GROUP BY 1, 2)"""
)


def per_class_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.average_precision(curve_of(spark, sf_dir), table(spark, sf_dir, "classes"))


@query(PER_CLASS + " SELECT class_id, round(ap50, 6) AS ap50, round(ap, 6) AS ap FROM pc")
def q54_average_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return per_class_of(spark, sf_dir).select("class_id", F.round("ap50", 6).alias("ap50"), F.round("ap", 6).alias("ap"))


OVERALL = (
    PER_CLASS
    + """, gr AS (SELECT c.class_id, k AS step, max(rank) AS rank, max(tp50) AS tp, max(n_truth) AS n FROM (SELECT DISTINCT class_id FROM cu) c CROSS JOIN range(0, 1001) r(k) LEFT JOIN (SELECT *, floor(score * 1000) AS s FROM cu) u ON u.class_id = c.class_id AND s >= k GROUP BY 1, 2),
 pr AS (SELECT *, coalesce(CAST(tp AS DOUBLE) / rank, 1) AS p, coalesce(CAST(tp AS DOUBLE) / n, 0) AS r FROM gr),
 mn AS (SELECT step, avg(p) AS p, avg(r) AS r, round(avg(2 * p * r / (p + r + CAST(1e-16 AS DOUBLE))), 9) AS f FROM pr GROUP BY 1), bs AS (SELECT p, r FROM mn ORDER BY f DESC, step LIMIT 1),
 ov AS (SELECT p AS mp, r AS mr, map50, map FROM bs, (SELECT avg(ap50) AS map50, avg(ap) AS map FROM pc))"""
)


def overall_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = materialise(evaluation.curve_points(curve_of(spark, sf_dir)))
    return evaluation.overall_points(points, evaluation.average_points(points, table(spark, sf_dir, "classes")))


@query(OVERALL + " SELECT round(mp, 6) AS mp, round(mr, 6) AS mr, round(map50, 6) AS map50, round(map, 6) AS map FROM ov")
def q55_overall_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overall_of(spark, sf_dir).select(*[F.round(c, 6).alias(c) for c in ("mp", "mr", "map50", "map")])


IN_TEST = "(SELECT image_id FROM images WHERE split = 'test')"
#: The evaluation of the test split: truth and predictions are cut down before anything is paired.
TESTED = f"""{with_tables('truth', 'predictions', 'classes', 'images').replace('truth AS (', 'truth0 AS (', 1).replace('predictions AS (', 'predictions0 AS (', 1)},
 truth AS (SELECT * FROM truth0 WHERE image_id IN {IN_TEST}), predictions AS (SELECT * FROM predictions0 WHERE image_id IN {IN_TEST} AND score >= 0.3)"""


def of_test_split(sql: str) -> str:
    """An evaluation's SQL for the test split."""
    return TESTED + sql[len(with_tables("truth", "predictions", "classes")) :]


BY_DOMAIN = (
    of_test_split(MATCHED)
    + ", md AS (SELECT mt.*, domain FROM mt JOIN images i ON mt.image_id = i.image_id), nt AS (SELECT domain, class_id, count(*) AS n_truth FROM truth t JOIN images i ON t.image_id = i.image_id GROUP BY 1, 2), cu AS (SELECT md.domain, md.class_id, image_id, pred_id, score, n_truth, row_number() OVER w AS rank, "
    + ", ".join(f"CAST(sum({n}) OVER w AS BIGINT) AS {n}" for n in NAMES)
    + " FROM md JOIN nt ON md.class_id = nt.class_id AND md.domain = nt.domain WINDOW w AS (PARTITION BY md.domain, md.class_id ORDER BY score DESC, image_id, pred_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"
    + f", th AS (SELECT domain, class_id, t, tp, rank, n_truth FROM cu UNPIVOT (tp FOR t IN ({', '.join(NAMES)})))"
    + """, st AS (SELECT domain, class_id, t, k, coalesce(max(CASE WHEN tp * 100 // n_truth >= k THEN CAST(tp AS DOUBLE) / rank END), 0) AS p FROM th, range(0, 101) r(k) GROUP BY 1, 2, 3, 4),
 pt AS (SELECT domain, class_id, t, sum(p) / 101 AS ap FROM st GROUP BY 1, 2, 3), pc AS (SELECT domain, class_id, max(CASE WHEN t = 'tp50' THEN ap END) AS ap50, avg(ap) AS ap FROM pt GROUP BY 1, 2)"""
)


@query(BY_DOMAIN + " SELECT domain, class_id, round(ap50, 6) AS ap50, round(ap, 6) AS ap FROM pc")
def q54_ap_by_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    images, classes = (table(spark, sf_dir, n) for n in ("images", "classes"))
    return evaluate_by_domain(*measured(spark, sf_dir), images, classes, confidence=0.3).select("domain", "class_id", F.round("ap50", 6).alias("ap50"), F.round("ap", 6).alias("ap"))


NUMBER = "coalesce(printf('%.3f', round({0}, 9)), '--')"
REPORT = f"""SELECT concat_ws(' & ', label, {NUMBER.format('ap50')}, {NUMBER.format('ap')}) AS line FROM pc
 UNION ALL SELECT concat_ws(' & ', 'mean', {NUMBER.format('avg(ap50)')}, {NUMBER.format('avg(ap)')}) FROM pc"""


@query(f"{of_test_split(PER_CLASS)} {REPORT}")
def job_evaluate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of the test split."""
    images, classes = (table(spark, sf_dir, n) for n in ("images", "classes"))
    return evaluate(*measured(spark, sf_dir), classes, 0.3, images=images).report().select("line")


@query(f"{PER_CLASS} {REPORT}")
def q10_report_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_class = materialise(per_class_of(spark, sf_dir)).select("class_id", F.round("ap50", 9).alias("ap50"), F.round("ap", 9).alias("ap"))
    means = per_class.agg(F.avg("ap50").alias("map50"), F.avg("ap").alias("map"))
    return files.report_rows(d.attach_class_name(per_class, table(spark, sf_dir, "classes")), means).select("line")


CUBE = with_tables("truth", "images") + ", j AS (SELECT i.image_id, split, domain, class_id, gt_id FROM images i LEFT JOIN truth t ON i.image_id = t.image_id)"


@query(
    CUBE
    + " SELECT split, domain, class_id, CAST(grouping(split) * 4 + grouping(domain) * 2 + grouping(class_id) AS BIGINT) AS level, count(gt_id) AS n_objects, count(DISTINCT image_id) AS n_images FROM j GROUP BY CUBE (split, domain, class_id)"
)
def q56_count_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return datasets.count_objects(table(spark, sf_dir, "truth"), table(spark, sf_dir, "images"))


# ---- top-k and order ------------------------------------------------------------------


@query(with_tables("detections") + HITS + " SELECT image_id, point_id, object_index FROM best")
def q57_smallest_hit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review.smallest_hit(review.holding(*hit_inputs(spark, sf_dir))).select("image_id", "point_id", "object_index")


@query(with_tables("candidates") + " SELECT image_id, mask_idx % 3 AS request_id, mask_idx FROM candidates QUALIFY row_number() OVER (PARTITION BY image_id, mask_idx % 3 ORDER BY score DESC, mask_idx) = 1")
def q58_best_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "candidates").withColumn("request_id", F.col("mask_idx") % 3)
    return review.best_mask(rows).select("image_id", "request_id", "mask_idx")


PROPOSAL = f"""{with_tables("candidates")}, top AS (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY area DESC, mask_idx) AS place FROM candidates),
 sh AS (SELECT *, {SHAPE} FROM top WHERE place <= 120 AND area >= 1500)
 SELECT image_id, mask_idx, round(area + 800 * aspect + 1200 * rectangularity, 4) AS confidence FROM sh WHERE aspect >= 2 AND rectangularity BETWEEN 0.45 AND 1.05
 QUALIFY row_number() OVER (PARTITION BY image_id ORDER BY area + 800 * aspect + 1200 * rectangularity DESC, place) = 1"""


@query(PROPOSAL)
def q59_best_proposal(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = shaped(spark, sf_dir).withColumn("obb_area", F.col("area"))
    return review.best_proposal(rows).select("image_id", "mask_idx", F.round("confidence", 4).alias("confidence"))


@query(with_tables("candidates") + " SELECT image_id, mask_idx FROM candidates WHERE score >= 0.8 AND (50 + mask_idx % 60) / 100.0 >= 0.92")
def q60_quality_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "candidates").withColumns({"predicted_iou": F.col("score"), "stability": (50 + F.col("mask_idx") % 60) / 100})
    return review.proposal_quality_filter(rows).select("image_id", "mask_idx")


@query(with_tables("detections") + " SELECT image_id, det_id, row_number() OVER (PARTITION BY image_id ORDER BY det_id % 2, det_id % 5, det_id) - 1 AS object_index FROM detections")
def q61_object_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "detections").withColumns({"branch": F.col("det_id") % 2, "prompt_no": F.col("det_id") % 5})
    return fusion.assign_object_index(rows).select("image_id", "det_id", "object_index")


@query(with_tables("label_lines") + " SELECT image_id AS stem, line_no % 4 AS revision, line_no FROM label_lines QUALIFY line_no % 4 = max(line_no % 4) OVER (PARTITION BY image_id)")
def q62_latest_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "label_lines").select(F.col("image_id").alias("stem"), (F.col("line_no") % 4).alias("revision"), "line_no")
    return review.latest_labels(rows)


MODELS = ["sam3", "yolo11_obb", "yolo26_seg"]
MODEL_AP = with_tables("detections") + ", ap AS (SELECT source AS model, lower(trim(label)) AS label, round(avg(score), 6) AS ap50 FROM detections GROUP BY 1, 2), rk AS (SELECT *, rank() OVER (PARTITION BY label ORDER BY ap50 DESC) AS rank FROM ap)"


@query(
    MODEL_AP
    + " SELECT label, "
    + ", ".join(f"max(CASE WHEN model = '{x}' THEN ap50 END) AS {x}_ap, max(CASE WHEN model = '{x}' THEN rank END) AS {x}_rank, round(max(CASE WHEN model = '{x}' THEN ap50 END) - max(CASE WHEN model = 'sam3' THEN ap50 END), 6) AS {x}_delta" for x in MODELS)
    + ", arg_max(model, ap50) AS best FROM rk GROUP BY label"
)
def q64_compare_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "detections").groupBy(F.col("source").alias("model"), clean_label(F.col("label")).alias("label")).agg(F.round(F.avg("score"), 6).alias("ap50"))
    return evaluation.compare_models(rows, MODELS, "sam3")


# ---- sets and records -----------------------------------------------------------------


@query(with_tables("detections") + " SELECT image_id, det_id, score, 'mask' AS branch FROM detections WHERE source <> 'yolo11_obb' UNION ALL SELECT image_id, det_id, NULL, 'aux' FROM detections WHERE score > 0.5")
def q65_combine_branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "detections")
    masks = rows.filter("source <> 'yolo11_obb'").select("image_id", "det_id", "score", F.lit("mask").alias("branch"))
    return d.combine_branches(masks, rows.filter("score > 0.5").select("image_id", "det_id", F.lit("aux").alias("branch")))


@query(with_tables("images") + " SELECT concat(domain, '_', CAST(image_id AS VARCHAR)) AS image_id, domain, width FROM images")
def q66_mix_datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "images").select("image_id", "domain", "width")
    return datasets.mix_datasets({x: rows.filter(F.col("domain") == x).drop("domain") for x in ("real", "sim")}).select("image_id", "domain", "width")


@query(
    with_tables("detections", "classes")
    + f", {SCHEME_B} SELECT label, CASE WHEN a AND b THEN 'both' WHEN a THEN 'left' ELSE 'right' END AS side FROM (SELECT coalesce(x.label, y.label) AS label, x.label IS NOT NULL AS a, y.label IS NOT NULL AS b FROM classes x FULL OUTER JOIN b y ON x.label = y.label)"
)
def q67_scheme_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return datasets.scheme_classes_diff(table(spark, sf_dir, "classes"), found_scheme(spark, sf_dir))


def toy_detector() -> Callable[[pd.DataFrame], pd.DataFrame]:
    """A stand-in model: one box on images of even id, in the middle."""

    def detect(batch: pd.DataFrame) -> pd.DataFrame:
        seen = batch[batch.image_id % 2 == 0]
        return pd.DataFrame({"image_id": seen.image_id, "cx": seen.width / 2, "cy": seen.height / 2})

    return detect


@query(with_tables("images") + " SELECT image_id, CAST(width AS DOUBLE) / 2 AS cx, CAST(height AS DOUBLE) / 2 AS cy FROM images WHERE image_id % 2 = 0")
def q68_run_detector(spark: SparkSession, sf_dir: str) -> DataFrame:
    images = table(spark, sf_dir, "images").select("image_id", "width", "height")
    return d.run_detector(images, toy_detector, "image_id long, cx double, cy double")


def toy_prompted() -> Callable[[pd.DataFrame], pd.DataFrame]:
    """A stand-in model: a prompt is found if its length divides the image's id."""

    def detect(batch: pd.DataFrame) -> pd.DataFrame:
        each = batch[["image_id", "prompts"]].explode("prompts").dropna().rename(columns={"prompts": "label"})
        return each[each.image_id % each.label.str.len() == 0]

    return detect


@query(with_tables("images", "classes") + " SELECT image_id, label FROM images, classes WHERE image_id % length(label) = 0")
def q69_run_prompted(spark: SparkSession, sf_dir: str) -> DataFrame:
    prompts = table(spark, sf_dir, "classes").select(F.col("label").alias("prompt"))
    return d.run_prompted_detector(table(spark, sf_dir, "images").select("image_id"), prompts, toy_prompted, "image_id long, label string")


def md5_draw(name: str) -> Column:
    """A number in [0, 1) of image, copy and the draw's name that DuckDB can make as well."""
    text = F.concat_ws("-", F.col("image_id").cast("string"), F.col("copy").cast("string"), F.lit(name))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 6), 16, 10).cast("double") / float(1 << 24)


def sql_draw(name: str, reach: float = 1.0) -> str:
    return f"((CAST('0x' || substr(md5(concat_ws('-', image_id, copy, '{name}')), 1, 6) AS BIGINT) / CAST(16777216 AS DOUBLE)) * 2 - 1) * CAST({reach} AS DOUBLE)"


MOVED = f"""sh AS (SELECT c.image_id, det_id * 10 + copy AS det_id, copy, k AS i, greatest(0, least(1, x / width)) - 0.5 AS x, greatest(0, least(1, y / height)) - 0.5 AS y FROM crn c JOIN images i ON c.image_id = i.image_id, range(1, 3) r(copy)),
 dr AS (SELECT *, radians({sql_draw('turn', 8.0)}) AS turn, tan(radians({sql_draw('sx', 2.0)})) AS sx, tan(radians({sql_draw('sy', 2.0)})) AS sy, 1 + {sql_draw('zoom', 0.4)} AS zoom, {sql_draw('dx', 0.1)} AS dx, {sql_draw('dy', 0.1)} AS dy, {sql_draw('flip')} < 0 AS flip FROM sh),
 sr AS (SELECT *, x + sx * y AS a, y + sy * x AS b FROM dr),
 mv AS (SELECT image_id, det_id, i, cos(turn) * zoom * a - sin(turn) * zoom * b + 0.5 + dx AS x, sin(turn) * zoom * a + cos(turn) * zoom * b + 0.5 + dy AS y, flip FROM sr),
 hd AS (SELECT image_id, det_id, i, greatest(0, least(1, CASE WHEN flip THEN 1 - x ELSE x END)) AS x, greatest(0, least(1, y)) AS y FROM mv), {ordered('hd', 'od')}"""


def sql_area() -> str:
    """The shoelace area of grouped corners k, x, y."""
    at = lambda c, k: f"max(CASE WHEN k = {k % 4 + 1} THEN {c} END)"
    return "abs(" + " + ".join(f"{at('x', k)} * {at('y', k + 1)} - {at('x', k + 1)} * {at('y', k)}" for k in range(4)) + ") / 2"


@query(f"{CORNERS_OF}, {MOVED} SELECT image_id, det_id // 10 AS det_id, det_id % 10 AS copy, {sql_corners(digits=6)} FROM od GROUP BY image_id, od.det_id HAVING {sql_area()} > 1e-9")
def q70_augment_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_corners(d.attach_image_size(table(spark, sf_dir, "detections"), table(spark, sf_dir, "images")))
    shares = rows.select("image_id", "det_id", g.normalize_corners(F.col("corners"), F.col("width"), F.col("height")).alias("corners"))
    moved = datasets.augment_labels(shares, copies=2, draw=md5_draw)
    return moved.select("image_id", "det_id", F.col("copy").cast("long").alias("copy"), *flat(F.col("corners"), 6))


@query(with_tables("images") + " SELECT image_id, CASE WHEN image_id * 7919 % 10000 < 7000 THEN 'train' WHEN image_id * 7919 % 10000 < 9000 THEN 'val' ELSE 'test' END AS split FROM images")
def q71_assign_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "images").select("image_id")
    return datasets.assign_split(rows, {"train": 0.7, "val": 0.2, "test": 0.1}, F.col("image_id") * 7919)


@query(with_tables("detections") + " SELECT stage, round(ms, 6) AS ms FROM (SELECT 'inference' AS stage, avg(w) AS ms FROM detections UNION ALL SELECT 'preprocess', avg(h) FROM detections)")
def q72_stage_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "detections").select(F.create_map(F.lit("preprocess"), F.col("h"), F.lit("inference"), F.col("w")).alias("speed_ms"))
    return evaluation.stage_times(rows).select(F.explode("speed_ms").alias("stage", "ms")).select("stage", F.round("ms", 6).alias("ms"))


ALL_OBJECTS = f"""{CORNERS_LISTED.replace('WITH ', 'WITH RECURSIVE ', 1)}, start AS (SELECT image_id, det_id AS place, det_id % 6 AS class_id, 'file' AS source, CAST(1 AS DOUBLE) AS confidence, px, py FROM cl)"""


@query(f"{ALL_OBJECTS.replace('WITH RECURSIVE ', with_tables('edits').replace('WITH ', 'WITH RECURSIVE ', 1) + ', ', 1)}{REPLAY} SELECT image_id, object_index, class_id, source, confidence, {EDITED_CORNERS} FROM edited WHERE object_index IS NOT NULL")
def q73_replay_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every detection of an edited image is an object at the start."""
    edits = table(spark, sf_dir, "edits")
    start = with_corners(table(spark, sf_dir, "detections")).select(
        "image_id",
        F.col("det_id").alias("object_index"),
        (F.col("det_id") % 6).alias("class_id"),
        F.lit("file").alias("source"),
        F.lit(1.0).alias("confidence"),
        "corners",
    )
    replayed = review.replay_edits(start.join(edits.select("image_id").distinct(), "image_id", "left_semi"), edits, classes=table(spark, sf_dir, "classes"))
    return replayed.select("image_id", "object_index", "class_id", "source", "confidence", *flat(F.col("corners")))


# Boxes of edits: those that are given, and those round four clicks.
_CLICKED = "SELECT image_id, det_id, i, a * cos(radians(angle)) - b * sin(radians(angle)) AS x, a * sin(radians(angle)) + b * cos(radians(angle)) AS y FROM (SELECT *, CASE WHEN i IN (1, 4) THEN u0 ELSE u1 END AS a, CASE WHEN i < 3 THEN v0 ELSE v1 END AS b FROM best, range(1, 5) r(i) WHERE u1 - u0 > 1e-9 AND v1 - v0 > 1e-9)"
_GIVEN = POINTS[POINTS.index("SELECT") : POINTS.rindex(")")].replace("det_id", "n AS det_id").replace("FROM detections", "FROM (SELECT n, image_id, x AS cx, y AS cy, w, h, deg FROM ef WHERE act IN ('add', 'accept') AND boxed AND h > 0)")
BOXED = f"""{ALL_OBJECTS.replace('WITH RECURSIVE ', with_tables('box_edits').replace('WITH ', 'WITH RECURSIVE ', 1) + ', ', 1)}{HAND_BOXES},{smallest('qp')},
 bp AS ({_CLICKED} UNION ALL {_GIVEN}), {ordered('bp', 'bc')}, bl AS (SELECT image_id, det_id AS n, list(x ORDER BY k) AS px, list(y ORDER BY k) AS py FROM bc GROUP BY 1, 2){REPLAY_BOXES}"""


@query(f"{BOXED} SELECT image_id, object_index, class_id, source, confidence, {EDITED_CORNERS} FROM edited WHERE object_index IS NOT NULL")
def q73_replay_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log with boxes of masks, four clicked corners and open prompts, on all objects of the edited images."""
    edits, rows = table(spark, sf_dir, "box_edits"), with_corners(table(spark, sf_dir, "detections"))
    start = rows.select("image_id", F.col("det_id").alias("object_index"), (F.col("det_id") % 6).alias("class_id"), F.lit("file").alias("source"), F.lit(1.0).alias("confidence"), "corners")
    has_box = F.col("action").isin("add", "accept") & F.col("boxed")
    edits = edits.withColumn("corners", F.when(has_box, g.rect_to_corners(F.col("x"), F.col("y"), F.col("w"), F.col("h"), F.col("deg"))))
    replayed = review.replay_edits(start.join(edits.select("image_id").distinct(), "image_id", "left_semi"), edits, classes=table(spark, sf_dir, "classes"))
    return replayed.select("image_id", "object_index", "class_id", "source", "confidence", *flat(F.col("corners")))


# ---- whole jobs -----------------------------------------------------------------------

LINES = (
    CORNERS_OF
    + f""", z AS (SELECT c.image_id, c.det_id, cl.class_id, k, greatest(0, least(1, x / width)) AS x, greatest(0, least(1, y / height)) AS y FROM crn c JOIN detections d ON c.image_id = d.image_id AND c.det_id = d.det_id
  JOIN classes cl ON lower(trim(d.label)) = cl.label JOIN images i ON c.image_id = i.image_id WHERE d.score >= CASE WHEN source LIKE 'yolo%' THEN CAST(0.25 AS DOUBLE) ELSE CAST(0.45 AS DOUBLE) END),
 fl AS (SELECT image_id, det_id, class_id, {sql_corners(digits=9)} FROM z GROUP BY 1, 2, 3)"""
)


@query(LINES + " SELECT image_id, row_number() OVER (PARTITION BY image_id ORDER BY det_id) - 1 AS object_index, class_id, " + ", ".join(f"{k}{i}" for i in range(1, 5) for k in "xy") + " FROM fl")
def job_label_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = label_boxes(table(spark, sf_dir, "detections"), table(spark, sf_dir, "images"), table(spark, sf_dir, "classes"))
    return rows.select("image_id", "object_index", "class_id", *flat(F.col("corners"), 9))


ASKED = [("yolo26_seg", x) for x in ("boat", "person")] + [("sam3", x) for x in ("boat", "person")] + [("yolo11", x) for x in ("sam", "buoy", "lolo", "catamaran")]
SMALL_IMAGES = "SELECT DISTINCT image_id, 20 + image_id % 3 * 4 AS width, 12 + image_id % 2 * 6 AS height FROM mask_dets"
SHOWN = "CASE WHEN det_id % 18 = 0 THEN ' Kite' WHEN det_id % 14 = 0 THEN 'sam' WHEN class_id = 4 THEN 'Boat ' ELSE 'person' END"
_FIT = "list_transform(range(0, height * width), lambda t: {b}[1 + ((t // width) * {n} // height) * {n} + (t % width) * {n} // width])"
LABELED = f"""{with_tables('mask_dets', 'detections', 'classes').replace('WITH ', 'WITH RECURSIVE ', 1)}, images AS ({SMALL_IMAGES}),
 m AS (SELECT d.image_id, det_id, source, lower(trim({SHOWN})) AS label, class_id, score, width, height, {SET} AS b FROM mask_dets d JOIN images i ON d.image_id = i.image_id),
 a AS (SELECT *, {_FIT.format(b='b', n=8)} AS f FROM m WHERE source = 'yolo26_seg' AND score >= 0.25 AND label IN ('boat', 'person')),
 a2 AS (SELECT * FROM a WHERE list_sum(f) >= 20),
 b16 AS (SELECT * REPLACE (list_transform(range(0, 256), lambda t: b[1 + (t // 32) * 8 + (t % 16) // 2]) AS b) FROM m WHERE source = 'sam3' AND score >= 0.45 AND label IN ('boat', 'person')),
 b2 AS (SELECT *, {_FIT.format(b='b', n=16)} AS f FROM b16 WHERE list_sum(b) >= 20),
 j AS (SELECT a.image_id, a.det_id AS first_id, b.det_id AS second_id, list_sum(list_transform(list_zip(a.f, b.f), lambda z: z[1] * z[2])) AS i, list_sum(list_transform(list_zip(a.f, b.f), lambda z: greatest(z[1], z[2]))) AS u FROM a2 a JOIN b2 b ON a.image_id = b.image_id AND a.label = b.label),
 k AS (SELECT * FROM j WHERE u > 0 AND CAST(i AS DOUBLE) / u >= 0.15),
 ax AS (SELECT image_id, det_id, 'lolo' AS label, score, 'seg' AS kind, CAST(0 AS DOUBLE) AS cx, CAST(0 AS DOUBLE) AS cy, CAST(0 AS DOUBLE) AS w, CAST(0 AS DOUBLE) AS h, CAST(0 AS DOUBLE) AS deg FROM m WHERE image_id % 4 = 0 AND det_id % 4 = 1
  UNION ALL SELECT d.image_id, det_id, lower(trim(label)), score, CASE WHEN det_id % 3 = 0 THEN 'obb' ELSE 'box' END, cx / 32, cy / 32, w / 16, h / 16, CASE WHEN det_id % 3 = 0 THEN deg ELSE 0 END FROM detections d JOIN images i ON d.image_id = i.image_id),
 ak AS (SELECT * FROM (SELECT *, CASE kind WHEN 'seg' THEN 0 WHEN 'obb' THEN 1 ELSE 2 END AS r, min(CASE kind WHEN 'seg' THEN 0 WHEN 'obb' THEN 1 ELSE 2 END) OVER (PARTITION BY image_id) AS best FROM ax) WHERE r = best AND score >= 0.25 AND label IN ('sam', 'buoy', 'lolo', 'catamaran')),
 xs AS (SELECT image_id, det_id AS key, 0 AS part, det_id, label, height AS h, width AS w, f FROM a2
  UNION ALL SELECT k.image_id, first_id, 0, first_id, b.label, b.height, b.width, b.f FROM k JOIN b2 b ON k.second_id = b.det_id
  UNION ALL SELECT image_id, det_id, 1, det_id, label, height, width, f FROM b2 WHERE det_id NOT IN (SELECT second_id FROM k)
  UNION ALL SELECT m.image_id, m.det_id + 1000000000, 2, m.det_id, ak.label, height, width, {_FIT.format(b='b', n=8)} FROM m JOIN ak ON m.det_id = ak.det_id AND kind = 'seg'),
 px AS (SELECT DISTINCT key, pos - 1 AS pos, h, w FROM (SELECT key, h, w, unnest(f) AS v, generate_subscripts(f, 1) AS pos FROM xs) WHERE v > 0){OUTLINES.format(min_area=20)},
 bx AS (SELECT DISTINCT image_id, part, det_id, label, cx, cy, obb.w, obb.h, angle AS deg FROM xs JOIN obb ON xs.key = obb.key UNION ALL SELECT image_id, 2, det_id, label, cx, cy, w, h, deg FROM ak WHERE kind <> 'seg'),
 nb AS (SELECT image_id, row_number() OVER (PARTITION BY image_id ORDER BY part, det_id) - 1 AS det_id, label, cx, cy, w, h, deg FROM bx),
 pts AS (SELECT image_id, det_id, i, cx + a * (w / 2) * cos(radians(deg)) - b * (h / 2) * sin(radians(deg)) AS x, cy + a * (w / 2) * sin(radians(deg)) + b * (h / 2) * cos(radians(deg)) AS y FROM nb, (VALUES (1, -1, -1), (2, 1, -1), (3, 1, 1), (4, -1, 1)) v(i, a, b)), {ordered('pts', 'crn')},
 sh AS (SELECT c.image_id, c.det_id, n.label, k, greatest(0, least(1, x / width)) AS x, greatest(0, least(1, y / height)) AS y FROM crn c JOIN nb n ON c.image_id = n.image_id AND c.det_id = n.det_id JOIN images i ON c.image_id = i.image_id)
 SELECT sh.image_id, sh.det_id AS object_index, class_id, {sql_corners(digits=6)} FROM sh JOIN classes c ON sh.label = c.label GROUP BY sh.image_id, sh.det_id, class_id"""


@query(LABELED)
def job_auto_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All three models on images of six sizes: 8 x 8 masks of the first, 16 x 16 masks of the second, and an auxiliary model whose kind of output differs by image."""
    found = packed_masks(spark, sf_dir).withColumn("label", F.expr(SHOWN)).drop("class_id")
    images = found.select("image_id").distinct().select("image_id", (20 + F.col("image_id") % 3 * 4).alias("width"), (12 + F.col("image_id") % 2 * 6).alias("height"))
    second = found.filter("source = 'sam3'").withColumn("mask", m.resize_mask(F.col("mask"), F.lit(16), F.lit(16)))
    boxes = table(spark, sf_dir, "detections").join(images.select("image_id"), "image_id", "left_semi")
    cx, cy, w, h = (F.col(c) / n for c, n in (("cx", 32), ("cy", 32), ("w", 16), ("h", 16)))
    sides = {"x1": cx - w / 2, "y1": cy - h / 2, "x2": cx + w / 2, "y2": cy + h / 2}
    boxes = boxes.select("image_id", "det_id", "label", "score", F.when(F.col("det_id") % 3 == 0, "obb").otherwise("box").alias("kind"), g.rect_to_corners(cx, cy, w, h, F.col("deg")).alias("corners"), *[c.alias(n) for n, c in sides.items()])
    masks = found.filter("image_id % 4 = 0 and det_id % 4 = 1").select("image_id", "det_id", F.lit("lolo").alias("label"), "score", F.lit("seg").alias("kind"), "mask")
    aux = d.combine_branches(masks, boxes).withColumn("source", F.lit("yolo11"))
    asked = spark.createDataFrame(ASKED, "source string, label string")
    rows = auto_label(found.filter("source = 'yolo26_seg'"), second, aux, images, table(spark, sf_dir, "classes"), asked)
    return rows.select("image_id", "object_index", "class_id", *flat(F.col("corners"), 6))


REVIEWED = f"""{with_tables('edits', 'detections', 'images', 'candidates').replace('WITH ', 'WITH RECURSIVE ', 1)}, {POINTS}, {ordered('pts', 'crn')},
 fz AS (SELECT c.image_id, det_id, k AS i, x / width * width AS x, y / height * height AS y FROM crn c JOIN images i ON c.image_id = i.image_id WHERE c.image_id % 6 = 0 AND det_id % 2 = 0), {ordered('fz', 'fc')},
 top AS (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY area DESC, mask_idx) AS place FROM candidates WHERE image_id % 3 <> 0 AND image_id IN (SELECT image_id FROM images)), sh AS (SELECT *, {SHAPE} FROM top WHERE place <= 120 AND area >= 1500),
 pro AS (SELECT image_id, mask_idx, area + 800 * aspect + 1200 * rectangularity AS confidence FROM sh WHERE aspect >= 2 AND rectangularity BETWEEN 0.45 AND 1.05 QUALIFY row_number() OVER (PARTITION BY image_id ORDER BY area + 800 * aspect + 1200 * rectangularity DESC, place) = 1),
 start AS (SELECT image_id, det_id AS place, det_id % 6 AS class_id, 'file' AS source, CAST(1 AS DOUBLE) AS confidence, list(x ORDER BY k) AS px, list(y ORDER BY k) AS py FROM fc GROUP BY 1, 2
  UNION ALL SELECT p.image_id, 0, 0, 'sam2_amg', confidence, list(x ORDER BY k), list(y ORDER BY k) FROM pro p JOIN crn c ON p.image_id = c.image_id AND p.mask_idx = c.det_id GROUP BY p.image_id, p.mask_idx, confidence){REPLAY}
 SELECT e.image_id, object_index AS line_no, class_id, {", ".join(f"{half_even(f'p{k}[{i}] / ' + ('width' if k == 'x' else 'height'))} AS {k}{i}" for i in range(1, 5) for k in ("x", "y"))} FROM edited e JOIN images i ON e.image_id = i.image_id"""


@query(REVIEWED)
def job_review_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label files of every third image (those of odd ones are empty), proposals for the others, and the edit log; a null line_no is an image saved empty."""
    images, edits = table(spark, sf_dir, "images"), table(spark, sf_dir, "edits")
    # Images that nobody edits have no rows, so they leave before anything is made of theirs.
    edited = edits.select("image_id").distinct()
    rows = with_corners(table(spark, sf_dir, "detections").join(edited, "image_id", "left_semi"))
    labels = d.attach_image_size(rows.filter("image_id % 6 = 0 and det_id % 2 = 0"), images)
    labels = labels.select("image_id", F.col("det_id").alias("line_no"), (F.col("det_id") % 6).alias("class_id"), g.normalize_corners(F.col("corners"), F.col("width"), F.col("height"), clip=False).alias("corners"))
    boxed = rows.select("image_id", F.col("det_id").alias("mask_idx"), "corners")
    candidates = shaped(spark, sf_dir).join(edited, "image_id", "left_semi").withColumn("obb_area", F.col("area")).join(boxed, ["image_id", "mask_idx"])
    start = review_labels.starting_objects(images, images.filter("image_id % 3 = 0"), labels, candidates)
    lines = review_labels.reviewed_lines(start, edits, images, empty=True, classes=table(spark, sf_dir, "classes"))
    number = F.split("line", " ")
    return lines.select("image_id", F.col("line_no").cast("int").alias("line_no"), F.get(number, F.lit(0)).cast("long").alias("class_id"), *[F.get(number, F.lit(2 * i + j + 1)).cast("double").alias(f"{k}{i + 1}") for i in range(4) for j, k in enumerate("xy")])


# The corners of all boxes of the set, as shares of their image; those of the training split once more for each copy, moved.
_OF_SET = "FROM crn c JOIN im ON c.image_id = im.id JOIN tr ON c.image_id = tr.image_id AND c.det_id = tr.det_id"
_SHARE = "greatest(0, least(1, x / width)) {0} AS x, greatest(0, least(1, y / height)) {0} AS y"
TRAINING = f"""{with_tables('truth', 'images')}, tr AS (SELECT image_id, gt_id AS det_id, class_id, cx, cy, w, h, deg FROM truth WHERE class_id IN (4, 1, 0)),
 {POINTS.replace('FROM detections', 'FROM tr')}, {ordered('pts', 'crn')},
 im AS (SELECT id, image_id, width, height, CASE WHEN place < 7000 THEN 'train' WHEN place < 9000 THEN 'val' ELSE 'test' END AS split FROM (
  SELECT image_id AS id, concat(domain, '_', image_id) AS image_id, width, height, CAST('0x' || substr(md5(concat(domain, '_', image_id)), 1, 6) AS BIGINT) % 10000 AS place FROM images)),
 {MOVED[MOVED.index('dr AS'):].replace('FROM sh)', f"FROM (SELECT im.image_id, c.det_id * 10 + copy AS det_id, copy, k AS i, {_SHARE.format('- 0.5')} {_OF_SET}, range(1, 3) r(copy) WHERE split = 'train'))", 1)},
 al AS (SELECT image_id, det_id // 10 AS det_id, det_id % 10 AS copy, {sql_corners(digits=9)} FROM od GROUP BY image_id, od.det_id HAVING {sql_area()} > 1e-9
  UNION ALL SELECT image_id, det_id, 0, {sql_corners(digits=9)} FROM (SELECT im.image_id, c.det_id, k, {_SHARE.format('')} {_OF_SET}) s GROUP BY image_id, s.det_id)
 SELECT al.image_id, split, al.det_id, CASE class_id WHEN 4 THEN 0 WHEN 1 THEN 1 ELSE 2 END AS class_id, copy, {', '.join(f'{k}{i}' for i in range(1, 5) for k in 'xy')} FROM al JOIN im ON al.image_id = im.image_id JOIN tr ON im.id = tr.image_id AND al.det_id = tr.det_id"""


@query(TRAINING)
def job_training_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two domains mixed, classes cut down to three, splits drawn, and two augmented copies of the training labels."""
    images, labels = table(spark, sf_dir, "images"), table(spark, sf_dir, "truth")
    shares = g.normalize_corners(F.col("corners"), F.col("width"), F.col("height")).alias("corners")
    labels = with_corners(d.attach_image_size(labels, images)).select("image_id", F.col("gt_id").alias("det_id"), "class_id", shares)
    of = lambda name: images.filter(F.col("domain") == name).select("image_id")
    domains = {name: (of(name), labels.join(of(name), "image_id", "left_semi")) for name in ("real", "sim")}
    mapping = datasets.subset_mapping(table(spark, sf_dir, "classes"), ["boat", "buoy", "sam"])
    key = lambda c: F.conv(F.substring(F.md5(c.cast("binary")), 1, 6), 16, 10).cast("long")
    made = assemble_dataset.build_training_set(domains, mapping, {"train": 0.7, "val": 0.2, "test": 0.1}, key, copies=2, draw=md5_draw)
    return made.labels.select("image_id", "split", "det_id", F.col("class_id").cast("int").alias("class_id"), F.col("copy").cast("long").alias("copy"), *flat(F.col("corners"), 9))
