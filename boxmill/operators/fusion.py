"""Fusion of the masks of two models, image by image and class by class."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.masks import MASK, mask_area, mask_iou, shared_at_most, tile_counts, union_all

FUSE_IOU = 0.15


def with_tiles(rows: DataFrame) -> DataFrame:
    """rows with `tiles`, a short header of their mask that tells most pairs apart before the masks are looked at."""
    return rows.withColumn("tiles", tile_counts(F.col("mask")))


def _possible(first: DataFrame, second: DataFrame, iou: float) -> DataFrame:
    """All pairs of one image and class, with by_area and by_tiles: whether these leave an overlap of iou possible.

    Areas are counted once a mask. Without the header (see with_tiles()) on both sides
    by_tiles is by_area.
    """
    tiled = "tiles" in first.columns and "tiles" in second.columns
    header = lambda name: [F.col("tiles").alias(name)] if tiled else []
    a = first.select("image_id", "class_id", F.col("det_id").alias("first_id"), F.col("mask").alias("mask"), mask_area(F.col("mask")).alias("n_a"), *header("tiles_a"))
    b = second.select("image_id", "class_id", F.col("det_id").alias("second_id"), F.col("score").alias("other_score"), F.col("mask").alias("other"), mask_area(F.col("mask")).alias("n_b"), *header("tiles_b"))
    asked = F.lit(iou * (1 - 1e-9))
    by_area = F.least("n_a", "n_b") >= F.greatest("n_a", "n_b") * asked
    by_tiles = by_area
    if tiled:
        # Overlap is at most bound / (n_a + n_b - bound).
        bound = F.coalesce(shared_at_most(F.col("tiles_a"), F.col("tiles_b")), F.least("n_a", "n_b"))
        by_tiles = F.when(by_area, bound * (1 + asked) >= (F.col("n_a") + F.col("n_b")) * asked).otherwise(False)
    return a.join(b, ["image_id", "class_id"]).withColumns({"by_area": by_area, "by_tiles": by_tiles}).drop("tiles_a", "tiles_b")


def _pairs(first: DataFrame, second: DataFrame, iou: float) -> DataFrame:
    """image_id, first_id, second_id, other_score, other (mask of second), iou of pairs that overlap enough.

    A pair whose areas or tiles alone rule the overlap out is not compared.
    """
    pairs = _possible(first, second, iou).withColumn("iou", F.when(F.col("by_tiles"), mask_iou(F.col("mask"), F.col("other"))))
    return pairs.filter(F.col("iou") >= iou)


def compared_pairs(first: DataFrame, second: DataFrame, iou: float = FUSE_IOU) -> DataFrame:
    """One row: n_pairs of one image and class, n_by_area and n_by_tiles that areas and tiles leave, n_matched."""
    found = _possible(first, second, iou).withColumn("match", F.col("by_tiles") & (mask_iou(F.col("mask"), F.col("other")) >= iou))
    return found.agg(F.count("*").alias("n_pairs"), *[F.count_if(c).alias(n) for c, n in (("by_area", "n_by_area"), ("by_tiles", "n_by_tiles"), ("match", "n_matched"))])


def match_masks(first: DataFrame, second: DataFrame, iou: float = FUSE_IOU) -> DataFrame:
    """image_id, first_id, second_id, iou of pairs of one image and class that overlap enough."""
    return _pairs(first, second, iou).select("image_id", "first_id", "second_id", "iou")


def unmatched(second: DataFrame, matches: DataFrame) -> DataFrame:
    """Rows of second that are in no pair."""
    return second.join(matches.select("image_id", F.col("second_id").alias("det_id")), ["image_id", "det_id"], "left_anti")


def fuse_masks(first: DataFrame, second: DataFrame, iou: float = FUSE_IOU) -> DataFrame:
    """image_id, det_id, class_id, score, mask, part: first with all it matches, then the rest of second.

    Every row of first keeps its id; its mask takes in every matching mask of second,
    compared with the original one, and its score is the greatest of them. A row of
    second may join several. part is 0 for rows of first, 1 for rows of second that
    joined none.
    """
    own = lambda rows, part: rows.select("image_id", F.lit(part).alias("part"), "det_id", "class_id", "score", "mask", F.lit(False).alias("used"))
    none = F.lit(None)
    # Each pair gives its mask to the row of first and takes the row of second out; pairs are found once.
    gives = F.struct(F.lit(0).alias("part"), F.col("first_id").alias("det_id"), F.col("other_score").alias("score"), F.col("other").alias("mask"), F.lit(False).alias("used"))
    takes = F.struct(F.lit(1).alias("part"), F.col("second_id").alias("det_id"), none.cast("double").alias("score"), none.cast(MASK).alias("mask"), F.lit(True).alias("used"))
    joined = _pairs(first, second, iou).select("image_id", F.explode(F.array(gives, takes)).alias("p")).select("image_id", "p.part", "p.det_id", none.cast("long").alias("class_id"), "p.score", "p.mask", "p.used")
    every = own(first, 0).unionByName(own(second, 1)).unionByName(joined)
    fused = every.groupBy("image_id", "part", "det_id").agg(F.max("class_id").alias("class_id"), F.max("score").alias("score"), union_all(F.collect_list("mask")).alias("mask"), F.max("used").alias("used"))
    return fused.filter("not used").select("image_id", "det_id", "class_id", "score", "mask", "part")


def assign_object_index(rows: DataFrame, order: list[str] | None = None) -> DataFrame:
    """rows with a 0-based object_index per image in order of branch, prompt and model."""
    order = order or ["branch", "prompt_no", "det_id"]
    return rows.withColumn("object_index", F.row_number().over(Window.partitionBy("image_id").orderBy(*order)).cast("long") - 1)
