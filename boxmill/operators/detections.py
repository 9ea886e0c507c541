"""Filters, class lookups and the plug-in surface for detectors.

Every operator takes and returns DataFrames; thresholds have the usual settings of an
auto-labeling run as defaults.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from ..functions.masks import mask_area
from ..functions.text import clean_label

#: Least scores by source prefix; evaluation takes 0.001 for all.
CONFIDENCE = {"yolo": 0.25, "sam": 0.45}
EVALUATION_CONFIDENCE = 0.001
MIN_AREA = 20


def small(table: DataFrame, limit: int = 100_000) -> DataFrame:
    """A table of classes, thresholds or the like, marked for broadcast if it has at most limit rows (counted)."""
    return F.broadcast(table) if table.limit(limit + 1).count() <= limit else table


def keep(rows: DataFrame, condition: Column) -> DataFrame:
    """rows.filter(condition), after the columns that it takes are made.

    A plain filter would move below them, where each of its terms is computed again from
    the start. A row's number cannot be moved below.
    """
    return rows.withColumn("_row", F.monotonically_increasing_id()).filter(condition & (F.col("_row") >= 0)).drop("_row")


def attach_class_id(detections: DataFrame, classes: DataFrame) -> DataFrame:
    """detections with the class_id of their cleaned label; unknown names are dropped."""
    return detections.withColumn("label", clean_label(F.col("label"))).join(small(classes.select("label", "class_id")), "label")


def attach_class_name(objects: DataFrame, classes: DataFrame) -> DataFrame:
    """objects with a class_name; ids without a name get the id as text."""
    names = classes.select("class_id", F.col("label").alias("class_name"))
    return objects.join(small(names), "class_id", "left").withColumn("class_name", F.coalesce("class_name", F.col("class_id").cast("string")))


def keep_known_classes(detections: DataFrame, whitelist: DataFrame, classes: DataFrame) -> DataFrame:
    """detections whose cleaned label is in their source's whitelist and in the class table."""
    cleaned = detections.withColumn("label", clean_label(F.col("label")))
    known = whitelist.join(classes, "label", "left_semi").select("source", "label").distinct()
    return cleaned.join(small(known), ["source", "label"], "left_semi")


def at_least(thresholds: dict[str, float] | float) -> Column:
    """Whether a row's score reaches its source's threshold; false for a source without one.

    thresholds: one number, or numbers by the beginning of the source's name.
    """
    score = F.col("score")
    if isinstance(thresholds, dict):
        cases = [F.when(F.col("source").startswith(prefix), score >= least) for prefix, least in thresholds.items()]
        return F.coalesce(*cases, F.lit(False))
    return score >= thresholds


def keep_confident(detections: DataFrame, thresholds: dict[str, float] | float = EVALUATION_CONFIDENCE) -> DataFrame:
    """detections at or over their source's threshold (see at_least)."""
    return detections.filter(at_least(thresholds))


def keep_large_masks(detections: DataFrame, min_area: int = MIN_AREA, mask_col: str = "mask") -> DataFrame:
    """detections whose mask has min_area pixels at least."""
    return detections.filter(mask_area(F.col(mask_col)) >= min_area)


def keep_large_obbs(objects: DataFrame, min_area: float = MIN_AREA, obb_col: str = "obb", area_col: str = "area") -> DataFrame:
    """objects with a box and an area of min_area at least."""
    return keep(objects, F.col(obb_col).isNotNull() & (F.col(area_col) >= min_area))


def shape_filter(objects: DataFrame, min_aspect: float = 2.0, min_rect: float = 0.45, max_rect: float = 1.05) -> DataFrame:
    """objects that are elongated and fill their rectangle; unknown shapes are dropped."""
    return objects.filter((F.col("aspect") >= min_aspect) & F.col("rectangularity").between(min_rect, max_rect))


def pick_output_kind(predictions: DataFrame, keep: Column | None = None) -> DataFrame:
    """Per image only segmentation rows if there are any, else oriented boxes, else boxes.

    kind is 'seg', 'obb' or 'box'. keep is applied afterwards: which outputs a model
    gives is decided before any row is filtered.
    """
    rank = F.when(F.col("kind") == "seg", 0).when(F.col("kind") == "obb", 1).otherwise(2)
    best = F.min(rank).over(Window.partitionBy("image_id"))
    picked = predictions.withColumns({"rank": rank, "best": best}).filter("rank = best").drop("rank", "best")
    picked = picked.withColumn("source", F.concat(F.lit("yolo11_"), F.col("kind")))
    return picked if keep is None else picked.filter(keep)


def attach_image_size(rows: DataFrame, images: DataFrame) -> DataFrame:
    """rows with the width and height of their image."""
    return rows.join(images.select("image_id", "width", "height"), "image_id")


def combine_branches(*branches: DataFrame) -> DataFrame:
    """All rows of all branches; columns that a branch lacks are null."""
    out = branches[0]
    for branch in branches[1:]:
        out = out.unionByName(branch, allowMissingColumns=True)
    return out


def run_detector(images: DataFrame, make: Callable[[], Callable[[pd.DataFrame], pd.DataFrame]], schema: StructType | str) -> DataFrame:
    """Rows of a detector for every image.

    make is called once per task and gives a function from a batch of image rows to a
    batch of detection rows. Only paths and keys travel; the function reads the pixels.
    """

    def detect(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        detector = make()
        for batch in batches:
            yield detector(batch)

    return images.mapInPandas(detect, schema)


def predict_batches(
    images: DataFrame, make: Callable[[], Callable[..., Any]], inputs: dict[str, tuple[int, ...]], output: DataType | str, column: str = "prediction", batch_size: int = 64
) -> DataFrame:
    """images with the output of a model of fixed shape, in `column`.

    make is called once per worker and gives a function from arrays, a row per image, to
    an array (or a dict of arrays for a struct) with as many rows. inputs: the array
    columns that it takes, each with the shape of one image's value; () for single
    numbers. At most batch_size images are in an array.
    """
    shapes = [list(shape) for shape in inputs.values()]
    kind = DataType.fromDDL(output) if isinstance(output, str) else output
    predict = predict_batch_udf(make, return_type=kind, batch_size=batch_size, input_tensor_shapes=shapes if any(shapes) else None)
    return images.withColumn(column, predict(*inputs))


def run_prompted_detector(images: DataFrame, prompts: DataFrame, make: Callable[[], Callable[[pd.DataFrame], pd.DataFrame]], schema: StructType | str, max_prompts: int = 1000) -> DataFrame:
    """Rows of a detector for every image and prompt; the prompts of an image are together.

    The prompts are an array of at most max_prompts texts (checked), so an image's row
    is not repeated before the detector sees it; `prompts` is its column.
    """
    texts = [r[0] for r in prompts.select("prompt").orderBy("prompt").limit(max_prompts + 1).collect()]
    if len(texts) > max_prompts:
        raise ValueError(f"more than {max_prompts} prompts")
    return run_detector(images.withColumn("prompts", F.array(*map(F.lit, texts)).cast("array<string>")), make, schema)
