"""From a folder of images to a folder of label files."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.masks import MASK
from ..operators import detections as d
from ..scratch import materialise
from ..sources import files
from .auto_label import auto_label

Model = Callable[[], Callable[[pd.DataFrame], pd.DataFrame]]
#: What the models give: masks, and for the auxiliary one boxes of a kind ('seg', 'obb' or 'box').
MASKS = f"image_id string, det_id long, source string, label string, score double, mask {MASK}"
BOXES = f"{MASKS}, kind string, corners array<struct<x:double,y:double>>, x1 double, y1 double, x2 double, y2 double"


def images_of(spark: SparkSession, root: str) -> DataFrame:
    """image_id (the path), path, stem, split, width, height of the readable images under root, one for each label file.

    Of images with one split and stem the last in order of path counts, as its labels
    would be the ones that stay.
    """
    sized = files.image_sizes(spark, root)
    parts = files.path_parts(F.col("path"))
    last = Window.partitionBy("split", "stem").orderBy(F.desc("path"))
    rows = sized.select(F.col("path").alias("image_id"), "path", "stem", parts["split"].alias("split"), "width", "height")
    return rows.withColumn("rank", F.row_number().over(last)).filter("rank = 1").drop("rank")


def label_folder(
    spark: SparkSession,
    root: str,
    out: str,
    classes: DataFrame,
    segment: Model | None = None,
    prompted: Model | None = None,
    extra: Model | None = None,
    prompts: DataFrame | None = None,
    whitelist: DataFrame | None = None,
    per_file: bool = True,
    **settings,
) -> DataFrame:
    """Label every image under root and write its label text below out; the labels as auto_label() gives them.

    segment, prompted and extra make the models (see run_detector()): a function from a
    batch of image rows (image_id, path, stem, split, width, height, and for prompted
    ones prompts) to rows of MASKS, or for extra of BOXES. A model that is None finds
    nothing. prompts: a table with `prompt`; those that classes lack are not asked.
    Images without objects get an empty text; unreadable ones none. settings: those of
    auto_label(). The models run once: their rows are written before they are used.
    """
    images = materialise(images_of(spark, root))
    none = lambda schema: spark.createDataFrame([], schema)
    found = lambda make, schema: materialise(d.run_detector(images, make, schema)) if make else none(schema)
    second = none(MASKS)
    if prompted is not None and prompts is not None:
        known = prompts.join(classes.select(F.col("label").alias("prompt")), "prompt", "left_semi")
        second = materialise(d.run_prompted_detector(images, known, prompted, MASKS))
    labels = materialise(auto_label(found(segment, MASKS), second, found(extra, BOXES), images.select("image_id", "width", "height"), classes, whitelist, **settings))
    lines = labels.join(images.select("image_id", "split", "stem"), "image_id").select("split", "stem", F.col("object_index").alias("line_no"), "line")
    files.write_labels(lines, images.select("split", "stem"), out, per_file)
    return labels
