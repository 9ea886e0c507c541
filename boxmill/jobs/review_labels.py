"""Review of an image set: what each image starts with, and what an edit log leaves."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as g
from ..functions.text import format_label_line
from ..operators import detections as d
from ..operators import review
from ..sources import files


def proposed_objects(candidates: DataFrame, **proposal) -> DataFrame:
    """The best proposal of every image as an object. candidates: as in best_proposal, with the corners of their box."""
    return review.best_proposal(candidates, **proposal).select("image_id", F.lit(0).cast("long").alias("object_index"), "class_id", "source", "confidence", "corners")


def starting_objects(images: DataFrame, label_files: DataFrame, labels: DataFrame, candidates: DataFrame, **proposal) -> DataFrame:
    """Objects of every image: its labels in pixels if it has a label file, else its best proposal.

    labels: image_id, line_no, class_id, corners (normalized).
    """
    sized = d.attach_image_size(labels, images)
    from_files = sized.select(
        "image_id",
        F.col("line_no").alias("object_index"),
        "class_id",
        F.lit("file").alias("source"),
        F.lit(1.0).alias("confidence"),
        g.denormalize_corners(F.col("corners"), F.col("width"), F.col("height")).alias("corners"),
    )
    return review.initial_objects(images, label_files, from_files, proposed_objects(candidates, **proposal))


def reviewed_lines(objects: DataFrame, edits: DataFrame, images: DataFrame, empty: bool = False, **replay) -> DataFrame:
    """image_id, line_no, line of every edited image as of its last save; corners are not clipped.

    empty: images that were saved without objects have one row with a null line.
    """
    saved = d.attach_image_size(review.replay_edits(objects, edits, empty=empty, **replay), images)
    shares = g.normalize_corners(F.col("corners"), F.col("width"), F.col("height"), clip=False)
    return saved.select("image_id", F.col("object_index").cast("long").alias("line_no"), format_label_line(F.col("class_id"), shares).alias("line"))


def reviewed_texts(objects: DataFrame, edits: DataFrame, images: DataFrame, **replay) -> DataFrame:
    """stem, content: the label text of every image that was saved; empty for one saved without objects."""
    lines = reviewed_lines(objects, edits, images, empty=True, **replay).withColumnRenamed("image_id", "stem")
    return files.label_texts(lines.filter("line_no is not null"), lines)
