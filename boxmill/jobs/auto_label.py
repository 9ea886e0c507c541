"""From detections of several models to label rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as g
from ..functions.masks import fit_mask, mask_to_obb
from ..functions.text import format_label_line
from ..operators import detections as d
from ..operators import fusion


def label_boxes(detections: DataFrame, images: DataFrame, classes: DataFrame, thresholds: dict[str, float] = d.CONFIDENCE) -> DataFrame:
    """image_id, object_index, class_id, corners (normalized), line of detections that are boxes already.

    detections: image_id, det_id, source, label, score, cx, cy, w, h, deg. Filters come
    before anything is shuffled; the join with the images and the index share the
    partitioning by image.
    """
    kept = d.attach_class_id(d.keep_confident(detections, thresholds), classes)
    # Corners are made after the join: five numbers go through it, not four points.
    sized = d.attach_image_size(kept, images)
    boxes = sized.select("image_id", "det_id", "class_id", "width", "height", g.rect_corners(*[F.col(c) for c in ("cx", "cy", "w", "h", "deg")]).alias("corners"))
    return finish(boxes, ["det_id"])


def finish(boxes: DataFrame, order: list[str]) -> DataFrame:
    """Normalized corners, place in the image and label line of boxes with their image's width and height."""
    shares = boxes.withColumn("corners", g.normalize_corners(F.col("corners"), F.col("width"), F.col("height")))
    indexed = fusion.assign_object_index(shares, order)
    return indexed.select("image_id", "object_index", "class_id", "corners", format_label_line(F.col("class_id"), F.col("corners")).alias("line"))


def outlined(rows: DataFrame, min_area: float) -> DataFrame:
    """Rows with the ordered corners of their mask's box; rows without a box of min_area are dropped."""
    boxed = rows.withColumn("o", mask_to_obb(F.col("mask"), float(min_area))).filter("o is not null")
    return boxed.withColumn("corners", g.rect_corners(*[F.col(f"o.{c}") for c in ("cx", "cy", "w", "h", "angle")])).drop("o", "mask")


def auto_label(
    first: DataFrame,
    second: DataFrame,
    aux: DataFrame,
    images: DataFrame,
    classes: DataFrame,
    whitelist: DataFrame | None = None,
    thresholds: dict[str, float] = d.CONFIDENCE,
    iou: float = fusion.FUSE_IOU,
    min_area: int = d.MIN_AREA,
) -> DataFrame:
    """image_id, object_index, class_id, corners (normalized), line: the labels of every image.

    first: masks of a segmenting model; second: masks of a prompted one (image_id,
    det_id, source, label, score, mask each; label is the prompt). aux: a model whose
    output is added as it is: image_id, det_id, source, label, score, kind ('seg' with
    mask, 'obb' with corners, 'box' with x1, y1, x2, y2). whitelist: source, label of the
    classes that each model is asked for (None: all); what it or classes lack is dropped.

    Masks of first count their area at the image's size, those of second at their own;
    all are compared and united at the image's size. Fused rows come first, then the rest
    of second, then aux. Images that images lacks have no rows.
    """
    known = lambda rows: d.attach_class_id(rows if whitelist is None else d.keep_known_classes(rows, whitelist, classes), classes)
    asked = lambda rows: known(d.keep_confident(rows, thresholds))
    sized = lambda rows: d.attach_image_size(rows, images).withColumn("mask", fit_mask(F.col("mask"), F.col("height"), F.col("width")))
    segmented = d.keep_large_masks(sized(asked(first)), min_area)
    prompted = sized(d.keep_large_masks(asked(second), min_area))
    fused = outlined(fusion.fuse_masks(fusion.with_tiles(segmented), fusion.with_tiles(prompted), iou), min_area)
    masks = fused.select("image_id", "det_id", "class_id", "part", "corners")

    # Which kind of output an image's aux rows are is settled before any of them is dropped.
    picked = known(d.pick_output_kind(aux.withColumn("model", F.col("source")), d.at_least(thresholds)).withColumn("source", F.col("model")))
    by_mask = outlined(sized(picked.filter("kind = 'seg'")), min_area)
    by_corners = picked.filter("kind = 'obb'").withColumn("corners", g.order_corners(F.col("corners")))
    by_box = picked.filter("kind = 'box'").withColumn("corners", g.box_to_corners(*[F.col(c) for c in ("x1", "y1", "x2", "y2")]))
    columns = ["image_id", "det_id", "class_id", F.lit(2).alias("part"), "corners"]
    boxes = d.combine_branches(masks, *[rows.select(columns) for rows in (by_mask, by_corners, by_box)])
    return finish(d.attach_image_size(boxes, images), ["part", "det_id"])
