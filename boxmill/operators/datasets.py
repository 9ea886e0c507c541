"""Checks, mixes, splits and label augmentation of detection datasets."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import order_corners, order_four, point, polygon_area
from .detections import keep, small


def dataset_orphans(images: DataFrame, labels: DataFrame) -> DataFrame:
    """split, stem, reason of images without a label file and label files without an image."""
    keys = ["split", "stem"]
    a, b = images.select(keys).distinct(), labels.select(keys).distinct()
    missing = a.join(b, keys, "left_anti").withColumn("reason", F.lit("image without label"))
    return missing.unionByName(b.join(a, keys, "left_anti").withColumn("reason", F.lit("label without image")))


def split_leaks(images: DataFrame) -> DataFrame:
    """stem, splits of stems that are in more than one split."""
    return images.groupBy("stem").agg(F.array_sort(F.collect_set("split")).alias("splits")).filter(F.size("splits") > 1)


def stem_collisions(images: DataFrame) -> DataFrame:
    """split, stem, n_files, winner of stems with several image files; the last path wins."""
    found = images.groupBy("split", "stem").agg(F.count("*").alias("n_files"), F.max("path").alias("winner"))
    return found.filter("n_files > 1")


def remap_classes(labels: DataFrame, mapping: DataFrame) -> DataFrame:
    """labels with ids of another scheme (mapping: class_id, new_id); classes that it lacks go."""
    ids = mapping.select("class_id", "new_id")
    return labels.join(small(ids), "class_id").drop("class_id").withColumnRenamed("new_id", "class_id")


def remapped_images(images: DataFrame, labels: DataFrame, mapping: DataFrame) -> DataFrame:
    """Every image with its number of remapped labels, 0 for those that became empty."""
    counts = remap_classes(labels, mapping).groupBy("image_id").agg(F.count("*").alias("n"))
    return images.select("image_id").join(counts, "image_id", "left").select("image_id", F.coalesce("n", F.lit(0)).alias("n"))


def subset_mapping(classes: DataFrame, keep: list[str]) -> DataFrame:
    """class_id, new_id of the kept names, numbered from 0 in the order of keep."""
    at = F.array_position(F.array(*map(F.lit, keep)), F.col("label"))
    return classes.filter(F.col("label").isin(keep)).select("class_id", (at - 1).cast("long").alias("new_id"))


def invalid_classes(labels: DataFrame, classes: DataFrame) -> DataFrame:
    """labels whose class is not in the scheme."""
    return labels.join(small(classes.select("class_id")), "class_id", "left_anti")


def scheme_conflicts(a: DataFrame, b: DataFrame) -> DataFrame:
    """class_id, left_label, right_label of ids whose names differ or that one side lacks."""
    left, right = a.select("class_id", F.col("label").alias("left_label")), b.select("class_id", F.col("label").alias("right_label"))
    return left.join(right, "class_id", "full_outer").filter(~F.col("left_label").eqNullSafe(F.col("right_label"))).select("class_id", "left_label", "right_label")


def scheme_classes_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """label, side: names in 'both' schemes, in the 'left' or the 'right' only."""
    x, y = a.select("label"), b.select("label")
    parts = [(x.intersect(y), "both"), (x.exceptAll(y), "left"), (y.exceptAll(x), "right")]
    out = None
    for part, side in parts:
        named = part.withColumn("side", F.lit(side))
        out = named if out is None else out.unionByName(named)
    return out


def count_objects(labels: DataFrame, images: DataFrame) -> DataFrame:
    """split, domain, class_id, level, n_objects, n_images over all their groupings.

    level is the grouping's number: null columns with a bit set in it stand for all.
    Images without objects are counted under a null class with their bit clear.
    """
    joined = images.select("image_id", "split", "domain").join(labels.select("image_id", "class_id", F.lit(1).alias("one")), "image_id", "left")
    # One row per image and cell first. Of an image's few rows the first with given values counts
    # the image there, so no grouping needs a set of images.
    keys = ["split", "domain", "class_id"]
    per = joined.groupBy("image_id", *keys).agg(F.count("one").alias("n"))
    before = Window.partitionBy("image_id").orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("seen", F.collect_list(F.struct(*keys)).over(before))

    def first_of(level: int) -> Column:
        own = [k for bit, k in zip((4, 2, 1), keys, strict=True) if not level & bit]
        if len(own) == len(keys):
            return F.lit(1)
        if not own:
            return (F.size("seen") == 0).cast("int")
        return (~F.exists("seen", lambda e: reduce(and_, [e[k].eqNullSafe(F.col(k)) for k in own]))).cast("int")

    # Cells are few; all groupings are sums of them.
    cells = per.groupBy(*keys).agg(F.sum("n").alias("n"), *[F.sum(first_of(i)).alias(f"first{i}") for i in range(8)])
    cube = cells.cube(*keys).agg(F.grouping_id().alias("level"), F.sum("n").alias("n_objects"), *[F.sum(f"first{i}").alias(f"first{i}") for i in range(8)])
    n_images = F.array(*[f"first{i}" for i in range(8)])[F.col("level").cast("int")].alias("n_images")
    return cube.select(*keys, "level", "n_objects", n_images)


def mix_datasets(datasets: dict[str, DataFrame]) -> DataFrame:
    """All rows with their domain; image ids get the domain as prefix so that they stay unique."""
    out = None
    for domain, rows in datasets.items():
        tagged = rows.withColumns({"domain": F.lit(domain), "image_id": F.concat_ws("_", F.lit(domain), F.col("image_id").cast("string"))})
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    return out


def assign_split(images: DataFrame, fractions: dict[str, float], key: Column, total: int = 10_000) -> DataFrame:
    """images with a split by a hash number of their key; the same at every run.

    key: a Column of whole numbers (a hash of the stem, or an id); fractions sum to 1.
    """
    place, low, split = F.pmod(key, F.lit(total)), 0.0, None
    for name, share in fractions.items():
        low += share
        case = place < round(low * total)
        split = F.when(case, name) if split is None else split.when(case, name)
    return images.withColumn("split", split.otherwise(list(fractions)[-1]))


def stem_key(stem: Column, seed: int = 0) -> Column:
    """A hash number of a stem for assign_split."""
    return F.xxhash64(stem, F.lit(seed))


def order_moved(rows: DataFrame, move: Callable[[Column], tuple[Column, Column]]) -> DataFrame:
    """rows with their corners moved (a point to its new x and y) and ordered again; each number is computed once a row."""
    four = [(f"_x{i}", f"_y{i}") for i in range(4)]
    rows = rows.withColumns({name: value for i, names in enumerate(four) for name, value in zip(names, move(F.get("corners", F.lit(i))), strict=True)})
    ordered = order_four([(F.col(x), F.col(y)) for x, y in four], order_corners(F.transform("corners", lambda p: point(*move(p)))), F.size("corners") == 4)
    return rows.withColumn("corners", ordered).drop(*[name for names in four for name in names])


def hashed_draw(seed: int) -> Callable[[str], Column]:
    """Numbers in [0, 1) by a hash of image_id, copy, seed and the draw's name."""
    return lambda name: F.pmod(F.xxhash64("image_id", "copy", F.lit(f"{seed}-{name}")), F.lit(1 << 24)) / float(1 << 24)


def augment_labels(
    labels: DataFrame,
    copies: int = 1,
    seed: int = 0,
    degrees: float = 8.0,
    translate: float = 0.1,
    scale: float = 0.4,
    shear: float = 2.0,
    flip: float = 0.5,
    min_area: float = 1e-9,
    draw: Callable[[str], Column] | None = None,
) -> DataFrame:
    """labels (image_id, corners in 0..1, and others) times copies, each image copy under one random affine map.

    Rotation and shear in degrees, shift and scale as shares, left-right flip with a
    probability. Draws are hashes of image, copy and seed (or those of `draw`: a name to
    a number in [0, 1) that depends on image_id and copy), so retries agree. Corners are
    clipped to 0..1 and ordered again. Boxes of which no more than min_area (a share of
    the image) is left inside are dropped, as those pushed out of the image; an image
    copy may be left without boxes.
    """
    draw = draw or hashed_draw(seed)
    rows = labels.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
    between = lambda name, reach: (draw(name) * 2 - 1) * reach
    rows = rows.withColumns(
        {
            "_turn": F.radians(between("turn", degrees)),
            "_sx": F.tan(F.radians(between("sx", shear))),
            "_sy": F.tan(F.radians(between("sy", shear))),
            "_zoom": 1 + between("zoom", scale),
            "_dx": between("dx", translate),
            "_dy": between("dy", translate),
            "_flip": draw("flip") < flip,
        }
    )
    # Steps of their own, each computed once a row: the map, the four points, their order, their area.
    rows = rows.withColumns({"_c": F.cos("_turn") * F.col("_zoom"), "_s": F.sin("_turn") * F.col("_zoom")})
    held = lambda v: F.greatest(F.lit(0.0), F.least(F.lit(1.0), v))

    def moved(p: Column) -> tuple[Column, Column]:
        x, y = p["x"] - 0.5, p["y"] - 0.5
        x, y = x + F.col("_sx") * y, y + F.col("_sy") * x
        x, y = F.col("_c") * x - F.col("_s") * y + 0.5 + F.col("_dx"), F.col("_s") * x + F.col("_c") * y + 0.5 + F.col("_dy")
        return held(F.when(F.col("_flip"), 1 - x).otherwise(x)), held(y)

    out = order_moved(rows, moved).withColumn("_area", polygon_area(F.col("corners")))
    return keep(out, F.col("_area") > min_area).drop("_turn", "_sx", "_sy", "_zoom", "_dx", "_dy", "_flip", "_c", "_s", "_area")
