"""A training set from several labeled image sets."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import datasets
from ..sources import files


@dataclass
class Dataset:
    """labels, and what is wrong: orphans, leaks, collisions, invalid classes and rejected lines."""

    images: DataFrame
    labels: DataFrame
    orphans: DataFrame
    leaks: DataFrame
    collisions: DataFrame
    invalid: DataFrame
    rejects: DataFrame


def assemble(spark: SparkSession, root: str, classes: DataFrame, mapping: DataFrame | None = None) -> Dataset:
    """Read root/images and root/labels, translate classes if asked, and check everything."""
    images, label_files, lines = files.read_dataset(spark, root)
    labels, rejects = files.parse_label_lines(lines)
    if mapping is not None:
        labels = datasets.remap_classes(labels, mapping)
    return Dataset(
        images,
        labels,
        datasets.dataset_orphans(images, label_files),
        datasets.split_leaks(images),
        datasets.stem_collisions(images),
        datasets.invalid_classes(labels, classes),
        rejects,
    )


def split_by_stem(images: DataFrame, fractions: dict[str, float], seed: int = 0) -> DataFrame:
    """Images with a split by their stem, so that copies of one stem stay together."""
    return datasets.assign_split(images, fractions, datasets.stem_key(F.col("stem"), seed))


@dataclass
class TrainingSet:
    """images: image_id, domain, split; labels: image_id, domain, split, class_id, corners, copy (0: as given)."""

    images: DataFrame
    labels: DataFrame

    def write(self, path: str) -> None:
        """Images and labels as Parquet, one folder a split."""
        self.images.write.mode("overwrite").partitionBy("split").parquet(f"{path}/images")
        self.labels.write.mode("overwrite").partitionBy("split").parquet(f"{path}/labels")


def build_training_set(
    domains: dict[str, tuple[DataFrame, DataFrame]], mapping: DataFrame, fractions: dict[str, float], key: Callable[[Column], Column] | None = None, copies: int = 0, **augment
) -> TrainingSet:
    """One training set of several domains' images (image_id, ...) and labels (image_id, class_id, corners, ...).

    Ids get the domain as prefix; classes go over by mapping (class_id, new_id); splits
    are drawn by a hash of the prefixed id (or key); labels of the split `train` get
    copies under random affine maps.
    """
    images = datasets.mix_datasets({name: rows.select("image_id") for name, (rows, _) in domains.items()})
    images = datasets.assign_split(images, fractions, (key or datasets.stem_key)(F.col("image_id")))
    labels = datasets.remap_classes(datasets.mix_datasets({name: rows for name, (_, rows) in domains.items()}), mapping)
    labels = labels.join(images.select("image_id", "split"), "image_id").withColumn("copy", F.lit(0))
    if copies:
        moved = datasets.augment_labels(labels.filter("split = 'train'").drop("copy"), copies, **augment)
        labels = labels.unionByName(moved)
    return TrainingSet(images, labels)
