"""Predictions against ground truth, end to end."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as g
from ..operators import detections as d
from ..operators import evaluation, suppression
from ..scratch import materialise
from ..sources import files


@dataclass
class Evaluation:
    """per_class: class_id, ap50, ap, class_name; overall: mp, mr, map50, map; predictions: those that count."""

    per_class: DataFrame
    overall: DataFrame
    predictions: DataFrame

    def report(self) -> DataFrame:
        """line_no, line of the report table."""
        return files.report_rows(self.per_class, self.overall)

    def write(self, path: str) -> None:
        """metrics (JSON), per_class (CSV), report (text) and predictions (JSON lines) as folders under path."""
        files.write_metrics_json(self.overall, f"{path}/metrics")
        files.write_per_class_csv(self.per_class.orderBy("class_id"), f"{path}/per_class")
        self.report().orderBy("line_no").select("line").coalesce(1).write.mode("overwrite").text(f"{path}/report")
        files.write_predictions_json(self.predictions, f"{path}/predictions")


def counted(predictions: DataFrame, truth: DataFrame, images: DataFrame | None, split: str, confidence: float, iou: float | None) -> tuple[DataFrame, DataFrame]:
    """The predictions and truths of a split that an evaluation counts."""
    kept = d.keep_confident(predictions, confidence)
    if images is not None:
        chosen = images.filter(F.col("split") == split).select("image_id")
        kept, truth = kept.join(chosen, "image_id", "left_semi"), truth.join(chosen, "image_id", "left_semi")
    if iou is not None:
        boxed = kept.withColumn("corners", g.rect_corners(*[F.col(c) for c in ("cx", "cy", "w", "h", "deg")]))
        kept = kept.join(suppression.nms(boxed, iou, id_col="pred_id", corners_col="corners"), ["image_id", "class_id", "pred_id"], "left_semi")
    return kept, truth


def evaluate(
    predictions: DataFrame, truth: DataFrame, classes: DataFrame, confidence: float = d.EVALUATION_CONFIDENCE, iou: float | None = None, images: DataFrame | None = None, split: str = "test"
) -> Evaluation:
    """Metrics of predictions (image_id, pred_id, class_id, score, cx, cy, w, h, deg).

    iou: suppress overlapping predictions first. images: image_id, split; only images of
    the split count. Pairing, matching and suppression all hash by image and class; only
    sums per class go further.
    """
    kept, truth = counted(predictions, truth, images, split, confidence, iou)
    counts = truth.groupBy("class_id").agg(F.count("*").alias("n_truth"))
    matches = evaluation.match_truth(kept, truth)
    points = materialise(evaluation.curve_points(evaluation.pr_curve(matches, counts)))
    per_class = d.attach_class_name(evaluation.average_points(points, classes), classes)
    return Evaluation(per_class, evaluation.overall_points(points, per_class), kept)


def evaluate_by_domain(predictions: DataFrame, truth: DataFrame, images: DataFrame, classes: DataFrame, confidence: float = d.EVALUATION_CONFIDENCE, iou: float | None = None, split: str = "test") -> DataFrame:
    """domain, class_id, ap50, ap, class_name of a split: each domain measured by itself."""
    kept, truth = counted(predictions, truth, images, split, confidence, iou)
    domains = images.select("image_id", "domain")
    counts = truth.join(domains, "image_id").groupBy("domain", "class_id").agg(F.count("*").alias("n_truth"))
    matches = evaluation.match_truth(kept, truth).join(domains, "image_id")
    per_class = evaluation.average_precision(evaluation.pr_curve(matches, counts, by=("domain",)), classes, by=("domain",))
    return d.attach_class_name(per_class, classes)
