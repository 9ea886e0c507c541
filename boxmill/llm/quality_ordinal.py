"""Quality grades by ordinal cumulative-link regression on hashed text features.

P(grade <= k) = sigmoid(threshold_k - w.x): one weight vector for all grades, and
thresholds that are kept in order. The expected grade and tail probabilities
P(grade >= k) follow from it. The model is fitted on a bounded sample of graded rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text_features import graded_features


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class OrdinalModel:
    """weights by bucket, ordered thresholds; grades 0..len(thresholds)."""

    weights: np.ndarray
    thresholds: np.ndarray
    bits: int

    def tails(self, texts: list[str | None]) -> np.ndarray:
        """P(grade >= k) for k = 1.. in columns."""
        score = np.array([float((self.weights[i] * v).sum()) for i, v in (graded_features(t, self.bits) for t in texts)])
        return sigmoid(score.reshape(-1, 1) - self.thresholds.reshape(1, -1))


def fit_cumulative(rows: list[tuple[np.ndarray, np.ndarray]], grades: np.ndarray, bits: int, steps: int = 200, penalty: float = 1e-4, rate: float = 0.3) -> OrdinalModel:
    """Maximum likelihood by Adam on all rows at once; thresholds as a first one and positive gaps."""
    n, top = len(rows), int(grades.max(initial=1))
    used, index = np.unique(np.concatenate([np.zeros(1, np.int64), *[np.asarray(i, np.int64) for i, _ in rows]]), return_inverse=True)
    index = index[1:]
    value = np.concatenate([np.empty(0), *[v for _, v in rows]])
    owner = np.repeat(np.arange(n), [len(i) for i, _ in rows])
    share = np.array([(grades >= k).mean() for k in range(1, top + 1)]).clip(1e-3, 1 - 1e-3)
    first = np.log((1 - share) / share)
    gaps = np.log(np.maximum(np.diff(first), 1e-2))
    params = np.concatenate([np.zeros(len(used)), first[:1], gaps])
    m = v = np.zeros_like(params)
    for t in range(1, steps + 1):
        w, theta = params[: len(used)], np.cumsum(np.concatenate([params[len(used) : len(used) + 1], np.exp(params[len(used) + 1 :])]))
        score = np.bincount(owner, w[index] * value, n)
        cuts = np.concatenate([[-np.inf], theta, [np.inf]])
        upper, lower = sigmoid(cuts[grades + 1] - score), sigmoid(cuts[grades] - score)
        by_score = 1 - upper - lower
        p = np.maximum(upper - lower, 1e-9)
        by_theta = np.zeros(top + 2)
        np.add.at(by_theta, grades + 1, -upper * (1 - upper) / p)
        np.add.at(by_theta, grades, lower * (1 - lower) / p)
        by_theta = by_theta[1:-1]
        ahead = np.cumsum(by_theta[::-1])[::-1]  # a gap moves all later thresholds
        slope = np.concatenate([np.bincount(index, by_score[owner] * value, len(used)) / n + penalty * w, ahead[:1] / n, ahead[1:] * np.exp(params[len(used) + 1 :]) / n])
        m, v = 0.9 * m + 0.1 * slope, 0.99 * v + 0.01 * slope**2
        params = params - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    weights = np.zeros(1 << bits)
    weights[used] = params[: len(used)]
    theta = np.cumsum(np.concatenate([params[len(used) : len(used) + 1], np.exp(params[len(used) + 1 :])]))
    return OrdinalModel(weights, theta, bits)


def sample_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_cols: list[str], max_rows: int) -> DataFrame:
    """label_cols and text of at most max_rows labelled rows, the same at every run.

    A row for each of the chosen ids: of repeated labels the least counts, of repeated
    documents the one of the least text hash.
    """
    given = labels.select(F.col(id_col).alias("__id"), *label_cols).dropna()
    given = given.groupBy("__id").agg(F.min(F.struct(*label_cols)).alias("__labels"))
    chosen = given.orderBy(F.xxhash64(F.col("__id").cast("string"), F.lit("sample")), "__id").limit(max_rows)
    # max_rows ids and labels: bounded by the parameter.
    text = F.col(text_col).cast("string")
    found = docs.select(F.col(id_col).alias("__id"), text.alias("text")).join(F.broadcast(chosen), "__id")
    once = found.groupBy("__id").agg(F.min("__labels").alias("__labels"), F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    return once.select("__labels.*", "text")


def train(docs: DataFrame, graded: DataFrame, id_col: str = "doc_id", text_col: str = "text", grade_col: str = "grade", bits: int = 15, max_rows: int = 5_000, **how) -> OrdinalModel:
    """A model of at most max_rows graded rows (the bound of what reaches the driver).

    Grades are whole numbers from 0; null ids and grades are left out; repeated ids count
    once (see sample_rows). With no graded row every text has the tail probability 0.5.
    """

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [graded_features(t, bits) for t in batch.column("text").to_pylist()]
            summed = [np.unique(i, return_inverse=True) for i, _ in rows]
            values = [np.bincount(at, v, len(u)) for (u, at), (_, v) in zip(summed, rows, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("grade"), pa.array([u for u, _ in summed], pa.list_(pa.int64())), pa.array(values, pa.list_(pa.float64()))], names=["grade", "index", "value"]
            )

    sample = sample_rows(docs, graded, id_col, text_col, [grade_col], max_rows).select(F.col(grade_col).cast("int").alias("grade"), "text")
    found = sample.mapInArrow(features, "grade int, index array<long>, value array<double>").toArrow().to_pandas()
    if not len(found):
        return OrdinalModel(np.zeros(1 << bits), np.zeros(1), bits)
    return fit_cumulative(list(zip(found["index"], found["value"], strict=True)), found.grade.to_numpy(dtype=np.int64), bits, **how)


def grade(model: OrdinalModel, text: Column) -> Column:
    """A struct (expected_grade, tails array) of a text column; tails[k - 1] is P(grade >= k).

    Null or blank texts have no features and get the base rates of the sample. Equal texts
    get equal grades.
    """
    from pyspark.sql import SparkSession

    shared = SparkSession.getActiveSession().sparkContext.broadcast(model)

    @F.pandas_udf("expected_grade double, tails array<double>")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            tails = shared.value.tails([t if isinstance(t, str) else None for t in texts]) if len(texts) else np.empty((0, 1))
            yield pd.DataFrame({"expected_grade": tails.sum(axis=1), "tails": list(tails)})

    return score(text.cast("string"))


def keep_good(docs: DataFrame, model: OrdinalModel, text_col: str = "text", least_expected: float = 1.0) -> DataFrame:
    """docs whose expected grade, the sum of all tails, is at least least_expected; all columns stay."""
    return docs.filter(grade(model, F.col(text_col))["expected_grade"] >= least_expected)
