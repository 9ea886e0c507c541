"""Toxicity categories by a chain of linear classifiers.

Categories are predicted one after another; the model of a later category also gets
the probabilities of the earlier ones. In training those come from models that did not
see the row (out-of-fold), so the later model learns how far they can be trusted.
Features are the presence of hashed words and word beginnings; each model keeps those
whose rates differ most between the classes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .quality_ordinal import sample_rows, sigmoid
from .text_features import presence_features


@dataclass
class Linear:
    """Logistic model: kept buckets (sorted), their weights, weights of earlier links, bias."""

    kept: np.ndarray
    weights: np.ndarray
    links: np.ndarray
    bias: float

    def predict(self, rows: list[np.ndarray], earlier: np.ndarray) -> np.ndarray:
        owner, index = _rows(rows)
        at = np.minimum(np.searchsorted(self.kept, index), max(0, len(self.kept) - 1))
        hit = self.kept[at] == index if len(self.kept) else np.zeros(len(index), bool)
        score = np.bincount(owner[hit], self.weights[at[hit]], len(rows)) if len(self.kept) else np.zeros(len(rows))
        return sigmoid(score + earlier @ self.links + self.bias)


def _rows(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Row number and bucket of every feature."""
    return np.repeat(np.arange(len(rows)), [len(r) for r in rows]), np.concatenate([np.empty(0, np.int64), *rows])


def fit_linear(rows: list[np.ndarray], y: np.ndarray, earlier: np.ndarray, keep: int = 4096, least_rows: int = 4, steps: int = 150, penalty: float = 3e-4, rate: float = 0.1) -> Linear:
    """Regularised logistic regression by Adam on the features that tell most."""
    owner, index = _rows(rows)
    n, positive = len(rows), float(y.sum())
    width = earlier.shape[1]
    if not n or positive in (0.0, float(n)):
        base = (positive + 0.5) / (n + 1)
        return Linear(np.empty(0, np.int64), np.empty(0), np.zeros(width), float(np.log(base / (1 - base))))
    used, at = np.unique(index, return_inverse=True)
    with_y, total = np.bincount(at, y[owner], len(used)), np.bincount(at, minlength=len(used))
    gap = with_y / positive - (total - with_y) / (n - positive)
    spread = np.sqrt((total / n) * (1 - total / n) * (1 / positive + 1 / (n - positive)) + 1e-9)
    told = np.where(total >= least_rows, np.abs(gap) / spread, -1)
    chosen = np.sort(np.argsort(-told, kind="stable")[:keep])
    chosen = chosen[told[chosen] > 2]
    place = np.full(len(used), -1)
    place[chosen] = np.arange(len(chosen))
    hit = place[at] >= 0
    owner, column = owner[hit], place[at[hit]]
    k = len(chosen)
    params = np.zeros(k + width + 1)
    params[-1] = np.log(positive / (n - positive))
    m = v = np.zeros_like(params)
    for t in range(1, steps + 1):
        error = sigmoid(np.bincount(owner, params[column], n) + earlier @ params[k:-1] + params[-1]) - y
        slope = np.concatenate([np.bincount(column, error[owner], k), earlier.T @ error, [error.sum()]]) / n
        slope[:-1] += penalty / np.sqrt(n / 1000 + 1) * params[:-1]
        m, v = 0.9 * m + 0.1 * slope, 0.99 * v + 0.01 * slope**2
        params = params - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return Linear(used[chosen], params[:k], params[k:-1], float(params[-1]))


@dataclass
class Chain:
    """One Linear per category, in order; cuts: the probability from which a category is given."""

    categories: list[str]
    models: list[Linear]
    cuts: list[float]
    bits: int

    def predict(self, texts: list[str | None]) -> np.ndarray:
        """Probabilities, one column per category."""
        rows = [presence_features(t, self.bits) for t in texts]
        out = np.zeros((len(rows), len(self.models)))
        for j, model in enumerate(self.models):
            out[:, j] = model.predict(rows, out[:, :j])
        return out


def fit_chain(rows: list[np.ndarray], labels: np.ndarray, categories: list[str], bits: int, folds: int = 4) -> Chain:
    """Models for the columns of labels; later ones are trained on out-of-fold probabilities."""
    fold = np.random.default_rng(0).permutation(len(rows)) % folds  # not in step with the order of rows
    honest = np.zeros((len(rows), len(categories)))
    models, cuts = [], []
    for j in range(len(categories)):
        earlier, y = honest[:, :j], labels[:, j].astype(float)
        models.append(fit_linear(rows, y, earlier))
        for f in range(folds):
            seen, unseen = np.flatnonzero(fold != f), np.flatnonzero(fold == f)
            model = fit_linear([rows[i] for i in seen], y[seen], earlier[seen])
            honest[unseen, j] = model.predict([rows[i] for i in unseen], earlier[unseen])
        cuts.append(best_cut(honest[:, j], y))
    return Chain(categories, models, cuts, bits)


def best_cut(p: np.ndarray, y: np.ndarray) -> float:
    """The cut of best F1, in the middle of the gap between two probabilities; without both classes 0.5."""
    if not 0 < y.sum() < len(y):
        return 0.5
    order = np.argsort(-p, kind="stable")
    right = np.cumsum(y[order])
    f1 = 2 * right / (np.arange(1, len(y) + 1) + y.sum())
    at = int(np.argmax(f1))
    below = p[order[at + 1]] if at + 1 < len(p) else 0.0
    return float((p[order[at]] + below) / 2)


def train(docs: DataFrame, labels: DataFrame, categories: dict[str, str], id_col: str = "doc_id", text_col: str = "text", bits: int = 20, max_rows: int = 6_000, folds: int = 4) -> Chain:
    """A chain for the given categories, in that order.

    categories: name and a SQL expression of 0 or 1 over the columns of labels and over
    `text`. At most max_rows labelled rows reach the driver, as hashed features; a model
    keeps the 4,096 features that tell most. A category is given from the cut of best F1
    on, found on out-of-fold probabilities. Rows
    with a null id or label are left out; repeated ids (see sample_rows) and texts that
    repeat word for word count once.
    With no labelled row every probability is 0.5.
    """

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [presence_features(t, bits).astype(np.int32) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("labels"), pa.array(rows, pa.list_(pa.int32()))], names=["labels", "index"])

    columns = [c for c in labels.columns if c not in (id_col, "text")]
    sample = sample_rows(docs, labels, id_col, text_col, columns, max_rows)
    sample = sample.select(F.array(*[F.expr(e).cast("int") for e in categories.values()]).alias("labels"), "text")
    found = sample.mapInArrow(features, "labels array<int>, index array<int>").toArrow()
    once = {}
    for batch in found.to_batches():
        index, ends = batch.column("index").values.to_numpy(), batch.column("index").offsets.to_numpy()
        for i, row_labels in enumerate(batch.column("labels").to_pylist()):
            row = index[ends[i] : ends[i + 1]].astype(np.int64)
            if None not in row_labels:
                once[row.tobytes(), tuple(row_labels)] = row
    order = sorted(once)  # Spark's order of rows must not matter
    rows = [once[key] for key in order]
    given = np.array([key[1] for key in order], np.int64).reshape(-1, len(categories))
    return fit_chain(rows, given, list(categories), bits, folds)


def score(model: Chain, text: Column) -> Column:
    """A struct with the probability of each category; null or empty texts get the base rates, equal texts equal ones."""
    from pyspark.sql import SparkSession

    shared = SparkSession.getActiveSession().sparkContext.broadcast(model)

    @F.pandas_udf(", ".join(f"`{c}` double" for c in model.categories))
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame(shared.value.predict([t if isinstance(t, str) else None for t in texts]), columns=shared.value.categories)

    return predict(text.cast("string"))
