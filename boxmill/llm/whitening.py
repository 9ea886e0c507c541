"""Whitening of vectors along their main components, from exactly centred rows.

The covariance is over distinct vectors, as whole numbers. Their sums S and count n are
exact; with S = q n + r a centred component is (x - q) - r / n, an integer and a fraction
below one. The Gramian of these rows comes from MLlib's RowMatrix, which adds up per
task and in a tree; the driver gets length x length numbers and finds the eigenvectors,
which go to all tasks by broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise
from .vectors import integer_vectors


@dataclass
class Whitening:
    """n and sums: of the distinct vectors; values: eigenvalues, falling; vectors: unit eigenvectors as columns; trace; identity_error."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float | None = None

    @property
    def explained(self) -> list[float | None]:
        return [float(v) / self.trace if self.trace > 0 else None for v in self.values]

    @property
    def known(self) -> np.ndarray:
        """Which components have a variance that is more than rounding."""
        return self.values > len(self.sums) * np.finfo(float).eps * max(self.trace, 0)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n, rounded once."""
        parts = [divmod(s, self.n) for s in self.sums]
        return (x - np.array([q for q, _ in parts], np.int64)).astype(float) - np.array([r / self.n for _, r in parts])

    def whitened(self, x: np.ndarray) -> np.ndarray:
        scale = np.sqrt(np.where(self.known, self.values, np.nan))
        return self.centred(x) @ self.vectors / scale

    def deviations(self, x: np.ndarray) -> list[int]:
        """The sums over all dimensions of (n x - S) ** 2, exact."""
        most = self.n * max(-int(x.min()), int(x.max()), 0) + max(map(abs, self.sums), default=0) if x.size else 0
        kind = np.int64 if len(self.sums) * most**2 < 1 << 63 else object
        return ((x.astype(kind) * self.n - np.array(self.sums, kind)) ** 2).sum(axis=1).tolist()


def _gramian(rows: DataFrame, vector: Column) -> np.ndarray:
    """The Gramian of a column of array<double>."""
    column = rows.select(array_to_vector(vector).alias("v"))
    return RowMatrix(MLUtils.convertVectorColumnsFromML(column, "v")).computeGramianMatrix().toArray()


def fit(distinct: DataFrame, components: int) -> Whitening:
    """The whitening of a written table of distinct vectors x (array<long>, of one length), at least one."""
    n = distinct.count()
    # Sums of 64-bit numbers need not fit into 64 bits.
    found = distinct.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("s"))
    sums = [int(r["s"]) for r in sorted(found.collect(), key=lambda r: r["i"])]
    if not sums:
        return Whitening(n, [], np.empty(0), np.empty((0, 0)), 0.0)
    whole, rest = F.lit([s // n for s in sums]).cast("array<long>"), F.lit([s % n / n for s in sums]).cast("array<double>")
    centred = F.transform("x", lambda v, i: (v - whole[i]).cast("double") - rest[i])
    covariance = _gramian(distinct, centred) / n
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")[:components]
    out = Whitening(n, sums, values[order], vectors[:, order], float(np.trace(covariance)))
    known = int(out.known.sum())
    if known:
        made = materialise(apply(distinct.select(F.lit(None).cast("long").alias("vec_id"), "x"), out).select(F.slice("whitened", 1, known).alias("w")))
        means = made.agg(*[F.avg(F.col("w")[i]) for i in range(known)]).first()
        centre = F.lit([float(m) for m in means])
        of_whitened = _gramian(made, F.transform("w", lambda v, i: v - centre[i])) / n
        out.identity_error = float(np.abs(of_whitened - np.eye(known)).max())
    return out


def apply(rows: DataFrame, model: Whitening) -> DataFrame:
    """vec_id, deviation (decimal; null beyond 38 digits), whitened (array<double>, null where a component has no variance) of rows (vec_id, x)."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def whiten(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = shared.value
        for batch in batches:
            if len(batch):
                x = np.stack(batch.x.to_list()).astype(np.int64).reshape(len(batch), len(own.sums))
                values = [[None if np.isnan(v) else v for v in row] for row in own.whitened(x).tolist()]
                yield pd.DataFrame({"vec_id": batch.vec_id, "deviation": [str(d) for d in own.deviations(x)], "whitened": values})

    id_type = rows.schema["vec_id"].dataType.simpleString()
    made = rows.select("vec_id", "x").mapInPandas(whiten, f"vec_id {id_type}, deviation string, whitened array<double>")
    return made.withColumn("deviation", F.col("deviation").try_cast("decimal(38,0)"))


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 4, scale: int = 256) -> tuple[DataFrame, Whitening | None]:
    """vec_id, deviation, whitened of every whole vector, and the fitted whitening.

    Components of vectors become floor(scale * c). The fit is over each distinct vector
    once. whitened has an entry for each of the first `components` main components (for
    as many as the vectors are long at most); it is null where the component's variance
    is no more than rounding, as in a table of one vector.

    Vectors that are null, hold null or non-finite components, or are of another length
    than the commonest are left out. Repeated rows and null ids are rows of their own.
    Other columns are ignored; an empty table gives no rows and no model.
    """
    kept, length = integer_vectors(vectors, vector_col, {"vec_id": F.col(id_col).cast("long")}, scale)
    distinct = materialise(kept.select("x").distinct())
    if distinct.isEmpty():
        return kept.select("vec_id", F.lit(None).cast("decimal(38,0)").alias("deviation"), F.lit(None).cast("array<double>").alias("whitened")), None
    model = fit(distinct, min(components, length))
    return apply(kept, model), model
