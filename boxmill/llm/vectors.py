"""Vectors as whole numbers, for operators that have to be exact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise


def is_whole(vector: Column) -> Column:
    """True unless the vector is null or holds a null, NaN or infinite component."""
    good = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    return vector.isNotNull() & F.coalesce(F.forall(vector, good), F.lit(False))


def integer_vectors(rows: DataFrame, vector_col: str, others: dict[str, Column], scale: int = 256) -> tuple[DataFrame, int]:
    """The given columns and x (array<long>, floor(scale * component)) of all whole vectors, as a written table; their length.

    Vectors of another length than the commonest (of equally common ones, the longest)
    cannot be compared with the rest and are left out as well. No vector: length 0.
    """
    vector = F.col(vector_col).cast("array<double>")
    floors = F.transform(vector, lambda x: F.floor(x * scale))
    kept = materialise(rows.filter(is_whole(vector)).select(*[c.alias(name) for name, c in others.items()], floors.alias("x")))
    size = F.size("x").alias("size")
    lengths = kept.groupBy(size).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("size")).take(2)
    if not lengths:
        return kept, 0
    return (kept.filter(size == lengths[0]["size"]) if len(lengths) > 1 else kept), lengths[0]["size"]
