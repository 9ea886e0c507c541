"""Vectors as short codes: a small codebook for each part of the vector, exact to the integer.

The codebooks are made by k-means on whole numbers. The nearest entry is found by
exponion search (Newling and Fleuret 2016): the search starts at the entry that the part
had before, at the distance u. An entry that is as near lies within 2 u of that entry
(triangle inequality), so only the beginning of its list of neighbours, sorted by
distance, is looked at. Squared distances are integers, so `d(entry, neighbour) <= 2 u`
is tested as `d2 <= 4 u2` without rounding; ties go to the lower index.

Each round is one pass over the vectors, which are written together with the entries
they got. Sums for the new entries are made per task and added by Spark; the driver
gets one row per part and entry.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hot_keys, join_lookup, materialise
from .vectors import integer_vectors

#: Vectors that are searched at once.
CHUNK = 2048


class Codebooks:
    """The entries of all parts (parts, entries, width), each with its neighbours by distance.

    bounds: where each part begins and ends in a vector; parts shorter than the widest
    are filled up with zeros, which changes no distance.
    """

    def __init__(self, entries: np.ndarray, bounds: list[int]):
        self.entries, self.bounds = entries, bounds
        self.parts, self.size, self.width = entries.shape
        squares = np.stack([((e[:, None, :] - e[None, :, :]) ** 2).sum(axis=2) for e in entries])
        order = np.argsort(squares, axis=2, kind="stable")
        self.apart = np.take_along_axis(squares, order, axis=2).reshape(-1, self.size)
        self.neighbours = order.reshape(-1, self.size)
        self.flat = entries.reshape(-1, self.width)
        # 4 u2 has to fit into 64 bits.
        self.most = isqrt((1 << 63) // (16 * max(self.width, 1))) - 1

    def cut(self, x: np.ndarray) -> np.ndarray:
        """Vectors (n, length) as parts (n, parts, width)."""
        if x.size and max(-int(x.min()), int(x.max())) > self.most:
            raise ValueError(f"a component lies beyond {self.most} after scaling: squared distances would not fit into 64 bits")
        out = np.zeros((len(x), self.parts, self.width), np.int64)
        for p, (low, high) in enumerate(zip(self.bounds, self.bounds[1:], strict=False)):
            out[:, p, : high - low] = x[:, low:high]
        return out

    def nearest(self, x: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entries, squared distances), both (n, parts), for parts (n, parts, width) and the entries to start at."""
        values = x.reshape(-1, self.width)
        first = np.tile(np.arange(self.parts) * self.size, len(x))  # of each part's codebook in flat
        at = first + start.ravel()
        least = ((values - self.flat[at]) ** 2).sum(axis=1)
        best = start.ravel().copy()
        radius = 4 * least
        live = np.arange(len(values))
        for t in range(self.size):
            live = live[self.apart[at[live], t] <= radius[live]]
            if not len(live):
                break
            found = self.neighbours[at[live], t]
            squares = ((values[live] - self.flat[first[live] + found]) ** 2).sum(axis=1)
            better = (squares < least[live]) | ((squares == least[live]) & (found < best[live]))
            least[live[better]], best[live[better]] = squares[better], found[better]
        return best.reshape(start.shape), least.reshape(start.shape)

    def moved(self, sums: dict[tuple[int, int], tuple[int, list[int]]]) -> Codebooks:
        """The means, rounded down, of what was given to each entry; entries without anything stay."""
        entries = self.entries.copy()
        for (part, entry), (n, total) in sums.items():
            entries[part, entry] = [s // n for s in total]
        return Codebooks(entries, self.bounds)

    def digest(self) -> str:
        """SHA-256 of all components by part, entry and position."""
        widths = np.diff(self.bounds)
        return sha256(",".join(str(v) for e, w in zip(self.entries, widths, strict=True) for row in e[:, :w].tolist() for v in row).encode()).hexdigest()


def _matrix(column: pa.Array, length: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), length)


def _assigned(rows: DataFrame, books: Codebooks) -> DataFrame:
    """rows with entries (array<int>) and error anew; entries are where the search starts."""
    length = books.bounds[-1]
    shared = rows.sparkSession.sparkContext.broadcast(books)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for whole in batches:
            for low in range(0, whole.num_rows, CHUNK):
                batch = whole.slice(low, CHUNK)
                entries, squares = own.nearest(own.cut(_matrix(batch.column("x"), length)), _matrix(batch.column("entries"), own.parts).astype(np.int64))
                ends = pa.array(np.arange(len(entries) + 1, dtype=np.int32) * own.parts)
                made = {"entries": pa.ListArray.from_arrays(ends, pa.array(entries.ravel().astype(np.int32))), "error": pa.array(squares.sum(axis=1))}
                yield pa.RecordBatch.from_arrays([made.get(n, batch.column(n) if n != "error" else None) for n in batch.schema.names], names=batch.schema.names)

    return materialise(rows.mapInArrow(assign, rows.schema))


def _sums(rows: DataFrame, books: Codebooks) -> dict[tuple[int, int], tuple[int, list[int]]]:
    """(part, entry) to (parts there, their sum), for all entries in use: a row of each at most."""
    length, parts, size, width = books.bounds[-1], books.parts, books.size, books.width
    shared = rows.sparkSession.sparkContext.broadcast(books)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, totals = np.zeros(parts * size, np.int64), np.zeros((parts * size, width), np.int64)
        for batch in batches:
            x = shared.value.cut(_matrix(batch.column("x"), length))
            at = (_matrix(batch.column("entries"), parts).astype(np.int64) + np.arange(parts) * size).ravel()
            counts += np.bincount(at, minlength=parts * size)
            np.add.at(totals, at, x.reshape(-1, width))
        used = np.flatnonzero(counts)
        of = np.repeat(used, width)
        yield pa.RecordBatch.from_arrays([pa.array(of), pa.array(np.tile(np.arange(width), len(used))), pa.array(counts[of]), pa.array(totals[used].ravel())], names=["at", "place", "n", "total"])

    found = rows.select("x", "entries").mapInArrow(add, "at long, place long, n long, total long").groupBy("at", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    out: dict[tuple[int, int], tuple[int, list[int]]] = {}
    for r in found.collect():
        out.setdefault((r["at"] // size, r["at"] % size), (r["n"], [0] * width))[1][r["place"]] = r["total"]
    return out


def compress(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256
) -> tuple[DataFrame, Codebooks | None]:
    """vec_id, label, entries (array<int>, one per part), error (squared distances, summed) of every whole vector; the codebooks.

    Components become floor(scale * x). A vector is cut into `parts` consecutive parts, as
    equal as its length allows. A codebook starts as that part of the `entries` rows of
    least id (then of least vector; null ids last), so of fewer if there are fewer rows.

    Vectors that are null, hold null or non-finite components, or are of another length
    than the commonest are left out. Repeated rows are rows of their own. Components over
    about 2**29 / sqrt(part's width) after scaling raise an error. Other columns are ignored; an empty
    table gives no rows and no codebooks.
    """
    kept, length = integer_vectors(vectors, vector_col, {"vec_id": F.col(id_col), "label": F.col(label_col)}, scale)
    first = [r["x"] for r in kept.orderBy(F.col("vec_id").asc_nulls_last(), "x").select("vec_id", "x").limit(entries).collect()]
    begin = kept.withColumns({"entries": F.array_repeat(F.lit(0), parts), "error": F.lit(0).cast("long")})
    if not first:
        return begin.select("vec_id", "label", "entries", "error"), None
    bounds = [length * p // parts for p in range(parts + 1)]
    width = max(np.diff(bounds))
    books = Codebooks(np.zeros((parts, len(first), width), np.int64), bounds)
    books = Codebooks(np.ascontiguousarray(books.cut(np.array(first, np.int64).reshape(len(first), length)).swapaxes(0, 1)), bounds)
    rows = begin
    for _ in range(rounds):
        rows = _assigned(rows, books)
        books = books.moved(_sums(rows, books))
    return _assigned(rows, books).select("vec_id", "label", "entries", "error"), books


def with_label_error(coded: DataFrame) -> DataFrame:
    """coded (label, error) with label_error: the sum over all rows of its label; nulls are one label."""
    key = {"__none": F.col("label").isNull(), "__label": F.coalesce(F.col("label").cast("string"), F.lit(""))}
    rows = coded.withColumns(key)
    sums = rows.groupBy(*key).agg(F.sum("error").alias("label_error"))
    return join_lookup(rows, sums, list(key), hot_keys(rows, list(key))).drop(*key)
