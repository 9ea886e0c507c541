"""Packing of tokenized documents into fixed windows by non-negative least squares.

1. Every document is tokenized once; its ids go to a written table together with a
   first, local cut: whole windows, a main piece whose length is a multiple of the
   grain, and a tail shorter than the grain.
2. Shallow combinations of grain multiples that fill a window exactly are enumerated;
   non-negative least squares (Lawson and Hanson 1974; for packing Krell et al. 2021)
   gives the number of repeats of each that fits the histogram of main pieces best.
   The histogram has one row per multiple, so driver work does not grow with the data.
3. Repeats are rounded down; pieces take their places by rank within their length.
   Ranks come from counts per (length, bucket), so no length is ordered in one task.
4. Left-over main pieces and all tails are laid end to end and cut at the windows'
   edges, so only the last window has padding.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

TOKENIZED = "row_key long, doc_id long, doc_tokens long, ids binary, pieces array<struct<start:long,length:long,crc:long>>"
BUCKETS = 4096


class CachedEncoder:
    """ids of whole texts by the word_bpe tokenizer, each word encoded once and looked up.

    That tokenizer lower-cases, drops white space and encodes each run of letters, each
    digit and each run of other signs by itself. Texts of Latin letters are cut into
    such runs here; words of any other text go through the tokenizer as they are.
    The caches are emptied when they are full.
    """

    #: What needs the tokenizer's own rules: apostrophes, controls, other scripts, also capitals whose small letters are beyond U+024F.
    OTHER = re.compile("['\x00-\x08\x0e-\x1f\x7f-\xbf%s\u0250-\U0010ffff]" % "".join(c for c in map(chr, range(0xC0, 0x250)) if max(c.lower()) > "\u024f"))
    RUN = re.compile(r"[^\W\d_]+|\d|(?:[^\s\w]|_)+")

    def __init__(self, path: str, cache_words: int = 500_000):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.limit = cache_words
        self.runs: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        # The tokenizer writes each byte of a word as one printable character.
        self.byte_char = {}
        for letter in map(chr, range(33, 0x250)):
            shown = self.tokenizer.pre_tokenizer.pre_tokenize_str(letter)
            if len(shown) == 1:
                self.byte_char.update(zip(letter.encode(), shown[0][0], strict=False))

    def _look_up(self, cache: dict[str, bytes], parts: list[str], learn) -> bytes:
        if missing := set(parts).difference(cache):
            if len(cache) + len(missing) > self.limit:
                cache.clear()
                missing = set(parts)
            learn(missing)
        return b"".join(map(cache.__getitem__, parts))

    def _learn_runs(self, runs: set[str]) -> None:
        tokenize = self.tokenizer.model.tokenize
        for run in runs:
            shown = run if run.isascii() else "".join(map(self.byte_char.__getitem__, run.encode()))
            self.runs[run] = b"".join([t.id.to_bytes(2, "little") for t in tokenize(shown)])

    def _learn_words(self, words: set[str]) -> None:
        words = list(words)
        encoded = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        self.words.update((w, np.array(e.ids, np.uint16).tobytes()) for w, e in zip(words, encoded, strict=True))

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        """uint16 ids of each text; null: none."""
        for text in texts:
            if not text:
                yield b""
            elif self.OTHER.search(text):
                yield self._look_up(self.words, re.split("[ \t-\r]+", text), self._learn_words)
            else:
                yield self._look_up(self.runs, self.RUN.findall(text.lower()), self._learn_runs)


@lru_cache(maxsize=1)
def worker_encoder(path: str) -> CachedEncoder:
    """One encoder for a Python worker's life, so that later tasks find its caches filled."""
    return CachedEncoder(path)


def crc_of(ids: np.ndarray) -> int:
    """CRC-32 of the ids as unsigned little-endian 32-bit numbers."""
    return zlib.crc32(ids.astype("<u4").tobytes())


def local_cut(n: int, window: int, grain: int) -> list[tuple[int, int]]:
    """(start, length) of whole windows, the main piece and the tail of n ids."""
    whole = n // window * window
    main = whole + (n - whole) // grain * grain
    cuts = [*range(0, whole, window), *([whole] if main > whole else []), *([main] if n > main else [])]
    return [(s, e - s) for s, e in zip(cuts, [*cuts[1:], n], strict=True)]


def tokenized(docs: DataFrame, id_col: str, text_col: str, tokenizer_path: str, end_id: int, window: int, grain: int) -> DataFrame:
    """TOKENIZED rows: a key of the row, its ids (uint16) with end_id at the end, and its local cut."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(tokenizer_path)
        key = TaskContext.get().partitionId() << 40
        last = np.array([end_id], np.uint16).tobytes()
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                ids = [x + last for x in encoder.encode(batch.column("text").to_pylist())]
                pieces = []
                for x in ids:
                    a = np.frombuffer(x, np.uint16)
                    pieces.append([{"start": s, "length": n, "crc": crc_of(a[s : s + n])} for s, n in local_cut(len(a), window, grain)])
                keys = np.arange(key, key + batch.num_rows)
                key += batch.num_rows
                kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("crc", pa.int64())]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys), batch.column("doc_id"), pa.array([len(x) // 2 for x in ids], pa.int64()), pa.array(ids, pa.binary()), pa.array(pieces, kind)],
                    names=["row_key", "doc_id", "doc_tokens", "ids", "pieces"],
                )

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(encode, TOKENIZED)


def combinations(units: int, depth: int) -> list[tuple[int, ...]]:
    """All non-increasing tuples of at most depth numbers from 1 that sum to units."""
    out: list[tuple[int, ...]] = []

    def grow(head: tuple[int, ...], left: int) -> None:
        if left == 0:
            out.append(head)
        elif len(head) < depth:
            for part in range(min(left, head[-1] if head else left), 0, -1):
                grow((*head, part), left - part)

    grow((), units)
    return out


def nnls(a: np.ndarray, b: np.ndarray, tolerance: float = 1e-9) -> np.ndarray:
    """x >= 0 with least |a x - b|, by the active-set method."""
    x = np.zeros(a.shape[1])
    free = np.zeros(a.shape[1], bool)
    for _ in range(3 * a.shape[1]):
        slope = a.T @ (b - a @ x)
        slope[free] = 0
        best = int(np.argmax(slope))
        if slope[best] <= tolerance:
            break
        free[best] = True
        while True:
            cols = np.flatnonzero(free)
            z = np.linalg.lstsq(a[:, cols], b, rcond=None)[0]
            if (z > 0).all():
                x[:] = 0
                x[cols] = z
                break
            low = z <= 0
            step = (x[cols][low] / np.maximum(x[cols][low] - z[low], 1e-300)).min()
            x[cols] += step * (z - x[cols])
            free[cols[x[cols] <= 1e-12]] = False
            x[~free] = 0
            if not free.any():
                break
    return x


def plan(histogram: dict[int, int], units: int, depth: int) -> list[tuple[tuple[int, ...], int]]:
    """(combination, repeats) that use no more pieces of a length than there are."""
    combos = combinations(units, depth)
    left = np.array([histogram.get(i, 0) for i in range(units + 1)], np.int64)
    if not left.any():
        return []
    matrix = np.zeros((units + 1, len(combos)))
    for j, combo in enumerate(combos):
        np.add.at(matrix[:, j], list(combo), 1)
    scale = left.sum()
    wished = np.floor(nnls(matrix, left / scale) * scale + 1e-6).astype(np.int64)
    chosen: dict[int, int] = {}
    for wish in (wished, None):  # the rounded solution, then what else still fits exactly
        for j in np.argsort(-wished, kind="stable"):
            parts = matrix[:, j] > 0
            fits = int((left[parts] // matrix[parts, j].astype(np.int64)).min())
            n = fits if wish is None else min(fits, int(wish[j]))
            if n > 0:
                chosen[j] = chosen.get(j, 0) + n
                left -= n * matrix[:, j].astype(np.int64)
    return [(combos[j], n) for j, n in chosen.items()]


def places(chosen: list[tuple[tuple[int, ...], int]], grain: int) -> tuple[list[tuple], int]:
    """Ranges of ranks (bin, low, high, copies, first sequence, offset), and the number of sequences."""
    taken: dict[int, int] = {}
    rows, sequences = [], 0
    for combo, repeats in chosen:
        offset = 0
        for part in dict.fromkeys(combo):
            copies, low = combo.count(part), taken.get(part, 0)
            taken[part] = low + copies * repeats
            rows.append((part, low, taken[part], copies, sequences, offset))
            offset += copies * part * grain
        sequences += repeats
    return rows, sequences


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 1,
    window: int = 2048,
    grain: int = 16,
    depth: int = 3,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document's ids are those of its text (null: none) and end_id, so every row has
    one id at least. Each id lies in one piece; offsets have no gaps from 0 on; all
    sequences but the last are full. Repeated rows and null ids are packed as rows of
    their own. The tokenizer must have under 65,536 ids, and must not join words
    across ASCII white space. Other columns are ignored; an empty table gives no rows.
    """
    if window % grain:
        raise ValueError("window must be a multiple of grain")
    spark = docs.sparkSession
    table = materialise(tokenized(docs, id_col, text_col, tokenizer_path, end_id, window, grain))
    pieces = table.select("row_key", "doc_id", "doc_tokens", F.explode("pieces").alias("p")).select("row_key", "doc_id", "doc_tokens", "p.*")
    pieces = pieces.withColumn("bin", F.when(F.col("length") % grain == 0, F.col("length") / grain).otherwise(0).cast("int"))
    pieces = pieces.withColumn("bucket", F.pmod(F.xxhash64("row_key", "start"), F.lit(BUCKETS)).cast("int"))
    mains = pieces.filter("bin > 0")

    counts = materialise(mains.groupBy("bin", "bucket").agg(F.count("*").alias("n")))
    histogram = {r["bin"]: r["n"] for r in counts.groupBy("bin").agg(F.sum("n").alias("n")).collect()}
    rows, sequences = places(plan(histogram, window // grain, depth), grain)
    ranges = spark.createDataFrame(rows, "bin int, low long, high long, copies long, first long, at long")

    before = Window.partitionBy("bin").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    within = Window.partitionBy("bin", "bucket").orderBy("row_key", "start")
    ranked = mains.join(starts, ["bin", "bucket"]).withColumn("rank", F.col("before") + F.row_number().over(within) - 1).drop("before")
    # At most depth rows for each combination: bounded by window, grain and depth alone.
    placed = materialise(
        ranked.join(F.broadcast(ranges), (ranked["bin"] == ranges["bin"]) & F.expr("rank >= low and rank < high"), "left").select(
            "row_key",
            "doc_id",
            "start",
            "length",
            "crc",
            "doc_tokens",
            "bucket",
            (F.col("first") + F.floor((F.col("rank") - F.col("low")) / F.col("copies"))).alias("sequence_id"),
            (F.col("at") + F.pmod(F.col("rank") - F.col("low"), F.col("copies")) * F.col("length")).alias("offset"),
        )
    )

    loose = placed.filter("sequence_id is null").drop("sequence_id", "offset").unionByName(pieces.filter("bin = 0").drop("bin"))
    sums = loose.groupBy("bucket").agg(F.sum("length").alias("n"))
    # One row per bucket, BUCKETS at most.
    ahead = sums.select("bucket", F.coalesce(F.sum("n").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    running = F.sum("length").over(Window.partitionBy("bucket").orderBy("row_key", "start").rowsBetween(Window.unboundedPreceding, 0))
    laid = loose.join(ahead, "bucket").withColumn("pos", F.col("before") + running - F.col("length"))
    laid = laid.withColumn("part", F.explode(F.sequence(F.expr(f"pos div {window}"), F.expr(f"(pos + length - 1) div {window}"))))
    laid = materialise(
        laid.select(
            "row_key",
            "doc_id",
            (F.col("start") + F.greatest(F.lit(0), F.col("part") * window - F.col("pos"))).alias("start"),
            (F.least(F.col("pos") + F.col("length"), (F.col("part") + 1) * window) - F.greatest(F.col("pos"), F.col("part") * window)).alias("length"),
            F.col("length").alias("uncut"),
            "crc",
            "doc_tokens",
            (F.col("part") + sequences).alias("sequence_id"),
            F.greatest(F.lit(0), F.col("pos") - F.col("part") * window).alias("offset"),
        )
    )

    def recount(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, start, length = (batch.column(c).to_pylist() for c in ("ids", "start", "length"))
            crc = [crc_of(np.frombuffer(x, np.uint16)[s : s + n]) for x, s, n in zip(ids, start, length, strict=True)]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            yield pa.RecordBatch.from_arrays([pa.array(crc, pa.int64()) if c == "ids_crc32" else batch.column(c) for c in names], names=names)

    out = ["doc_id", "start", "length", F.col("crc").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"]
    cut = laid.filter("length < uncut").join(table.select("row_key", "ids"), "row_key")
    again = cut.mapInArrow(recount, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
    return placed.filter("sequence_id is not null").select(*out).unionByName(laid.filter("length = uncut").select(*out)).unionByName(again)
