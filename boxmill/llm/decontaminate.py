"""Benchmark passages in documents by pigeonhole pieces and Myers' bit-parallel distance.

An item that may differ in k places from a passage is cut into k + 1 pieces: one of
them must occur unchanged. All pieces of a block of items are looked for at once with
an Aho-Corasick automaton; round every hit Myers' algorithm (1999) finds the passage
of the least edit distance. Items are handled in blocks of bounded size, each with a
pass over all documents, so time grows with the benchmark. A block is on the driver
while it is sent out, and a worker holds the automata of the blocks that it looks for.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HITS = "doc_id long, item_id long, start long, stop long, distance long"
TO_SPACE = bytes(c if chr(c).isalnum() or c > 127 else 32 for c in range(256))


def normalise(text: str | None) -> str:
    """Lower case; ASCII punctuation and white space become single spaces; null: empty."""
    if not text:
        return ""
    return b" ".join(text.lower().encode("utf-8", "replace").translate(TO_SPACE).split()).decode()


def best_match(pattern: str, text: str) -> tuple[int, int]:
    """(least edit distance of pattern to a substring of text, end of the first such substring)."""
    m = len(pattern)
    peq: dict[str, int] = {}
    for i, c in enumerate(pattern):
        peq[c] = peq.get(c, 0) | 1 << i
    mask, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score = mask, 0, m
    best, end = m, 0
    for j, c in enumerate(text, 1):
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv) & mask
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph = ph << 1 & mask
        mh = mh << 1 & mask
        pv = mh | ~(xv | ph) & mask
        mv = ph & xv
        if score < best:
            best, end = score, j
    return best, end


class Matcher:
    """Looks for a block of items in texts."""

    def __init__(self, items: list[tuple[int, str]], error_rate: float):
        self.items = []
        pieces: dict[str, list[tuple[int, int]]] = {}
        for item_id, text in items:
            pattern = normalise(text)
            if not pattern:
                continue
            errors = int(len(pattern) * error_rate)
            at = [len(pattern) * i // (errors + 1) for i in range(errors + 2)]
            for start, stop in zip(at, at[1:], strict=False):
                pieces.setdefault(pattern[start:stop], []).append((len(self.items), start))
            self.items.append((item_id, pattern, errors))
        self.automaton = ahocorasick.Automaton()
        for piece, places in pieces.items():
            self.automaton.add_word(piece, (len(piece), places))
        if pieces:
            self.automaton.make_automaton()

    def find(self, text: str | None) -> list[tuple[int, int, int, int]]:
        """(item id, start, stop, distance) of the best passage of every item in the normalised text."""
        if not self.items:
            return []
        text = normalise(text)
        best: dict[int, tuple[int, int, int]] = {}
        tried: dict[int, list[int]] = {}
        for last, (length, places) in self.automaton.iter(text):
            for item, offset in places:
                item_id, pattern, errors = self.items[item]
                diagonal = last + 1 - length - offset
                old = tried.setdefault(item, [])
                # A window reaches errors beyond its own diagonal on either side.
                if any(abs(diagonal - d) <= errors for d in old[-8:]):
                    continue
                old.append(diagonal)
                if item in best and best[item][2] == 0:
                    continue
                low = max(0, diagonal - 2 * errors)
                window = text[low : diagonal + len(pattern) + 2 * errors]
                distance, end = best_match(pattern, window)
                if distance <= errors and (item not in best or distance < best[item][2]):
                    size, back = best_match(pattern[::-1], window[:end][::-1])
                    best[item] = (low + end - back, low + end, distance if size == distance else size)
        return sorted((self.items[i][0], *found) for i, found in best.items())


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, block_bytes: int) -> Iterator[list[tuple[int, str]]]:
    """Items on the driver, about block_bytes at a time."""
    items = benchmark.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).filter("id is not null and text is not null")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-size // block_bytes)
    for i in range(n):
        part = items if n == 1 else items.filter(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == i)
        yield [(r["id"], r["text"]) for r in part.orderBy("id", "text").collect()]


def find_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    error_rate: float = 0.06,
    block_bytes: int = 8_000_000,
) -> DataFrame:
    """doc_id, item_id, start, stop, distance: the best passage of each item in each document.

    Positions are those of the normalised text. Edits allowed: error_rate of the item's
    length, rounded down, whatever its length. Null or empty texts
    hold nothing; null items are skipped; repeated items and rows each give their rows.
    Other columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    out = spark.createDataFrame([], HITS)
    for block in _blocks(benchmark, item_col, item_text_col, block_bytes):
        shared = spark.sparkContext.broadcast(block)

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(shared.value, error_rate)
            for batch in batches:
                rows, found = [], []
                for i, text in enumerate(batch.column("text").to_pylist()):
                    for hit in matcher.find(text):
                        rows.append(i)
                        found.append(hit)
                ids = batch.column("doc_id").take(pa.array(rows, pa.int64()))
                columns = [pa.array([h[i] for h in found], pa.int64()) for i in range(4)]
                yield pa.RecordBatch.from_arrays([ids, *columns], names=["doc_id", "item_id", "start", "stop", "distance"])

        out = out.unionByName(texts.mapInArrow(search, HITS))
    return out


def _is_clean(shared, error_rate: float):
    @F.pandas_udf("boolean")
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        matcher = Matcher(shared.value, error_rate)
        for texts in batches:
            yield pd.Series([not matcher.find(t) for t in texts], dtype=bool)

    return clean


def keep_uncontaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    error_rate: float = 0.06,
    block_bytes: int = 8_000_000,
) -> DataFrame:
    """docs without the rows that hold a benchmark passage; all columns stay."""
    for block in _blocks(benchmark, item_col, item_text_col, block_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        docs = docs.filter(_is_clean(shared, error_rate)(F.col(text_col).cast("string")))
    return docs
