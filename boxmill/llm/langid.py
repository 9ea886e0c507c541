"""Language of a text by multinomial naive Bayes over hashed character n-grams.

Training counts n-grams per language over all given rows; only sums per (language,
bucket) reach the driver, bounded by max_languages times the number of buckets. The
matrix of log probabilities is broadcast, and whole batches of texts are scored at
once in NumPy.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise

GAP = 3
SLICE, CELLS = 500_000, 16_000_000
UNKNOWN = "und"


@lru_cache(maxsize=1)
def letter_table() -> np.ndarray:
    """Whether each code point of the basic plane is a letter; higher planes have one entry that is."""
    return np.array([chr(c).isalpha() for c in range(0x10000)] + [True])


def slices(texts: list[str | None], size: int = SLICE) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Code points of lower-cased texts in runs of about `size`, where each text starts, and its index.

    Other signs than letters are spaces; GAP spaces stand before each text, so no n-gram
    has letters of two texts. A longer text comes in runs of its own that overlap by GAP:
    as n-grams are taken at all places of a run but the last GAP, each counts once.
    """
    parts, starts, owners, filled = [], [], [], 0
    table = letter_table()
    gap = np.full(GAP, 32, np.uint32)
    for i, text in enumerate(texts):
        codes = np.frombuffer((text.lower() if text else "").encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = np.where(table[np.minimum(codes, 0x10000)], codes, np.uint32(32))
        if len(codes) > size:
            whole = np.concatenate([gap, codes, gap])
            for at in range(0, len(whole) - GAP, size):
                yield whole[at : at + size + GAP], np.zeros(1, np.int64), np.array([i])
            continue
        starts.append(filled)
        owners.append(i)
        parts += [gap, codes]
        filled += GAP + len(codes)
        if filled >= size:
            yield np.concatenate([*parts, gap]), np.array(starts), np.array(owners)
            parts, starts, owners, filled = [], [], [], 0
    if parts:
        yield np.concatenate([*parts, gap]), np.array(starts), np.array(owners)


def buckets(codes: np.ndarray, n: int, bits: int) -> np.ndarray:
    """The bucket of the n-gram at every place but the last GAP."""
    size = len(codes) - GAP
    with np.errstate(over="ignore"):
        h = np.full(size, n, np.uint32)
        for i in range(n):
            h = (h ^ codes[i : i + size]) * np.uint32(0x9E3779B1)
            h ^= h >> np.uint32(15)
    return h >> np.uint32(32 - bits)


@dataclass
class LanguageModel:
    """log_prob[bucket, language], log_prior[language]."""

    languages: list[str]
    log_prob: np.ndarray
    log_prior: np.ndarray
    orders: tuple[int, ...]
    bits: int

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Languages and posterior probabilities; no letter or no training: UNKNOWN and 0.

        Of equally likely languages the first by name. Runs are shorter the more languages
        there are, so that a run's table of log probabilities has at most CELLS numbers.
        """
        total = np.zeros((len(texts), max(1, len(self.languages))))
        letters = np.zeros(len(texts), bool)
        for codes, starts, owners in slices(texts, min(SLICE, max(1000, CELLS // max(1, len(self.languages))))):
            found = np.logical_or.reduceat(codes != 32, starts)
            np.logical_or.at(letters, owners, found)
            if self.languages:
                for n in self.orders:
                    sums = np.add.reduceat(self.log_prob[buckets(codes, n, self.bits)], starts, axis=0, dtype=np.float64)
                    np.add.at(total, owners, sums)
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        total += self.log_prior
        best = total.argmax(axis=1)
        score = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
        return [self.languages[b] if x else UNKNOWN for b, x in zip(best, letters, strict=True)], np.where(letters, score, 0.0)


def train(
    rows: DataFrame, text_col: str = "text", lang_col: str = "lang", orders: tuple[int, ...] = (1, 2, 3), bits: int = 16, smoothing: float = 0.1, max_languages: int = 500
) -> LanguageModel:
    """A model of all rows with a text and a language; others are left out.

    n-grams of order 4 at most. More than max_languages languages raise an error: the
    matrix is held by the driver and every worker. An empty table gives a model that
    answers UNKNOWN.
    """
    if max(orders) > GAP + 1:
        raise ValueError("n-grams of order 4 at most")
    size = 1 << bits

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        seen: dict[str, int] = {}
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), dtype=object)
            texts = np.array(batch.column("text").to_pylist(), dtype=object)
            for lang in dict.fromkeys(langs):
                mine = list(texts[langs == lang])
                seen[lang] = seen.get(lang, 0) + len(mine)
                into = sums.setdefault(lang, np.zeros(size, np.int64))
                for codes, _, _ in slices(mine):
                    for n in orders:
                        into += np.bincount(buckets(codes, n, bits), minlength=size)
        for lang, into in sums.items():
            full = np.flatnonzero(into)
            names = pa.array([lang] * (len(full) + 1), pa.string())
            yield pa.RecordBatch.from_arrays(
                [names, pa.array(np.append(full, -1), pa.int32()), pa.array(np.append(into[full], seen[lang]), pa.int64())], names=["lang", "bucket", "n"]
            )

    usable = rows.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")).filter("text is not null and lang is not null")
    counts = materialise(usable.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")))
    if (found := counts.filter("bucket = -1").limit(max_languages + 1)).count() > max_languages:
        raise ValueError(f"more than {max_languages} languages: {found.count()}")
    table = counts.toArrow().to_pandas()
    languages = sorted(table.lang.unique()) if len(table) else []
    column = table.lang.map({x: i for i, x in enumerate(languages)}).to_numpy(dtype=np.int64)
    matrix = np.full((size, len(languages)), smoothing)
    gram = (table.bucket >= 0).to_numpy()
    matrix[table.bucket[gram].to_numpy(), column[gram]] += table.n[gram].to_numpy()
    prior = np.zeros(len(languages))
    prior[column[~gram]] = table.n[~gram].to_numpy()
    with np.errstate(divide="ignore"):
        return LanguageModel(languages, np.log(matrix / matrix.sum(axis=0)).astype(np.float32), np.log(prior / max(1, prior.sum())), orders, bits)


def identify(model: LanguageModel, text: Column) -> Column:
    """A struct (lang_pred, score) of a text column; null or without letters: UNKNOWN, 0. Equal texts get equal answers; see LanguageModel.predict on ties."""
    from pyspark.sql import SparkSession

    shared = SparkSession.getActiveSession().sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            langs, score = shared.value.predict([t if isinstance(t, str) else None for t in texts])
            yield pd.DataFrame({"lang_pred": langs, "score": score})

    return predict(text.cast("string"))
