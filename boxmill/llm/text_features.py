"""Hashed features of texts for the linear models: words, shapes and repetition."""

from __future__ import annotations

import numpy as np
import xxhash

#: Classes of bytes: lower, upper, digit, space, line end, and every other ASCII sign by itself.
CLASSES = np.array([ord("a") if c > 127 or chr(c).islower() else ord("A") if chr(c).isupper() else ord("0") if chr(c).isdigit() else ord("_") if c in (32, 9, 11, 12, 13) else c for c in range(256)], np.uint32)
#: Buckets for repetition come before the hashed ones.
REPEATS = 4


def graded_features(text: str | None, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and weights: shares of words, of three-sign shapes, and of repeated words.

    Null or blank: none.
    """
    raw = (text or "").encode("utf-8", "replace")
    words = raw.split()
    if not words:
        return np.empty(0, np.int64), np.empty(0)
    size = (1 << bits) - REPEATS
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    repeats = [(h[k:] == h[:-k]).sum() if len(h) > k else 0 for k in range(1, REPEATS)]
    distinct = len(np.unique(h)) / len(h)
    kinds = CLASSES[np.frombuffer(raw, np.uint8)]
    with np.errstate(over="ignore"):
        shape = (kinds[:-2] * np.uint32(65599) + kinds[1:-1]) * np.uint32(65599) + kinds[2:]
        shape = (shape * np.uint32(0x9E3779B1)).astype(np.uint64)
    # Few shapes are frequent, so they are summed before they are hashed.
    shapes, n = np.unique(shape, return_counts=True)
    of_word = (h % np.uint64(size)).astype(np.int64) + REPEATS
    of_shape = ((shapes ^ np.uint64(0x51ED270B)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(20)) % np.uint64(size)
    index = np.concatenate([np.arange(REPEATS), of_word, of_shape.astype(np.int64) + REPEATS])
    value = np.concatenate([np.array([1 - distinct, *repeats]) / np.array([1, *[len(h)] * (REPEATS - 1)]) * 4, np.full(len(h), 1.0 / len(h)), n / max(1, len(raw)) * 4])
    return index, value


def presence_features(text: str | None, bits: int) -> np.ndarray:
    """Sorted distinct buckets of the text's lower-cased words and of their beginnings; null: none."""
    if not text:
        return np.empty(0, np.int64)
    raw = text.lower().encode("utf-8", "replace").translate(WORDS)
    words = set(raw.split())
    parts = words | {b"^" + w[:5] for w in words if len(w) > 5} | {b"^" + w[:4] for w in words if len(w) > 4}
    mask = (1 << bits) - 1
    digest = xxhash.xxh3_64_intdigest
    return np.unique(np.fromiter((digest(p) & mask for p in parts), np.int64, len(parts)))


WORDS = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256))
