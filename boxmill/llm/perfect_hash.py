"""A minimal perfect hash over 128-bit keys, and arrays of fingerprints and values that it indexes."""

from __future__ import annotations

import io

import numpy as np

from .common import mix64

#: Bits of a level for each key that is still without a place.
GAMMA = 1.5
MOST_LEVELS = 400
ONE = np.uint64(1)


def _places(a: np.ndarray, b: np.ndarray, level: int, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (mix64(a + mix64(b + np.uint64(level * 2 + 1))) % np.uint64(size)).astype(np.int64)


class PerfectHash:
    """Distinct keys (a, b) to 0..n-1, without holding the keys (Limasset et al. 2017).

    On each level a key whose bit nobody else wants gets it; the others go on to the
    next. A key's number is the rank of its bit over all levels. Other keys get some
    number or -1.
    """

    def __init__(self, sizes: np.ndarray, words: np.ndarray):
        self.sizes, self.words = sizes, words
        counts = np.bitwise_count(words).astype(np.int64)
        self.before = np.concatenate([[0], np.cumsum(counts)])
        self.starts = np.concatenate([[0], np.cumsum(sizes)])

    @classmethod
    def of(cls, a: np.ndarray, b: np.ndarray) -> PerfectHash:
        sizes, bits = [], []
        while len(a):
            if len(sizes) == MOST_LEVELS:
                raise ValueError("the keys are not distinct")
            size = -(-int(GAMMA * len(a) + 1) // 64) * 64
            at = _places(a, b, len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            left = ~alone[at]
            a, b = a[left], b[left]
            sizes.append(size)
            bits.append(alone)
        flat = np.concatenate(bits) if bits else np.zeros(0, bool)
        return cls(np.array(sizes, np.int64), np.packbits(flat, bitorder="little").view(np.uint64))

    def numbers(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = np.full(len(a), -1, np.int64)
        left = np.arange(len(a))
        for level, size in enumerate(self.sizes.tolist()):
            bit = self.starts[level] + _places(a[left], b[left], level, size)
            word, shift = bit >> 6, (bit & 63).astype(np.uint64)
            bits = self.words[word]
            here = (bits >> shift) & ONE == ONE
            below = np.bitwise_count(bits[here] & ((ONE << shift[here]) - ONE)).astype(np.int64)
            out[left[here]] = self.before[word[here]] + below
            left = left[~here]
            if not len(left):
                break
        return out


class Shard:
    """Keys (a, b) with a count and a last id each: fingerprints, counts and ids in the order of a perfect hash.

    A key is found if b is the fingerprint at its number; counts over 2**32 - 1 stand as that.
    """

    def __init__(self, hash_: PerfectHash, marks: np.ndarray, counts: np.ndarray, last: np.ndarray):
        self.hash, self.marks, self.counts, self.last = hash_, marks, counts, last

    @classmethod
    def of(cls, a: np.ndarray, b: np.ndarray, counts: np.ndarray, last: np.ndarray) -> Shard:
        found = PerfectHash.of(a, b)
        order = np.argsort(found.numbers(a, b))
        return cls(found, b[order], np.minimum(counts, (1 << 32) - 1).astype(np.uint32)[order], last[order])

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        for array in (self.hash.sizes, self.hash.words, self.marks, self.counts, self.last):
            np.save(out, array, allow_pickle=False)
        return out.getvalue()

    @classmethod
    def from_bytes(cls, raw: bytes) -> Shard:
        given = io.BytesIO(raw)
        sizes, words, *rest = (np.load(given, allow_pickle=False) for _ in range(5))
        return cls(PerfectHash(sizes, words), *rest)

    def find(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(count, last id) of each key; count 0 for keys that are not there."""
        number = self.hash.numbers(a, b)
        there = number >= 0
        there[there] = self.marks[number[there]] == b[there]
        counts, last = np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
        counts[there], last[there] = self.counts[number[there]], self.last[number[there]]
        return counts, last


class Index:
    """Shards by number; a key is in the shard a (as a signed number) modulo their count."""

    def __init__(self, shards: dict[int, bytes], count: int):
        self.shards, self.count = {k: Shard.from_bytes(v) for k, v in shards.items()}, count

    def find(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        counts, last = np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
        if not self.shards:
            return counts, last
        of = a.view(np.int64) % self.count
        order = np.argsort(of, kind="stable")
        for rows in np.split(order, np.flatnonzero(np.diff(of[order])) + 1):
            if len(rows) and (shard := self.shards.get(int(of[rows[0]]))) is not None:
                counts[rows], last[rows] = shard.find(a[rows], b[rows])
        return counts, last
