"""Minimax cuts against all partitions, and the shards' laws."""

from __future__ import annotations

import random
import zlib
from itertools import combinations

from boxmill.llm import sharding

SCHEMA = "doc_id long, text string"


def least_largest(sizes, shards):
    n = len(sizes)
    best = sum(sizes)
    for k in range(1, min(shards, n) + 1):
        for cuts in combinations(range(1, n), k - 1):
            at = [0, *cuts, n]
            best = min(best, max(sum(sizes[a:b]) for a, b in zip(at, at[1:], strict=False)))
    return best


def test_cuts_against_all_partitions():
    r = random.Random(0)
    for _ in range(80):
        sizes = [r.randint(1, 30) for _ in range(r.randint(1, 9))]
        shards = r.randint(1, 4)
        ends = sharding.minimax_cuts(sizes, shards)
        assert ends[-1] == len(sizes) and len(ends) <= shards and ends == sorted(set(ends))
        assert max(sum(sizes[a:b]) for a, b in zip([0, *ends], ends, strict=False)) == least_largest(sizes, shards)
    assert sharding.minimax_cuts([], 3) == []


def test_a_group_over_an_even_share_is_alone():
    assert sharding.assign([10, 500, 10, 10, 10], 3) == [1, 0, 1, 2, 2]


def test_shards(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = {r.doc_id: r.text for r in docs.collect()}
    got = sharding.shard_documents(docs).collect()
    assert sorted(r.doc_id for r in got) == sorted(rows)
    slots, of_text, bytes_of = {}, {}, [0] * 24
    for r in got:
        raw = (rows[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 8, zlib.crc32(raw), "bytes", None)
        slots.setdefault(r.shard, []).append(r.slot)
        of_text.setdefault(raw, set()).add(r.shard)
        bytes_of[r.shard] += r.size
    assert all(len(s) == 1 for s in of_text.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and len(slots) == 24
    groups = {}
    for t in rows.values():
        groups[t] = groups.get(t, 0) + len((t or "").encode()) + 8
    # No contiguous partition can be better than an even share, or worse than it by more than one group.
    assert max(bytes_of) <= sum(bytes_of) / 24 + max(groups.values())


def test_odd_rows(spark):
    rows = [(1, None, "s"), (2, "", "s"), (3, "é", "s"), (3, "é", "s"), (None, "x", "s")] + [(i, "same text", "s") for i in range(10, 40)]
    got = sharding.shard_documents(spark.createDataFrame(rows, f"{SCHEMA}, shard string"), shards=4).collect()
    assert len(got) == len(rows)
    assert {r.size for r in got if r.doc_id == 3} == {10} and {r.text_crc32 for r in got if r.doc_id in (1, 2)} == {0}
    assert len({r.shard for r in got if r.size == 17}) == 1
    for s in range(4):
        mine = sorted(r.slot for r in got if r.shard == s)
        assert mine == list(range(len(mine)))
    assert sharding.shard_documents(spark.createDataFrame([], SCHEMA)).collect() == []
