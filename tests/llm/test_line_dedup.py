"""Perfect hashes against dictionaries, and shared lines against a plain loop."""

from __future__ import annotations

import random
import re
from collections import defaultdict
from hashlib import sha256
from pathlib import Path

import duckdb
import numpy as np
import pytest

from boxmill.llm import line_dedup, queries
from boxmill.llm.perfect_hash import Index, PerfectHash, Shard

SCHEMA = "doc_id long, text string, n_lines string, a int, doc string"
LOW = -(1 << 63)


def keys(n, seed):
    r = np.random.default_rng(seed)
    return tuple(r.integers(0, 1 << 64, n, np.uint64, endpoint=False) for _ in range(2))


@pytest.mark.parametrize("n", [0, 1, 2, 63, 1000, 30_000])
def test_numbers_are_a_permutation(n):
    a, b = keys(n, n)
    found = PerfectHash.of(a, b)
    assert sorted(found.numbers(a, b).tolist()) == list(range(n))
    assert len(found.words) * 64 < 4.5 * n + 300


def test_keys_that_agree_in_one_half():
    a = np.repeat(np.arange(50, dtype=np.uint64), 50)
    b = np.tile(np.arange(50, dtype=np.uint64), 50)
    assert sorted(PerfectHash.of(a, b).numbers(a, b).tolist()) == list(range(2500))
    with pytest.raises(ValueError, match="distinct"):
        PerfectHash.of(np.zeros(2, np.uint64), np.zeros(2, np.uint64))


def test_index_against_a_dictionary():
    a, b = keys(5000, 1)
    counts, last = np.arange(5000) * (1 << 21), np.arange(5000) - 2500
    shard = a.view(np.int64) % 7
    raw = {k: Shard.of(a[shard == k], b[shard == k], counts[shard == k], last[shard == k]).to_bytes() for k in range(7)}
    index = Index({k: v for k, v in raw.items() if k != 3}, 7)
    got, of = index.find(a, b)
    assert (got[shard != 3] == np.minimum(counts, (1 << 32) - 1)[shard != 3]).all() and (of[shard != 3] == last[shard != 3]).all()
    assert not got[shard == 3].any()
    other, mixed = keys(5000, 2)
    assert not index.find(other, mixed)[0].any() and not index.find(a, mixed)[0].any()
    assert not Index({}, 1).find(a, b)[0].any()


def plainly(rows, least, docs_least):
    """(id, lines, dropped, text) of every row."""
    key = lambda line: re.sub("[A-Z]", lambda m: m[0].lower(), line.strip("\t\n\x0b\x0c\r "))
    split = [(i, (t or "").split("\n")) for i, t in rows]
    holders = defaultdict(set)
    for i, lines in split:
        for x in lines:
            if len(key(x)) >= least:
                holders[key(x)].add(LOW if i is None else i)
    out = []
    for i, lines in split:
        own = LOW if i is None else i
        kept = [x for x in lines if len(holders[key(x)]) < docs_least or max(holders[key(x)]) == own]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def made_rows():
    r = random.Random(5)
    shared = ["Die Straße im Älteren Haus liegt am See, %d" % k for k in range(12)] + ["x" * 39, "y" * 40, "Ä" * 39, "é" * 40, "z" * 20 + " " + "z" * 20]
    rows = [(None, None), (None, "\n".join(shared)), (1, ""), (2, "\n\n"), (3, "y" * 40 + "\r"), (4, "long " * 40_000 + "\n" + shared[0] + "\nlong")]
    for k in range(60):
        lines = [r.choice([" ", "", "\t"]) + (x.upper() if r.random() < 0.2 and x.isascii() else x) + r.choice(["", " ", "\x0b"]) for x in r.choices(shared, k=r.randint(0, 6))]
        rows.append((r.choice([k + 10, k % 9 + 10, None]), "\n".join(lines + ["own line %d" % k])))
    return rows + rows[-3:]


@pytest.mark.parametrize("index_bytes", [64_000_000, 0])
def test_rows_against_a_plain_loop(spark, index_bytes, monkeypatch):
    monkeypatch.setattr(line_dedup, "SHARD_KEYS", 3)
    if not index_bytes:
        monkeypatch.setattr(line_dedup, "HOT_SHARE", 12)
    rows = made_rows()
    docs = spark.createDataFrame([(*r, "?", 1, "x") for r in rows], SCHEMA)
    got = line_dedup.drop_shared_lines(docs, min_docs=5, index_bytes=index_bytes)
    assert got.columns == ["doc_id", "n_lines", "n_dropped", "text"]
    expected = plainly(rows, 40, 5)
    assert sorted(map(tuple, got.collect()), key=str) == expected
    assert sum(r[2] for r in expected) > 30


def test_no_rows_and_no_shared_lines(spark):
    assert line_dedup.drop_shared_lines(spark.createDataFrame([], SCHEMA)).collect() == []
    assert line_dedup.drop_shared_lines(spark.createDataFrame([], SCHEMA), index_bytes=-1).collect() == []
    one = spark.createDataFrame([(1, "a\nb", None, None, None)], SCHEMA)
    assert [tuple(r) for r in line_dedup.drop_shared_lines(one).collect()] == [(1, 2, 0, "a\nb")]


def test_whole_table(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    expected = sorted((i, n, d, sha256(t.encode()).hexdigest()) for i, n, d, t in plainly(rows, 40, 5))
    assert sorted(map(tuple, queries.op11_shared_lines(spark, sf_dir).collect())) == expected
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{Path(sf_dir)}/documents.parquet'")
    assert sorted(con.sql(queries.ORACLE_SQL["op11_shared_lines"]).fetchall()) == expected
