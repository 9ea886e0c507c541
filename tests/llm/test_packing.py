"""Packing: exact round trip of every id."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from boxmill.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string"
ODD = [
    None, "", "  \n", "Hello don't it's WE'RE x<|endoftext|>y", "ÀÉ İI ǅ ñandú, Ünïcode ét", "你好 世界 12,5 a_b __", "\x1c a\x1cb \x85 \xa0c",
    "ΣΑΣ ́", "a" * 3000, "word " * 9000,
]


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


def test_cached_ids_are_the_tokenizers(tokenizer, sf_dir):
    import duckdb

    texts = ODD + [r[0] for r in duckdb.sql(f"SELECT text FROM '{sf_dir}/documents.parquet'").fetchall()]
    for cache in (20, 500_000):
        encoder = packing.CachedEncoder(PATH, cache)
        for text, ids in zip(texts, encoder.encode(texts), strict=True):
            assert np.frombuffer(ids, np.uint16).tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids, text[:80] if text else text


def test_every_code_point_of_latin_letters(tokenizer):
    """Alone, in a word and beside an apostrophe; small letters of some capitals lie beyond U+024F."""
    encoder = packing.CachedEncoder(PATH)
    texts = [t for c in map(chr, range(0x250)) for t in (c, f"a{c}b {c}{c} x", f"{c}'s")]
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        assert np.frombuffer(ids, np.uint16).tolist() == tokenizer.encode(text, add_special_tokens=False).ids, ascii(text)


def check(rows, pieces, tokenizer, window=2048):
    ids = {d: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for d, t in rows}
    covered, sequences = {d: [] for d in ids}, {}
    for p in pieces:
        part = ids[p.doc_id][p.start : p.start + p.length]
        assert len(part) == p.length > 0 and p.doc_tokens == len(ids[p.doc_id])
        assert p.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
        covered[p.doc_id].append((p.start, p.length))
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for d, parts in covered.items():
        at = 0
        for start, length in sorted(parts):
            assert start == at
            at += length
        assert at == len(ids[d])
    lengths = []
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
        lengths.append(at)
    assert sum(n < window for n in lengths) <= 1


def test_every_id_lies_in_one_piece_and_windows_are_full(spark, sf_dir, tokenizer):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    check([tuple(r) for r in docs.collect()], packing.pack(docs, PATH).collect(), tokenizer)


def test_odd_texts_and_extra_columns(spark, tokenizer):
    rows = list(enumerate(ODD))
    df = spark.createDataFrame([(*r, 0, "x") for r in rows], f"{SCHEMA}, length int, bin string")
    check(rows, packing.pack(df, PATH).collect(), tokenizer)
    assert packing.pack(spark.createDataFrame([], SCHEMA), PATH).collect() == []
    twice = packing.pack(spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c")], SCHEMA), PATH).collect()
    assert sorted((p.doc_id or 0, p.length) for p in twice) == [(0, 2), (1, 3), (1, 3)]


def test_nnls_meets_the_optimality_conditions():
    rng = np.random.default_rng(0)
    for _ in range(10):
        a, b = rng.random((8, 20)), rng.random(8)
        x = packing.nnls(a, b)
        slope = a.T @ (b - a @ x)
        assert (x >= 0).all() and (slope <= 1e-6).all() and np.abs(slope[x > 1e-9]).max(initial=0) < 1e-6


def test_plan_fills_windows_with_pieces_that_exist():
    rng = np.random.default_rng(2)
    histogram = {i: int(rng.integers(0, 300)) for i in range(1, 33)}
    chosen = packing.plan(histogram, 32, 3)
    used = {}
    for combo, n in chosen:
        assert sum(combo) == 32 and n > 0
        for part in combo:
            used[part] = used.get(part, 0) + n
    assert all(used[p] <= histogram[p] for p in used)
    assert sum(n for _, n in chosen) >= 0.6 * sum(k * v for k, v in histogram.items()) / 32
    assert packing.plan({}, 32, 3) == []
