"""Codes and whitening of vectors against plain versions on whole tables and on odd rows."""

from __future__ import annotations

import math
from collections import defaultdict
from hashlib import sha256

import duckdb
import numpy as np
import pytest

from boxmill.llm import queries, vector_codes, whitening
from boxmill.llm.vector_codes import Codebooks

SCHEMA = "vec_id long, embedding array<double>, label int, x string, error string, n int"
NAN, INF = float("nan"), float("inf")


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "e", 7) for r in rows], SCHEMA)


def floors(rows):
    return [(i, [math.floor(256 * c) for c in v], label) for i, v, label in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]


def plain_codes(rows, parts, size, rounds):
    """(id, code, error, label error, digest) of every kept row."""
    kept = floors(rows)
    width = len(kept[0][1]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, v, _ in kept]
    order = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0, kept[k][1]))[:size]
    books = [[cut[k][p] for k in order] for p in range(parts)]
    square = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    nearest = lambda: [[min((square(c[p], e), k) for k, e in enumerate(books[p])) for p in range(parts)] for c in cut]
    for _ in range(rounds):
        of = nearest()
        for p in range(parts):
            for e in range(len(books[p])):
                mine = [c[p] for c, o in zip(cut, of, strict=True) if o[p][1] == e]
                books[p][e] = [sum(x) // len(mine) for x in zip(*mine, strict=True)] if mine else books[p][e]
    of = nearest()
    digest = sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    errors = [sum(d for d, _ in o) for o in of]
    by_label = defaultdict(int)
    for (_, _, label), e in zip(kept, errors, strict=True):
        by_label[label] += e
    return sorted([(i, "".join(f"{k:02x}" for _, k in o), e, by_label[label], digest) for (i, _, label), o, e in zip(kept, of, errors, strict=True)], key=str)


def test_nearest_entries_are_exact():
    r = np.random.default_rng(0)
    for low in (2, 5, 400):
        entries = r.integers(-low, low, (3, 40, 4))
        entries[1, 20:] = entries[1, :20]  # equal entries
        books = Codebooks(entries, [0, 4, 8, 12])
        x = books.cut(r.integers(-2 * low, 2 * low, (500, 12)))
        squares = ((x[:, :, None, :] - entries[None]) ** 2).sum(axis=3)
        for start in (np.zeros((500, 3), np.int64), r.integers(0, 40, (500, 3)), squares.argmin(axis=2)):
            found, least = books.nearest(x, start)
            assert (found == squares.argmin(axis=2)).all() and (least == squares.min(axis=2)).all()


def test_components_that_squares_cannot_hold():
    with pytest.raises(ValueError, match="64 bits"):
        Codebooks(np.zeros((1, 1, 4), np.int64), [0, 4]).cut(np.array([[1 << 31, 0, 0, 0]]))


def odd_vectors():
    r = np.random.default_rng(3)
    rows = [(int(i), [float(v) for v in r.integers(-300, 300, 8) / 100], int(r.integers(0, 3)) if r.random() < 0.8 else None) for i in r.permutation(90)]
    rows += [rows[0], rows[0], (None, rows[1][1], 1), (None, rows[2][1], None), (500, [1.0] * 8, 1), (501, [1.0] * 8, 1), (502, [-0.001] * 8, 1), (503, [-0.0] * 8, 2)]
    return rows + [(600, None, 1), (601, [1.0, None] + [0.0] * 6, 1), (602, [NAN] + [0.0] * 7, 1), (603, [INF] + [0.0] * 7, 1)]


def short_rows(spark, coded, books):
    named = vector_codes.with_label_error(coded).collect()
    return sorted([(r.vec_id, "".join(f"{e:02x}" for e in r.entries), r.error, r.label_error, books.digest()) for r in named], key=str)


def test_codes_of_odd_rows(spark):
    rows = odd_vectors()
    coded, books = vector_codes.compress(table(spark, rows + [(604, [1.0] * 5, 0), (605, [], 0)]).repartition(5), parts=4, entries=9)
    assert short_rows(spark, coded, books) == plain_codes(rows, 4, 9, 2)
    few = [(1, [0.5, 1.0], 1), (2, [0.25, 3.0], None)]
    coded, books = vector_codes.compress(table(spark, few), parts=2)
    assert short_rows(spark, coded, books) == plain_codes(few, 2, 64, 2)
    # A length that the parts do not divide: some parts are longer, some empty.
    coded, books = vector_codes.compress(table(spark, few), parts=3)
    assert books.bounds == [0, 0, 1, 2] and sorted((r.vec_id, r.error) for r in coded.collect()) == [(1, 0), (2, 0)]
    empty, none = vector_codes.compress(table(spark, []))
    assert none is None and vector_codes.with_label_error(empty).collect() == []


def test_codes_of_the_whole_table(spark, sf_dir):
    rows = [(r.vec_id, list(r.embedding), r.label) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    expected = plain_codes(rows, 16, 64, 2)
    assert sorted(map(tuple, queries.op12_vector_codes(spark, sf_dir).collect()), key=str) == expected
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{sf_dir}/embeddings.parquet'")
    assert sorted(con.sql(queries.ORACLE_SQL["op12_vector_codes"]).fetchall(), key=str) == expected


def held_against_plain(rows, got, model, components):
    kept = floors(rows)
    fit = np.array(sorted({tuple(v) for _, v, _ in kept}), np.int64)
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    assert model.n == n and model.sums == sums.tolist()
    assert np.allclose(model.explained, values / np.trace(covariance), rtol=1e-9, atol=1e-15)
    assert model.identity_error < 1e-9
    known = values > 1e-9 * values[0]
    assert (model.known == known).all()
    of = defaultdict(list)
    for i, v, _ in kept:
        of[i].append(v)
    signs = np.sign((model.vectors * vectors).sum(axis=0))
    assert len(got) == len(kept)
    for r in got:
        choices = []
        for v in of[r.vec_id]:
            exact = sum((n * int(x) - int(s)) ** 2 for x, s in zip(v, sums, strict=True))
            made = (np.array(v) - sums / n) @ vectors[:, known] / np.sqrt(values[known]) * signs[known]
            choices.append(exact == int(r.deviation) and np.allclose(made, [w for w in r.whitened if w is not None], atol=1e-9))
        assert any(choices) and [w is not None for w in r.whitened] == known.tolist()


def test_whitening_of_odd_rows(spark):
    rows = odd_vectors()
    made, model = whitening.whiten(table(spark, rows + [(604, [1.0] * 5, 0)]).repartition(5))
    held_against_plain(rows, made.collect(), model, 4)
    # Three vectors have two components only.
    few = [(k, [float(k * k), float(k), 1.0, 2.0, 0.0], 1) for k in range(3)] + [(0, [0.0, 0.0, 1.0, 2.0, 0.0], 1)]
    made, model = whitening.whiten(table(spark, few))
    held_against_plain(few, made.collect(), model, 4)
    made, model = whitening.whiten(table(spark, few[:1]))
    assert [(r.vec_id, int(r.deviation), r.whitened) for r in made.collect()] == [(0, 0, [None] * 4)] and model.identity_error is None
    empty, none = whitening.whiten(table(spark, [(1, None, 1)]))
    assert empty.collect() == [] and none is None


def test_deviations_beyond_64_bits(spark):
    rows = [(1, [1e12, 0.0], 1), (2, [-1e12, 0.5], 1), (3, [0.0, 3.0], None)]
    made, model = whitening.whiten(table(spark, rows))
    held_against_plain(rows, made.collect(), model, 2)


def test_whitening_of_the_whole_table(spark, sf_dir):
    rows = [(r.vec_id, list(r.embedding), r.label) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    made, model = whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    held_against_plain(rows, made.collect(), model, 4)
    got = queries.op13_whitened(spark, sf_dir).collect()
    assert len(got) == 4 * len(rows) and {r.component for r in got} == {1, 2, 3, 4}
    assert {r.identity_error for r in got} == {model.identity_error} and all(r.deviation > 0 for r in got)
