"""Near-duplicate classes against all pairs of small tables."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

from boxmill.llm import neardup

SCHEMA = "doc_id long, text string"


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def classes(rows):
    """Least id reachable, over links of all pairs."""
    sets = {d: shingles(t) for d, t in rows}
    ids = sorted(sets)
    parent = {d: d for d in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in ids}


def documents(seed=1, n=150):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(1, 5)))
    rows = []
    for d in range(n):
        if rows and r.random() < 0.6:
            words = r.choice(rows[-30:])[1].split(" ")
            for _ in range(r.choice([0, 1, 2, 5, len(words) // 8])):
                words[r.randrange(len(words))] = word()
            rows.append((d, " ".join(words)))
        else:
            rows.append((d, " ".join(word() for _ in range(r.choice([3, 5, 8, 30, 90, 300])))))
    return rows


def result(spark, docs, **how):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(spark.createDataFrame(docs, SCHEMA), **how).collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_same_classes_as_all_pairs(spark, seed):
    rows = documents(seed)
    assert result(spark, rows) == classes(rows)


def test_a_chain_that_no_star_joins(spark):
    """Each document is near to its neighbours only; small blocks and the shuffle way give the same."""
    base = [f"w{i}" for i in range(120)]
    rows = []
    for d in range(24):
        for i in range(2):
            base[(d * 5 + i * 2) % 120] = f"x{d}-{i}"
        rows.append((d, " ".join(base)))
    rows = [(100 - d, t) for d, t in rows]
    assert result(spark, rows, broadcast_ids=3) == classes(rows)


def grouped(spark, links, nodes):
    """The components as sets, and how many tables a run of components() writes."""
    frame = lambda rows, schema: spark.createDataFrame(rows, schema)
    found = neardup.components(frame([(n,) for n in nodes], "node long"), frame(links, "a long, b long")).collect()
    assert len(found) == len(nodes)
    sets = {}
    for r in found:
        sets.setdefault(r.comp, set()).add(r.node)
    assert all(comp in own for comp, own in sets.items())
    return sorted(map(sorted, sets.values()))


def test_components_of_random_links_and_hubs(spark, monkeypatch):
    r = random.Random(3)
    nodes = list(range(300))
    links = [(r.randrange(300), r.randrange(300)) for _ in range(170)] + [(7, x) for x in range(100, 140)] + [(5, 5), (9, 8), (8, 9)]
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    expected = sorted(sorted(n for n in nodes if find(n) == root) for root in {find(n) for n in nodes})
    assert grouped(spark, links, nodes) == expected
    monkeypatch.setattr(neardup, "FINISH", 20)
    assert grouped(spark, links, nodes) == expected
    assert grouped(spark, [], [1, 2]) == [[1], [2]]


def test_an_ordered_path_takes_few_rounds(spark, monkeypatch):
    monkeypatch.setattr(neardup, "FINISH", 0)
    rounds = []
    monkeypatch.setattr(neardup, "hot_keys", lambda rows, key, of=neardup.hot_keys: rounds.append(key) or of(rows, key))
    assert grouped(spark, [(i, i + 1) for i in range(4095)], list(range(4096))) == [list(range(4096))]
    assert rounds.count("a") <= 2 * 15


def test_hot_rows_of_a_lookup_are_dealt_out(spark):
    from pyspark.sql import functions as F

    from boxmill.llm.common import hot_keys, join_lookup

    rows = spark.range(6000).select(F.when(F.col("id") < 3000, 0).otherwise(F.col("id")).alias("k"), "id", F.array("id").alias("held"))
    lookup = spark.range(4000).select(F.col("id").alias("k"), F.concat(F.lit("v"), F.col("id").cast("string")).alias("v"))
    hot = hot_keys(rows, "k")
    assert [tuple(r) for r in hot.collect()] == [(0, 500)]
    assert sorted((r.k, r.id, r.v) for r in join_lookup(rows, lookup, "k", hot).collect()) == sorted((0 if i < 3000 else i, i, f"v{0 if i < 3000 else i}") for i in range(4000))
    assert join_lookup(rows, lookup, "k", hot, how="left").filter("v is null").count() == 2000


def test_odd_rows(spark):
    long = " ".join(f"v{i}" for i in range(60_000))
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "a b"), (5, "A  B"), (6, "a b c"), (7, long), (8, long + " tail"), (9, None), (10, "É a"), (11, "é a"), (12, "a b")]
    got = result(spark, rows)
    assert got == classes(rows)
    assert [got[d] for d in (1, 2, 3)] == [(0, 1), (0, 2), (0, 3)]
    again = neardup.near_duplicates(spark.createDataFrame([(4, "a b"), (4, "a b"), (None, "a b"), (None, None)], SCHEMA)).collect()
    assert sorted((r.doc_id or 0, r.kept) for r in again) == [(0, True), (0, True), (4, True), (4, True)]
    assert neardup.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_one_id_on_several_texts(spark):
    """Every row comes out once, each in the class of its own text."""
    a, b = [" ".join(f"{x}{i}" for i in range(60)) for x in "ab"]
    rows = [(5, a), (5, b), (7, b + " tail"), (9, b + " end"), (3, a + " tail"), (9, None), (5, a)]
    got = sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in neardup.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == [(3, 57, 3, True), (5, 56, 3, False), (5, 56, 3, False), (5, 56, 5, True), (7, 57, 5, False), (9, 0, 9, True), (9, 57, 5, False)]
    kept = neardup.keep_one(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.doc_id, r.text or "") for r in kept) == [(3, a + " tail"), (5, b), (9, "")]


def test_a_crowded_bucket_of_unlinked_sets(spark, monkeypatch):
    """Sets that share much, but not enough, and a few pairs among them that no star joins; tiny blocks give the same."""
    r = random.Random(4)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for d in range(120):
        own = [f"x{d}-{i}" for i in range(r.randint(12, 40))]
        rows.append((d, " ".join(base + own)))
        if d % 10 == 3:
            rows.append((1000 + d, " ".join([*base, *own[:-1], "z"])))
    expected = classes(rows)
    assert result(spark, rows, bands=4, rows=1) == expected
    monkeypatch.setattr(neardup, "BLOCK", 7)
    assert result(spark, rows, bands=4, rows=1) == expected


def test_filter_keeps_all_columns(spark):
    df = spark.createDataFrame([(1, "a b c", 1, "x"), (2, "a b c", 2, "y"), (3, None, 3, "z")], f"{SCHEMA}, kept int, comp string")
    got = neardup.keep_one(df).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == [(1, "a b c", 1, "x"), (3, None, 3, "z")]


def test_links_between_blocks_are_exact():
    rng = np.random.default_rng(0)
    base = rng.integers(0, 2**60, 150, dtype=np.uint64)
    sets = []
    for _ in range(50):
        own = base.copy()
        k = int(rng.integers(0, 40))
        own[:k] = rng.integers(0, 2**60, k, dtype=np.uint64)
        sets.append(np.unique(own))
    import pandas as pd

    frame = lambda a, b: pd.DataFrame({"node": range(a, b), "comp": range(a, b), "hashes": [x.tobytes() for x in sets[a:b]]})
    expected = {(a, b) for a in range(20) for b in range(20, 50) if neardup.similar(sets[a], sets[b], 75)}
    assert neardup._links_between(frame(0, 20), frame(20, 50), 75) == expected


def test_sketch_agreement_is_near_the_similarity():
    rng = np.random.default_rng(1)
    sketch = neardup.Sketch(72, 6)
    for n in (40, 400, 3000):
        a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        b = np.unique(np.concatenate([a[: int(0.9 * n)], rng.integers(0, 2**63, n // 10, dtype=np.uint64)]))
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert abs((sketch.values(a) == sketch.values(b)).mean() - true) < 0.15
