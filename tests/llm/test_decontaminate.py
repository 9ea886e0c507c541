"""Passages against the full edit-distance table."""

from __future__ import annotations

import random

from boxmill.llm import decontaminate as dc

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def least_distance(pattern, text):
    """Edit distance to the nearest substring, by the whole table."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(pattern, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


def test_myers_distance():
    r = random.Random(0)
    for _ in range(150):
        p = "".join(r.choice("ab c") for _ in range(r.randint(1, 80)))
        t = "".join(r.choice("ab c") for _ in range(r.randint(0, 150)))
        assert dc.best_match(p, t)[0] == least_distance(p, t)


def cases(seed=1):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(2, 7)))
    items = [(i, " ".join(word() for _ in range(r.randint(12, 40)))) for i in range(8)]
    items += [(8, "abc bca cab hgf"[:15]), (9, "gabc hbca fcab ehgf"), (10, "dhgef cabba gfedh bacab hhgfe edcab"[:34])]  # 0, 1 and 2 edits
    docs = []
    for d in range(60):
        middle = list(r.choice(items)[1])
        for _ in range(r.choice([0, 1, 4, 8, 20])):
            middle[r.randrange(len(middle))] = r.choice("xyz")
        filler = [word() for _ in range(60)]
        docs.append((d, " ".join(filler[:30]) + " " + "".join(middle) * (d % 3 > 0) + " " + " ".join(filler[30:])))
    return docs, items


def test_all_passages_within_the_budget_and_no_others(spark):
    docs, items = cases()
    got = {(r.doc_id, r.item_id): r.distance for r in dc.find_passages(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)).collect()}
    expected = {}
    for d, t in docs:
        for i, b in items:
            p = dc.normalise(b)
            errors = int(len(p) * 0.06)
            if (k := least_distance(p, dc.normalise(t))) <= errors:
                expected[d, i] = k
    assert got == expected and len(expected) > 15


def test_blocks_of_items_give_the_same(spark):
    docs, items = cases(2)
    a, b = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)
    key = lambda df: sorted(tuple(r) for r in df.collect())
    assert key(dc.find_passages(a, b)) == key(dc.find_passages(a, b, block_bytes=150))
    gone = {r.doc_id for r in dc.find_passages(a, b).collect()}
    kept = dc.keep_uncontaminated(a, b, block_bytes=400)
    assert sorted(r.doc_id for r in kept.collect()) == [d for d, _ in docs if d not in gone]


def test_odd_rows(spark):
    text = "some words of a test item that is long enough to be found again"
    items = spark.createDataFrame([(1, text), (1, text), (2, None), (None, text), (3, ""), (4, "..")], ITEMS)
    docs = spark.createDataFrame([(1, None, 0), (2, "", 0), (3, f"x {text.upper()}!! y", 0), (3, text, 0), (None, text, 0), (5, "z " * 300_000 + text, 0)], f"{DOCS}, distance int")
    got = dc.find_passages(docs, items).collect()
    assert sorted((r.doc_id or 0, r.item_id, r.distance) for r in got) == sorted([(d, 1, 0) for d in (3, 3, 0, 5) for _ in range(2)])
    assert all(r.stop - r.start == len(text) for r in got)
    assert sorted(r.doc_id for r in dc.keep_uncontaminated(docs, items).collect()) == [1, 2]
    assert dc.find_passages(docs.limit(0), items).collect() == [] == dc.find_passages(docs, items.limit(0)).collect()
