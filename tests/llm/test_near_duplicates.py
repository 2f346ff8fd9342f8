"""Near duplicates and components against brute force."""

from __future__ import annotations

import random

import numpy as np

from conftest import SF_SMALL
from ledgermatch.llm import minhash
from ledgermatch.llm.components import components
from ledgermatch.llm.queries import QUERIES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in (text or "").translate(LOWER)).split(" ") if w]


def shingles(text):
    w = words(text)
    if not w:
        return frozenset()
    return frozenset([tuple(w)]) if len(w) < 4 else frozenset(tuple(w[i:i + 4]) for i in range(len(w) - 3))


def brute(rows):
    """{doc_id: (n_shingles, component)} for unique ids."""
    sets = {d: shingles(t) for d, t in rows}
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    where = {}
    for d, s in sets.items():
        for x in s:
            where.setdefault(x, []).append(d)
    for d, s in sets.items():
        for e in {e for x in s for e in where[x] if e > d}:
            common = len(s & sets[e])
            if 100 * common >= 80 * (len(s) + len(sets[e]) - common):
                a, b = find(d), find(e)
                parent[max(a, b)] = min(a, b)
    return {d: (len(s), find(d)) for d, s in sets.items()}


def test_query_against_brute_force(spark):
    sf = SF_SMALL.replace("0.001", "0.01")
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = brute(rows)
    got = QUERIES["op3_near_duplicates"](spark, sf).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want and len(got) == len(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def planted(seed, groups=12, size=9):
    """Copies at many similarities, around the limit above all."""
    rng = random.Random(seed)
    rows, vocabulary = [], [f"w{i}" for i in range(3000)]
    for _ in range(groups):
        base = [rng.choice(vocabulary) for _ in range(rng.choice((5, 30, 120, 400)))]
        for _ in range(size):
            own = list(base)
            for _ in range(rng.randrange(0, 1 + len(base) // 18)):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            rows.append(" ".join(own))
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_planted_copies(spark, monkeypatch):
    rows = planted(1)
    want = brute(rows)
    assert 12 < len({c for _, c in want.values()}) < len(rows)
    for weight in (minhash.BLOCK_WEIGHT, 1500):  # one block a group, and many
        monkeypatch.setattr(minhash, "BLOCK_WEIGHT", weight)
        got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want


def test_odd_rows(spark):
    base = " ".join(f"x{i}" for i in range(40))
    rows = [(1, None, "k"), (2, "", "k"), (3, " \n\t ", "k"), (4, "One two", "k"), (5, "one\x0btwo", "k"), (6, base, None), (None, base, "k"),
            (7, base.upper(), "k"), (8, "one two three", "k"), (9, "one\x85two three", "k"), (10, base, "k"), (10, base, "k"), (11, "aa bb cc dd ee", "k"),
            (12, "solo text that stands for itself", "k"), (12, "solo text that stands for itself", "k"), (13, "left words of one id", "k"),
            (14, "right words of one id", "k"), (15, "left words of one id", "k"), (15, "right words of one id", "k")]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id string").selectExpr("*", "1 AS node", "2 AS bands")
    got = sorted(map(tuple, minhash.near_duplicates(df).select("doc_id", "n_shingles", "component_id", "kept").collect()), key=repr)
    want = [(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (5, 1, 4, False), (6, 37, 6, True), (7, 37, 6, False),
            (8, 1, 8, True), (9, 1, 9, True), (10, 37, 6, False), (10, 37, 6, False), (11, 2, 11, True), (12, 3, 12, True), (12, 3, 12, True),
            (13, 2, 13, True), (14, 2, 13, False), (15, 2, 13, False), (15, 2, 13, False), (None, 37, None, True)]
    assert got == sorted(want, key=repr)
    left = minhash.deduplicate(df)
    assert left.columns == df.columns
    assert sorted((r.doc_id for r in left.collect()), key=repr) == sorted([1, 2, 3, 4, 6, None, 8, 9, 11, 12, 13], key=repr)
    assert minhash.near_duplicates(df.limit(0)).collect() == []


def test_connect_finds_every_group():
    rng = random.Random(5)
    for _ in range(30):
        sets = []
        for _ in range(rng.randrange(2, 25)):
            base = list(sets[rng.randrange(len(sets))]) if sets and rng.random() < 0.7 else [rng.randrange(1 << 40) for _ in range(rng.randrange(1, 40))]
            for _ in range(rng.randrange(0, 1 + len(base) // 6)):
                base[rng.randrange(len(base))] = rng.randrange(1 << 40)
            sets.append(np.unique(np.array(base, np.uint64)))
        links = minhash.connect(np.arange(len(sets)), sets)
        parent = list(range(len(sets)))

        def find(x, parent=parent):
            while parent[x] != x:
                x = parent[x]
            return x

        want = list(range(len(sets)))
        for i in range(len(sets)):
            for j in range(i):
                common = len(np.intersect1d(sets[i], sets[j]))
                if 100 * common >= 80 * (len(sets[i]) + len(sets[j]) - common):
                    a, b = want[i], want[j]
                    want = [min(a, b) if x in (a, b) else x for x in want]
        for i, j in links:
            common = len(np.intersect1d(sets[i], sets[j]))
            assert 100 * common >= 80 * (len(sets[i]) + len(sets[j]) - common)
            a, b = find(i), find(j)
            parent[max(a, b)] = min(a, b)
        assert [find(i) for i in range(len(sets))] == want
        assert len(links) <= len(sets) - 1


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(1000, 1000 + i) for i in range(300)] + [(2000 + i, 2001 + i) for i in range(60)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
