"""Vector search against all products of all rows."""

from __future__ import annotations

import math
import random

import pytest

from ledgermatch.llm import vector_search as vs

NAN, INF = float("nan"), float("inf")


def plain(rows, every=20, k=20):
    own = {}
    for vec_id, v in rows:
        if vec_id is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            w = [math.floor(64 * x) for x in v]
            own[vec_id] = min(own.get(vec_id, w), w)
    out = []
    for q, v in own.items():
        if q % every == 0:
            found = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in own.items() if i != q)
            out += [(q, rank, i, -s) for rank, (s, i) in enumerate(found[:k], 1)]
    return sorted(out)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, score long, route int")
    return sorted(tuple(r) for r in vs.search_embeddings(df, **kw).collect())


@pytest.fixture
def small(monkeypatch):
    """Many nodes, pages, blocks and groups from few rows."""
    for name, value in {"SAMPLE": 40, "ROWS_PER_ROUTE": 30, "NODE": 32, "PAGE": 8, "BLOCK": 4, "TASK_BLOCKS": 2, "TASK_NODES": 2}.items():
        monkeypatch.setattr(vs, name, value)


def vectors(n, dims, seed, spread=1.0):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 2) for _ in range(dims)] for _ in range(6)]
    return [(i, [c + rng.gauss(0, spread) for c in rng.choice(centres)]) for i in range(n)]


def test_random_vectors_of_one_node(spark):
    rows = vectors(300, 8, 1)
    assert run(spark, rows) == plain(rows)


def test_many_nodes_and_blocks(spark, small):
    rows = vectors(400, 6, 2, 0.2)
    assert run(spark, rows, every=5, k=7) == plain(rows, 5, 7)


def test_hot_vector_and_ties(spark, small):
    rng = random.Random(3)
    rows = [(i, [1.0, 2.0, -1.0]) for i in range(0, 300, 2)] + [(i, [rng.choice([-1.0, 0.0, 1.0]) for _ in range(3)]) for i in range(1, 300, 2)]
    assert run(spark, rows, every=10, k=5) == plain(rows, 10, 5)


def test_odd_rows(spark, small):
    rows = vectors(90, 4, 4) + [(None, [1.0] * 4), (1000, None), (1020, [1.0, None, 0.0, 0.0]), (1040, [NAN, 0.0, 0.0, 0.0]), (1060, [INF, 0.0, 0.0, 0.0]),
                                (1080, []), (1100, [0.5]), (1120, [0.0] * 4), (20, [9.0, 9.0, 9.0, 9.0]), (20, [9.0, 9.0, 9.0, 9.0]), (-40, [0.1, -0.1, 3.0, 4.0])]
    assert run(spark, rows) == plain(rows)


def test_fewer_candidates_than_asked_and_empty_tables(spark):
    rows = [(0, [1.0, 0.0]), (20, [0.5, 0.5]), (3, [-1.0, 0.25])]
    assert run(spark, rows) == plain(rows)
    assert run(spark, [(20, [1.0])]) == [] and run(spark, []) == [] and run(spark, [(1, [1.0]), (2, [2.0])]) == []


def test_products_beyond_a_double(spark, small):
    rows = [(i, [float((1 << 23) + i), float((1 << 22) - 3 * i), 1.0]) for i in range(60)]
    assert run(spark, rows) == plain(rows)


def test_bounds_spare_computations(spark):
    """On clustered rows most pages are left out, and nothing is lost by it."""
    import numpy as np
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(40, 8)) * 400
    data = np.floor(centres[rng.integers(0, 40, 4000)] + rng.normal(size=(4000, 8)) * 4)
    space = vs.Space(4000, 8, float((data ** 2).sum(1).max()), float(np.abs(data).max()), np.arange(4000), data[:1000])
    schema = ["vec_id", "route", "far", "v"]
    import pyarrow as pa
    far = space.distances(space.lifted(data), space.routes)
    rows = sorted(zip(range(4000), far.argmin(1).tolist(), far.min(1).tolist(), [v.tobytes() for v in data]), key=lambda r: (r[1], r[2], r[0]))
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], schema)
    seen = []

    class Counted(vs.Space):
        def products(self, queries, found):
            seen.append(len(queries) * len(found))
            return super().products(queries, found)

    counted = Counted(4000, 8, space.square, space.largest, space.ids, space.sample)
    from unittest import mock
    with mock.patch.object(vs, "_number", lambda: 0):
        nodes = [vs._Node(counted, row) for b in vs._nodes(counted, 1)([batch]) for row in b.to_pylist()]
    ids = np.arange(0, 4000, 20)
    scores = data[ids] @ data.T
    scores[np.arange(len(ids)), ids] = -np.inf
    bound = np.sort(scores, axis=1)[:, -40].astype(np.int64)
    best = vs._search(counted, nodes, ids, data[ids], bound, 20)
    order = np.lexsort((np.broadcast_to(np.arange(4000), scores.shape), -scores), axis=-1)[:, :20]
    assert (best.found == order).all()
    assert sum(seen) < 0.5 * len(ids) * 4000
