"""Exact best inner products by an M-tree.

With M the largest norm, a vector x gets the further component sqrt(M^2 - |x|^2) and a query q a 0. Then
d(q, x)^2 = |q|^2 + M^2 - 2 q.x is a metric distance, and the highest products are the nearest objects.

The tree has three levels of paged nodes. Routing objects are a bounded sample of the rows; every row goes to its nearest one
and carries that parent distance. Rows in order of (routing object, parent distance) are cut into nodes of ``NODE`` rows, each
a ring of parent distances; a node is split by halves between two far objects until its pages have ``PAGE`` rows. A page has
a routing object, a covering radius, its distance to the parent, and its members' distances to it. Equal vectors are told
apart by their ids, so a vector that a third of the rows share spreads over many nodes.

Blocks of queries meet groups of nodes in a grid of tasks, each of bounded size. A task visits its pages best first: those
whose lower bound (ring, parent distance, covering radius) lies within a query's bound, of these the members whose stored
distance lets them be near enough. A query starts with the bound that the sample gives it. The answer is exact: products are
whole numbers, and bounds give way by ``SLACK``.

Rows without id, without vector, or with a null or non-finite component take no part. Of rows with one id the smallest
vector counts. A vector of fewer components than others has zeros there. An empty table, or one without queries, gives no
rows. Products have to fit a long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgermatch.llm.common import fresh_path

#: Rows of the sample: routing objects and the first bounds of the queries. At most ``SAMPLE_NUMBERS`` components in all.
SAMPLE, SAMPLE_NUMBERS = 4096, 1 << 20
#: Of these, the routing objects: one for so many rows, and so many at most.
ROWS_PER_ROUTE, ROUTES = 1024, 256
NODE, PAGE = 2048, 128
#: Queries of a block, blocks and nodes of a task.
BLOCK, TASK_BLOCKS, TASK_NODES = 256, 8, 16
#: Part of |q|^2 + M^2 by which a bound may be wrong in floating point.
SLACK = 1e-9


def whole_parts(vector: str, factor: int = 64) -> Column:
    """floor(factor * x) of every component, as doubles; null for a vector that is null or holds a null or non-finite component."""
    x = F.col(vector)
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v.cast("double")) | (F.abs(v.cast("double")) == F.lit(float("inf"))))
    return F.when(x.isNotNull() & ~bad, F.transform(x, lambda v: F.floor(F.lit(factor) * v.cast("double")).cast("double")))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """The lists of an Arrow column as rows of one matrix, padded with zeros or cut to ``dims`` (where all points have zeros)."""
    lengths = np.asarray(pc.list_value_length(column))
    out = np.zeros((len(column), dims))
    flat = np.asarray(column.flatten())
    if len(flat) == len(column) * dims:
        return flat.reshape(len(column), dims).astype(float)
    at = np.cumsum(lengths) - lengths
    for i, (a, n) in enumerate(zip(at.tolist(), lengths.tolist(), strict=True)):
        out[i, :n] = flat[a:a + n][:dims]
    return out


class Space:
    """Sizes of the data and the sample; small, goes to every task."""

    def __init__(self, rows: int, dims: int, square: float, largest: float, ids: np.ndarray, sample: np.ndarray):
        self.rows, self.dims, self.square, self.largest, self.ids, self.sample = rows, dims, square, largest, ids, sample
        self.routes = self.lifted(sample[:max(1, min(ROUTES, -(-rows // ROWS_PER_ROUTE)))]) if len(sample) else np.zeros((0, dims + 1))

    def lifted(self, vectors: np.ndarray) -> np.ndarray:
        return np.column_stack([vectors, np.sqrt(np.maximum(self.square - (vectors ** 2).sum(1), 0))])

    def distances(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Between objects of the lifted space, a query being one with a last component of 0."""
        return np.sqrt(np.maximum((a ** 2).sum(1)[:, None] + (b ** 2).sum(1)[None, :] - 2 * (a @ b.T), 0))

    def products(self, queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
        """Whole inner products as longs; sums that a double cannot hold are made from Python's integers."""
        if self.largest ** 2 * max(self.dims, 1) < 2.0 ** 53:
            return (queries @ vectors.T).astype(np.int64)
        exact = [[int(x) for x in v] for v in vectors.tolist()]
        return np.array([[sum(int(a) * b for a, b in zip(q, v, strict=True)) for v in exact] for q in queries.tolist()],
                        dtype=np.int64).reshape(len(queries), len(vectors))


def measure(points: DataFrame) -> Space:
    """One pass for the sizes and one bounded sample by the hash of the ids."""
    n, dims, square, largest = points.agg(
        F.count("*"), F.max(F.size("v")), F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)),
        F.max(F.aggregate("v", F.lit(0.0), lambda s, x: F.greatest(s, F.abs(x))))).first()
    dims = dims or 0
    some = points.orderBy(F.xxhash64("vec_id"), "vec_id").limit(max(1, min(SAMPLE, SAMPLE_NUMBERS // max(dims, 1)))).collect()
    sample = np.zeros((len(some), dims))
    for i, row in enumerate(some):
        sample[i, :len(row.v)] = row.v
    return Space(n, dims, square or 0.0, largest or 0.0, np.array([r.vec_id for r in some], np.int64), sample)


def _route(space: Space, lift: bool):
    """Nearest routing object and the distance to it, and the vector as bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = _matrix(batch.column("v"), space.dims)
            far = space.distances(space.lifted(vectors) if lift else np.column_stack([vectors, np.zeros(len(vectors))]), space.routes)
            route = far.argmin(1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(route.astype(np.int32)), pa.array(far[np.arange(len(far)), route]),
                 pa.array([v.tobytes() for v in vectors], pa.binary())], ["vec_id", "route", "far", "v"])
    return run


def _pages(lifted: np.ndarray) -> list[np.ndarray]:
    """Rows of the pages of a node: halves between two far objects, as long as they are too large."""
    todo, done = [np.arange(len(lifted))], []
    while todo:
        rows = todo.pop()
        if len(rows) <= PAGE:
            done.append(rows)
            continue
        own = lifted[rows]
        one = own[((own - own[0]) ** 2).sum(1).argmax()]
        other = own[((own - one) ** 2).sum(1).argmax()]
        order = rows[np.argsort(own @ (other - one), kind="stable")]
        todo += [order[:len(order) // 2], order[len(order) // 2:]]
    return done


def _number() -> int:
    """First number of a task's nodes or blocks; the groups they are dealt to differ from task to task."""
    return TaskContext.get().partitionId() * 7919


def _nodes(space: Space, dealt: int):
    """Rows in order of (route, far) become nodes; ``part`` deals them into groups that one task can hold."""
    def node(rows: list[tuple], number: int) -> dict:
        ids = np.array([r[0] for r in rows], np.int64)
        far = np.array([r[2] for r in rows])
        vectors = np.array([np.frombuffer(r[3]) for r in rows]).reshape(len(rows), space.dims)
        lifted = space.lifted(vectors)
        pages = _pages(lifted)
        order = np.concatenate(pages)
        heads, radius, inner = [], [], np.empty(len(rows))
        for page in pages:
            head = page[((lifted[page] - lifted[page].mean(0)) ** 2).sum(1).argmin()]
            own = np.sqrt(((lifted[page] - lifted[head]) ** 2).sum(1))
            inner[page] = own
            heads.append(head)
            radius.append(own.max())
        return {"part": number % dealt, "route": rows[0][1], "low": float(far.min()), "high": float(far.max()),
                "sizes": np.array([len(p) for p in pages], np.int64).tobytes(), "heads": lifted[heads].tobytes(),
                "radius": np.array(radius).tobytes(), "far": far[heads].tobytes(), "inner": inner[order].tobytes(),
                "ids": ids[order].tobytes(), "v": vectors[order].tobytes()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        number = _number()
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("vec_id", "route", "far", "v")), strict=True):
                if held and (row[1] != held[0][1] or len(held) == NODE):
                    yield pa.RecordBatch.from_pylist([node(held, number)], _NODE_ARROW)
                    held, number = [], number + 1
                held.append(row)
        if held:
            yield pa.RecordBatch.from_pylist([node(held, number)], _NODE_ARROW)
    return run


_NODE_FIELDS = {"part": "long", "route": "int", "low": "double", "high": "double", "sizes": "binary", "heads": "binary", "radius": "binary",
                "far": "binary", "inner": "binary", "ids": "binary", "v": "binary"}
_NODE_SCHEMA = ", ".join(f"{k} {t}" for k, t in _NODE_FIELDS.items())
_NODE_ARROW = pa.schema([(k, {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "binary": pa.binary()}[t])
                         for k, t in _NODE_FIELDS.items()])


def _blocks(space: Space, k: int, dealt: int):
    """Queries in order of (route, far) become blocks, each query with the bound that the sample gives."""
    def block(rows: list[tuple], number: int) -> dict:
        ids = np.array([r[0] for r in rows], np.int64)
        vectors = np.array([np.frombuffer(r[3]) for r in rows]).reshape(len(rows), space.dims)
        bound = np.full(len(rows), np.iinfo(np.int64).min)
        if len(space.sample) > k:
            scores = space.products(vectors, space.sample)
            scores[ids[:, None] == space.ids[None, :]] = np.iinfo(np.int64).min
            bound = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
        return {"part": number % dealt, "ids": ids.tobytes(), "v": vectors.tobytes(), "bound": bound.astype(np.int64).tobytes()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        number = _number()
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("vec_id", "route", "far", "v")), strict=True):
                if len(held) == BLOCK:
                    yield pa.RecordBatch.from_pylist([block(held, number)], _BLOCK_ARROW)
                    held, number = [], number + 1
                held.append(row)
        if held:
            yield pa.RecordBatch.from_pylist([block(held, number)], _BLOCK_ARROW)
    return run


_BLOCK_ARROW = pa.schema([("part", pa.int64()), ("ids", pa.binary()), ("v", pa.binary()), ("bound", pa.binary())])


class _Best:
    """The k best of each query of a block so far, and the score that a candidate has to reach."""

    def __init__(self, ids: np.ndarray, bound: np.ndarray, k: int):
        self.ids, self.k = ids, k
        self.scores = np.full((len(ids), k), np.iinfo(np.int64).min)
        self.found = np.full((len(ids), k), np.iinfo(np.int64).max)
        self.bound = bound.copy()

    def offer(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """``scores`` of the queries ``rows`` against the vectors ``ids``."""
        worst, last = self.scores[rows, -1][:, None], self.found[rows, -1][:, None]
        better = (scores >= self.bound[rows][:, None]) & ((scores > worst) | ((scores == worst) & (ids[None, :] < last)))
        better &= ids[None, :] != self.ids[rows][:, None]
        some = np.flatnonzero(better.any(1))
        if not len(some):
            return
        rows, better = rows[some], better[some]
        width = int(better.sum(1).max())
        # A row's candidates come first, in order of their places; the others of the row count for nothing.
        pick = np.argsort(~better, axis=1, kind="stable")[:, :width]
        fits = np.take_along_axis(better, pick, 1)
        s = np.where(fits, np.take_along_axis(scores[some], pick, 1), np.iinfo(np.int64).min)
        i = np.where(fits, ids[pick], np.iinfo(np.int64).max)
        s, i = np.concatenate([self.scores[rows], s], 1), np.concatenate([self.found[rows], i], 1)
        order = np.lexsort((i, ~s), axis=-1)[:, :self.k]  # ~s falls as s rises, for every long
        self.scores[rows], self.found[rows] = np.take_along_axis(s, order, 1), np.take_along_axis(i, order, 1)
        self.bound[rows] = np.maximum(self.bound[rows], self.scores[rows, -1])


class _Node:
    def __init__(self, space: Space, row: dict):
        self.route, self.low, self.high = row["route"], row["low"], row["high"]
        self.heads = np.frombuffer(row["heads"]).reshape(-1, space.dims + 1)
        self.radius, self.far, self.inner = (np.frombuffer(row[c]) for c in ("radius", "far", "inner"))
        self.ids, self.v = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["v"]).reshape(len(row["ids"]) // 8, space.dims)
        ends = np.cumsum(np.frombuffer(row["sizes"], np.int64))
        self.pages = [slice(int(e - n), int(e)) for e, n in zip(ends, np.frombuffer(row["sizes"], np.int64), strict=True)]


def _search(space: Space, nodes: list[_Node], ids: np.ndarray, queries: np.ndarray, bound: np.ndarray, k: int) -> _Best:
    """Best-first over the pages of ``nodes`` for one block of queries."""
    best = _Best(ids, bound, k)
    at = np.column_stack([queries, np.zeros(len(queries))])
    reach = (queries ** 2).sum(1) + space.square
    slack = SLACK * (reach + 1)

    def possible(rows: np.ndarray, least: np.ndarray) -> np.ndarray:
        """May objects at distance ``least`` or more still be among the best of the queries ``rows``?"""
        shape = (-1,) + (1,) * (least.ndim - 1)
        most = (reach[rows].reshape(shape) - np.maximum(least, 0) ** 2) / 2 + slack[rows].reshape(shape)
        return most >= best.bound[rows].astype(float).reshape(shape)

    everyone = np.arange(len(ids))
    to_route = space.distances(at, space.routes)
    queue = []
    for node in nodes:
        far = to_route[:, node.route]
        ring = np.maximum(far - node.high, node.low - far)
        # The parent distance of a page bounds its members without a distance of their own.
        parent = np.maximum(np.abs(far[:, None] - node.far[None, :]) - node.radius[None, :], ring[:, None])
        queue += [(float(np.sort(parent[:, p])[len(ids) // 4]), node, p, parent[:, p]) for p in range(len(node.pages))]
    queue.sort(key=lambda x: x[0])
    for _, node, p, least in queue:
        rows = everyone[possible(everyone, least)]
        if not len(rows):
            continue
        to_head = space.distances(at[rows], node.heads[p:p + 1])[:, 0]
        near = possible(rows, np.maximum(to_head - node.radius[p], least[rows]))
        rows, to_head = rows[near], to_head[near]
        if not len(rows):
            continue
        members = np.arange(node.pages[p].start, node.pages[p].stop)
        members = members[possible(rows, np.abs(to_head[:, None] - node.inner[None, members])).any(0)]
        if len(members):
            best.offer(rows, space.products(queries[rows], node.v[members]), node.ids[members])
    return best


def nearest(points: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows of ``points`` with the highest product for every row of ``queries``.

    Both have vec_id and v (whole numbers as doubles, ``whole_parts``); a query's own id is not among its results, ties go
    to the smaller id. The rows, nodes and blocks are written to the shared folder.
    """
    spark: SparkSession = points.sparkSession
    points, queries = _one_per_id(points), _one_per_id(queries)
    path = fresh_path(spark, "points")
    points.write.parquet(path)
    points = spark.read.parquet(path)
    space = measure(points)
    schema = "vec_id long, route int, far double, v binary"
    n_queries = queries.count() if space.rows else 0
    if not n_queries:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    node_parts = max(1, -(-space.rows // (NODE * TASK_NODES // 2)))
    block_parts = max(1, -(-n_queries // (BLOCK * TASK_BLOCKS // 2)))

    def placed(df: DataFrame, lift: bool) -> DataFrame:
        order = ["route", "far", "vec_id"]
        return df.mapInArrow(_route(space, lift), schema).repartitionByRange(*order).sortWithinPartitions(*order)

    tree, blocks = fresh_path(spark, "tree"), fresh_path(spark, "queries")
    placed(points, True).mapInArrow(_nodes(space, node_parts), _NODE_SCHEMA).write.parquet(tree)
    placed(queries, False).mapInArrow(_blocks(space, k, block_parts), "part long, ids binary, v binary, bound binary").write.parquet(blocks)

    # The grid: every group of blocks meets every group of nodes once, a group being a bounded number of either.
    grid_blocks = spark.read.parquet(blocks).withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(node_parts - 1)).cast("array<long>")))
    grid_nodes = spark.read.parquet(tree).withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(block_parts - 1)).cast("array<long>")))

    def task(left: pa.Table, right: pa.Table) -> pa.Table:
        nodes = [_Node(space, row) for row in right.to_pylist()]
        out = []
        for row in left.to_pylist():
            ids = np.frombuffer(row["ids"], np.int64)
            best = _search(space, nodes, ids, np.frombuffer(row["v"]).reshape(len(ids), space.dims), np.frombuffer(row["bound"], np.int64), k)
            true = best.found != np.iinfo(np.int64).max
            out.append(pd.DataFrame({"query_id": np.repeat(ids, true.sum(1)), "vec_id": best.found[true], "score": best.scores[true]}))
        return pa.Table.from_pandas(pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64"),
                                    preserve_index=False)

    left = grid_blocks.select(F.col("part").alias("blocks"), F.col("other").alias("nodes"), "ids", "v", "bound")
    right = grid_nodes.withColumnsRenamed({"part": "nodes", "other": "blocks"})
    found = left.groupBy("blocks", "nodes").cogroup(right.groupBy("blocks", "nodes")).applyInArrow(task, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _one_per_id(df: DataFrame) -> DataFrame:
    return df.where("vec_id IS NOT NULL AND v IS NOT NULL").groupBy(F.col("vec_id").cast("long").alias("vec_id")).agg(F.min("v").alias("v"))


def search_embeddings(embeddings: DataFrame, every: int = 20, k: int = 20) -> DataFrame:
    """``nearest`` over the whole parts of 64 times the components; queries are the rows whose id is divisible by ``every``."""
    points = embeddings.select("vec_id", whole_parts("embedding").alias("v"))
    return nearest(points, points.where(F.col("vec_id") % every == 0), k)
