"""Connected components by alternating large and small stars; every step is a join, no hub is one task's group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermatch.llm.common import cut, release

MAX_ROUNDS = 60


def _lowest(pairs: DataFrame) -> DataFrame:
    """(u, v, m): each pair with the smallest neighbour m of u. The minimum is pre-aggregated; a hub's pairs may be split."""
    low = pairs.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "__u")
    return pairs.join(low, F.col("u") == F.col("__u")).select("u", "v", F.least("m", "u").alias("m"))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b); the component is its smallest node."""
    pairs = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    state = None
    for _ in range(MAX_ROUNDS):
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Large star: the larger neighbours of u point to the smallest.
        large = _lowest(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # Small star: u and its smaller neighbours point to the smallest.
        small = _lowest(large)
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        pairs = cut(small)
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
        del both, large, small
        release(pairs.sparkSession)
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    roots = pairs.select("v").distinct()
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.select(F.col("v").alias("node"), F.col("v").alias("component")))
