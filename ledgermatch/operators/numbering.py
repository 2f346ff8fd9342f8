"""One bigint order key for rows that have an order, without a single task that sees them all."""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgermatch.session import written

#: ``monotonically_increasing_id`` holds the partition above these bits and the row's place in it below them.
_PLACE_BITS = 33


def number_rows(df: DataFrame, order: list[str | Column], out: str = "seq") -> DataFrame:
    """Add ``out``, the 0-based place of each row in the order of ``order`` over the whole frame.

    The rows are shuffled once, into sorted ranges that number their own rows, and written down with these
    numbers; a table with one row per range (as many as there are shuffle partitions) places the ranges after one
    another when the rows are read.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = written(ranged.withColumn("_own", F.monotonically_increasing_id()), "numbered").withColumn("_range", F.shiftright("_own", _PLACE_BITS))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy("_range").count().select(
        "_range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    return (placed.join(F.broadcast(totals), "_range")
            .withColumn(out, F.col("_before") + F.col("_own").bitwiseAND((1 << _PLACE_BITS) - 1)).drop("_range", "_own", "_before"))


#: Ranges of keys per shuffle partition: ranges are dealt by hash, several per task make the tasks even.
RANGES_PER_TASK = 8


def key_bounds(keys: DataFrame, key: str) -> list[float]:
    """Ascending inner bounds that cut the values of ``key`` into ranges of about equal counts (an estimate; no rule rests on it)."""
    n = RANGES_PER_TASK * int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = keys.select(F.percentile_approx(key, [i / n for i in range(1, n)], max(10_000, 4 * n))).first()[0]
    return sorted({float(x) for x in found or [0]})


def in_key_ranges(df: DataFrame, key: str, bounds: list[float]) -> DataFrame:
    """Rows whose key is not null, with ``_range``, the number of the key's range, and dealt by it.

    Two frames that are dealt by the same bounds join on ``_range`` and the key as they lie, where a join need not be dealt
    by all its keys (``number_ranges`` sees to that).
    """
    cut = Bucketizer(splits=[float("-inf"), *bounds, float("inf")], inputCol="_key", outputCol="_range")
    placed = cut.transform(df.where(F.col(key).isNotNull()).withColumn("_key", F.col(key).cast("double"))).drop("_key")
    return placed.withColumn("_range", F.col("_range").cast("int")).repartition("_range")


def number_ranges(ranged: DataFrame, order: list[str | Column], out: str = "seq") -> DataFrame:
    """As ``number_rows``, for rows that ``in_key_ranges`` has dealt by the first column of ``order``: nothing is shuffled again.

    Each range numbers its own rows as they are written; one row per range places the ranges after one another.
    """
    own = F.row_number().over(Window.partitionBy("_range").orderBy(*order)) - 1
    conf, name = ranged.sparkSession.conf, "spark.sql.requireAllClusterKeysForCoPartition"
    kept = conf.get(name)
    conf.set(name, "false")  # several ranges per task keep a join by ranges even
    try:
        placed = written(ranged.withColumn("_own", own), "numbered")
    finally:
        conf.set(name, kept)
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy("_range").count().select(
        "_range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    return placed.join(F.broadcast(totals), "_range").withColumn(out, F.col("_before") + F.col("_own")).drop("_range", "_own", "_before")
