"""Operator 7: contiguous shards of near equal bytes by global prefix sums.

Documents stand in the order (doc_id, text_crc32, size). Each range of that order sums its own sizes and
rows; one small table of range totals gives every range its place in the whole; a document goes to
the shard in which the middle of its bytes falls when the total is cut at equal targets. A shard's
bytes differ from the target by less than the largest document.

Nulls: a null text has no bytes (size 8, crc 0); null doc_ids stand first. Rows that share a doc_id, and equal rows,
are each placed. An empty table gives no rows. Other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgermatch.llm.common import cut

ROW_BYTES = 8
ORDER = ("doc_id", "text_crc32", "size")


def balanced_shards(docs: DataFrame, n_shards: int = 24) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every row of ``docs`` (doc_id, text)."""
    text = F.coalesce("text", F.lit(""))
    # The texts are read once; from here on rows hold three numbers.
    sizes = cut(docs.select(F.col("doc_id").cast("long"), (F.octet_length(text) + F.lit(ROW_BYTES)).cast("long").alias("size"),
                            F.crc32(text.cast("binary")).alias("text_crc32")))
    # Ranges of the whole order, so that rows that share a doc_id can be split as well. Written down, since the
    # number of a range is not a value that Spark could compute again.
    ranged = cut(sizes.repartitionByRange(*ORDER).withColumn("range", F.spark_partition_id()))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy("range").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).select(
        "range", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in ("bytes", "rows")])
    total = ranged.agg(F.sum("size")).first()[0] or 1
    own = Window.partitionBy("range").orderBy(*[F.asc_nulls_first(c) for c in ORDER])
    # One row per range: bounded by the number of shuffle partitions.
    placed = ranged.repartitionByRange("range").select(
        *ORDER, "range", (F.sum("size").over(own.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")).alias("bytes_in"),
        (F.row_number().over(own) - 1).alias("rows_in")).join(F.broadcast(totals), "range")
    start = F.col("bytes_before") + F.col("bytes_in")
    placed = cut(placed.select(
        *ORDER, (F.col("rows_before") + F.col("rows_in")).alias("index"),
        F.least(F.lit(n_shards - 1), F.floor(((2 * start + F.col("size")) * n_shards).cast("decimal(38,0)") / (2 * total)))
        .cast("int").alias("shard")))
    first = placed.groupBy("shard").agg(F.min("index").alias("first"))  # n_shards rows
    return placed.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("index") - F.col("first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))
