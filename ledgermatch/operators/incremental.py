"""Incremental load: rows whose serial number was not seen before.

A run compares serials, not rows: the distinct serials of the ledger (a narrow scan) lose those of the base, and the few
that are left pick their rows. In a monthly run these are broadcast, so the wide ledger is not shuffled at all.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermatch.operators.harmonize import registry_serial
from ledgermatch.session import written

# Null keys never match, so they are replaced by a per-row key no serial can
# equal. Without this every null-serial row would hash to one reducer.
_NULL_KEY_PREFIX = "\u0000"

#: New serials of at most so many rows and bytes are sent to every executor; beyond that Spark chooses the join.
SMALL_ROWS, SMALL_BYTES = 500_000, 32 << 20

#: More new serials than that mark a bit each, by their hash, in a map that is sent instead: so many bits per serial, so many in all.
BITS_PER_SERIAL, MOST_BITS = 16, 1 << 27


#: Column of a bucketed base: the serial text, or for a null one a key that matches nothing.
BUCKET_KEY = "_bucket_key"


def base_serials(base: DataFrame) -> DataFrame | None:
    """Distinct known serials as text: ``serialnumber``, else ``serialnumber_fixed``; of a bucketed base by its own key."""
    if BUCKET_KEY in base.columns:
        return (base.select(F.col(BUCKET_KEY).alias("_serial")).filter(~F.col("_serial").startswith(_NULL_KEY_PREFIX)).distinct())
    for name in ("serialnumber", "serialnumber_fixed"):
        if name in base.columns:
            return (base.select(F.col(name).cast("string").alias("_serial"))
                    .filter(F.col("_serial").isNotNull())
                    .distinct())
    return None


def spread_key(key: Column) -> Column:
    """The key, or for a null key a distinct per-row one that matches nothing.

    The row id reads no column (so the scan stays pruned to what the plan
    uses); its exact value never matters, because no key can equal it.
    """
    row_id = F.monotonically_increasing_id().cast("string")
    return F.coalesce(key, F.concat(F.lit(_NULL_KEY_PREFIX), row_id))


def anti_join_serials(df: DataFrame, serial: Column, seen: DataFrame | None) -> DataFrame:
    """Rows of ``df`` whose serial text is not in ``seen._serial``; null serial is always new."""
    if seen is None:
        return df
    keyed = df.withColumn("_serial", spread_key(serial))
    seen = seen.filter(~F.col("_serial").startswith(_NULL_KEY_PREFIX))
    return keyed.join(seen, "_serial", "left_anti").drop("_serial")


def _bit_of(serial: Column, bits: int) -> Column:
    """1-based place of a serial in a map of ``bits`` bits, as Spark's bitmap functions count."""
    return F.pmod(F.xxhash64(serial), F.lit(bits)) + 1


def maybe_of_serials(df: DataFrame, serial: Column, serials: DataFrame, rows: int) -> DataFrame:
    """``df`` without most of the rows whose serial text is not in ``serials._serial`` (``rows`` of them).

    Each serial sets the bit of its hash in a map of bounded size (``MOST_BITS``, 16 MB), which every executor gets: rows
    whose bit is not set hold none of the serials. Rows without a serial stay, and those that share a bit with one.
    """
    bits = min(MOST_BITS, BITS_PER_SERIAL * rows)
    # Dealt by their piece of the map, so that a piece is set by one task and shuffled as serials, not as partial maps.
    marks = serials.select(_bit_of(F.col("_serial"), bits).alias("_bit")).withColumn("_piece", F.bitmap_bucket_number("_bit"))
    pieces = marks.repartition("_piece").groupBy("_piece").agg(F.bitmap_construct_agg(F.bitmap_bit_position("_bit")).alias("_map"))
    placed = df.withColumn("_none", serial.isNull()).withColumn("_bit", _bit_of(serial, bits))
    placed = placed.withColumn("_piece", F.bitmap_bucket_number("_bit")).withColumn("_bit", F.bitmap_bit_position("_bit"))
    is_set = F.expr("getbit(conv(hex(substring(_map, int(_bit div 8) + 1, 1)), 16, 10)::int, int(_bit % 8)) = 1")
    return (placed.join(F.broadcast(pieces), "_piece", "left").filter(F.col("_none") | F.coalesce(is_set, F.lit(False)))
            .drop("_piece", "_none", "_bit", "_map"))


def rows_of_serials(df: DataFrame, serial: Column, serials: DataFrame) -> DataFrame:
    """Rows of ``df`` whose serial text is in ``serials._serial`` (distinct, written), and all rows without a serial.

    One pass over ``df``. Where the serials are too many to be sent, a map of their hashes first drops the rows that hold
    none of them; only the others are shuffled for the exact join, those without a serial under keys of their own.
    """
    rows, size = serials.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("_serial")), F.lit(0))).first()
    marked = serials.select("_serial", F.lit(True).alias("_is_new"))
    if rows <= SMALL_ROWS and size <= SMALL_BYTES:
        marked = F.broadcast(marked)
    else:
        df = maybe_of_serials(df, serial, serials, rows)
    keyed = df.withColumn("_none", serial.isNull()).withColumn("_serial", spread_key(serial))
    return keyed.join(marked, "_serial", "left").filter(F.col("_none") | F.col("_is_new")).drop("_serial", "_none", "_is_new")


def find_new_rows(ledger: DataFrame, base: DataFrame,
                  registry_columns: dict[str, set[str]] | None = None) -> DataFrame:
    """New rows of a mixed registry ledger against the base's serial set.

    The serial set is global (not per registry); rows of a registry without a
    serial column are all new; duplicates inside the batch stay. The new serials
    are written down when this is called. ``base`` may be bucketed by its serial
    (``write_bucketed``): then it is not shuffled.
    """
    seen = base_serials(base)
    if seen is None:
        return ledger
    serial = registry_serial(ledger, registry_columns)
    own = ledger.select(serial.alias("_serial")).filter(F.col("_serial").isNotNull()).distinct()
    return rows_of_serials(ledger, serial, written(own.join(seen, "_serial", "left_anti"), "new_serials"))


def write_bucketed(base: DataFrame, table: str, buckets: int, path: str | None = None, serial: str = "serialnumber") -> DataFrame:
    """``base`` as a table bucketed and sorted by its serial text, read back; ``buckets`` should be the shuffle's partitions.

    Serials are hashed once, when the base is written: every later run joins its serials to the buckets as they lie. Rows
    without a serial are dealt over the buckets under keys that match nothing, so they do not meet in one.
    """
    if not re.fullmatch(r"\w+", table):
        raise ValueError(f"not a table name: {table}")
    spark: SparkSession = base.sparkSession
    # The column that is bucketed is never null; the serial itself stays as it is.
    keyed = base.withColumn(BUCKET_KEY, spread_key(F.col(serial).cast("string")))
    writer = keyed.repartition(buckets, BUCKET_KEY).write.mode("overwrite").option("compression", "zstd").bucketBy(buckets, BUCKET_KEY).sortBy(BUCKET_KEY)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return spark.table(table)


def snapshot_diff(new: DataFrame, previous: DataFrame | None, registry_col: str = "registry_key",
                  serial_col: str = "serial") -> DataFrame:
    """Rows of a new snapshot whose (registry, serial) the previous one lacks (all if there is none).

    One anti-join over all registries; a row without a serial is always new and
    gets a key of its own, so such rows do not meet in one task. A text serial is
    shuffled once: the key gives it back. The previous snapshot has no bound, so it
    is never broadcast on an estimate of its size.
    """
    if previous is None:
        return new
    seen = previous.select(F.col(registry_col).alias("_registry"), F.col(serial_col).cast("string").alias("_seen")) \
        .filter(F.col("_seen").isNotNull() & ~F.coalesce(F.col("_seen").startswith(_NULL_KEY_PREFIX), F.lit(False))).distinct()
    key = spread_key(F.col(serial_col).cast("string")).alias("_serial")
    same = (F.col(registry_col) == F.col("_registry")) & (F.col("_serial") == F.col("_seen"))
    if new.schema[serial_col].dataType != T.StringType():
        return new.select("*", key).join(seen.hint("merge"), same, "left_anti").drop("_serial")
    keyed = new.select(*[F.col(f"`{c}`") for c in new.columns if c != serial_col], F.col(serial_col).isNull().alias("_none"), key)
    found = keyed.join(seen.hint("merge"), same, "left_anti").withColumn(serial_col, F.when(~F.col("_none"), F.col("_serial")))
    return found.select(*[F.col(f"`{c}`") for c in new.columns])
