"""Incremental ingest as a Structured Streaming file source with state.

The seen serials live in the stream's state store: the stream carries a row per serial and file, and ``dropDuplicates`` lets
a serial through once in the stream's life, restarts included. Only these narrow rows pass the state's shuffle. A
micro-batch then reads the files it was given and keeps the rows whose serials are new (and not in the base); rows without
a serial are always new, and rows that repeat a serial within one micro-batch all stay, as in the batch job. Earlier rows
are not read again.

``trigger(availableNow=True)`` processes the backlog and stops. A micro-batch writes one folder named by its number and
overwrites it when it is retried, so a restart neither loses nor doubles rows.
"""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermatch.operators.harmonize import registry_serial
from ledgermatch.operators.incremental import base_serials, rows_of_serials
from ledgermatch.session import written
from ledgermatch.sources.paths import exists

#: Keys that stand for a file, not for a serial; they start with a NUL.
_FILE = "\u0000"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _serial(rows: DataFrame, registry_columns: dict[str, set[str]] | None) -> Column:
    """The serial of a row; one that starts with a NUL counts as none, so its row is always new."""
    serial = registry_serial(rows, registry_columns)
    return F.when(~serial.startswith(_FILE), serial)


def _keys(rows: DataFrame, registry_columns: dict[str, set[str]] | None) -> DataFrame:
    """(key, file): each row's serial, and its file under a key of its own."""
    path = F.col("_metadata.file_path")
    keys = F.array(_serial(rows, registry_columns), F.concat(F.lit(_FILE), path))
    return rows.select(path.alias("file"), F.explode(keys).alias("key")).where("key IS NOT NULL")


def stream_new_rows(spark: SparkSession, source_dir: str, schema: T.StructType, base_raw: DataFrame,
                    registry_columns: dict[str, set[str]] | None, out_path: str,
                    max_files_per_trigger: int | None = None) -> DataFrame:
    """New rows of every export file under ``source_dir`` (partition folders included), written to ``out_path``.

    Call it again with the same ``out_path`` after more files have landed. Returns all new rows so far. The state store is
    RocksDB unless the session names another: the seen serials need not fit the executors' memory.
    """
    rows_path, state_path = f"{out_path}/rows", f"{out_path}/state"
    if spark.conf.get(_PROVIDER).endswith("HDFSBackedStateStoreProvider"):
        spark.conf.set(_PROVIDER, _ROCKSDB)
    reader = spark.readStream.format("parquet").schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    known = base_serials(base_raw)
    # The base does not change while the stream runs: its serials are computed once, not per micro-batch.
    known = None if known is None else written(known, "base_serials")
    root = re.split(r"/[^/]*[*?\[{]", source_dir)[0]  # the folder that a pattern stands in
    out_schema = T.StructType([*schema, T.StructField("batch", T.LongType())])

    def per_batch(keys: DataFrame, epoch_id: int) -> None:
        session = keys.sparkSession
        fresh = written(keys.select("key", "file"), "stream_keys")
        # As many names as the trigger has files; the source itself holds that list on the driver.
        files = [unquote(r.file) for r in fresh.where(F.col("key").startswith(_FILE)).select("file").collect()]
        if not files:
            return
        serials = fresh.where(~F.col("key").startswith(_FILE)).select(F.col("key").alias("_serial"))
        if known is not None:
            serials = written(serials.join(known, "_serial", "left_anti"), "stream_serials")
        rows = session.read.schema(schema).option("basePath", root).parquet(*files)
        new = rows_of_serials(rows, _serial(rows, registry_columns), serials)
        new.write.mode("overwrite").parquet(f"{rows_path}/batch={epoch_id}")

    keys = _keys(reader.load(source_dir), registry_columns).dropDuplicates(["key"])
    query = (keys.writeStream.outputMode("append").foreachBatch(per_batch)
             .option("checkpointLocation", state_path).trigger(availableNow=True).start())
    query.awaitTermination()
    if not exists(spark, rows_path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(out_schema).parquet(rows_path).drop("batch")
