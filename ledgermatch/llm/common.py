"""Small helpers the operators of this subpackage share."""

from __future__ import annotations

import gc
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermatch.session import checkpoint_dir

#: Rows of text one Python step handles at once; keeps a worker's memory to a few MB of text.
SLICE_BYTES = 4 << 20


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder; meant for narrow frames that are read more than once."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def release(spark: SparkSession, wait: float = 0.0) -> None:
    """Let Spark's cleaner drop the shuffle files and checkpoints that nothing refers to any more.

    It acts on what the driver's garbage collection finds, which a small driver may not run for a whole loop. Python's
    references end a moment after its own collection and the cleaner works on its own: a step that needs the room before
    it goes on collects twice and gives each ``wait`` seconds.
    """
    for _ in range(2 if wait else 1):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(wait)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a table that this run has written (``fresh_path``) and that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new place for a written table under the shared folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def small_side(df: DataFrame, max_rows: int = 50_000) -> DataFrame:
    """Mark ``df`` for broadcast if it has at most ``max_rows`` rows; else leave the join to Spark."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def held(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that Spark computes once per row, however often later expressions use them.

    A one-element explode is a boundary that the optimiser does not move expressions across.
    """
    kept = df.columns
    one = F.explode(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))).alias("__held")
    return df.select(*[F.col(f"`{c}`") for c in kept], one).select(
        *[F.col(f"`{c}`") for c in kept], *[F.col("__held")[n].alias(n) for n in columns])


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs that run inside pass rows to Python in Arrow batches of about ``SLICE_BYTES`` (a longer row alone).

    Spark's own limit is 64 MB, which the executor and the worker hold side by side, once per running task.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(SLICE_BYTES))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def distinct(values: np.ndarray) -> np.ndarray:
    """The values, ascending, each once. ``np.unique`` without counts goes by a hash table, with more time and memory."""
    values = np.sort(values)
    return values[np.append(True, values[1:] != values[:-1])[:len(values)]]


def slices(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each holds a few MB of text (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        per_row = max(1, batch.column(text).nbytes // batch.num_rows)
        step = max(1, SLICE_BYTES // per_row)
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)
