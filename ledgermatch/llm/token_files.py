"""Operator 2: documents as token ids in Parquet files that allow selective reads.

Layout, one row per document in ascending doc_id order over files and within each file:

  part     int      number of the file, ascending with doc_id
  doc_id   long     as in the input
  first    long     ids in this file before the document
  n_tokens long     ids of the document, the end id included
  ids      list<int>

Ids are dictionary-encoded (a row group holds few distinct ids against its length), the counters
delta-encoded; row groups and pages are kept small and have page indexes, so a reader that wants
some documents, or only the counters, skips the other ids.

Nulls: a null text is an empty one (it yields the end id alone); a null doc_id sorts first. Rows that
share a doc_id stay separate rows, ordered by text. An empty table gives a file set without rows.
Other columns of the input are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgermatch.llm.bpe import encoder
from ledgermatch.llm.common import fresh_path, slices

FILE_SCHEMA = "part int, doc_id long, first long, n_tokens long, ids array<int>"


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 0,
                      row_group_bytes: int = 16 << 20, page_rows: int = 500) -> str:
    """Encode ``docs`` (doc_id, text) and write the files under ``path``."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, first = encoder(tokenizer_path), TaskContext.get().partitionId(), 0
        end = np.array([end_id], "<u4").tobytes()
        for batch in slices(batches, "text"):
            each = [enc.encode(t) + end for t in batch.column("text").to_pylist()]
            counts = np.array([len(e) // 4 for e in each], np.int64)
            offsets = np.concatenate([[0], np.cumsum(counts)])
            ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()),
                                           pa.array(np.frombuffer(b"".join(each), "<i4")))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(each), part, np.int32)), batch.column("doc_id"),
                 pa.array(first + offsets[:-1]), pa.array(counts), ids],
                ["part", "doc_id", "first", "n_tokens", "ids"])
            first += int(offsets[-1])

    ordered = (docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
               .repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text"))
    (ordered.mapInArrow(encode, FILE_SCHEMA).write
     .option("parquet.writer.version", "v2")
     .option("parquet.block.size", str(row_group_bytes))
     .option("parquet.page.row.count.limit", str(page_rows))
     .option("parquet.enable.dictionary", "true")
     .option("parquet.enable.dictionary#doc_id", "false")
     .option("parquet.enable.dictionary#first", "false")
     .option("parquet.enable.dictionary#n_tokens", "false")
     .option("compression", "zstd")
     .parquet(path))
    return path


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """The files as (doc_id, start, n_tokens, ids); ``start`` counts the ids of all documents before.

    Only the counters are read to place the files after one another (one row per file).
    """
    rows = spark.read.schema(FILE_SCHEMA).parquet(path)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = rows.groupBy("part").agg(F.sum("n_tokens").alias("total")).select(
        F.col("part").alias("base_part"), F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    # One row per file: as small as the file listing itself.
    return rows.join(F.broadcast(base), F.col("part") == F.col("base_part")).select(
        "doc_id", (F.col("base") + F.col("first")).alias("start"), "n_tokens", "ids")


def ids_crc32(tokens: DataFrame) -> DataFrame:
    """Replace ``ids`` by the unsigned crc32 of its little-endian unsigned 32-bit integers."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            flat = memoryview(np.ascontiguousarray(lists.values.to_numpy(), "<i4")).cast("B")
            at = lists.offsets.to_numpy().astype(np.int64) * 4
            crc = np.fromiter((zlib.crc32(flat[a:b]) for a, b in zip(at[:-1], at[1:])), np.int64, len(lists))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("start"), batch.column("n_tokens"), pa.array(crc)],
                ["doc_id", "start", "n_tokens", "ids_crc32"])

    return tokens.mapInArrow(digest, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_digest(spark: SparkSession, docs: DataFrame, tokenizer_path: str, end_id: int = 0) -> DataFrame:
    """Write ``docs`` to token files in the shared folder and report on what the files hold."""
    path = write_token_files(docs, fresh_path(spark, "tokens"), tokenizer_path, end_id)
    return ids_crc32(read_token_files(spark, path))
