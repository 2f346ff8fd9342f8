"""Operator 10: harmonic packing of documents into sequences of at most ``capacity`` tokens.

Length classes are the reciprocals capacity/1, capacity/2, capacity/4, ... Every document is cut
from its start into pieces of exactly a class length, the longest first, until less than
``min_cut`` tokens are left; the tail, if any, joins the class whose slot it fits. A class with slots of
capacity/j always takes j pieces a sequence: a worker holds back the pieces of a class until j of them
fill a sequence and writes them with their place, independent of all other workers. Cut pieces fill their
slots exactly. What a worker holds at its end, less than a sequence of each class, is packed over all workers: these
pieces are numbered by ranges of (class, worker) and fill sequences in the same way. The last pieces of a class,
too few for a sequence, are laid in sequences of 2^i pieces, whose length is a power of two and needs no
padding. Only tails (less than ``min_cut`` tokens a document) leave room in their slots.

Nulls: a null text is an empty one and has the end id alone; a null doc_id is kept. Rows that share a doc_id are
packed each for itself. A very long text is encoded whole, its ids are held once. An empty table gives no pieces. Other
columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgermatch.llm.bpe import encoder
from ledgermatch.llm.common import fresh_path, slices, small_batches
from ledgermatch.operators.numbering import number_rows

#: ``ids``: little-endian unsigned 32-bit integers. ``slot``: class, ``rank``: number among what the worker ``part`` holds at its
#: end in the class; null, like ``part``, for the pieces that have their sequence.
PIECE_SCHEMA = ("part int, slot int, tail boolean, rank long, doc_id long, start long, length long, "
                "doc_tokens long, ids binary, sequence_id long, offset long")
#: Sequences of a worker are numbered from part * 2^40 on, those over all workers from 2^62 on.
PART_BITS, SHARED = 40, 1 << 62


def cut_lengths(total: int, capacity: int, min_cut: int) -> list[tuple[int, int, bool]]:
    """(length, slot, tail) of the pieces of a document of ``total`` tokens."""
    out = [(capacity, capacity, False)] * (total // capacity)
    left, slot = total % capacity, capacity // 2
    while left >= min_cut:
        if slot <= left:
            out.append((slot, slot, False))
            left -= slot
        slot //= 2
    if left:
        slot = 1 << (left - 1).bit_length()
        out.append((left, slot, left < slot))
    return out


def write_pieces(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, capacity: int, min_cut: int) -> str:
    """Encode and cut ``docs`` (doc_id, text); sequences that a task fills by itself have their number and offsets."""
    kinds = (pa.int32(), pa.int32(), pa.bool_(), *[pa.int64()] * 5, pa.binary(), pa.int64(), pa.int64())
    names = ["part", "slot", "tail", "rank", "doc_id", "start", "length", "doc_tokens", "ids", "sequence_id", "offset"]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part = encoder(tokenizer_path), TaskContext.get().partitionId()
        end, waiting, sequence = np.array([end_id], "<u4").tobytes(), {}, part << PART_BITS
        for batch in slices(batches, "text"):
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = enc.encode(text) + end
                n, start = len(ids) // 4, 0
                for length, slot, tail in cut_lengths(n, capacity, min_cut):
                    held = waiting.setdefault((slot, tail), [])
                    held.append((doc_id, start, length, n, ids[4 * start:4 * (start + length)]))
                    start += length
                    if len(held) * slot == capacity:
                        offset = 0
                        for piece in held:
                            rows.append((None, slot, tail, None, *piece, sequence, offset))
                            offset += piece[2]
                        sequence += 1
                        held.clear()
            if rows:
                yield batch_of(rows)
        left = [(part, slot, tail, rank, *piece, None, None) for (slot, tail), held in waiting.items() for rank, piece in enumerate(held)]
        if left:
            yield batch_of(left)

    with small_batches(docs.sparkSession):
        (docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
         .mapInArrow(cut_up, PIECE_SCHEMA).write.option("compression", "zstd").parquet(path))
    return path


def _block(index: Column, count: Column, bits: int) -> tuple[Column, Column]:
    """Lay ``count`` < 2^bits pieces in runs of falling powers of two: (run, place) of piece ``index``."""
    run, place = F.lit(0), index
    for b in range(bits):
        before = F.shiftleft(F.shiftright(count, b + 1), b + 1)
        inside = (F.shiftright(count, b).bitwiseAND(F.lit(1)) == 1) & (index >= before) & (index < before + (1 << b))
        run = F.when(inside, F.lit(bits - 1 - b)).otherwise(run)
        place = F.when(inside, index - before).otherwise(place)
    return run, place


def place_pieces(spark: SparkSession, path: str, capacity: int) -> DataFrame:
    """The written pieces with ``sequence_id`` and ``offset``, gapless from 0 in each sequence."""
    rows = spark.read.schema(PIECE_SCHEMA).parquet(path)
    bits = capacity.bit_length()
    kept = ["doc_id", "start", "length", "doc_tokens", "ids", "sequence_id"]
    done = rows.where("part IS NULL").select(*kept, "offset")
    held = number_rows(rows.where("part IS NOT NULL").drop("sequence_id", "offset"), ["slot", "tail", "part", "rank"], "at")
    # One row a class: 2 log2(capacity) at most.
    classes = held.groupBy("slot", "tail").agg(F.count("*").alias("n"), F.min("at").alias("first")).withColumn(
        "full", F.floor(F.col("n") * F.col("slot") / capacity).cast("long"))
    # Sequences of a class: its full ones, then one for each set bit of what is left (tails: one for all).
    width = F.col("full") + F.when(F.col("tail"), 1).otherwise(F.lit(bits))
    earlier = Window.orderBy(F.desc("slot"), "tail").rowsBetween(Window.unboundedPreceding, -1)
    classes = classes.withColumn("sequence_base", F.lit(SHARED) + F.coalesce(F.sum(width).over(earlier), F.lit(0)))
    per = (F.lit(capacity) / F.col("slot")).cast("long")
    at = held.join(F.broadcast(classes), ["slot", "tail"]).withColumn("at", F.col("at") - F.col("first"))
    at = at.withColumn("bin", F.floor(F.col("at") / per).cast("long")).withColumn("place", F.col("at") % per)
    left = F.col("n") - F.col("full") * per
    run, place = _block(F.col("place"), left, bits)
    last = (F.col("bin") == F.col("full")) & ~F.col("tail")
    at = at.withColumn("sequence_id", F.col("sequence_base") + F.col("bin") + F.when(last, run).otherwise(F.lit(0)))
    at = at.withColumn("place", F.when(last, place).otherwise(F.col("place")))
    exact = at.where(~F.col("tail")).select(*kept, (F.col("place") * F.col("slot")).alias("offset"))
    # Tails are shorter than their slots and stand close together; a sequence holds at most capacity of them.
    close = Window.partitionBy("sequence_id").orderBy("place")
    tails = at.where("tail").withColumn("offset", F.sum("length").over(close) - F.col("length"))
    return done.unionByName(exact).unionByName(tails.select(*kept, "offset"))


def pack(spark: SparkSession, docs: DataFrame, tokenizer_path: str, end_id: int = 1, capacity: int = 2048,
         min_cut: int = 64) -> DataFrame:
    """Pieces (doc_id, start, length, doc_tokens, ids, sequence_id, offset) of all documents."""
    if capacity & (capacity - 1) or min_cut < 1:
        raise ValueError("capacity must be a power of two and min_cut at least 1")
    path = write_pieces(docs, fresh_path(spark, "pieces"), tokenizer_path, end_id, capacity, min_cut)
    return place_pieces(spark, path, capacity)


def pack_digest(spark: SparkSession, docs: DataFrame, tokenizer_path: str, end_id: int = 1, capacity: int = 2048) -> DataFrame:
    """``pack`` with the crc32 of each piece's ids in place of the ids (their bytes are what Spark's crc32 takes)."""
    return pack(spark, docs, tokenizer_path, end_id, capacity).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
