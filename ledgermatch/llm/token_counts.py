"""Operator 5: tokens per document from counts of distinct pre-tokens.

The texts of a task are one block (cut when it grows past ``BLOCK_BYTES``). A block writes, for each
document, how often each of its pre-tokens occurs, as numbers into the block's list of distinct
pre-tokens, and that list. The lists of all blocks meet by pre-token, where the tokenizer's model counts the pieces of
each distinct one once; the counts go back to their blocks and are summed over each document's frequencies. Ids are
never listed, a pre-token that stands in every document travels once per block, and no task holds more than
a block.

Nulls: a null text is an empty one; a null doc_id is kept. Repeated rows are counted each. An empty table
gives no rows. Other columns of the input are ignored.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgermatch.llm.bpe import LETTERS, byte_letters, uncached_model
from ledgermatch.llm.common import fresh_path, slices

BLOCK_BYTES = 32 << 20
BLOCK_PIECES = 1_000_000
# Letters, contractions, single digits, other marks; white space is dropped.
_SPLIT = re.compile(rf"[{LETTERS}]++|'(?:s|t|re|ve|m|ll|d)|[0-9]|[^\s0-9{LETTERS}]++")
# Elsewhere the library normalises and splits: here lower case and classes agree and nothing composes.
_UNSURE = re.compile("[^\t\n\r -~\u00a0-\u00b1\u00b4-\u00b8\u00ba\u00bb\u00bf-\u012f\u0131-\u024f\u2010-\u2027\u2030-\u205e\u20ac]")
BLOCK_SCHEMA = "block long, doc_id long, n_bytes long, base long, frequencies binary, pieces array<string>"


class PreTokens:
    """Distinct pieces of a text as the tokenizer splits it before its merges."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        added = [re.escape(t["content"]) for t in spec["added_tokens"]]
        self.added = re.compile("|".join(sorted(added, key=len, reverse=True))) if added else None
        self.letters, self.model = byte_letters(), uncached_model(self.tokenizer)
        self.bytes = {ord(c): b for b, c in self.letters.items()}
        kinds = [n.get("type") for n in (spec["normalizer"] or {}).get("normalizers", [])]
        splits = [p.get("type") for p in (spec["pre_tokenizer"] or {}).get("pretokenizers", [])]
        if kinds != ["NFC", "Replace", "Lowercase"] or splits != ["Split", "ByteLevel"] or spec["model"]["type"] != "BPE":
            raise ValueError(f"{path}: not a lower-casing BPE over split words")

    def pieces(self, text: str) -> tuple[list[str], int]:
        """(pieces in order, number of added tokens that stand in the text)."""
        if self.added is None or not self.added.search(text):
            return self._split(text), 0
        parts = self.added.split(text)
        return [p for part in parts for p in self._split(part)], len(parts) - 1

    def _split(self, text: str) -> list[str]:
        if not _UNSURE.search(text):
            return _SPLIT.findall(text.lower())
        shown = self.tokenizer.pre_tokenizer.pre_tokenize_str(self.tokenizer.normalizer.normalize_str(text))
        return [bytes(map(self.bytes.__getitem__, map(ord, p))).decode() for p, _ in shown]

    def count(self, piece: str) -> int:
        return len(self.model.tokenize(piece.encode().decode("latin-1").translate(self.letters)))


def packed(numbers: np.ndarray, times: np.ndarray) -> bytes:
    """Ascending numbers and how often each occurs: two width bytes, the steps between the numbers, the counts."""
    steps = np.diff(numbers.astype(np.int64), prepend=0)
    wide = 2 if not len(steps) or steps.max() < 1 << 16 else 4
    high = 1 if not len(times) or times.max() < 1 << 8 else 4
    return bytes((wide, high)) + steps.astype(f"<u{wide}").tobytes() + times.astype(f"<u{high}").tobytes()


def unpacked(frequencies: bytes) -> tuple[np.ndarray, np.ndarray]:
    wide, high = frequencies[0], frequencies[1]
    n = (len(frequencies) - 2) // (wide + high)
    numbers = np.cumsum(np.frombuffer(frequencies, f"<u{wide}", n, 2), dtype=np.int64)
    return numbers, np.frombuffer(frequencies, f"<u{high}", n, 2 + n * wide).astype(np.int64)


class _Numbers(dict):
    def __missing__(self, piece: str) -> int:
        self[piece] = n = len(self)
        return n


def write_blocks(docs: DataFrame, path: str, tokenizer_path: str) -> str:
    """Write frequencies per document and distinct pre-tokens per block; ``base`` counts each pre-token as one piece."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, numbers, held, block = PreTokens(tokenizer_path), _Numbers(), 0, TaskContext.get().partitionId() << 32

        def listed():
            return pa.RecordBatch.from_pylist([{"block": block, "pieces": list(numbers)}], schema)

        for batch in slices(batches, "text"):
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                pieces, extra = split.pieces(text)
                own, times = np.unique(np.fromiter(map(numbers.__getitem__, pieces), np.uint32, len(pieces)), return_counts=True)
                rows.append((block, doc_id, len(text.encode()), len(pieces) + extra, packed(own, times), None))
                held += len(text)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
            if held > BLOCK_BYTES or len(numbers) > BLOCK_PIECES:
                yield listed()
                numbers, held, block = _Numbers(), 0, block + 1
        if numbers:
            yield listed()

    schema = pa.schema([("block", pa.int64()), ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("base", pa.int64()),
                        ("frequencies", pa.binary()), ("pieces", pa.list_(pa.string()))])
    (docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
     .mapInArrow(count, BLOCK_SCHEMA).write.option("compression", "zstd").parquet(path))
    return path


def count_tokens(spark: SparkSession, docs: DataFrame, tokenizer_path: str, limit: int = 2048) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row of ``docs`` (doc_id, text)."""
    path = write_blocks(docs, fresh_path(spark, "blocks"), tokenizer_path)
    rows = spark.read.schema(BLOCK_SCHEMA).parquet(path)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, last, n = PreTokens(tokenizer_path), None, 0
        for batch in batches:
            more = []
            for piece in batch.column("piece").to_pylist():
                if piece != last:  # in order, so each distinct piece is counted once
                    last, n = piece, split.count(piece) - 1
                more.append(n)
            out = pa.RecordBatch.from_arrays([batch.column("block"), batch.column("number"), pa.array(more, pa.int32())],
                                             ["block", "number", "more"])
            yield out.filter(pa.array(np.array(more, np.int32) != 0))  # a piece of one token is in the base already

    pieces = rows.where("pieces IS NOT NULL").select("block", F.posexplode("pieces").alias("number", "piece"))
    counted = pieces.repartition("piece").sortWithinPartitions("piece").mapInArrow(count, "block long, number int, more int")

    def add_up(left: pa.Table, right: pa.Table) -> pa.Table:
        numbers = right.column("number").to_numpy()
        more = np.zeros(numbers.max() + 1 if len(numbers) else 1, np.int64)
        more[numbers] = right.column("more").to_numpy()
        sums = array("q")
        for frequencies in left.column("frequencies").to_pylist():
            own, times = unpacked(frequencies)
            inside = own < len(more)
            sums.append(int(more[own[inside]] @ times[inside]))
        total = np.array(sums, np.int64) + left.column("base").to_numpy()
        return pa.table({"doc_id": left.column("doc_id"), "n_bytes": left.column("n_bytes"), "n_tokens": total,
                         "over_limit": total > limit})

    docs_of = rows.where("frequencies IS NOT NULL").select("block", "doc_id", "n_bytes", "base", "frequencies")
    return docs_of.groupBy("block").cogroup(counted.groupBy("block")).applyInArrow(
        add_up, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
