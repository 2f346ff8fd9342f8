"""Content hashes of landed files."""

from __future__ import annotations

import hashlib

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermatch.session import settings, written

#: A file's bytes are one value of a row, which cannot be longer than this.
MAX_BYTES = (1 << 31) - 1
#: Files of more bytes are hashed piece by piece, so that no task holds one whole.
WHOLE_BYTES = 64 << 20

#: Pieces end here; any byte would do.
_END = b"\n"
#: Spark's reader leaves this mark out at the start of a file.
_MARK = b"\xef\xbb\xbf"
#: Names that make Spark's reader unpack a file: these are hashed whole.
_PACKED = r"(?i)\.(gz|bz2|deflate|lz4|snappy|zst|passthrough)$"


def file_hashes(spark: SparkSession, path: str, pattern: str | None = None, max_bytes: int | None = None,
                whole_bytes: int = WHOLE_BYTES) -> DataFrame:
    """(path, length, sha256) of every file under ``path``, folders included; ``pattern`` is a glob on the file's name.

    Each file is hashed in the task that reads it; an empty file has nothing to read and gives no row. Files of more than
    ``whole_bytes`` are hashed when this is called, as streams of pieces: SHA-256 chains its blocks, so one task reads one
    such file, in bounded memory. A packed file (``_PACKED``) is one value of a row and cannot pass 2 GB: the call names
    such files and stops, as it does for files of more than ``max_bytes``, before any file is read.
    """
    def read(kind: str) -> DataFrame:
        reader = spark.read.format(kind).option("recursiveFileLookup", True).option("lineSep", _END.decode())
        return (reader.option("pathGlobFilter", pattern) if pattern else reader).load(path)

    files = read("binaryFile")
    packed = F.col("path").rlike(_PACKED)
    refused = packed & (F.col("length") > MAX_BYTES)
    if max_bytes is not None:
        refused = refused | (F.col("length") > max_bytes)
    large = [r.path for r in files.where(refused).select("path").orderBy("path").limit(20).collect()]
    if large:
        raise ValueError(f"files of more than {MAX_BYTES if max_bytes is None else max_bytes} bytes cannot be hashed whole: {', '.join(large)}")
    over = F.col("length") > whole_bytes
    longest = files.where(over & ~packed).agg(F.max("length")).first()[0]

    def whole(some: DataFrame) -> DataFrame:
        return some.select("path", "length", F.sha2("content", 256).alias("sha256"))

    if longest is None:
        return whole(files)
    # Plain bounds of the length and conditions on the file alone leave files out before they are read.
    file, is_packed = F.col("_metadata.file_path"), F.col("_metadata.file_path").rlike(_PACKED)
    at_once = whole(files.where(F.col("length") <= whole_bytes)).unionByName(
        whole(files.where(is_packed).where(over).where(F.col("length") <= MAX_BYTES)))
    pieces = read("text").where(~is_packed).where(F.col("_metadata.file_size") > whole_bytes).select(
        file.alias("_file"), F.col("_metadata.file_size").alias("_size"), F.col("value").cast("binary").alias("_piece"))
    # A file is never cut and no two share a task.
    with settings(spark, {"spark.sql.files.maxPartitionBytes": longest, "spark.sql.files.openCostInBytes": longest, "spark.sql.files.minPartitionNum": 1}):
        sums = written(pieces.mapInArrow(_stream_hashes, "_file string, sha256 string"), "file_hashes")
    named = files.where(over & ~packed).select("path", "length", file.alias("_file"))
    return at_once.unionByName(named.join(F.broadcast(sums), "_file").select("path", "length", "sha256"))


def _stream_hashes(batches):
    """One (_file, sha256) for each run of rows (_file, _size, _piece) of one file."""
    name, stream = None, None
    for batch in batches:
        names, at = batch.column(0), 0
        while at < batch.num_rows:
            if names[at].as_py() != name:
                if stream:
                    yield stream.row(name)
                name, stream = names[at].as_py(), _Stream(batch.column(1)[at].as_py())
            rows = pc.sum(pc.equal(names.slice(at), name)).as_py()
            stream.add(batch.column(2).slice(at, rows).to_pylist())
            at += rows
    if stream:
        yield stream.row(name)


class _Stream:
    """SHA-256 of a file's pieces and the ends between them; the file's length tells what the reader left out."""

    def __init__(self, size: int):
        self.size, self.read, self.plain, self.marked = size, None, hashlib.sha256(), hashlib.sha256(_MARK)

    def add(self, pieces: list[bytes]) -> None:
        data = _END.join(pieces if self.read is None else [b"", *pieces])
        self.read = (self.read or 0) + len(data)
        self.plain.update(data)
        self.marked.update(data)

    def row(self, name: str) -> pa.RecordBatch:
        left = self.size - self.read
        found = {0: self.plain, 1: self.plain, len(_MARK): self.marked, len(_MARK) + 1: self.marked}.get(left)
        if found is None:
            raise ValueError(f"{name}: {self.read} of {self.size} bytes were read")
        if left % len(_MARK):
            found.update(_END)
        return pa.RecordBatch.from_pydict({"_file": [name], "sha256": [found.hexdigest()]})
