"""Operator 9: a modified Kneser-Ney language model of trusted text as a quality classifier.

The units are words, runs of other marks, white space other than a single blank, and the start and end of a text, each as a 64-bit hash; a
pair is the hash of two. All pairs of the texts labelled good but for a held-out fifth are counted, so the model grows
with the trusted text. It is interpolated: pairs over continuation counts of units over the chance of a unit's spelling.
The spelling of units that no trusted text has comes from a Kneser-Ney model of order 4 over 32 character
classes (``train``), which is of one size (4 MB) and broadcast; it is only this base.

Scoring joins counts in shards, in rounds of texts. The texts of a task form blocks; a block asks once for each of its
distinct units and pairs, in lists by the top bits of the hash; a shard looks its part of the lists up in its part of
the counts, and the answers go back to the block, which sums over its texts. The counts are packed once, a row per shard
with its keys in ascending order, in tables bucketed by shard, so that no round shuffles them; the number of shards follows the keys. A round's blocks are deleted when its scores are
written, so disk holds the model and a part of the corpus. No task holds more than a block, or a shard. The log perplexity
is over the whole text, per character.

The limits come from the held-out good texts of each language: the excess over the language's median, scaled by the
root of the text's length (up to ``STEADY`` characters), may be at most the upper quantile ``QUANTILE`` seen there. Languages with
few held-out texts take the limits of all.

Nulls: a null or empty text has no perplexity and is not kept; a null language is a group of its own; labels with null
doc_id are ignored, a doc_id with several labels is good if none of them says otherwise, and toxic if any says so (a null quality or toxic says nothing).
Texts labelled toxic teach nothing and set no limits; they are judged by their perplexity like all others, not dropped for the label. Without good
texts all documents with a text are kept. Repeated rows are scored each. Other columns pass through ``filter_documents``.
"""

from __future__ import annotations

import re
import unicodedata
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermatch.llm.common import cut, delete, distinct, fresh_path, release, slices, small_batches, small_side
from ledgermatch.llm.decontaminate import text_key

ORDER, BITS = 4, 5
CLASSES = 1 << BITS
HELD_OUT = 5  # one good text in so many is not counted but sets the limits
MIN_GROUP = 30
STEADY = 400
QUANTILE = 0.995
BLOCK_CHARS = 12 << 20
SHARD_KEYS = 1_000_000  # keys of a shard, about
ROUND_CHARS, MOST_ROUNDS = 64 << 20, 12  # a round takes so many characters of text at least
CHARS_PER_UNIT = 5
SETTLE = 0.7  # seconds that the files of a finished step get to go
MAX_BROADCAST_LABELS = 1_000_000  # (long, boolean) rows
START, END = "", "\0"  # no unit is empty, and a lone NUL is a mark
UNIT_CHARS = 1 << 19  # characters whose units are found at once (a longer text alone)
LONG_UNIT = 128  # units of more characters are told apart by themselves, not by their keys
_UNIT = re.compile(r"\w+|[^\w\s]+|\s\s+|[^\S ]")
_TURN = 23
BLOCK_SCHEMA = ("block long, doc_id array<long>, lang array<string>, held array<boolean>, text_key array<long>, n array<long>, "
                "lengths array<long>, units binary, hashes binary, spelled binary")


@lru_cache(maxsize=1)
def class_table() -> np.ndarray:
    """Class of each code point up to U+FFFF; those beyond are other marks."""
    table = np.full(0x10001, 31, np.uint32)
    for cp in range(0x10000):
        c = chr(cp)
        kind = unicodedata.category(c)
        if c.isspace():
            table[cp] = 28
        elif kind == "Lu":
            table[cp] = 27
        elif kind[0] == "L":
            base = unicodedata.normalize("NFKD", c)[0]
            table[cp] = ord(base) - 96 if "a" <= base <= "z" else 1 + cp % 26
        elif kind[0] == "N":
            table[cp] = 29
        elif kind[0] == "P":
            table[cp] = 30
    return table


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Order-4 n-gram numbers of all the texts, and the number of characters of each."""
    lengths = np.array([len(t) for t in texts], np.int64)
    if not len(lengths):
        return np.zeros(0, np.uint32), lengths
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    begins = np.cumsum(lengths + (ORDER - 1)) - lengths - (ORDER - 1)
    inside = np.ones(len(points) + (ORDER - 1) * len(texts), bool)
    for k in range(ORDER - 1):
        inside[begins + k] = False
    padded = np.zeros(len(inside), np.uint32)
    padded[inside] = class_table()[np.minimum(points, 0x10000)]
    rolled = padded[:-(ORDER - 1)].copy()
    for k in range(1, ORDER):
        rolled <<= np.uint32(BITS)
        rolled |= padded[k:len(padded) - (ORDER - 1) + k]
    return rolled[inside[ORDER - 1:]], lengths


def parts(texts: list[str]) -> Iterator[list[str]]:
    """The texts in turn, in lists of about ``UNIT_CHARS`` characters (a longer text alone)."""
    chars = np.cumsum([len(t) for t in texts])
    cuts = [0, *np.flatnonzero(np.diff(chars // UNIT_CHARS)) + 1, len(texts)]
    return (texts[i:j] for i, j in zip(cuts[:-1], cuts[1:], strict=True))


def count_grams(texts: DataFrame) -> DataFrame:
    """(gram, c): how often each order-4 n-gram occurs in ``texts`` (text)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES ** ORDER, np.int64)
        for batch in slices(batches, "text"):
            for part in parts(batch.column("text").to_pylist()):
                total += np.bincount(grams(part)[0], minlength=len(total))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], ["gram", "c"])

    return texts.select(F.coalesce("text", F.lit("")).alias("text")).mapInArrow(count, "gram int, c long") \
        .groupBy("gram").agg(F.sum("c").alias("c"))


def _discounts(counts: DataFrame) -> tuple[float, float, float]:
    """The modified Kneser-Ney discounts of the counts 1, 2, and 3 or more, from the counts of counts."""
    return _discounts_of(*counts.agg(*[F.count_if(F.col("c") == i) for i in (1, 2, 3, 4)]).first())


def _discounts_of(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    steps = [(i, i - (i + 1) * y * up / at if at else 0.5) for i, at, up in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
    d1, d2, d3 = (min(max(d, 0.1), i) for i, d in steps)
    return d1, d2, d3


def _discounted(counts: DataFrame, by: tuple[float, float, float] | None = None) -> DataFrame:
    """Add ``d``, the discount of each count."""
    d1, d2, d3 = by or _discounts(counts)
    return counts.withColumn("d", F.when(F.col("c") == 1, d1).when(F.col("c") == 2, d2).otherwise(d3))


def _interpolated(counts: DataFrame, below: DataFrame | None, order: int) -> DataFrame:
    """(gram, p) for all n-grams of ``order``; below: (gram, p) of the order under it, None for equal chances."""
    spark = counts.sparkSession
    counts = _discounted(counts)
    contexts = counts.groupBy(F.shiftright("gram", BITS).alias("context")).agg(
        F.sum("c").alias("total"), F.sum("d").alias("freed"))
    every = spark.range(CLASSES ** order).select(F.col("id").cast("int").alias("gram"))
    every = every.withColumns({"context": F.shiftright("gram", BITS),
                               "lower": F.col("gram").bitwiseAND(F.lit(CLASSES ** (order - 1) - 1))})
    found = every.join(counts, "gram", "left").join(contexts, "context", "left")
    if below is None:
        found = found.withColumn("p_lower", F.lit(1.0 / CLASSES))
    else:
        found = found.join(below.select(F.col("gram").alias("lower"), F.col("p").alias("p_lower")), "lower")
    own = F.coalesce((F.col("c") - F.col("d")) / F.col("total"), F.lit(0.0))
    # A context that was never seen leaves everything to the order below.
    return found.select("gram", (own + F.coalesce(F.col("freed") / F.col("total"), F.lit(1.0)) * F.col("p_lower")).alias("p"))


def train(texts: DataFrame) -> np.ndarray:
    """log probability of every order-4 n-gram (float32, 32^4 values) from the trusted ``texts`` (text)."""
    counts = {ORDER: cut(count_grams(texts))}
    for order in range(ORDER - 1, 0, -1):  # lower orders count the n-grams that they continue
        counts[order] = cut(counts[order + 1].groupBy(F.col("gram").bitwiseAND(F.lit(CLASSES ** order - 1)).alias("gram"))
                            .agg(F.count("*").alias("c")))
    p = None
    for order in range(1, ORDER + 1):
        p = _interpolated(counts[order], p, order)
    rows = p.select("gram", F.log("p").cast("float").alias("p")).toArrow()  # 32^4 rows at any input size
    table = np.zeros(CLASSES ** ORDER, np.float32)
    table[rows.column("gram").to_numpy()] = rows.column("p").to_numpy()
    return table


def trusted_labels(labels: DataFrame) -> DataFrame:
    """(label_id, held): doc_ids whose labels call them good and not toxic, and whether a text is held out."""
    good = labels.where("doc_id IS NOT NULL AND (quality IS NOT NULL OR toxic IS NOT NULL)").groupBy(F.col("doc_id").cast("long").alias("label_id")) \
        .agg(F.min("quality").alias("q"), F.max(F.coalesce("toxic", F.lit(0)).cast("int")).alias("t")).where("q > 0 AND t = 0")
    return good.select("label_id", (F.pmod(F.xxhash64("label_id"), F.lit(HELD_OUT)) == 0).alias("held"))


@lru_cache(maxsize=1)
def _class_sizes() -> np.ndarray:
    """log of the number of code points in each class."""
    sizes = np.bincount(class_table()[:0x10000], minlength=CLASSES).astype(np.float64)
    sizes[31] += 0x110000 - 0x10000
    return np.log(np.maximum(sizes, 1))


def spellings(units: list[str], table: np.ndarray) -> np.ndarray:
    """log chance of each unit's characters and of the blank that ends it."""
    found = []
    for part in parts(units):
        codes, lengths = grams([u + " " for u in part])
        sums = np.concatenate([[0.0], np.cumsum(table[codes].astype(np.float64) - _class_sizes()[codes & (CLASSES - 1)])])
        ends = np.cumsum(lengths)
        found.append(sums[ends] - sums[ends - lengths])
    return np.concatenate(found)


def unit_hash(unit: str) -> int:
    return xxhash.xxh3_64_intdigest(unit.encode("utf-8", "surrogatepass"))


def pair_hashes(hashes: np.ndarray) -> np.ndarray:
    """Hash of each two neighbours (uint64): the first, and the second turned, so that order matters."""
    a, b = hashes[:-1], hashes[1:]
    return a ^ ((b << np.uint64(_TURN)) | (b >> np.uint64(64 - _TURN)))


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """Kind of each code point as ``_UNIT`` tells them apart: of words 0, other marks 1, white space 2."""
    table = np.ones(0x110000, np.uint8)
    every = "".join(map(chr, range(0x110000)))
    for kind, pattern in ((0, r"\w+"), (2, r"\s+")):
        for m in re.finditer(pattern, every):
            table[m.start():m.end()] = kind
    return table


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of an odd number and of its inverse, modulo 2 ** 64."""
    odd = 0x9E3779B97F4A7C15
    return tuple(np.cumprod(np.full(size, x, np.uint64)) for x in (odd, pow(odd, -1, 1 << 64)))


def unit_places(whole: str, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and a 64-bit key of each unit that ``_UNIT`` finds in the texts which end at ``ends`` in ``whole``.

    Equal units have equal keys; those of different ones differ but for chance (units up to ``LONG_UNIT`` characters).
    """
    points = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds = _kinds()[points]
    new = np.ones(len(points) + 1, bool)
    new[1:-1] = kinds[1:] != kinds[:-1]
    new[ends] = True
    at = np.flatnonzero(new)
    first, last = at[:-1], at[1:]
    unit = (last - first > 1) | (points[first] != 32)
    first, last = first[unit], last[unit]
    up, down = _powers(max(2 * UNIT_CHARS, 1 << len(points).bit_length()))
    mixed = (points.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0x94D049BB133111EB) * up[:len(points)]
    sums = np.append(np.uint64(0), np.cumsum(mixed))
    return first, last, (sums[last] - sums[first]) * down[first]


class _Units(dict):
    """Numbers of the units in order of first sight; 0 and 1 are the start and the end of a text."""

    def __init__(self):
        super().__init__({START: 0, END: 1})
        self.keys, self.known = np.zeros(0, np.uint64), np.zeros(0, np.uint32)  # ascending keys of units met, and their numbers

    def __missing__(self, unit: str) -> int:
        self[unit] = n = len(self)
        return n

    def of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the units of the texts in a row, each text between its start and its end, and how many each text has."""
        rows, lengths = zip(*map(self._of, parts(texts)), strict=True)
        return np.concatenate(rows), np.concatenate(lengths)

    def _of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        whole, ends = "".join(texts), np.cumsum([len(t) for t in texts])
        first, last, keys = unit_places(whole, ends)
        coded = pa.array(keys).dictionary_encode()
        codes = coded.indices.to_numpy()
        some = np.empty(len(coded.dictionary), np.int64)  # a place of each distinct unit
        some[codes] = np.arange(len(codes))
        keys, numbers = keys[some], np.zeros(len(some), np.uint32)
        at = np.searchsorted(self.keys, keys)
        old = np.append(self.keys, np.uint64(0))[at] == keys
        old &= at < len(self.keys)
        numbers[old] = self.known[at[old]]
        new = np.flatnonzero(~old)
        numbers[new] = self._numbers(whole, first[some[new]], last[some[new]])
        new = new[np.argsort(keys[new])]
        self.keys, self.known = np.insert(self.keys, at[new], keys[new]), np.insert(self.known, at[new], numbers[new])
        found = numbers[codes]
        long = np.flatnonzero(last - first > LONG_UNIT)
        found[long] = self._numbers(whole, first[long], last[long])
        lengths = np.diff(np.searchsorted(first, ends), prepend=0) + 2
        row, inside, after = np.zeros(lengths.sum(), np.uint32), np.ones(lengths.sum(), bool), np.cumsum(lengths)
        row[after - 1] = 1
        inside[after - 1] = inside[after - lengths] = False
        row[inside] = found
        return row, lengths

    def _numbers(self, whole: str, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        return np.fromiter((self[whole[i:j]] for i, j in zip(first.tolist(), last.tolist(), strict=True)), np.uint32, len(first))

    def hashes(self) -> np.ndarray:
        return np.fromiter(map(unit_hash, self), np.uint64, len(self))


def _pair_starts(lengths: np.ndarray) -> np.ndarray:
    """Whether each but the last unit, in a row of texts with so many units each, starts a pair inside a text."""
    inside = np.ones(lengths.sum(), bool)
    inside[np.cumsum(lengths) - 1] = False
    return inside[:-1]


def _small(values: np.ndarray) -> bytes:
    """The values by byte planes, compressed."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T)
    return len(values).to_bytes(8, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _large(data: bytes, kind: type) -> np.ndarray:
    n, wide = int.from_bytes(data[:8], "little"), np.dtype(kind).itemsize
    planes = pa.decompress(data[8:], decompressed_size=n * wide, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(wide, n).T).view(kind).reshape(n)


def _pairs_of_blocks(texts: DataFrame) -> DataFrame:
    """(a, b, c): how often unit b follows unit a (hashes) in each block of ``texts`` (text)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def counted():
            hashes = numbers.hashes().view(np.int64)
            row, inside = np.concatenate(units), _pair_starts(np.concatenate(lengths))
            seen, times = np.unique((row[:-1][inside].astype(np.uint64) << np.uint64(32)) | row[1:][inside], return_counts=True)
            for k in range(0, len(seen), 500_000):
                a, b = seen[k:k + 500_000] >> np.uint64(32), seen[k:k + 500_000] & np.uint64(0xFFFFFFFF)
                yield pa.RecordBatch.from_arrays([pa.array(hashes[a]), pa.array(hashes[b]), pa.array(times[k:k + 500_000])], ["a", "b", "c"])

        numbers, units, lengths, held = _Units(), [], [], 0
        for batch in slices(batches, "text"):
            texts = batch.column("text").to_pylist()
            for into, found in zip((units, lengths), numbers.of(texts), strict=True):
                into.append(found)
            held += sum(map(len, texts))
            if held > BLOCK_CHARS:
                yield from counted()
                numbers, units, lengths, held = _Units(), [], [], 0
        if units:
            yield from counted()

    return texts.select(F.coalesce("text", F.lit("")).alias("text")).where("text <> ''").mapInArrow(count, "a long, b long, c long")


def count_pairs(texts: DataFrame) -> DataFrame:
    """(a, b, c): how often unit b follows unit a (hashes) in ``texts`` (text)."""
    return _pairs_of_blocks(texts).groupBy("a", "b").agg(F.sum("c").alias("c"))


@dataclass
class Model:
    """Packed counts: of pairs their occurrences, of units (total, freed, own); and the numbers that go with them."""

    pairs: DataFrame
    units: DataFrame
    discounts: tuple[float, float, float]
    share: float
    bits: int
    tables: tuple[str, ...] = ()

    def drop(self, spark: SparkSession) -> None:
        """Remove the counts, when nothing is scored any more."""
        for table in self.tables:
            path = spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name = 'Location'").first()["data_type"]
            spark.sql(f"DROP TABLE {table}")
            delete(spark, path)


def shard_bits(n_keys: int) -> int:
    """Leading bits of a hash that give its shard: about ``SHARD_KEYS`` keys each, whatever ``n_keys`` is."""
    return min(40, max(4, (n_keys // SHARD_KEYS).bit_length()))


def _shard(key: Column, bits: int) -> Column:
    return F.shiftrightunsigned(key, 64 - bits)


def _by_shard(packed: DataFrame, table: str) -> DataFrame:
    """``packed`` written as the table ``table``, bucketed by shard into as many buckets as a shuffle has partitions, read back."""
    spark = packed.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    packed.write.option("path", fresh_path(spark, table)).bucketBy(buckets, "shard").saveAsTable(table)
    return spark.table(table)


def packed_units(counts: DataFrame, values: list[str], bits: int, table: str) -> DataFrame:
    """(shard, keys, found): ``counts`` (key, values) written as one row per shard, keys ascending as steps, values (float32) in their order."""

    def pack(key: tuple, rows: pa.Table) -> pa.Table:
        keys = rows.column("key").to_numpy().view(np.uint64)
        order = np.argsort(keys)
        found = np.column_stack([rows.column(v).to_numpy()[order].astype(np.float32) for v in values])
        return pa.table({"shard": [key[0].as_py()], "keys": pa.array([_small(np.diff(keys[order], prepend=np.uint64(0)))], pa.binary()),
                         "found": pa.array([_small(found.reshape(-1))], pa.binary())})

    sharded = counts.select(_shard(F.col("key"), bits).alias("shard"), "key", *values).groupBy("shard")
    return _by_shard(sharded.applyInArrow(pack, "shard long, keys binary, found binary"), table)


def packed_pairs(texts: DataFrame, bits: int, table: str) -> DataFrame:
    """The pairs of ``texts`` written as one row per shard: keys ascending as steps, counts (uint32) and first units in their
    order, and how many counts are 1, 2, 3 and 4."""

    def pack(key: tuple, rows: pa.Table) -> pa.Table:
        a, b = (rows.column(c).to_numpy().view(np.uint64) for c in ("a", "b"))
        keys = a ^ ((b << np.uint64(_TURN)) | (b >> np.uint64(64 - _TURN)))
        order = np.argsort(keys)
        keys = keys[order]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        counts = np.add.reduceat(rows.column("c").to_numpy()[order], first)
        return pa.table({"shard": [key[0].as_py()], "keys": pa.array([_small(np.diff(keys[first], prepend=np.uint64(0)))], pa.binary()),
                         "found": pa.array([_small(counts.astype(np.uint32))], pa.binary()), "firsts": pa.array([_small(a[order][first])], pa.binary()),
                         **{f"n{i}": [int((counts == i).sum())] for i in (1, 2, 3, 4)}})

    schema = "shard long, keys binary, found binary, firsts binary, n1 long, n2 long, n3 long, n4 long"
    turned = F.shiftleft("b", _TURN).bitwiseOR(F.shiftrightunsigned("b", 64 - _TURN))
    sharded = _pairs_of_blocks(texts).withColumn("shard", _shard(F.col("a").bitwiseXOR(turned), bits)).groupBy("shard")
    packed = _by_shard(sharded.applyInArrow(pack, schema), table)
    release(texts.sparkSession, SETTLE)
    return packed


def _sides(discounts: tuple[float, float, float]):
    """(key, total, freed, c) of the units of some packed pairs: as first ones their counts and discounts, as second ones how many pairs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = np.array([0.0, *discounts])
        for batch in batches:
            for k in range(batch.num_rows):
                keys = np.cumsum(_large(batch.column("keys")[k].as_py(), np.uint64), dtype=np.uint64)
                a, c = _large(batch.column("firsts")[k].as_py(), np.uint64), _large(batch.column("found")[k].as_py(), np.uint32)
                turned = keys ^ a
                b = (turned >> np.uint64(_TURN)) | (turned << np.uint64(64 - _TURN))
                first, at = np.unique(a, return_inverse=True)
                second, n = np.unique(b, return_counts=True)
                none = np.zeros(len(second))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([first, second]).view(np.int64)), pa.array(np.concatenate([np.bincount(at, c), none])),
                     pa.array(np.concatenate([np.bincount(at, by[np.minimum(c, 3)]), none])),
                     pa.array(np.concatenate([np.zeros(len(first), np.int64), n]))], ["key", "total", "freed", "c"])
    return run


def unit_model(texts: DataFrame, n_keys: int) -> Model:
    """The model of the trusted ``texts``; ``n_keys`` is about how many keys it has, or how many a round of texts asks for if that is more.

    The chance of b after a is (own(ab) + freed(a) * p(b)) / total(a), or p(b) if total(a) is 0; p(b) is
    own(b) + share * chance of its spelling.
    """
    bits = shard_bits(n_keys)
    tables = tuple(f"packed_{x}_{uuid.uuid4().hex}" for x in ("pairs", "units"))
    pairs = packed_pairs(texts, bits, tables[0])
    by = _discounts_of(*(n or 0 for n in pairs.agg(*[F.sum(f"n{i}") for i in (1, 2, 3, 4)]).first()))
    sides = pairs.select("keys", "found", "firsts").mapInArrow(_sides(by), "key long, total double, freed double, c long")
    units = cut(sides.groupBy("key").agg(*[F.sum(x).alias(x) for x in ("total", "freed", "c")]))
    followers = units.where("c > 0")
    then = _discounted(units, _discounts(followers)).withColumn("d", F.when(F.col("c") > 0, F.col("d")).otherwise(0.0))
    whole, freed = then.agg(F.sum("c"), F.sum("d")).first()
    units = then.select("key", "total", "freed", ((F.col("c") - F.col("d")) / F.lit(float(whole or 1))).alias("own"))
    model = Model(pairs.select("shard", "keys", "found"), packed_units(units, ["total", "freed", "own"], bits, tables[1]), by,
                  freed / whole if whole else 1.0, bits, tables)
    release(texts.sparkSession, SETTLE)
    return model


def write_blocks(docs: DataFrame, table: np.ndarray, path: str) -> DataFrame:
    """Write ``docs`` (doc_id, lang, held, text_key, text) as blocks, one row each, with unit numbers instead of texts."""
    shared = docs.sparkSession.sparkContext.broadcast(table)
    plain = ("doc_id", "lang", "held", "text_key")
    schema = pa.schema([("block", pa.int64()), ("doc_id", pa.list_(pa.int64())), ("lang", pa.list_(pa.string())),
                        ("held", pa.list_(pa.bool_())), ("text_key", pa.list_(pa.int64())), ("n", pa.list_(pa.int64())),
                        ("lengths", pa.list_(pa.int64())), ("units", pa.binary()), ("hashes", pa.binary()), ("spelled", pa.binary())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def finished():
            row = np.concatenate(units)
            order = np.argsort(-np.bincount(row, minlength=len(numbers)), kind="stable")  # frequent units get small numbers, which compress
            place = np.empty(len(order), np.uint32)
            place[order] = np.arange(len(order), dtype=np.uint32)
            spelled = spellings(list(numbers), shared.value)[order].astype(np.float32)
            yield pa.RecordBatch.from_pylist([{
                **kept, "block": block, "lengths": np.concatenate(lengths).tolist(), "units": _small(place[row]),
                "hashes": numbers.hashes()[order].tobytes(), "spelled": spelled.tobytes()}], schema)

        numbers, units, lengths, held, block = _Units(), [], [], 0, TaskContext.get().partitionId() << 32
        kept = {c: [] for c in (*plain, "n")}
        for batch in slices(batches, "text"):
            texts = batch.column("text").to_pylist()
            for into, found in zip((units, lengths), numbers.of(texts), strict=True):
                into.append(found)
            kept["n"] += map(len, texts)
            held += sum(map(len, texts))
            for c in plain:
                kept[c] += batch.column(c).to_pylist()
            if held > BLOCK_CHARS:
                yield from finished()
                numbers, units, lengths, held, block = _Units(), [], [], 0, block + 1
                kept = {c: [] for c in kept}
        if units:
            yield from finished()

    docs.select(*plain, "text").mapInArrow(write, BLOCK_SCHEMA).write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(BLOCK_SCHEMA).parquet(path)


def _block_pairs(units: bytes, hashes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of the first and of the second unit, and hash, of each pair of a block."""
    row, inside = _large(units, np.uint32), _pair_starts(lengths)
    return row[:-1][inside], row[1:][inside], pair_hashes(hashes[row])[inside]


def ask(blocks: DataFrame, pair: bool, bits: int) -> DataFrame:
    """(block, pair, shard, keys): the distinct hashes of each block's pairs or units, ascending, as steps, cut by shard."""

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                r = {c: batch.column(c)[k] for c in batch.schema.names}
                keys = np.frombuffer(r["hashes"].as_py(), np.uint64)
                if pair:
                    keys = _block_pairs(r["units"].as_py(), keys, r["lengths"].values.to_numpy())[2]
                keys = distinct(keys)
                shard = (keys >> np.uint64(64 - bits)).astype(np.int64)
                starts = np.flatnonzero(np.append(True, shard[1:] != shard[:-1]))
                ends = np.append(starts[1:], len(keys))
                lists = [_small(np.diff(keys[i:j], prepend=np.uint64(0))) for i, j in zip(starts, ends, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array([r["block"].as_py()] * len(lists), pa.int64()), pa.array([pair] * len(lists)),
                                                  pa.array(shard[starts]), pa.array(lists, pa.binary())], ["block", "pair", "shard", "keys"])

    return blocks.select("block", "units", "hashes", "lengths").mapInArrow(asked, "block long, pair boolean, shard long, keys binary")


def look_up(asked: DataFrame, counts: DataFrame, wide: int, kind: type) -> DataFrame:
    """(block, pair, shard, found): the ``wide`` values (0 if there are none) of all keys of each list in turn.

    ``asked`` (block, pair, shard, keys) meets ``counts`` (``packed``) by shard.
    """

    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        known, table = np.zeros(0, np.uint64), np.zeros((0, wide), kind)
        if right.num_rows:
            known = np.cumsum(_large(right.column("keys")[0].as_py(), np.uint64), dtype=np.uint64)
            table = _large(right.column("found")[0].as_py(), kind).reshape(-1, wide)
        table = np.vstack([table, np.zeros((1, wide), kind)])
        ended = np.append(known, np.uint64(0))
        found = []
        for keys in left.column("keys").to_pylist():
            keys = np.cumsum(_large(keys, np.uint64), dtype=np.uint64)
            at = np.searchsorted(known, keys)
            at[ended[at] != keys] = len(known)
            found.append(_small(table[at].reshape(-1)))
        return pa.table({"block": left.column("block"), "pair": left.column("pair"), "shard": left.column("shard"), "found": pa.array(found, pa.binary())})

    return asked.groupBy("shard").cogroup(counts.groupBy("shard")).applyInArrow(answer, "block long, pair boolean, shard long, found binary")


def score_blocks(blocks: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang, held, text_key, __ppl, __n) of each document; __ppl is the log perplexity per character, null without text."""
    answers = look_up(ask(blocks, True, model.bits), model.pairs, 1, np.uint32).unionByName(
        look_up(ask(blocks, False, model.bits), model.units, 3, np.float32))
    out = ["doc_id", "lang", "held", "text_key"]
    discounts, share = np.array([0.0, *model.discounts]), model.share

    def add_up(left: pa.Table, right: pa.Table) -> pa.Table:
        said = right.sort_by("shard")

        def answered(pair: bool, kind: type) -> np.ndarray:
            found = said.filter(said.column("pair") if pair else pc.invert(said.column("pair"))).column("found").to_pylist()
            return np.concatenate([_large(f, kind) for f in found])

        listed = {c: left.column(c).combine_chunks().flatten() for c in [*out, "n", "lengths"]}
        hashes = np.frombuffer(left.column("hashes")[0].as_py(), np.uint64)
        spelled = np.exp(np.frombuffer(left.column("spelled")[0].as_py(), np.float32).astype(np.float64))
        total, freed, own = answered(False, np.float32).astype(np.float64).reshape(-1, 3)[np.unique(hashes, return_inverse=True)[1]].T
        alone = np.maximum(own + share * spelled, 1e-300)  # a very long unknown unit underflows
        lengths = listed["lengths"].to_numpy()
        a, b, keys = _block_pairs(left.column("units")[0].as_py(), hashes, lengths)
        counts = answered(True, np.uint32)[np.unique(keys, return_inverse=True)[1]]
        logs = np.empty(len(counts))
        for k in range(0, len(counts), UNIT_CHARS):  # a part of the pairs at a time, so that only the logarithms are whole
            i, j, c = (x[k:k + UNIT_CHARS] for x in (a, b, counts))
            of_pairs = c.astype(np.float64) - discounts[np.minimum(c, 3)]
            logs[k:k + UNIT_CHARS] = np.log(np.where(total[i] > 0, (of_pairs + freed[i] * alone[j]) / np.maximum(total[i], 1), alone[j]))
        sums = np.add.reduceat(logs, np.cumsum(lengths - 1) - (lengths - 1))
        n = listed["n"].to_numpy()
        return pa.table({**{c: listed[c] for c in out}, "__ppl": pa.array(-sums / np.maximum(n, 1), mask=n == 0), "__n": n})

    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        add_up, "doc_id long, lang string, held boolean, text_key long, __ppl double, __n long")


def score(told: DataFrame, trusted: DataFrame) -> DataFrame:
    """Scores of ``told`` (doc_id, lang, held, text_key, text) under the model of ``trusted`` (text), in rounds of texts."""
    spark = told.sparkSession
    n_chars, n_trusted = (n or 0 for n in told.agg(F.sum(F.length("text")), F.sum(F.when(~F.col("held"), F.length("text")))).first())
    rounds = max(1, min(MOST_ROUNDS, n_chars // ROUND_CHARS))
    model = unit_model(trusted, max(n_trusted, n_chars // rounds) // CHARS_PER_UNIT)
    table = train(trusted)
    # A round reads a part of every split; so few tasks that each can fill a block.
    tasks = max(2 * spark.sparkContext.defaultParallelism, n_chars // rounds // BLOCK_CHARS)
    scored = None
    for k in range(rounds):
        part = told if rounds == 1 else told.where(F.pmod(F.xxhash64("doc_id", "text_key"), F.lit(rounds)) == k).coalesce(tasks)
        path = fresh_path(spark, "units")
        one = cut(score_blocks(write_blocks(part, table, path), model))
        delete(spark, path)
        release(spark, SETTLE)
        scored = one if scored is None else scored.unionByName(one)
    model.drop(spark)
    return scored


def _excess(median: Column) -> Column:
    return (F.col("__ppl") - median) * F.sqrt(F.least("__n", F.lit(STEADY)))


def _limits(held: DataFrame) -> DataFrame:
    """(lang, median, limit) from held-out good texts (lang, __ppl, __n); a null-safe lang of '*' stands for all."""
    both = cut(held.where("__ppl IS NOT NULL").select(F.explode(F.array(F.coalesce("lang", F.lit("")), F.lit("*"))).alias("group"), "__ppl", "__n"))
    middle = both.groupBy("group").agg(F.count("*").alias("n"), F.percentile_approx("__ppl", 0.5, 10_000).alias("median")) \
        .where((F.col("n") >= MIN_GROUP) | (F.col("group") == "*"))
    return both.join(small_side(middle), "group").withColumn("z", _excess(F.col("median"))) \
        .groupBy("group", "median").agg(F.percentile_approx("z", QUANTILE, 10_000).alias("limit"))


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, lang, text_key, __ppl, __n, __kept) of every row of ``docs`` (doc_id, lang, text)."""
    told = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", F.coalesce("text", F.lit("")).alias("text"))
    roles = cut(trusted_labels(labels))
    told = told.join(small_side(roles, MAX_BROADCAST_LABELS), F.col("doc_id") == F.col("label_id"), "left") \
        .select("doc_id", "lang", "held", text_key(F.col("text")).alias("text_key"), "text")
    with small_batches(docs.sparkSession):
        scored = score(told, told.where("NOT held").select("text"))
    return _judged(scored, cut(_limits(scored.where("held").select("lang", "__ppl", "__n"))))


def _judged(scored: DataFrame, limits: DataFrame) -> DataFrame:
    own = limits.where("`group` <> '*'").select(F.col("group").alias("__lang"), F.col("median").alias("__m"), F.col("limit").alias("__l"))
    whole = limits.where("`group` = '*'").first()  # one row, or none without held-out texts
    middle, most = (whole["median"], whole["limit"]) if whole else (None, None)
    df = scored.withColumn("__lang", F.coalesce("lang", F.lit(""))).join(small_side(own), "__lang", "left")
    excess = _excess(F.coalesce("__m", F.lit(middle).cast("double"))) - F.coalesce("__l", F.lit(most).cast("double"))
    excess = F.coalesce(excess, F.lit(0.0))
    return df.withColumn("__kept", F.col("__ppl").isNotNull() & (excess <= 0))


def judge_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, lang, n_chars, perplexity, kept) of every row of ``docs`` (doc_id, text, lang)."""
    return judged(docs, labels).select("doc_id", "lang", F.col("__n").alias("n_chars"), F.exp("__ppl").alias("perplexity"), F.col("__kept").alias("kept"))


def filter_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier keeps, with all their columns."""
    bad = cut(judged(docs, labels).where("NOT __kept").select(F.col("doc_id").alias("__d"), F.col("lang").alias("__g"), F.col("text_key").alias("__k")).distinct())
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__d")) & F.col("lang").eqNullSafe(F.col("__g")) & (text_key(F.col("text")) == F.col("__k"))
    return docs.join(small_side(bad), same, "left_anti")
