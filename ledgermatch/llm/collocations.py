"""Phrase collocations by prefix-free parsing.

A piece of text is cut before every window of ``max_words - 1`` words whose hash is a multiple of ``PERIOD``; a chunk keeps
the window it runs into, so chunks overlap by that window and equal texts are cut alike wherever they stand. The distinct
chunks are the dictionary, their counts the parse frequencies. A phrase starts in exactly one chunk before its overlap and
ends inside it, so phrases are counted once per distinct chunk, weighted by the chunk's frequency.

Nearly all phrases are rare, and a phrase is as frequent as its parts at most. So phrases of one and two words are first
counted by hashes of 64 bits, in shards whose number follows the dictionary; the frequent ones set bits of a filter of fixed
size (16 MB). Texts are then counted of what the filter lets through. It may let rare phrases through, more of them as it
fills, and holds back no frequent one: the counts by text decide.

Nulls, empty texts and texts of separators alone have no words. A null language is ``und``. Repeated rows count as often as
they stand. An empty table gives no rows. Other columns are not read. Long texts are parsed a few hundred KB at a time, cut
between pieces.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import chain
from zlib import compress, crc32, decompress

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgermatch.llm.common import cut, fresh_path, release, slices

#: One window in so many starts a chunk. Pieces end chunks as well, so a change resynchronises within a sentence anyway.
PERIOD = 32
#: Entries a task counts in memory before it hands them on.
HELD = 300_000
#: Bytes of chunks that a task counts at once, and hashes of a shard (about).
HELD_BYTES, SHARD_HASHES = 10 << 20, 2_000_000
#: Size of the filter of frequent phrases: 2^27 bits are 16 MB.
FILTER_BITS = 27
#: Bytes of one text parsed at once.
BLOCK = 1 << 18
#: Parts in which a language's best rows are found before its own order is made.
RANK_PARTS = 64

_SEPARATORS = bytes.maketrans(b".,;:!?\x0b\x0c\r", b"\n" * 9)
_COUNTS = "lang string, phrase string, n long"


def _blocks(text: bytes) -> Iterator[list[list[bytes]]]:
    """The pieces of a text as lists of words, some hundred KB of text at a time."""
    at = 0
    while at < len(text):
        end = text.find(b"\n", at + BLOCK)
        end = len(text) if end < 0 else end
        yield [w for w in map(bytes.split, text[at:end].split(b"\n")) if w]
        at = end + 1


def _chunks(pieces: list[list[bytes]], window: int) -> list[bytes]:
    """The chunks of some pieces; one that runs into another ends with a space, its last ``window`` words are the overlap."""
    words = [w for piece in pieces for w in piece]
    lengths = np.array([len(piece) for piece in pieces])
    ends = np.cumsum(lengths)
    end = np.repeat(ends, lengths)
    begins = np.zeros(len(words), dtype=bool)
    begins[ends - lengths] = True
    if len(words) > window:
        hashes = np.fromiter(map(crc32, words), np.uint64, len(words))
        mixed = np.zeros(len(words) - window + 1, dtype=np.uint64)
        for k in range(window):
            mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + hashes[k:k + len(mixed)]
        mixed = (mixed * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(33)
        fits = np.arange(len(mixed)) + window <= end[:len(mixed)]
        begins[:len(mixed)] |= fits & (mixed % np.uint64(PERIOD) == 0)
    starts = np.flatnonzero(begins)
    nexts = np.append(starts[1:], len(words))
    own_end = end[starts]
    runs_on = nexts < own_end
    stops = np.where(runs_on, nexts + window, own_end)
    return [b" ".join(words[a:z]) + b" " if on else b" ".join(words[a:z])
            for a, z, on in zip(starts.tolist(), stops.tolist(), runs_on.tolist(), strict=True)]


def _emit(counts: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
    for lang, counter in counts.items():
        keys = list(counter)
        for at in range(0, len(keys), 50_000):
            some = keys[at:at + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(some), pa.string()), pa.array(some, pa.binary()).cast(pa.string()),
                 pa.array([counter[k] for k in some], pa.int64())], ["lang", "phrase", "n"])
    counts.clear()


def _parse(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {}
        held = 0
        for batch in slices(batches, "text"):
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(), strict=True):
                for pieces in _blocks(text.lower().translate(_SEPARATORS)):
                    if pieces:
                        counter = counts.setdefault(lang, Counter())
                        held -= len(counter)
                        counter.update(_chunks(pieces, window))
                        held += len(counter)
                    if held > HELD:
                        yield from _emit(counts)
                        held = 0
        yield from _emit(counts)
    return run


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


class _Grams:
    """The words of many chunks laid out flat as numbers, with hashes of their phrases of one and two words."""

    def __init__(self, chunks: pa.Table, window: int):
        parts = [c.split(b" ") for c in chunks.column("phrase").cast(pa.binary()).to_pylist()]
        runs_on = np.fromiter((not p[-1] for p in parts), bool, len(parts))
        lengths = np.fromiter(map(len, parts), np.int64, len(parts))
        words = list(chain.from_iterable(parts))
        numbers = _Numbers()
        self.word = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
        self.words = list(numbers)
        langs = _Numbers()
        lang = np.fromiter(map(langs.__getitem__, chunks.column("lang").to_pylist()), np.int64, len(parts))
        self.langs, self.lang = list(langs), np.repeat(lang, lengths)
        ends = np.cumsum(lengths)
        place = np.arange(len(words)) - np.repeat(ends - lengths, lengths)
        #: A phrase belongs to the chunk if it starts before the overlap; ``left`` words follow from its place to the chunk's end.
        self.own = place < np.repeat(lengths - runs_on * (1 + window), lengths)
        self.left = np.repeat(lengths - runs_on, lengths) - place
        self.n = np.repeat(chunks.column("n").to_numpy(), lengths)
        seeds = np.fromiter((xxhash.xxh64_intdigest(x) for x in self.langs), np.uint64, len(self.langs))
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, self.words), np.uint64, len(self.words))
        #: Hashes with the language in them, of the words and of each two neighbours.
        self.one = _mixed(seeds[self.lang], hashes[self.word])
        self.two = _mixed(self.one, np.append(hashes[self.word[1:]], np.zeros(min(1, len(words)), np.uint64)))


def _mixed(hashes: np.ndarray, more: np.ndarray) -> np.ndarray:
    mixed = (hashes ^ (hashes >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + more
    return (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Some ``HELD_BYTES`` of chunks at a time."""
    waiting, held = [], 0
    for batch in batches:
        waiting.append(batch)
        held += batch.nbytes
        if held > HELD_BYTES:
            yield pa.Table.from_batches(waiting).combine_chunks()
            waiting, held = [], 0
    if held:
        yield pa.Table.from_batches(waiting).combine_chunks()


def _summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in ascending order, their sums, and a place of each."""
    order = np.argsort(keys)
    ordered = keys[order]
    first = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])) if len(ordered) else np.empty(0, np.int64)
    return ordered[first], np.add.reduceat(n[order], first) if len(first) else n[:0], order[first]


def _hashed_counts(window: int, shard_bits: int):
    """(shard, hashes, counts): phrases of one and two words of many chunks, by the leading bits of their hashes."""
    def flush(found: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        # Counts matter up to the least one asked for; a byte holds enough of them.
        n = np.minimum(n, 255).astype(np.uint8)
        shard = (found >> np.uint64(64 - shard_bits)).astype(np.int64)
        cuts = np.append(np.flatnonzero(np.append(True, shard[1:] != shard[:-1])), len(shard)).tolist()
        spans = list(zip(cuts[:-1], cuts[1:], strict=True))
        return pa.RecordBatch.from_arrays(
            [pa.array([int(shard[a]) for a, _ in spans], pa.int64()), pa.array([found[a:z].tobytes() for a, z in spans], pa.binary()),
             pa.array([n[a:z].tobytes() for a, z in spans], pa.binary())], ["shard", "hashes", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunks in _gathered(batches):
            grams = _Grams(chunks, window)
            pair = grams.own & (grams.left > 1)
            hashes, n = np.concatenate([grams.one[grams.own], grams.two[pair]]), np.concatenate([grams.n[grams.own], grams.n[pair]])
            # Most chunks stand once: their hashes are sorted without weights.
            once = np.sort(hashes[n == 1])
            if len(once):
                first = np.flatnonzero(np.append(True, once[1:] != once[:-1]))
                yield flush(once[first], np.diff(np.append(first, len(once))))
            found, total, _ = _summed(hashes[n > 1], n[n > 1])
            if len(found):
                yield flush(found, total)
    return run


def _frequent_bits(min_count: int, shard_bits: int):
    """One slice of the filter: the bits of the shard's hashes that occur often enough."""
    def run(key: tuple, table: pa.Table) -> pa.Table:
        hashes = np.concatenate([np.frombuffer(x, np.uint64) for x in table.column("hashes").to_pylist()])
        n = np.concatenate([np.frombuffer(x, np.uint8) for x in table.column("counts").to_pylist()]).astype(np.int64)
        found, total, _ = _summed(hashes, n)
        bits = np.zeros(1 << (FILTER_BITS - shard_bits), dtype=bool)
        places = (found[total >= min_count] >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
        bits[places - (key[0].as_py() << (FILTER_BITS - shard_bits))] = True
        return pa.table({"shard": [key[0].as_py()], "bits": pa.array([compress(np.packbits(bits).tobytes(), 1)], pa.binary())})
    return run


def _filter(chunks: DataFrame, max_words: int, min_count: int, own_words: int) -> np.ndarray:
    """Bits of the hashes of frequent phrases of one and two words; ``1 << FILTER_BITS`` bits whatever the size of the corpus."""
    shard_bits = min(max(4, (2 * own_words // SHARD_HASHES).bit_length()), FILTER_BITS - 3)
    counted = chunks.mapInArrow(_hashed_counts(max_words - 1, shard_bits), "shard long, hashes binary, counts binary")
    slices_ = counted.groupBy("shard").applyInArrow(_frequent_bits(min(min_count, 255), shard_bits), "shard long, bits binary").collect()
    out = np.zeros(1 << (FILTER_BITS - 3), dtype=np.uint8)
    size = 1 << (FILTER_BITS - 3 - shard_bits)
    for row in slices_:
        out[row.shard * size:(row.shard + 1) * size] = np.frombuffer(decompress(row.bits), np.uint8)
    return out


def _count(max_words: int, frequent: Broadcast):
    """Phrases by their text; of one and two words those that the filter lets through, longer ones if all their pairs do."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = frequent.value

        def passes(hashes: np.ndarray) -> np.ndarray:
            place = (hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
            return (bits[place >> 3] >> (7 - (place & 7)).astype(np.uint8) & 1).astype(bool)

        for chunks in _gathered(batches):
            grams = _Grams(chunks, max_words - 1)
            pairs = (grams.left > 1) & passes(grams.two)
            # ``number`` tells the phrases of a size apart: a word in its language, then a shorter phrase and the next word.
            fits, number = grams.own & passes(grams.one), grams.lang << 32 | grams.word
            for size in range(1, max_words + 1):
                if size > 1:
                    fits = fits & np.append(pairs[size - 2:], np.zeros(min(size - 2, len(pairs)), bool)) & (grams.left >= size)
                places = np.flatnonzero(fits)
                if not len(places):
                    break
                if size > 1:
                    number[places] = number[places] << 32 | grams.word[places + size - 1]
                distinct, number[places] = np.unique(number[places], return_inverse=True)
                n = np.bincount(number[places], weights=grams.n[places]).astype(np.int64)
                at = np.empty(len(distinct), np.int64)
                at[number[places]] = places
                texts = list(map(b" ".join, zip(*(map(grams.words.__getitem__, grams.word[at + k].tolist()) for k in range(size)), strict=True)))
                lang = [grams.langs[k] for k in grams.lang[at].tolist()]
                for k in range(0, len(texts), 50_000):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(lang[k:k + 50_000], pa.string()), pa.array(texts[k:k + 50_000], pa.binary()).cast(pa.string()),
                         pa.array(n[k:k + 50_000])], ["lang", "phrase", "n"])
    return run


def dictionary(docs: DataFrame, max_words: int = 3) -> DataFrame:
    """(lang, phrase, n): the distinct chunks of the texts with their frequencies; ``phrase`` is a chunk as ``_chunks`` writes it."""
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text").where("text IS NOT NULL")
    return texts.mapInArrow(_parse(max_words - 1), _COUNTS).groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def _n_words(phrase: str) -> Column:
    return F.size(F.split(phrase, " "))


def _exact_score(a: str, left: str, right: str) -> Column:
    """floor(1000000 * a * a / (l * r)) in whole numbers of 38 digits; exact while a is below 10^16."""
    def wide(c: str, digits: int) -> Column:
        return F.col(c).cast(f"decimal({digits},0)")
    above = (wide(a, 16) * wide(a, 16)).cast("decimal(32,0)") * F.lit(1_000_000).cast("decimal(7,0)")
    return F.call_function("div", above.cast("decimal(38,0)"), (wide(left, 19) * wide(right, 19)).cast("decimal(38,0)"))


def collocations(docs: DataFrame, max_words: int = 3, min_count: int = 10, covered_percent: int = 50, top: int = 2000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of 2 to ``max_words`` words of each language.

    A phrase scores as its weakest cut. One that stands inside a longer candidate in at least ``covered_percent`` of its
    occurrences is left out. The dictionary and the counts of frequent phrases are written to the shared folder, so that a
    lost executor repeats neither the parse nor the counting.
    """
    spark = docs.sparkSession
    window = max_words - 1
    path = fresh_path(spark, "chunks")
    dictionary(docs, max_words).write.parquet(path)
    release(spark)
    chunks = spark.read.parquet(path)
    # Words that a chunk owns: the last field of a chunk that runs on is empty, and its overlap belongs to the next.
    own = F.size(F.split("phrase", " ")) - F.when(F.col("phrase").endswith(" "), 1 + window).otherwise(0)
    totals = cut(chunks.groupBy("lang").agg(F.sum(F.col("n") * own).alias("n"), F.sum(own).alias("n_own")))
    own_words = totals.agg(F.sum("n_own")).first()[0] or 0
    totals = totals.drop("n_own")
    frequent = spark.sparkContext.broadcast(_filter(chunks, max_words, min_count, own_words))
    release(spark)
    counted = chunks.mapInArrow(_count(max_words, frequent), _COUNTS).groupBy("lang", "phrase").agg(F.sum("n").alias("a"))
    path = fresh_path(spark, "phrases")
    # The parts of a frequent phrase are as frequent at least, so rarer ones are needed nowhere.
    counted.where(F.col("a") >= min_count).withColumn("words", _n_words("phrase")).write.parquet(path)
    release(spark)
    phrases = spark.read.parquet(path)
    candidates = phrases.where("words > 1")

    cuts = candidates.select("lang", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")).select(
        "lang", "phrase", "a", "k", F.expr("substring_index(phrase, ' ', k)").alias("first"),
        F.expr("substring_index(phrase, ' ', k - words)").alias("rest"))
    left = phrases.select("lang", F.col("phrase").alias("first"), F.col("a").alias("l"))
    right = phrases.select("lang", F.col("phrase").alias("rest"), F.col("a").alias("r"))
    scored = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).withColumn("score", _exact_score("a", "l", "r"))
    best = scored.groupBy("lang", "phrase").agg(F.max("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    inner = F.expr("""flatten(transform(sequence(2, words - 1), size ->
        transform(sequence(1, words - size + 1), at -> array_join(slice(split(phrase, ' '), at, size), ' '))))""")
    longer = candidates.where("words > 2").select("lang", F.explode(inner).alias("phrase"), F.col("a").alias("longer"))
    cover = longer.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    free = best.join(cover, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (F.lit(100) * F.col("longer") < F.lit(covered_percent) * F.col("a")))

    found = free.select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("cut.score").alias("score"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    parts = found.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS)))
    first = parts.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    # At most ``top`` rows a language are left; the totals are a row a language.
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
