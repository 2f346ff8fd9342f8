"""Spelling variants: words that differ by one code point, by dense prefix-suffix tiles.

Two words differ by one inserted, deleted or replaced code point exactly if common prefix and common suffix together reach
the longer length m less one. Cut the m places into segments: the segment in which the common prefix ends is the only place
where they differ, so both share what stands before and behind it. Words meet under that key, are laid into padded
code-point matrices of ``TILE`` rows, and pairs of tiles that hold a common key are compared as whole matrices. A pair is
counted in the segment where its common prefix ends, thus once. No pairs leave a task, only a word's number of near words
and the best of them.

Segments have ``SEGMENT`` places (a ``MAX_SEGMENTS``-th of very long words), so a key has at most A^2 + A words over an
alphabet of A code points, 8,190 for the 90 of the counting step: no key grows with the data.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermatch.llm.common import cut, fresh_path, release, slices

SEGMENT = 2
MAX_SEGMENTS = 16
TILE = 256
#: Entries a task counts in memory before it hands them on.
HELD = 300_000
#: Bytes of one text searched at once.
BLOCK = 1 << 20
#: A form has at least twice the occurrences of its word, so chains are short: 2^ROUNDS steps.
ROUNDS = 8

_RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")


def _emit(counts: Counter) -> Iterator[pa.RecordBatch]:
    words = list(counts)
    for at in range(0, len(words), 50_000):
        some = words[at:at + 50_000]
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.binary()).cast(pa.string()), pa.array([counts[w] for w in some], pa.int64())],
                                         ["word", "n"])
    counts.clear()


def _runs(text: bytes) -> Iterator[list[bytes]]:
    at = 0
    while at < len(text):
        end = at + BLOCK
        # A run must not be cut: go on to its end.
        while end < len(text) and (97 <= text[end] <= 122 or text[end] >= 0x80):
            end += 1
        yield _RUN.findall(text, at, end)
        at = end


def _count(modulus: int, min_length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in slices(batches, "text"):
            for doc, text in zip(batch.column("doc").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(), strict=True):
                own: Counter = Counter()
                for found in _runs(text.lower()):
                    own.update(found)
                seed = crc32(f"{doc}:".encode())
                for word, n in own.items():
                    h = crc32(word, seed)
                    if not h % modulus:
                        letters = word.decode()
                        k = h % len(letters)
                        word = (letters[:k] + letters[k + 1:]).encode()
                    # Two bytes a code point at most: a shorter one need not be decoded.
                    if len(word) >= min_length and (len(word) >= 2 * min_length or len(word.decode()) >= min_length):
                        counts[word] += n
                if len(counts) > HELD:
                    yield from _emit(counts)
        yield from _emit(counts)
    return run


def count_words(docs: DataFrame, modulus: int = 97, min_length: int = 5, min_count: int = 3) -> DataFrame:
    """(word, n): words of the texts with their occurrences, after the planned slips (contract of op13).

    Maximal runs of Latin letters, A-Z lower-cased; a run loses a code point where ``modulus`` divides its hash with doc_id
    (a null doc_id is hashed as an empty one). Null and empty texts have none, repeated rows count as often as they stand.
    """
    texts = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), "text").where("text IS NOT NULL")
    return (texts.mapInArrow(_count(modulus, min_length), "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count))


def _segments(m: int) -> int:
    """Places of a segment in words of ``m`` places."""
    return max(SEGMENT, -(-m // MAX_SEGMENTS))


def _keyed(words: DataFrame) -> DataFrame:
    """(key, m, j, word, n): a row for each segment j of the longer length m, which may be the word's own or one more."""
    size = f"greatest({SEGMENT}, cast(ceil(m / {MAX_SEGMENTS}) AS int))"
    return (words.withColumn("length", F.length("word"))
            .select("word", "n", "length", F.explode(F.expr("array(length, length + 1)")).alias("m"))
            .withColumn("size", F.expr(size))
            .select("*", F.explode(F.expr("sequence(0, cast(ceil(m / size) AS int) - 1)")).alias("j"))
            .select(F.expr("xxhash64(m, j, substring(word, 1, j * size), right(word, m - least(m, (j + 1) * size)))").alias("key"),
                    "m", "j", "word", "n"))


class _Rows:
    """Rows in key order with what tiles need of them, and the pairs found among them."""

    def __init__(self, batch: pa.RecordBatch):
        self.words = batch.column("word").to_pylist()
        self.n = batch.column("n").to_numpy()
        m, j, key = (batch.column(c).to_numpy() for c in ("m", "j", "key"))
        self.key = (key, m, j)
        new = np.ones(len(key), dtype=bool)
        new[1:] = (key[1:] != key[:-1]) | (m[1:] != m[:-1]) | (j[1:] != j[:-1])
        self.group = np.cumsum(new)
        length = np.array([len(w) for w in self.words])
        self.long = length == m
        size = np.array([_segments(x) for x in m.tolist()])
        start, stop = j * size, np.minimum(m, (j + 1) * size)
        self.need = stop - start - 1
        wide = int((stop - start).max(initial=1))
        codes = np.frombuffer("".join(self.words).encode("utf-32-le"), np.uint32)
        offset = np.cumsum(length) - length
        place = np.arange(wide)
        # After the shared prefix, and (from the end) before the shared suffix; 0 where the word or the segment is over.
        at = start[:, None] + place
        inside = (place < (stop - start)[:, None]) & (at < length[:, None])
        self.ahead = np.where(inside, codes[np.minimum(offset[:, None] + at, len(codes) - 1)], 0) if len(codes) else np.zeros((0, wide), np.uint32)
        at = (length - (m - stop) - 1)[:, None] - place
        inside = (place < (stop - start)[:, None]) & (at >= 0)
        self.behind = np.where(inside, codes[np.maximum(offset[:, None] + at, 0)], 0) if len(codes) else np.zeros((0, wide), np.uint32)
        self.width = stop - start

    def tile(self, a: slice, b: slice) -> tuple[np.ndarray, np.ndarray]:
        """Near pairs (rows, rows) between two tiles of rows; of one tile with itself each pair once."""
        near = (self.group[a][:, None] == self.group[b][None, :]) & (self.long[a][:, None] | self.long[b][None, :])
        if a == b:
            near &= np.tri(a.stop - a.start, dtype=bool).T
            np.fill_diagonal(near, False)
        if not near.any():
            return np.empty(0, int), np.empty(0, int)
        width = int(self.width[a].max())
        common = []
        for side in (self.ahead, self.behind):
            alive = np.ones(near.shape, dtype=bool)
            length = np.zeros(near.shape, dtype=np.int16)
            for c in range(width):
                alive &= side[a, c][:, None] == side[b, c][None, :]
                length += alive
            common.append(np.minimum(length, self.width[a][:, None]))
        before, after = common
        # The prefix ends in this segment, and prefix and suffix reach the longer length less one.
        near &= (before < self.width[a][:, None]) & (before + after >= self.need[a][:, None])
        x, y = np.nonzero(near)
        return x + a.start, y + b.start

    def same_key(self, x: int, y: int) -> bool:
        """The words really share what the hash of the key stands for."""
        one, two, m = self.words[x], self.words[y], int(self.key[1][x])
        size, j = _segments(m), int(self.key[2][x])
        behind = m - min(m, (j + 1) * size)
        return one[:j * size] == two[:j * size] and one[len(one) - behind:] == two[len(two) - behind:]

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        last = np.append(np.flatnonzero(np.diff(self.group)), len(self.group) - 1) if len(self.group) else np.empty(0, int)
        found = []
        for at in range(0, len(self.group), TILE):
            a = slice(at, min(at + TILE, len(self.group)))
            end = int(last[np.searchsorted(last, a.stop - 1)]) + 1  # of the group in which the tile ends
            found.append(self.tile(a, a))
            for to in range(a.stop, end, TILE):
                found.append(self.tile(a, slice(to, min(to + TILE, end))))
        if not found:
            return np.empty(0, int), np.empty(0, int)
        x, y = (np.concatenate(side) for side in zip(*found, strict=True))
        true = np.fromiter(map(self.same_key, x.tolist(), y.tolist()), bool, len(x))
        return x[true], y[true]

    def near(self) -> pa.RecordBatch:
        """Per word and key: how many near words, and the most frequent (then smallest) of them."""
        x, y = self.pairs()
        x, y = np.concatenate([x, y]), np.concatenate([y, x])
        best: dict[int, tuple[int, int, str]] = {}
        for row, other, n in zip(x.tolist(), y.tolist(), self.n[y].tolist(), strict=True):
            seen, most, word = best.get(row, (0, -1, ""))
            name = self.words[other]
            best[row] = (seen + 1, n, name) if n > most or n == most and name < word else (seen + 1, most, word)
        return pa.RecordBatch.from_arrays(
            [pa.array([self.words[r] for r in best], pa.string()), pa.array([b[0] for b in best.values()], pa.int64()),
             pa.array([-b[1] for b in best.values()], pa.int64()), pa.array([b[2] for b in best.values()], pa.string())],
            ["word", "near", "less", "form"])


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in key order: whole keys are handed on, the last key of a batch waits for the next."""
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        key, m, j = (batch.column(c).to_numpy() for c in ("key", "m", "j"))
        other = np.flatnonzero((key != key[-1]) | (m != m[-1]) | (j != j[-1]))
        if waiting and not len(other):
            held = waiting[-1]
            if any(held.column(c)[held.num_rows - 1] != batch.column(c)[0] for c in ("key", "m", "j")):
                yield _Rows(_joined(waiting)).near()
                waiting = []
        if len(other):
            whole = int(other[-1]) + 1
            yield _Rows(_joined([*waiting, batch.slice(0, whole)])).near()
            waiting, batch = [], batch.slice(whole)
        waiting.append(batch)
    if waiting:
        yield _Rows(_joined(waiting)).near()


def _joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, form, form_n): per word that has one, its near words counted, and the most frequent of them (ties: smallest).

    ``words`` has distinct ``word`` and ``n``; empty words and nulls take no part.
    """
    rows = _keyed(words.where("word <> ''").select("word", "n"))
    ordered = rows.repartition("key").sortWithinPartitions("key", "m", "j")
    found = ordered.mapInArrow(_tiles, "word string, near long, less long, form string")
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), F.min(F.struct("less", "form")).alias("best")).select(
        "word", "n_near", F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of every word of ``forms`` (word, form): follow forms to the last, by doubling the steps of a round."""
    steps = cut(forms.select("word", F.col("form").alias("root")))
    for _ in range(ROUNDS):
        ahead = steps.select(F.col("word").alias("root"), F.col("root").alias("__next"))
        further = cut(steps.join(ahead, "root", "left").select("word", F.coalesce("__next", "root").alias("root"),
                                                               F.col("__next").isNotNull().alias("moved")))
        moved = further.where("moved").limit(1).count()
        steps = further.select("word", "root")
        if not moved:
            return steps
        release(forms.sparkSession)
    raise RuntimeError(f"a chain of forms is longer than 2^{ROUNDS}")


def group_variants(words: DataFrame, times: int = 2) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every row of ``words`` (distinct word, n).

    A word's form is its most frequent near word, if it has at least ``times`` the word's occurrences (``times`` over 1, so
    chains end). A word without form is its own root.
    """
    spark = words.sparkSession
    path = fresh_path(spark, "words")
    words.select("word", "n").write.parquet(path)
    release(spark)
    words = spark.read.parquet(path)
    path = fresh_path(spark, "near")
    near_words(words).write.parquet(path)
    release(spark)
    near = spark.read.parquet(path)
    joined = words.join(near, "word", "left")
    fits = F.col("form_n") >= times * F.col("n")
    forms = joined.where(fits).select("word", "form")
    return joined.join(roots(forms), "word", "left").select(
        "word", F.when(fits, F.col("form")).alias("form"), F.coalesce("root", "word").alias("root"), "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(fits, F.col("form_n")).alias("form_n"))
