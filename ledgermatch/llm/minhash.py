"""Operator 3: near duplicates by MinHash with tensored banding, every link confirmed on full sets.

A text's set holds its distinct 4-word shingles (a shorter text: its words as one). Texts with equal sets are one node.
Instead of m * m bands with minhashes of their own, two collections of m small bands of three
minhashes are computed, and the table keys are all pairs of a band of one with a band of the
other: 6 m minhashes for m * m keys. At a similarity of 0.8 a pair shares no band of a collection
with probability (1 - 0.8^3)^m, 2e-4 for m = 12, and otherwise shares a key.
A band that no other text has cannot be half of a shared key, so only bands seen twice are paired.

Each key links its texts to the smallest of them: candidate links. Their components are candidate
groups; every pair of texts that share a key lies in one. A group is cut into blocks of bounded
size, and each pair of blocks is one task that counts common shingles over an inverted index of its texts. It passes over a
pair only when both are known to be connected, and gives the links that connect them, never all pairs. The
components of the confirmed links are the result.

Shingles are compared by 64-bit hashes.

Nulls: a null or empty text has an empty set and is linked with nothing; a text with a null doc_id is linked with
nothing (component null, kept). Rows that share a doc_id are one document with the links of all its texts, each row
reported; ``deduplicate`` keeps one row of them. An empty table gives no rows. Other columns are ignored, ``deduplicate``
keeps them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgermatch.llm.common import cut, distinct, held, release, slices, small_batches
from ledgermatch.llm.components import components

SHINGLE = 4
BANDS, ROWS = 12, 3
#: Bound of a block: shingles plus ``PER_TEXT`` for each text.
BLOCK_WEIGHT, PER_TEXT = 250_000, 200
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_SEEDS = np.random.default_rng(20240607).integers(1, 2 ** 63, size=2 * BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


class _Words(dict):
    """word -> 64-bit hash, for one worker."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str, words: _Words, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the shingles; bytes.lower and bytes.split are exactly A-Z and \\x20, \\x09-\\x0D."""
    own = text.encode("utf-8", "surrogatepass").lower().split()
    if not own:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(words.__getitem__, own), np.uint64, len(own))
    if len(own) < size:  # the whole sequence; its length keeps it apart from longer shingles
        return _mixed(np.array([sum(int(x) * int(p) for x, p in zip(h, _PLACES)) + len(own) & 0xFFFFFFFFFFFFFFFF], np.uint64))
    n = len(h) - size + 1
    total = np.zeros(n, np.uint64)
    for k in range(size):
        total += h[k:n + k] * _PLACES[k]
    return distinct(_mixed(total))


def bands(shingles: np.ndarray) -> np.ndarray:
    """2 * BANDS values, each of ROWS minhashes."""
    low = np.array([(shingles * s).min() for s in _SEEDS]).reshape(2 * BANDS, ROWS)
    out = np.arange(2 * BANDS, dtype=np.uint64)
    for k in range(ROWS):
        out = _mixed(out * _PLACES[0] + low[:, k])
    return out.view(np.int64)


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, set_key, bands) of each row; set_key is a 128-bit hash of the full set, null if empty."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        for batch in slices(batches, "text"):
            sets = [shingle_set(t, words) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                 pa.array([bands(s) if len(s) else None for s in sets], pa.list_(pa.int64()))],
                ["doc_id", "n_shingles", "set_key", "bands"])

    return docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")) \
        .mapInArrow(sketch, "doc_id long, n_shingles long, set_key binary, bands array<long>")


def candidate_links(nodes: DataFrame) -> DataFrame:
    """(a, b) links between ``nodes`` (node, bands) such that texts that share a key are connected."""
    single = nodes.select("node", F.posexplode("bands").alias("band", "value"))
    # Bands that two nodes have at least; counting is pre-aggregated, the join splits a frequent one.
    shared = single.groupBy("band", "value").agg(F.count("*").alias("n")).where("n > 1").select(
        F.col("band").alias("__b"), F.col("value").alias("__v"))
    kept = single.join(shared, (F.col("band") == F.col("__b")) & (F.col("value") == F.col("__v"))).select("node", "band", "value")
    both = kept.groupBy("node").agg(F.collect_list(F.struct("band", "value")).alias("all"))  # at most 2 * BANDS
    both = held(both, one=F.filter("all", lambda x: x["band"] < BANDS), two=F.filter("all", lambda x: x["band"] >= BANDS)).drop("all")
    keys = F.flatten(F.transform("one", lambda x: F.transform("two", lambda y: F.xxhash64(x["band"], x["value"], y["band"], y["value"]))))
    keys = cut(both.select("node", F.explode(keys).alias("key")))
    first = keys.groupBy("key").agg(F.min("node").alias("a"), F.count("*").alias("n")).where("n > 1").select(F.col("key").alias("__k"), "a")
    return keys.join(first, F.col("key") == F.col("__k")).where("a <> node").select("a", F.col("node").alias("b")).distinct()


def connect(nodes: np.ndarray, sets: list[np.ndarray], percent: int = 80) -> list[tuple[int, int]]:
    """Links (i, j), 100 * common >= percent * union, that connect all texts which such links connect."""
    n = len(sets)
    size = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(n, dtype=np.int32), size)
    values = np.concatenate(sets)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    starts = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    ends = np.concatenate([starts[1:], [len(values)]])
    once = values[starts]
    group = nodes.copy()  # label of each text's group, equal nodes being one from the start
    links = []

    def compare(i: int) -> None:
        at = np.searchsorted(once, sets[i])
        lists = np.concatenate([owner[starts[k]:ends[k]] for k in at])
        common = np.bincount(lists, minlength=n)
        near = np.flatnonzero(100 * common >= percent * (size + size[i] - common))
        for j in near[group[near] != group[i]]:
            if group[j] != group[i]:
                links.append((i, int(j)))
                group[group == group[j]] = group[i]

    # The first text of each group found so far speaks for it, until no new one is met.
    done = np.zeros(n, bool)
    for i in range(n):
        if not done[i] and not (group[:i] == group[i]).any():
            compare(i)
            done[i] = True
    # Every remaining pair of two groups has an end outside the largest group.
    labels, sizes = np.unique(group, return_counts=True)
    largest = labels[sizes.argmax()]
    for i in range(n):
        if not done[i] and group[i] != largest and (group != group[i]).any():
            compare(i)
    return links


def confirmed_links(docs: DataFrame, groups: DataFrame, sizes: DataFrame) -> DataFrame:
    """(a, b) links of the near duplicates within ``groups`` (node, component); sizes: (node, n_shingles)."""
    spread = Window.partitionBy("component").orderBy("node").rowsBetween(Window.unboundedPreceding, 0)
    weighed = groups.join(sizes, "node").withColumn("block", F.floor(
        F.sum(F.col("n_shingles") + PER_TEXT).over(spread) / BLOCK_WEIGHT).cast("int"))
    blocks = weighed.groupBy("component").agg(F.collect_set("block").alias("blocks"))  # one number per block
    # A text goes to each pair of its block with another (a group of one block: to that alone).
    pairs = F.explode(F.filter("blocks", lambda b: (b != F.col("block")) | (F.size("blocks") == 1)))
    placed = cut(weighed.join(blocks, "component").select("node", "component", "block", pairs.alias("other")).select(
        F.col("node").alias("__node"), "component", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")))
    texts = docs.select(F.col("doc_id").cast("long").alias("node"), "text").join(
        placed.select("__node").distinct().hint("shuffle_hash"), F.col("node") == F.col("__node"), "left_semi")

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        for batch in slices(batches, "text"):
            sets = [shingle_set(t or "", words).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(sets, pa.binary())], ["node", "shingles"])

    def link(table: pa.Table) -> pa.Table:
        nodes = table.column("node").to_numpy()
        sets = [np.frombuffer(s, np.uint64) for s in table.column("shingles").to_pylist()]
        full = [i for i, s in enumerate(sets) if len(s)]
        nodes, sets = nodes[full], [sets[i] for i in full]
        found = connect(nodes, sets) if len(sets) > 1 else []
        return pa.table({"a": pa.array([int(nodes[i]) for i, _ in found], pa.int64()), "b": pa.array([int(nodes[j]) for _, j in found], pa.int64())})

    shingled = texts.mapInArrow(sets_of, "node long, shingles binary")
    tasks = shingled.join(placed, F.col("node") == F.col("__node")).select("node", "shingles", "component", "low", "high")
    return tasks.groupBy("component", "low", "high").applyInArrow(link, "a long, b long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs`` (doc_id, text)."""
    with small_batches(docs.sparkSession):
        sketched = cut(sketches(docs))
    named = sketched.where("set_key IS NOT NULL AND doc_id IS NOT NULL")
    # Equal sets are one node, named by their smallest doc_id.
    nodes = cut(named.groupBy("set_key").agg(F.min("doc_id").alias("node")))
    nodes_of = nodes.withColumnRenamed("set_key", "__key")
    first = named.join(nodes_of, (F.col("set_key") == F.col("__key")) & (F.col("doc_id") == F.col("node")))
    candidates = cut(components(candidate_links(first.select("node", "bands").distinct())))
    release(docs.sparkSession)
    sizes = first.groupBy("node").agg(F.max("n_shingles").alias("n_shingles"))
    with small_batches(docs.sparkSession):
        links = cut(confirmed_links(docs, candidates, sizes))
    release(docs.sparkSession)
    # A doc_id with several texts connects the nodes of all of them.
    same_id = named.join(nodes_of, F.col("set_key") == F.col("__key")).where("doc_id <> node").select(F.col("node").alias("a"), F.col("doc_id").alias("b"))
    repeated = same_id.join(named.groupBy("doc_id").agg(F.count_distinct("set_key").alias("n")).where("n > 1").select(F.col("doc_id").alias("b")), "b")
    found = components(links.unionByName(repeated.select("a", "b")))
    joined = named.select("doc_id", "n_shingles", "set_key").join(nodes_of, F.col("set_key") == F.col("__key")) \
        .join(found.withColumnRenamed("node", "__node"), F.col("node") == F.col("__node"), "left") \
        .select("doc_id", "n_shingles", F.coalesce("component", "node").alias("component_id"))
    alone = sketched.where("set_key IS NULL OR doc_id IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return joined.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def deduplicate(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` for each group of near duplicates, with all its columns: that of the smallest doc_id."""
    judged = near_duplicates(docs)
    gone = judged.where("NOT kept").select(F.col("doc_id").alias("__gone")).distinct()
    left = docs.join(gone, F.col("doc_id") == F.col("__gone"), "left_anti")
    again = judged.where("kept AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1")
    if again.isEmpty():
        return left
    once = left.join(again.select(F.col("doc_id").alias("__again")), F.col("doc_id") == F.col("__again"), "left_anti")
    return once.unionByName(left.join(again.select(F.col("doc_id").alias("__again")), F.col("doc_id") == F.col("__again"), "left_semi")
                            .dropDuplicates(["doc_id"]))
