"""Operator 6: benchmark decontamination by winnowing.

Of every 13 consecutive words a text keeps the smallest of their seven 7-word hashes (a robust winnow: k = 7,
window = 7), so two texts that share 13 words in a row share a kept hash. The kept hashes of the documents
are joined with those of the items; each match gives an alignment of item and document, and
along an alignment the match is extended over the whole item: runs of at least 13 equal words are hit.
Of an item all places of its kept hashes are listed, so a hash that occurs twice within a window cannot hide the
right alignment. Items with fewer than 13 words are one window: their whole hash is looked up at every place of
the documents, once for each length that occurs.

Words are compared by their 64-bit hashes.

Nulls: a null text has no words; a null item_id counts as an item but has no name in the list. Rows that share
a doc_id are judged each by its own text, repeated rows alike; repeated item_ids are one item with several texts.
Empty tables give no rows or no hits. Other columns of the input are ignored, ``clean_documents`` keeps them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermatch.llm.common import cut, held, small_side

WINDOW = 13
GRAM = 7
KEEP = WINDOW - GRAM + 1  # hashes a window is reduced from
#: Item hashes up to this number are broadcast (about 24 bytes each); beyond it both sides are shuffled by hash.
MAX_BROADCAST_HASHES = 200_000
#: Words of whole items that are broadcast (8 bytes each) to extend matches along; beyond it Spark chooses the join.
MAX_BROADCAST_WORDS = 4_000_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def word_hashes(text: Column) -> Column:
    """One hash per word of a whole text."""
    words = F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), _BETWEEN), "")
    return F.transform(words, lambda w: F.xxhash64(w))


def text_key(text: Column) -> Column:
    """Tells rows with one doc_id and different texts apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _grams(words: Column, size: int) -> Column:
    n = F.size(words)
    made = F.transform(F.sequence(F.lit(0), n - size), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(size)]))
    return F.when(n >= size, made).otherwise(F.array().cast("array<bigint>"))


def _window_minima(marked: Column) -> Column:
    """The smallest of each ``KEEP`` consecutive values."""
    n = F.size(marked)
    made = F.transform(F.sequence(F.lit(0), n - KEEP), lambda i: F.least(*[F.get(marked, i + k) for k in range(KEEP)]))
    return F.when(n >= KEEP, made).otherwise(F.array().cast("array<bigint>"))


def _marked(grams: Column) -> Column:
    """Hashes whose last three bits hold the place modulo 8: within a window that is the place itself."""
    return F.transform(grams, lambda h, i: F.shiftleft(F.shiftright(h, 3), 3).bitwiseOR(i.cast("long").bitwiseAND(F.lit(7))))


def _winnowed(minima: Column) -> Column:
    """(hash, place) of each kept hash; consecutive windows with the same one give it once."""
    def kept(x, i):
        place = i + F.pmod(x.bitwiseAND(F.lit(7)) - i, F.lit(8))
        new = (i == 0) | (x != F.get(minima, i - 1))
        return F.when(new, F.struct(F.shiftright(x, 3).alias("hash"), place.cast("int").alias("place")))
    return F.filter(F.transform(minima, kept), lambda x: x.isNotNull())


def _item_hashes(items: DataFrame) -> DataFrame:
    """(size, hash, item, at): where the items' kept hashes stand; size is 7, or the length of a short item."""
    long_ = held(items.where(F.size("words") >= WINDOW), g=_marked(_grams(F.col("words"), GRAM)))
    long_ = held(long_, kept=F.array_distinct(F.transform(_window_minima(F.col("g")), lambda x: F.shiftright(x, 3))))
    long_ = long_.select("item", "kept", F.posexplode("g").alias("at", "x")) \
        .where(F.array_contains("kept", F.shiftright("x", 3))).select(F.lit(0).alias("short"), F.shiftright("x", 3).alias("hash"), "item", "at")
    short = items.where((F.size("words") < WINDOW) & (F.size("words") > 0)).select(
        F.size("words").alias("short"), F.aggregate("words", F.lit(42).cast("long"), lambda a, w: F.xxhash64(a, w)).alias("hash"), "item", F.lit(0).alias("at"))
    return long_.unionByName(short)


def _short_grams(words: Column, size: int) -> Column:
    """(hash, place) of every run of ``size`` words, hashed as a short item is."""
    def one(i):
        h = F.lit(42).cast("long")
        for k in range(size):
            h = F.xxhash64(h, F.get(words, i + k))
        return F.struct(h.alias("hash"), i.alias("place"))
    made = F.transform(F.sequence(F.lit(0), F.size(words) - size), one)
    return F.when(F.size(words) >= size, made).otherwise(F.array().cast("array<struct<hash:bigint,place:int>>"))


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, text_key, n_words, n_hit, n_items, items_sha256, contaminated) of every row of ``docs`` (doc_id, text)."""
    items = cut(benchmark.select(F.monotonically_increasing_id().alias("item"), "item_id", word_hashes(F.col("text")).alias("words")))
    sizes = sorted(r[0] for r in items.select(F.size("words").alias("n")).where(f"n BETWEEN 1 AND {WINDOW - 1}").distinct().collect())  # at most 12
    hashes = _item_hashes(items)

    df = held(docs.select("doc_id", "text"), text_key=text_key(F.col("text")), words=word_hashes(F.col("text"))).drop("text")
    df = held(df, g=_marked(_grams(F.col("words"), GRAM)))
    df = held(df, m=_window_minima(F.col("g"))).drop("g")
    def labelled(found: Column, size: int) -> Column:
        return F.transform(found, lambda x: F.struct(F.lit(size).alias("short"), x["hash"].alias("hash"), x["place"].alias("place")))

    prints = labelled(_winnowed(F.col("m")), 0)
    for n in sizes:
        prints = F.concat(prints, labelled(_short_grams(F.col("words"), n), n))
    # Each text also sends one row with its length; its hash spreads these rows and matches nothing.
    head = F.array(F.struct(F.lit(-1).alias("short"), F.col("text_key").alias("hash"), F.size("words").alias("place")))
    prints = df.select("doc_id", "text_key", F.explode(F.concat(head, prints)).alias("p")).select("doc_id", "text_key", "p.*")
    found = cut(prints.join(small_side(hashes, MAX_BROADCAST_HASHES), ["short", "hash"], "left")
                .where("short < 0 OR item IS NOT NULL")
                .select("doc_id", "text_key", "item", "short", F.when(F.col("short") < 0, F.col("place")).alias("n_words"),
                        (F.col("place") - F.col("at")).alias("shift")))
    heads = found.where("short < 0").select("doc_id", "text_key", F.col("n_words").cast("long"))
    aligned = cut(found.where("short >= 0").select("doc_id", "text_key", "item", "shift").distinct())

    hit = _extended(docs, items, aligned)
    of_doc = hit.select("doc_id", "text_key", "at").distinct().groupBy("doc_id", "text_key").agg(F.count("*").alias("n_hit"))
    named = hit.select("doc_id", "text_key", "item").distinct().join(small_side(items.select("item", "item_id")), "item") \
        .select("doc_id", "text_key", F.col("item_id").cast("string").alias("name"), F.col("item_id").isNull().alias("unnamed")).distinct()
    named = named.groupBy("doc_id", "text_key").agg(
        F.count("*").alias("n_items"), F.sha2(F.array_join(F.sort_array(F.collect_list("name")), ","), 256).alias("sha"))
    # A table without hits is usual; repeated rows of a document share their row here.
    told = of_doc.join(named.withColumnsRenamed({"doc_id": "__d", "text_key": "__k"}),
                       F.col("doc_id").eqNullSafe(F.col("__d")) & (F.col("text_key") == F.col("__k"))) \
        .select(F.col("doc_id").alias("__d"), F.col("text_key").alias("__k"), "n_hit", "n_items", "sha")
    out = heads.join(told, F.col("doc_id").eqNullSafe(F.col("__d")) & (F.col("text_key") == F.col("__k")), "left")
    n_hit = F.coalesce("n_hit", F.lit(0))
    return out.select("doc_id", "text_key", "n_words", n_hit.alias("n_hit"), F.coalesce("n_items", F.lit(0)).alias("n_items"),
                      F.coalesce("sha", F.sha2(F.lit(""), 256)).alias("items_sha256"),
                      ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"))


def _item_words(items: DataFrame) -> DataFrame:
    """(item, words), marked for broadcast if items and words are few."""
    words = items.select("item", "words")
    n = items.agg(F.sum(F.size("words").cast("long"))).first()[0] or 0
    return small_side(words) if n <= MAX_BROADCAST_WORDS else words


def _extended(docs: DataFrame, items: DataFrame, aligned: DataFrame) -> DataFrame:
    """(doc_id, text_key, item, at): the words hit along the alignments."""
    al = aligned.withColumnsRenamed({"doc_id": "__d", "text_key": "__k"})
    texts = docs.select("doc_id", "text", text_key(F.col("text")).alias("text_key")) \
        .join(small_side(al.select("__d", "__k").distinct()), F.col("doc_id").eqNullSafe(F.col("__d")) & (F.col("text_key") == F.col("__k")), "left_semi") \
        .dropDuplicates(["doc_id", "text_key"]).select("doc_id", "text_key", word_hashes(F.col("text")).alias("doc_words"))
    # Only the part of the document beside the item goes on.
    pairs = texts.join(al, F.col("doc_id").eqNullSafe(F.col("__d")) & (F.col("text_key") == F.col("__k"))) \
        .join(_item_words(items), "item")
    first, beside = F.greatest(F.col("shift"), F.lit(0)), F.size("words") + F.col("shift")
    pairs = pairs.select("doc_id", "text_key", "item", "words", "shift",
                         F.slice("doc_words", first + 1, F.greatest(beside - first, F.lit(0))).alias("part"))
    skip = F.greatest(-F.col("shift"), F.lit(0))
    bits = F.array_join(F.transform("part", lambda w, i: F.when(w == F.get("words", i + skip), F.lit("1")).otherwise(F.lit("0"))), "")
    enough = F.least(F.lit(WINDOW), F.size("words"))
    runs = F.transform(F.split(bits, "0"), lambda r: F.when(F.length(r) >= enough, r).otherwise(F.repeat(F.lit("0"), F.length(r))))
    pairs = pairs.select("doc_id", "text_key", "item", first.alias("first"), F.array_join(runs, "0").alias("hits")).where("hits LIKE '%1%'")
    return pairs.select("doc_id", "text_key", "item", "first", F.posexplode(F.split("hits", "")).alias("i", "hit")).where("hit = '1'") \
        .select("doc_id", "text_key", "item", (F.col("first") + F.col("i")).alias("at"))


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns."""
    bad = contamination(docs, benchmark).where("contaminated").select(F.col("doc_id").alias("__d"), F.col("text_key").alias("__k")).distinct()
    bad = cut(bad)  # counted and joined
    return docs.join(small_side(bad), F.col("doc_id").eqNullSafe(F.col("__d")) & (text_key(F.col("text")) == F.col("__k")), "left_anti")
