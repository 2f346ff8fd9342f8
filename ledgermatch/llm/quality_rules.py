"""Operator 4: quality rules with thresholds that adapt to language and source.

Fixed rules reject a text with fewer than 10 words or with more than a fifth of its words inside repeated
5-word windows. The other measures have no fixed cutoff: per language and source, percentile_approx
(its buffers are quantile summaries that partial aggregates merge) gives quartiles of each
measure, and a text is rejected that lies above the upper quartile by more than ``FENCE`` times the
quartile distance. Symbols and repeated lines are absent from most texts: their quartiles are those of the texts
that have some, and the limit lies above their median. Groups with fewer than
``min_group`` texts take the quartiles of their language, then of the whole table. The small
table of thresholds is joined back to the texts. ``LEAST_SPREAD`` guards groups whose texts are all alike; it is
a tenth to a third of the distances seen in ordinary groups.

Nulls: a null text has no words; null language or source are groups of their own. Repeated rows are judged
row by row, with equal results. An empty table gives no rows. Other columns pass through ``filter_documents`` unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermatch.llm.common import cut, held, small_side

MIN_WORDS = 10
WINDOW = 5
MAX_REPEATED_PERCENT = 20
FENCE = 10.0
#: measure -> the least quartile distance that counts, so that uniform groups do not reject ordinary texts.
LEAST_SPREAD = {"symbol_share": 0.0015, "mark_share": 0.0015, "capital_share": 0.002, "dup_line_share": 0.01, "word_length": 0.075}
#: Measures that are 0 for most texts.
RARE = ("symbol_share", "dup_line_share")
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_SPACE = " \t\n\x0b\x0c\r"
_BREAK = r"[\x20\x09-\x0D]+"


def _left_of(text: Column, pattern: str) -> Column:
    """Code points of ``text`` outside the runs that ``pattern`` matches."""
    return F.length(F.regexp_replace(text, pattern, "")).cast("long")


def with_counts(docs: DataFrame) -> DataFrame:
    """``docs`` with the counts of each whole text, the measures and ``base_failed``, all under ``__q``."""
    own = [F.col(f"`{c}`") for c in docs.columns]
    df = docs.select(F.struct(*own).alias("__doc"), F.coalesce("text", F.lit("")).alias("__t"))
    inner = F.btrim("__t", F.lit(_SPACE))
    df = held(df, __w=F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, _BREAK)))
    w, n = F.col("__w"), F.size("__w")
    hashes = F.transform(F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)]))
    df = held(df, __h=F.when(n >= WINDOW, hashes).otherwise(F.array().cast("array<bigint>")),
              __l=F.filter(F.split("__t", "\n"), lambda line: F.btrim(line, F.lit(_SPACE)) != ""))
    # Only a text with a repeated window is sorted: equal hashes become neighbours.
    repeated = F.size(F.array_distinct("__h")) < F.size("__h")
    df = held(df, __s=F.when(repeated, F.sort_array(F.transform("__h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    s = F.col("__s")
    twice = F.filter(s, lambda x, k: (x["h"] == F.get(s, k + 1)["h"]) | (F.when(k > 0, x["h"] == F.get(s, k - 1)["h"])))
    df = held(df, __p=F.sort_array(F.transform(twice, lambda x: x["i"])))
    p = F.col("__p")
    # A window at place i covers words i to i+4; the next one takes over where it starts.
    covered = F.transform(p, lambda at, k: F.least(F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - at, F.lit(WINDOW))))
    total = F.coalesce(F.aggregate(covered, F.lit(0), lambda a, b: a + b), F.lit(0))
    df = df.select(
        "__doc", n.cast("long").alias("n_words"), _left_of(F.col("__t"), _BREAK).alias("word_chars"),
        _left_of(F.col("__t"), r"[^#*$%&|<>]+").alias("n_symbols"),
        (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long").alias("n_dup_lines"),
        total.cast("long").alias("n_repeat_words"), F.size("__l").alias("__lines"),
        _left_of(F.col("__t"), r"[\p{L}\p{M}\p{N}\x20\x09-\x0D]+").alias("__marks"), _left_of(F.col("__t"), r"[^\p{Lu}]+").alias("__capitals"))
    chars = F.greatest("word_chars", F.lit(1))
    measures = {"symbol_share": F.col("n_symbols") / chars, "mark_share": F.col("__marks") / chars,
                "capital_share": F.col("__capitals") / chars, "dup_line_share": F.col("n_dup_lines") / F.greatest("__lines", F.lit(1)),
                "word_length": F.col("word_chars") / F.greatest("n_words", F.lit(1))}
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    return df.select("__doc", F.struct(*COUNTS, *[m.alias(k) for k, m in measures.items()], failed.alias("base_failed")).alias("__q"))


def thresholds(counted: DataFrame, min_group: int = 50) -> DataFrame:
    """Upper limit of each measure per language and source, from texts that the fixed rules pass.

    ``counted`` has lang, source and the fields of ``__q`` as columns. Levels: 0 language and source,
    1 language, 2 all.
    """
    thirds = F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))
    quartiles = [F.percentile_approx(F.when(F.col(m) > 0, F.col(m)) if m in RARE else m, thirds, F.lit(10_000)).alias(m) for m in LEAST_SPREAD]
    passed = counted.where(~F.col("base_failed")).withColumns({"lang": F.coalesce("lang", F.lit("")), "source": F.coalesce("source", F.lit(""))})
    levels = passed.rollup("lang", "source").agg(
        F.count("*").alias("n"), (F.grouping("lang") + F.grouping("source")).alias("level"), *quartiles)

    def limit(m: str, least: float) -> Column:
        q = F.col(m)
        # A group of which no text has a symbol or a repeated line has no quartiles of these: 0.
        start = F.coalesce(q[1], F.lit(0.0)) if m in RARE else q[2]
        return start + FENCE * F.greatest(F.coalesce(q[2] - q[0], F.lit(0.0)), F.lit(least))

    limits = [limit(m, least).alias(m) for m, least in LEAST_SPREAD.items()]
    return levels.select("lang", "source", "level", "n", F.struct(*limits).alias("limits")).where((F.col("n") >= min_group) | (F.col("level") == 2))


def _verdict(df: DataFrame, limits: DataFrame, counts: str) -> DataFrame:
    """Add ``__kept``: the counts under ``counts`` hold the nearest limits of the row's ``__lang`` and ``__source``."""
    level = {k: limits.where(F.col("level") == k) for k in range(3)}
    one = level[0].select(F.col("lang").alias("__lang"), F.col("source").alias("__source"), F.col("limits").alias("__0"))
    two = level[1].select(F.col("lang").alias("__lang"), F.col("limits").alias("__1"))
    whole = level[2].select("limits.*").first()  # a single row, of nulls if no text passes
    df = df.join(small_side(one), ["__lang", "__source"], "left").join(small_side(two), "__lang", "left")
    near = F.coalesce("__0", "__1")
    within = [F.coalesce(F.col(counts)[m] <= F.coalesce(near[m], F.lit(whole and whole[m]).cast("double")), F.lit(True)) for m in LEAST_SPREAD]
    kept = ~F.col(counts)["base_failed"]
    for x in within:
        kept = kept & x
    return df.withColumn("__kept", kept)


def _keys(doc: str) -> dict[str, Column]:
    return {"__lang": F.coalesce(F.col(doc)["lang"], F.lit("")), "__source": F.coalesce(F.col(doc)["source"], F.lit(""))}


def judge_documents(docs: DataFrame, min_group: int = 50) -> DataFrame:
    """doc_id, the counts, base_failed, kept and the measures of every row of ``docs`` (doc_id, text, lang, source)."""
    counted = cut(with_counts(docs.select("doc_id", "text", "lang", "source")).select(
        F.struct("__doc.doc_id", "__doc.lang", "__doc.source").alias("__doc"), "__q"))
    limits = cut(thresholds(counted.select("__doc.lang", "__doc.source", "__q.*"), min_group))
    judged = _verdict(counted.withColumns(_keys("__doc")), limits, "__q")
    return judged.select("__doc.doc_id", *[f"__q.{c}" for c in COUNTS], "__q.base_failed", F.col("__kept").alias("kept"),
                         *[f"__q.{m}" for m in LEAST_SPREAD])


def filter_documents(docs: DataFrame, min_group: int = 50) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns.

    The texts are counted in two passes, one for the thresholds and one for the filter: cheaper than to shuffle
    or to write them in between.
    """
    counted = with_counts(docs.select("text", "lang", "source")).select("__doc.lang", "__doc.source", "__q.*")
    limits = cut(thresholds(counted, min_group))
    judged = _verdict(with_counts(docs).withColumns(_keys("__doc")), limits, "__q")
    return judged.where("__kept").select(*[F.col("__doc")[c].alias(c) for c in docs.columns])
