"""Near-miss matching: names that no cache key equals, but one is at most k edits away from.

Two texts within k edits (a code point inserted, deleted or replaced) have a form in common once up to k code points are
deleted from each. Keys and missed names emit the hashes of their forms, meet by an equi-join on the hash, and the exact
distance decides. No blocks and no pairs inside a block: a pair is only formed where a form is shared. Names meet as
distinct normal forms; rows never do. No side has a bound, so none is broadcast: Spark's estimate counts the bytes of
compressed files and not the forms that are made of each name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermatch.operators.matching import RESULT_COLUMNS, cache_order, has_id
from ledgermatch.operators.names import normalize_names

#: Shorter forms are near to too much to mean anything; longer ones have too many forms (about L^k / k!).
MIN_LENGTH, MAX_LENGTH = 5, 80
METHOD = "cache_near"


def deletion_forms(text: str, k: int) -> Column:
    """Hashes of the distinct forms of ``text`` (a column name) with up to ``k`` code points deleted."""
    forms = f"array({text})"
    for _ in range(k):
        forms = f"""array_distinct(flatten(transform({forms}, s -> concat(array(s),
            transform(slice(sequence(0, length(s)), 2, length(s)), i -> concat(left(s, i - 1), substr(s, i + 1)))))))"""
    return F.expr(f"array_distinct(transform({forms}, s -> xxhash64(s)))")


def near_keys(cache: DataFrame) -> DataFrame:
    """(_key, _order, _name, _id): normal forms of the cache that name a firm; the last row of a form gives it."""
    rows = cache.filter(F.col("company_normalized").isNotNull() & (F.col("company_normalized") != ""))
    last = F.max_by(F.struct(cache_order(cache).alias("o"), F.col("official_name").alias("n"), F.col("factset_entity_id").alias("i")),
                    cache_order(cache))
    keys = rows.groupBy(F.col("company_normalized").alias("_key")).agg(last.alias("_v"))
    return keys.select("_key", F.col("_v.o").alias("_order"), F.col("_v.n").alias("_name"), F.col("_v.i").alias("_id")) \
        .filter(has_id("_id"))


def near_misses(missed: DataFrame, cache: DataFrame, k: int = 1, name_col: str = "raw_name",
                suffixes: list[str] | None = None) -> DataFrame:
    """Match results of the names that are within ``k`` edits of a key, with their ``distance``; other names give no row.

    The nearest key wins, of equally near ones the first in cache order. One edit is confidence ``medium`` (accepted with a
    flag), more is ``low`` (review). Null and blank names, and forms outside MIN_LENGTH to MAX_LENGTH, are left alone.
    """
    def fits(c: str) -> Column:
        return F.length(c).between(MIN_LENGTH, MAX_LENGTH)

    named = normalize_names(missed.select(F.col(name_col).alias("raw_name")).distinct(), "raw_name", "_nkey", suffixes)
    forms = named.filter(fits("_nkey")).select("_nkey").distinct()
    keys = near_keys(cache)
    left = forms.select("_nkey", F.explode(deletion_forms("_nkey", k)).alias("_h"))
    right = keys.filter(fits("_key")).select("_key", "_order", F.explode(deletion_forms("_key", k)).alias("_h"))
    # A pair that shares several forms is measured several times; the minimum takes it once.
    close = (left.join(right.hint("merge"), "_h").withColumn("_d", F.levenshtein("_nkey", "_key", k)).filter(F.col("_d") >= 0)
             .groupBy("_nkey").agg(F.min(F.struct("_d", "_order", "_key")).alias("_best"))
             .select("_nkey", F.col("_best._key").alias("_key"), F.col("_best._d").alias("distance")))
    found = close.join(keys.select("_key", "_name", "_id").hint("merge"), "_key")
    return named.join(found.hint("merge"), "_nkey").select(
        "raw_name", F.col("_name").alias("matched_name"), F.col("_id").alias("factset_entity_id"),
        F.when(F.col("distance") <= 1, "medium").otherwise("low").alias("confidence"),
        F.lit(METHOD).alias("match_method"), F.concat(F.col("distance").cast("string"), F.lit(" edits")).alias("reasoning"), "distance")


def with_near_misses(results: DataFrame, cache: DataFrame, k: int, suffixes: list[str] | None = None) -> DataFrame:
    """Match results in which names without any hit take the near key, where there is one."""
    missed = results.filter(F.col("match_method") == "unmatched").select("raw_name")
    near = near_misses(missed, cache, k, "raw_name", suffixes).select(
        F.col("raw_name").alias("_near"), *[F.col(c).alias(f"_{c}") for c in RESULT_COLUMNS[1:]])
    joined = results.join(near.hint("merge"), F.col("raw_name") == F.col("_near"), "left")
    hit = F.col("_near").isNotNull()
    return joined.select("raw_name", *[F.when(hit, F.col(f"_{c}")).otherwise(F.col(c)).alias(c) for c in RESULT_COLUMNS[1:]])
