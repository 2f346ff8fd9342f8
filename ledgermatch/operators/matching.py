"""Cache matching: exact and normalised lookups over distinct names.

The known-match cache is small next to the ledger, but it has no bound and its
files are compressed many times: its two keyed views meet the distinct names in
merge joins, never as a broadcast on an estimate of their size. Rows never pass
these joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermatch import codes
from ledgermatch.functions.text import exact_key
from ledgermatch.operators.names import normalize_names

RESULT_COLUMNS = ["raw_name", "matched_name", "factset_entity_id", "confidence",
                  "match_method", "reasoning"]


def cache_order(cache: DataFrame) -> Column:
    """Row order of the cache file: built rows by firm then first sight, then appended batches."""
    return F.struct(F.col("batch"), F.col("ord_firm"), F.col("ord_seq"))


def exact_lookup(cache: DataFrame) -> DataFrame:
    """lower(strip(company_raw)) -> (official_name, id); blank keys skipped, last row wins."""
    keyed = cache.withColumn("_ekey", exact_key(F.col("company_raw")))
    return (keyed.filter(F.col("company_raw").isNotNull() & (F.col("company_raw") != ""))
            .groupBy("_ekey")
            .agg(F.max_by(F.struct(F.col("official_name").alias("e_name"),
                                   F.col("factset_entity_id").alias("e_id")),
                          cache_order(cache)).alias("_e"))
            .select("_ekey", "_e.e_name", "_e.e_id", F.lit(True).alias("e_hit")))


def normalized_lookup(cache: DataFrame) -> DataFrame:
    """company_normalized -> (official_name, id); blank keys skipped, last row wins."""
    return (cache.filter(F.col("company_normalized").isNotNull() & (F.col("company_normalized") != ""))
            .groupBy(F.col("company_normalized").alias("_nkey"))
            .agg(F.max_by(F.struct(F.col("official_name").alias("n_name"),
                                   F.col("factset_entity_id").alias("n_id")),
                          cache_order(cache)).alias("_n"))
            .select("_nkey", "_n.n_name", "_n.n_id", F.lit(True).alias("n_hit")))


def has_id(col) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce((c.isNotNull()) & (c != ""), F.lit(False))


def match_cache(names: DataFrame, cache: DataFrame, name_col: str = "raw_beneficiary",
                suffixes: list[str] | None = None) -> DataFrame:
    """MatchResult per distinct name: the exact key wins, the normal form counts only on a miss.

    An exact hit is final even when its id is blank (then the name is
    unmatched); an empty name never matches.
    """
    distinct = names.select(F.col(name_col).alias("raw_name")).distinct()
    # Normal form of every distinct name (cheap next to the rows), computed before
    # the lookups so each generated stage stays small enough for whole-stage codegen.
    normed = normalize_names(distinct, "raw_name", "_nkey", suffixes,
                             only_when=F.col("raw_name") != "")
    # Stage boundary (a shuffle of distinct names only): keeps the regex-heavy
    # normalisation and the lookup joins in separate, compilable stages.
    normed = normed.repartition("raw_name")
    keyed = normed.withColumn("_ekey", exact_key(F.col("raw_name")))
    both = (keyed.join(exact_lookup(cache).hint("merge"), "_ekey", "left")
            .join(normalized_lookup(cache).hint("merge"), "_nkey", "left"))
    is_blank = F.coalesce(F.col("raw_name") == "", F.lit(True))
    by_exact = ~is_blank & F.col("e_hit").isNotNull()
    by_norm = ~is_blank & F.col("e_hit").isNull() & (F.col("_nkey") != "") & F.col("n_hit").isNotNull()
    matched_name = F.when(by_exact, F.col("e_name")).when(by_norm, F.col("n_name"))
    fid = F.when(by_exact, F.col("e_id")).when(by_norm, F.col("n_id"))
    method = (F.when(by_exact, "cache_exact").when(by_norm, "cache_normalized")
              .otherwise("unmatched"))
    found = by_exact | by_norm
    return both.select(
        "raw_name",
        matched_name.alias("matched_name"),
        fid.alias("factset_entity_id"),
        F.when(found, "high").otherwise("none").alias("confidence"),
        method.alias("match_method"),
        F.lit("").alias("reasoning"),
    )


def apply_matches(parsed: DataFrame, results: DataFrame, name_col: str = "raw_beneficiary") -> DataFrame:
    """Join results with an id back onto the rows by raw name; the rest are unmatched.

    The result side holds one row per matched name; the join is left outer on
    the ledger, so AQE may broadcast the result side or split a hot name's
    partition (skew join) when it shuffles.
    """
    r = (results.filter(has_id("factset_entity_id"))
         .select(F.col("raw_name").alias("_rname"),
                 F.col("matched_name").alias("_r_name"),
                 F.col("factset_entity_id").alias("_r_id"),
                 F.col("confidence").alias("_r_conf"),
                 F.col("match_method").alias("_r_method")))
    drop = [c for c in ("matched_name", "factset_entity_id", "match_confidence", "match_method")
            if c in parsed.columns]
    joined = parsed.drop(*drop).join(r, F.col(name_col) == F.col("_rname"), "left")
    hit = F.col("_rname").isNotNull()
    return (joined
            .withColumn("factset_entity_id", F.when(hit, F.col("_r_id")).otherwise(F.lit("")))
            .withColumn("matched_name", F.when(hit, F.col("_r_name")).otherwise(F.lit("")))
            .withColumn("match_confidence", F.when(hit, F.col("_r_conf")).otherwise(F.lit("none")))
            .withColumn("match_method", F.when(hit, F.col("_r_method")).otherwise(F.lit("unmatched")))
            .drop("_rname", "_r_name", "_r_id", "_r_conf", "_r_method"))


def review_flag(df: DataFrame, confidence_col: str = "match_confidence") -> DataFrame:
    """Documented confidence bands: high accept, medium accept and flag, low review."""
    c = F.col(confidence_col)
    return df.withColumn(
        "review_flag",
        F.when(c == "high", "accept").when(c == "medium", "accept_flagged")
        .when(c == "low", "review").otherwise("none"))


def confidence_rank(col) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    expr = F.lit(0)
    for name, rank in sorted(codes.CONFIDENCE_RANK.items(), key=lambda kv: kv[1]):
        expr = F.when(c == name, F.lit(rank)).otherwise(expr)
    return expr
