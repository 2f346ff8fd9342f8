"""Lookup builders: the known-match cache and the listed-firm universe."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermatch import codes
from ledgermatch.functions.text import py_strip
from ledgermatch.operators.names import normalize_names
from ledgermatch.session import written

CACHE_COLUMNS = ["company_raw", "company_normalized", "official_name", "factset_entity_id",
                 "batch", "ord_firm", "ord_seq"]


def known_matches(matched: DataFrame, suffixes: list[str] | None = None,
                  seq_col: str = "seq") -> DataFrame:
    """Cache of raw name -> firm from earlier matched rows.

    Per firm: the first non-null official name, each distinct raw name with the
    place it was first seen; blank names skipped; then one row per (normal form,
    firm), keeping the first seen. The base is read once and reduced, by hash
    aggregation on the bigint order key, to its distinct (firm, raw name, official
    name) triples; these few rows are written down and everything else is made
    from them. They have no bound: the joins merge, nothing is broadcast.
    """
    triples = (matched.filter(F.col("factset_entity_id") != "")
               .groupBy("factset_entity_id", "company", "official_name").agg(F.min(seq_col).alias("seq")))
    triples = written(triples, "known_triples")
    official = (triples.filter(F.col("official_name").isNotNull())
                .groupBy("factset_entity_id").agg(F.min_by("official_name", "seq").alias("official_name")))
    names = (triples.filter(F.col("company").isNotNull() & (py_strip(F.col("company")) != ""))
             .groupBy("factset_entity_id", "company")
             .agg(F.min("seq").alias("first_seq")))
    names = normalize_names(names, "company", "company_normalized", suffixes)
    first = names.groupBy("company_normalized", "factset_entity_id").agg(F.min("first_seq").alias("first_seq"))
    per_form = first.join(names.select("first_seq", "company").hint("merge"), "first_seq")
    return (per_form.join(official.hint("merge"), "factset_entity_id", "left")
            .select(py_strip(F.col("company")).alias("company_raw"),
                    "company_normalized",
                    "official_name",
                    "factset_entity_id",
                    F.lit(0).alias("batch"),
                    F.col("factset_entity_id").alias("ord_firm"),
                    F.col("first_seq").alias("ord_seq")))


def public_firms(coverage: DataFrame, identifiers: DataFrame | None,
                 suffixes: list[str] | None = None, seq_col: str = "seq") -> DataFrame:
    """Listed firms (type PUB) with normalised name and first ISIN / LEI.

    The type filter and the column list reach the Parquet scan; each input is read
    once. Identifiers are filtered to the two types and pivoted with the first
    value (by source order) per entity and type.
    """
    keep = [c for c in codes.FIRM_COLUMNS if c in coverage.columns]
    firms = coverage.filter(F.col("entity_type") == "PUB").select(*keep, seq_col)
    if "entity_proper_name" in firms.columns:
        firms = normalize_names(firms, "entity_proper_name", "entity_name_normalized", suffixes)
    else:
        firms = firms.withColumn("entity_name_normalized", F.lit(""))
    if identifiers is None:
        return (firms.withColumn("isin", F.lit(None).cast("string"))
                .withColumn("lei", F.lit(None).cast("string")))
    ids = identifiers.filter(F.col("entity_id_type").isin(codes.IDENTIFIER_TYPES) & F.col("entity_id_value").isNotNull())
    pivot = (ids.groupBy("factset_entity_id")
             .pivot("entity_id_type", codes.IDENTIFIER_TYPES)
             .agg(F.min_by("entity_id_value", seq_col)))
    pivot = pivot.withColumnsRenamed({t: t.lower() for t in codes.IDENTIFIER_TYPES})
    return firms.join(pivot, "factset_entity_id", "left")


def _metrics(df: DataFrame, **aggs) -> DataFrame:
    """One aggregate pass, unpivoted to (metric, value) rows."""
    wide = df.agg(*[expr.cast("long").alias(name) for name, expr in aggs.items()])
    return wide.unpivot([], list(aggs), "metric", "value")


def universe_coverage(coverage: DataFrame, firms: DataFrame, cache: DataFrame,
                      matched: DataFrame) -> DataFrame:
    """Builder counts as (metric, value): entities, public, ISIN / LEI, cache rows and firms."""
    rows = matched.filter(F.col("factset_entity_id") != "")
    return (_metrics(coverage, total_entities=F.count(F.lit(1)),
                     public_entities=F.count_if(F.col("entity_type") == "PUB"))
            .unionByName(_metrics(firms, public_firms=F.count(F.lit(1)),
                                  with_isin=F.count("isin"), with_lei=F.count("lei")))
            .unionByName(_metrics(rows, matched_rows=F.count(F.lit(1)),
                                  matched_firms=F.countDistinct("factset_entity_id")))
            .unionByName(_metrics(cache, cache_rows=F.count(F.lit(1)))))
