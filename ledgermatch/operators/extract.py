"""Beneficiary extraction per registry (one CASE over the registry key).

A mixed ledger holds the rows of all four registry exports, tagged with
``registry_key`` and carrying the union of their columns (null where an
export lacks one). ``registry_columns`` says which columns each export really
has, a schema fact known when the plan is built, so "column absent" and
"value null" stay distinct exactly as in per-file processing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermatch import codes
from ledgermatch.functions.text import clean_name, extract_on_behalf, py_strip

PARSED = "parsed"


def _col_or(columns: set[str], name: str, default=None) -> Column:
    return F.col(f"`{name}`") if name in columns else F.lit(default).cast("string")


def name_sources(registry: str, columns: set[str]) -> dict[str, Column]:
    """Per registry: primary text and label, fallback text and label, and whether
    the fallback is free text (searched for "on behalf of") or a plain name."""
    lit_str = lambda v: F.lit(v).cast("string")
    if registry == "verra":
        return dict(p=_col_or(columns, codes.VERRA_PRIMARY), p_field=F.lit(codes.VERRA_PRIMARY),
                    f=_col_or(columns, codes.VERRA_DETAILS), f_field=F.lit(codes.VERRA_DETAILS),
                    f_text=F.lit(True))
    if registry == "gold":
        first = _col_or(columns, codes.GOLD_PRIMARY, "")
        second = _col_or(columns, codes.GOLD_SECONDARY, "")
        # Python `a or b`: only an empty string falls through; a null does not
        using = F.when(first == "", second).otherwise(first)
        return dict(p=using, p_field=F.lit(codes.GOLD_PRIMARY),
                    f=_col_or(columns, codes.GOLD_NOTE), f_field=F.lit(codes.GOLD_NOTE),
                    f_text=F.lit(True))
    if registry == "acr":
        return dict(p=_col_or(columns, codes.ACR_PRIMARY), p_field=F.lit(codes.ACR_PRIMARY),
                    f=_col_or(columns, codes.ACR_HOLDER), f_field=F.lit(codes.ACR_HOLDER),
                    f_text=F.lit(False))
    if registry == "car":
        return dict(p=_col_or(columns, codes.CAR_HOLDER), p_field=F.lit(codes.CAR_HOLDER),
                    f=_col_or(columns, codes.CAR_DETAILS), f_field=F.lit(codes.CAR_DETAILS),
                    f_text=F.lit(True))
    raise ValueError(f"Unknown registry: {registry}. Must be one of {codes.REGISTRIES}")


def registry_case(df: DataFrame, registry_columns: dict[str, set[str]] | None,
                  build, key_col: str = "registry_key") -> Column:
    """CASE registry_key WHEN r THEN build(r, columns_of_r) ...; unknown key fails the job."""
    keys = list(registry_columns) if registry_columns else codes.REGISTRIES
    expr = None
    for reg in keys:
        if reg not in codes.REGISTRIES:
            raise ValueError(f"Unknown registry: {reg}. Must be one of {codes.REGISTRIES}")
        cols = set(registry_columns[reg]) if registry_columns else set(df.columns)
        branch = build(reg, cols)
        cond = F.col(key_col) == reg
        expr = F.when(cond, branch) if expr is None else expr.when(cond, branch)
    # an unknown registry fails the job, like the per-file dispatch does
    return expr.otherwise(F.raise_error(F.concat(F.lit("Unknown registry: "), F.col(key_col))))


def _staged_names(df: DataFrame, registry_columns: dict[str, set[str]] | None,
                  word_bounded: bool) -> DataFrame:
    """Helper columns ``_nm_*`` and the three result columns, or null when no name is found.

    A cheap CASE over the registry picks the primary and fallback texts; the
    cleaning and extraction chains then run once per row (the fallback only when
    the primary cleans to blank), which keeps the generated code small enough
    for whole-stage codegen.
    """
    picks = {}
    for part in ("p", "p_field", "f", "f_field", "f_text"):
        picks[part] = registry_case(df, registry_columns,
                                    lambda reg, cols, part=part: name_sources(reg, cols)[part])
    label = registry_case(df, registry_columns,
                          lambda reg, cols: F.lit(codes.REGISTRY_LABEL[reg]))
    staged = df.select("*", *[v.alias(f"_nm_{k}") for k, v in picks.items()], label.alias("_nm_label"))
    staged = staged.select("*", clean_name(F.col("_nm_p")).alias("_nm_pc"))
    # the fallback is read only when the primary name cleans to blank
    need = F.col("_nm_pc") == ""
    found = F.when(need, F.when(F.col("_nm_f_text"), extract_on_behalf(F.col("_nm_f"), word_bounded))
                   .otherwise(F.col("_nm_f")))
    staged = staged.select("*", found.alias("_nm_found"))
    staged = staged.select("*", F.when(need, clean_name(F.col("_nm_found"))).alias("_nm_fc"))
    use_p = F.col("_nm_pc") != ""
    use_f = (F.col("_nm_f_text") & F.col("_nm_found").isNotNull()) | \
        (~F.col("_nm_f_text") & (F.col("_nm_fc") != ""))
    return staged.select(
        "*",
        F.when(use_p, F.col("_nm_pc")).when(use_f, F.col("_nm_fc")).alias("_nm_raw_name"),
        F.when(use_p, F.col("_nm_p_field")).when(use_f, F.col("_nm_f_field")).alias("_nm_source_field"),
        F.when(use_p | use_f, F.col("_nm_label")).alias("_nm_registry"))


def _drop_helpers(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith("_nm_")])


def with_beneficiary(df: DataFrame, registry_columns: dict[str, set[str]] | None = None,
                     word_bounded: bool = False) -> DataFrame:
    """Add ``parsed`` (struct<raw_name, source_field, registry> or null) to every row."""
    staged = _staged_names(df, registry_columns, word_bounded)
    parsed = F.when(F.col("_nm_raw_name").isNotNull(),
                    F.struct(F.col("_nm_raw_name").alias("raw_name"),
                             F.col("_nm_source_field").alias("source_field"),
                             F.col("_nm_registry").alias("registry")))
    return _drop_helpers(staged.withColumn(PARSED, parsed))


def extract_beneficiary(df: DataFrame, registry_columns: dict[str, set[str]] | None = None,
                        word_bounded: bool = False) -> DataFrame:
    """Rows where a name was found, with raw_beneficiary, source_field, registry."""
    staged = _staged_names(df, registry_columns, word_bounded)
    out = (staged.filter(F.col("_nm_raw_name").isNotNull())
           .withColumn("raw_beneficiary", F.col("_nm_raw_name"))
           .withColumn("source_field", F.col("_nm_source_field"))
           .withColumn("registry", F.col("_nm_registry")))
    return _drop_helpers(out)


def parse_rate(df: DataFrame, registry_columns: dict[str, set[str]] | None = None) -> DataFrame:
    """Parsed / total rows per registry key, in percent (one pass, no join)."""
    parsed = with_beneficiary(df, registry_columns)
    return (parsed.groupBy("registry_key")
            .agg(F.count(PARSED).alias("parsed_rows"), F.count(F.lit(1)).alias("total_rows"))
            .withColumn("parse_pct", F.round(F.col("parsed_rows") * 100.0 / F.col("total_rows"), 1)))


__all__ = ["with_beneficiary", "extract_beneficiary", "parse_rate", "registry_case",
           "name_sources", "py_strip"]
