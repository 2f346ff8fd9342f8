"""Enrichment: HQ country, code tables, project category, country clean-up.

Code tables are fixed lists of at most a few hundred rows (a proven bound), so
they are broadcast explicitly. The firm universe is not: AQE decides at run
time whether it is small enough to broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermatch import codes
from ledgermatch.operators.incremental import spread_key


def code_table(spark: SparkSession, mapping: dict[str, str], key: str, value: str) -> DataFrame:
    """A fixed mapping as a two-column frame, marked for broadcast (bounded by its literal size)."""
    rows = list(mapping.items())
    return F.broadcast(spark.createDataFrame(rows, f"`{key}` string, `{value}` string"))


def lookup(df: DataFrame, col: str, mapping: dict[str, str], out: str) -> DataFrame:
    """Left join against a fixed code table; unknown -> null."""
    spark = df.sparkSession
    table = code_table(spark, mapping, "_code_key", out)
    return (df.join(table, F.col(col) == F.col("_code_key"), "left").drop("_code_key"))


def hq_country(df: DataFrame, firms: DataFrame | None, seq_col: str = "seq") -> DataFrame:
    """hq_country from the firm universe; a repeated firm id keeps its last row; missing -> ""."""
    if firms is None:
        return df.withColumn("hq_country", F.lit(""))
    last = (firms.groupBy(F.col("factset_entity_id").alias("_fid"))
            .agg(F.max_by("iso_country", seq_col).alias("_hq")))
    # Rows without an id (most of the ledger, all with the same blank) get keys of their own that match
    # nothing: one pass over the rows, and where the join shuffles they spread over all tasks.
    key = spread_key(F.when(F.col("factset_entity_id") != "", F.col("factset_entity_id")))
    out = df.drop("hq_country").withColumn("_key", key).join(last, F.col("_key") == F.col("_fid"), "left")
    return out.withColumn("hq_country", F.coalesce(F.col("_hq"), F.lit(""))).drop("_key", "_fid", "_hq")


def project_category(col) -> Column:
    """Ordered substring rules on the lower-cased type, first hit wins; null -> Other."""
    c = F.lower(F.col(col) if isinstance(col, str) else col)
    expr = None
    for category, needles in codes.PROJECT_CATEGORY_RULES:
        cond = None
        for needle in needles:
            hit = F.contains(c, F.lit(needle))
            cond = hit if cond is None else (cond | hit)
        expr = F.when(cond, category) if expr is None else expr.when(cond, category)
    return F.when(c.isNull(), codes.PROJECT_CATEGORY_DEFAULT).otherwise(
        expr.otherwise(codes.PROJECT_CATEGORY_DEFAULT))


def clean_countries(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Five exact alias replacements in whichever country columns exist."""
    present = [c for c in (columns or codes.REPORT_COUNTRY_COLUMNS) if c in df.columns]
    if not present:
        return df
    return df.replace(codes.COUNTRY_RENAMES, subset=present)


def hq_country_name(df: DataFrame) -> DataFrame:
    """ISO2 HQ code -> country name (unknown -> null)."""
    if "hq_country" not in df.columns:
        return df
    return lookup(df, "hq_country", codes.ISO2_TO_NAME, "hq_country_name")
