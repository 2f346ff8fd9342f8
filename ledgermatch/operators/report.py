"""Roll-ups, maps and report frames over the matched table.

Every group-by drops null keys first (pandas does, Spark would keep them), and
every result here is small: registries, years, methods, countries, firms.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgermatch import codes
from ledgermatch.operators.enrich import clean_countries, hq_country_name, lookup, project_category
from ledgermatch.operators.harmonize import parse_timestamp, GENERIC_DATE_FORMATS


def is_matched(col: str = "factset_entity_id") -> Column:
    """Strict matched predicate: not null, not "", not "None"."""
    c = F.col(col)
    return F.coalesce(~c.isin("", "None"), F.lit(False))


def is_matched_loose(col: str = "factset_entity_id") -> Column:
    """Loose matched predicate: not null and not ""."""
    c = F.col(col)
    return F.coalesce(c != "", F.lit(False))


def megatonnes(col) -> Column:
    """Tonnes -> Mt, one decimal, half-even."""
    c = F.col(col) if isinstance(col, str) else col
    return F.bround(c / F.lit(1e6), 1)


def _qty(df: DataFrame) -> Column:
    return F.col("quantity") if "quantity" in df.columns else F.lit(0.0)


def _group_stats(df: DataFrame) -> list[Column]:
    m = is_matched()
    q = _qty(df)
    return [
        F.count(F.lit(1)).alias("total"),
        F.count_if(m).alias("matched"),
        megatonnes(F.coalesce(F.sum(q), F.lit(0.0))).alias("total_mtco2"),
        megatonnes(F.coalesce(F.sum(F.when(m, q)), F.lit(0.0))).alias("matched_mtco2"),
    ]


def summary_kpis(df: DataFrame) -> DataFrame:
    """One row: rows, matched rows, distinct matched firms, total and matched Mt."""
    m = is_matched()
    q = _qty(df)
    return df.agg(
        F.count(F.lit(1)).alias("total_retirements"),
        F.count_if(m).alias("matched_retirements"),
        F.countDistinct(F.when(m, F.col("factset_entity_id"))).alias("unique_firms"),
        megatonnes(F.coalesce(F.sum(q), F.lit(0.0))).alias("total_mtco2"),
        megatonnes(F.coalesce(F.sum(F.when(m, q)), F.lit(0.0))).alias("matched_mtco2"),
    )


def summary_by_registry(df: DataFrame) -> DataFrame:
    return df.groupBy("registry").agg(*_group_stats(df))


def summary_by_year(df: DataFrame) -> DataFrame:
    """Per retirement year, null year dropped, ascending."""
    return (df.filter(F.col("retirement_year").isNotNull())
            .groupBy("retirement_year").agg(*_group_stats(df))
            .orderBy("retirement_year"))


def summary_by_method(df: DataFrame) -> DataFrame:
    return df.groupBy("match_method").agg(F.count(F.lit(1)).alias("rows"))


def summary_rollup(df: DataFrame) -> DataFrame:
    """Registry, year, method and grand totals in one pass (GROUPING SETS).

    Long form: (dim, key, total, matched, unique_firms, total_mtco2,
    matched_mtco2). Null years stay out of the year set, as in the per-year
    roll-up; the grand-total row carries the KPI values.
    """
    m = is_matched()
    q = _qty(df)
    view = df.select("registry", "match_method", "retirement_year",
                     m.alias("_m"), q.alias("_q"), F.when(m, F.col("factset_entity_id")).alias("_fid"))
    year_key = F.col("retirement_year").cast("string")
    dim = (F.when(F.grouping("registry") == 0, "registry")
           .when(F.grouping("retirement_year") == 0, "year")
           .when(F.grouping("match_method") == 0, "method").otherwise("all"))
    out = (view.groupingSets([["registry"], ["retirement_year"], ["match_method"], []],
                             "registry", "retirement_year", "match_method")
           .agg(dim.alias("dim"),
                F.coalesce(F.col("registry"), year_key, F.col("match_method"), F.lit("")).alias("key"),
                F.count(F.lit(1)).alias("total"),
                F.count_if(F.col("_m")).alias("matched"),
                F.countDistinct("_fid").alias("unique_firms"),
                megatonnes(F.coalesce(F.sum("_q"), F.lit(0.0))).alias("total_mtco2"),
                megatonnes(F.coalesce(F.sum(F.when(F.col("_m"), F.col("_q"))), F.lit(0.0)))
                .alias("matched_mtco2")))
    return (out.filter(~((F.col("dim") == "year") & F.col("retirement_year").isNull()))
            .select("dim", "key", "total", "matched", "unique_firms", "total_mtco2", "matched_mtco2"))


# ------------------------------------------------------------------ maps

def map_project(df: DataFrame, mode: str = "row") -> DataFrame:
    """Tonnes by project country, positive only.

    ``mode="column"``: group by ``isocode`` when that column exists (blank is a
    group), else by country name mapped to ISO3 (aliases stay separate rows).
    ``mode="row"``: per row, ``isocode`` when non-blank, else the name's ISO3.
    """
    listed = df.filter(is_matched())
    q = _qty(df)
    if mode == "column":
        if "isocode" in df.columns:
            out = (listed.filter(F.col("isocode").isNotNull())
                   .groupBy(F.col("isocode").alias("iso3")).agg(F.sum(q).alias("tonnes")))
        else:
            per = (listed.filter(F.col("country").isNotNull())
                   .groupBy("country").agg(F.sum(q).alias("tonnes")))
            out = (lookup(per, "country", codes.COUNTRY_TO_ISO3, "iso3")
                   .filter(F.col("iso3").isNotNull()).select("iso3", "tonnes"))
    else:
        # grouped by the two columns first: the code table meets the few groups, not the rows
        code = (F.when(F.col("isocode") != "", F.col("isocode")) if "isocode" in df.columns
                else F.lit(None).cast("string"))
        groups = listed.groupBy(code.alias("_code"), "country").agg(F.sum(q).alias("tonnes"))
        named = lookup(groups, "country", codes.COUNTRY_TO_ISO3, "_iso3_name")
        out = (named.withColumn("iso3", F.coalesce("_code", "_iso3_name")).filter(F.col("iso3").isNotNull())
               .groupBy("iso3").agg(F.sum("tonnes").alias("tonnes")))
    return (out.filter(F.col("tonnes") > 0)
            .select("iso3", F.col("tonnes").cast("long").alias("tonnes"),
                    F.log10(F.col("tonnes") + 1).alias("log_tonnes")))


def map_hq(df: DataFrame, firms: DataFrame | None, mode: str = "column",
           seq_col: str = "seq") -> DataFrame:
    """Tonnes by HQ country (ISO2 -> ISO3), positive only.

    ``mode="column"`` joins the universe as is, so a repeated firm id counts its
    rows once per universe row; ``mode="row"`` uses one row per firm (last wins).
    """
    listed = df.filter(is_matched())
    q = _qty(df)
    if firms is None:
        spark = df.sparkSession
        return spark.createDataFrame([], "iso3 string, tonnes long, log_tonnes double")
    side = firms.select("factset_entity_id", "iso_country", seq_col)
    if mode == "row":
        side = (side.groupBy("factset_entity_id")
                .agg(F.max_by("iso_country", seq_col).alias("iso_country")))
    else:
        side = side.select("factset_entity_id", "iso_country")
    merged = listed.drop("iso_country").join(side, "factset_entity_id", "left")
    per = (merged.filter(F.col("iso_country").isNotNull())
           .groupBy("iso_country").agg(F.sum(q).alias("tonnes")))
    out = lookup(per, "iso_country", codes.ISO2_TO_ISO3, "iso3").filter(F.col("iso3").isNotNull())
    return (out.filter(F.col("tonnes") > 0)
            .select("iso3", F.col("tonnes").cast("long").alias("tonnes"),
                    F.log10(F.col("tonnes") + 1).alias("log_tonnes")))


# ------------------------------------------------------------------ report view

def report_view(df: DataFrame) -> DataFrame:
    """Matched rows only, with date/year, category, cleaned countries, HQ name."""
    out = df
    for col in codes.REPORT_DATE_COLUMNS:
        if col in out.columns:
            out = out.withColumn("retirement_date", parse_timestamp(F.col(f"`{col}`"), GENERIC_DATE_FORMATS))
            out = out.withColumn("retirement_year", F.year("retirement_date"))
            break
    out = out.filter(is_matched_loose())
    if "projecttype" in out.columns:
        out = out.withColumn("project_category", project_category("projecttype"))
    out = clean_countries(out)
    return hq_country_name(out)


def _first_present(df: DataFrame, names: list[str]) -> str | None:
    return next((c for c in names if c in df.columns), None)


def faceted_filter(df: DataFrame, year_range: tuple[int, int] | None = None,
                   hq: list[str] | None = None, countries: list[str] | None = None,
                   categories: list[str] | None = None, firm_search: str | None = None) -> DataFrame:
    """AND of the chosen facets; an empty choice means no filter.

    Year range is inclusive (null year fails); firm search is a case-insensitive
    regular expression on the matched name (else raw name), null -> false.
    """
    preds = []
    if year_range and "retirement_year" in df.columns:
        preds.append(F.coalesce(F.col("retirement_year").between(*year_range), F.lit(False)))
    if hq and "hq_country_name" in df.columns:
        preds.append(F.coalesce(F.col("hq_country_name").isin(hq), F.lit(False)))
    country_col = _first_present(df, codes.REPORT_COUNTRY_COLUMNS)
    if countries and country_col:
        preds.append(F.coalesce(F.col(f"`{country_col}`").isin(countries), F.lit(False)))
    if categories and "project_category" in df.columns:
        preds.append(F.coalesce(F.col("project_category").isin(categories), F.lit(False)))
    if firm_search:
        name_col = "matched_name" if "matched_name" in df.columns else "raw_beneficiary"
        preds.append(F.coalesce(F.col(name_col).rlike("(?iu)" + firm_search), F.lit(False)))
    if not preds:
        return df
    return df.filter(reduce(lambda a, b: a & b, preds))


def report_metrics(df: DataFrame) -> DataFrame:
    """Tonnes, rows, distinct firms, distinct countries, and the tonnes label."""
    qty_col = _first_present(df, codes.REPORT_QUANTITY_COLUMNS)
    country_col = _first_present(df, codes.REPORT_COUNTRY_COLUMNS)
    q = F.col(qty_col) if qty_col else F.lit(0.0)
    aggs = [F.coalesce(F.sum(q), F.lit(0.0)).alias("total_quantity"),
            F.count(F.lit(1)).alias("transactions"),
            F.countDistinct("factset_entity_id").alias("unique_firms")]
    if country_col:
        aggs.append(F.countDistinct(F.col(f"`{country_col}`")).alias("countries"))
    out = df.agg(*aggs)
    return out.withColumn("quantity_label", fmt_tonnes(F.col("total_quantity")))


def fmt_tonnes(col) -> Column:
    """>= 1e6 'x.xM', >= 1e3 'xK', both without grouping; else thousands-separated, no decimals."""
    t = F.col(col) if isinstance(col, str) else col
    return (F.when(t >= 1e6, F.format_string("%.1fM", F.bround(t / 1e6, 1)))
            .when(t >= 1e3, F.format_string("%.0fK", F.bround(t / 1e3, 0)))
            .otherwise(F.format_number(F.bround(t, 0), 0)))


def yearly_quantity(df: DataFrame) -> DataFrame:
    q = F.col("quantity")
    return (df.filter(F.col("retirement_year").isNotNull())
            .groupBy("retirement_year").agg((F.sum(q) / 1e6).alias("mtco2"))
            .orderBy("retirement_year"))


def category_share(df: DataFrame) -> DataFrame:
    """Tonnes per category, descending, with percent of total and a label blank under 1%."""
    per = (df.filter(F.col("project_category").isNotNull())
           .groupBy(F.col("project_category").alias("category"))
           .agg(F.sum("quantity").alias("tonnes")))
    pct = F.col("tonnes") / F.sum("tonnes").over(Window.partitionBy()) * 100
    return (per.withColumn("pct", pct)
            .withColumn("label", F.when(F.col("pct") >= 1, F.format_string("%.1f%%", F.col("pct")))
                        .otherwise(F.lit("")))
            .orderBy(F.desc("tonnes"), "category"))


def top_by(df: DataFrame, key: str, n: int = 20, out_key: str | None = None) -> DataFrame:
    """Top n keys by tonnes; ties keep the lower key (TakeOrderedAndProject)."""
    per = (df.filter(F.col(f"`{key}`").isNotNull())
           .groupBy(F.col(f"`{key}`").alias(out_key or key))
           .agg(F.sum("quantity").alias("tonnes")))
    return per.orderBy(F.desc("tonnes"), F.col(out_key or key)).limit(n)


def top_countries(df: DataFrame, n: int = 20) -> DataFrame:
    col = _first_present(df, codes.REPORT_COUNTRY_COLUMNS)
    return top_by(df, col, n, "country")


def top_firms(df: DataFrame, n: int = 20) -> DataFrame:
    col = "matched_name" if "matched_name" in df.columns else "raw_beneficiary"
    return top_by(df, col, n, "firm")


def facets(df: DataFrame) -> DataFrame:
    """Facet values as (facet, value) rows in one pass: the distinct HQ names, countries and categories, and the first and last year.

    Each row gives its few values; distinct values are pre-aggregated, so no task gathers a column's whole set.
    """
    country_col = _first_present(df, codes.REPORT_COUNTRY_COLUMNS)
    columns = {"hq_countries": "hq_country_name", "countries": country_col, "categories": "project_category"}
    pairs = [F.struct(F.lit(facet).alias("facet"), F.col(f"`{c}`").cast("string").alias("value"), F.lit(None).cast("int").alias("year"))
             for facet, c in columns.items() if c and c in df.columns]
    year = F.col("retirement_year").cast("int")
    pairs += [F.struct(F.lit(facet).alias("facet"), F.lit(None).cast("string").alias("value"), year.alias("year"))
              for facet in ("min_year", "max_year")]
    values = df.select(F.explode(F.array(*pairs)).alias("p")).select("p.*").filter(
        F.col("value").isNotNull() | F.col("facet").isin("min_year", "max_year"))
    per = values.groupBy("facet", "value").agg(F.min("year").alias("low"), F.max("year").alias("high"))
    text = F.when(F.col("facet") == "min_year", F.col("low").cast("string")) \
        .when(F.col("facet") == "max_year", F.col("high").cast("string")).otherwise(F.col("value"))
    return per.select("facet", text.alias("value"))


def display_columns(df: DataFrame) -> list[str]:
    return [c for c in codes.REPORT_DISPLAY_COLUMNS if c in df.columns]


def report_table(df: DataFrame, n: int = 500, order: tuple[str, ...] = ("src", "seq")) -> DataFrame:
    """First n rows of the filtered view in source order, display columns only (the on-screen table)."""
    return df.orderBy(*order).limit(n).select(*display_columns(df))


def registry_share(stats: DataFrame) -> DataFrame:
    """Registry case variants merged (upper-case key), summing their rounded Mt."""
    key = F.upper(F.col("registry"))
    return (stats.groupBy(key.alias("registry_key"))
            .agg(F.sum("total_mtco2").alias("total_mtco2"),
                 F.sum("matched_mtco2").alias("matched_mtco2")))
