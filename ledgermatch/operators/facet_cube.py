"""Report figures under any facet choice from one table, exact distinct firms included.

Distinct counts do not add up over facet values, but bitmaps of dense firm numbers do: the cube holds a row per combination
of facet values and bucket of 32,768 firm numbers, with its tonnes, its rows and a bitmap of its firms
(``bitmap_construct_agg``). A choice filters the cube, ORs the bitmaps of a bucket (``bitmap_or_agg``) and counts bits; the
view's rows are not read again. A bitmap is 4 KB, so the cube is bounded by combinations times buckets, whatever the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermatch.operators.numbering import number_rows

#: Facets of the report view; a country that is missing is a value of its own.
FACETS = ["retirement_year", "hq_country_name", "country", "project_category"]


def firm_numbers(view: DataFrame) -> DataFrame:
    """(factset_entity_id, firm): the firms of the view numbered from 0 in order of their ids."""
    firms = view.select("factset_entity_id").filter(F.col("factset_entity_id").isNotNull()).distinct()
    return number_rows(firms, ["factset_entity_id"], "firm")


def build_cube(view: DataFrame, firms: DataFrame) -> DataFrame:
    """(facets, bucket, quantity, transactions, firms) of a report view; rows without firm id are in bucket null.

    Rows meet their firm's number by an equi-join (a hot firm is split by AQE where it shuffles); sums and bitmaps are
    pre-aggregated before the shuffle by facet values.
    """
    number = firms.select(F.col("factset_entity_id").alias("_fid"), F.col("firm").cast("long").alias("_firm"))
    rows = view.select(*FACETS, "quantity", "factset_entity_id").join(number, F.col("factset_entity_id") == F.col("_fid"), "left")
    return rows.groupBy(*FACETS, F.bitmap_bucket_number("_firm").alias("bucket")).agg(
        F.sum("quantity").alias("quantity"), F.count("*").alias("transactions"),
        F.bitmap_construct_agg(F.bitmap_bit_position("_firm")).alias("firms"))


def chosen(cube: DataFrame, year_range: tuple[int, int] | None = None, hq: list[str] | None = None,
           countries: list[str] | None = None, categories: list[str] | None = None) -> DataFrame:
    """Cube rows of a facet choice, with the rules of ``report.faceted_filter``: no choice, no filter; a null fails a choice."""
    tests: list[Column] = []
    if year_range:
        tests.append(F.col("retirement_year").between(*year_range))
    for column, values in (("hq_country_name", hq), ("country", countries), ("project_category", categories)):
        if values:
            tests.append(F.col(column).isin(values))
    for test in tests:
        cube = cube.filter(F.coalesce(test, F.lit(False)))
    return cube


def metrics(cube: DataFrame, **choice) -> DataFrame:
    """(total_quantity, transactions, unique_firms, countries) under a choice; one row, zeros where nothing is left."""
    rows = chosen(cube, **choice)
    by_bucket = rows.groupBy("bucket").agg(F.sum("quantity").alias("q"), F.sum("transactions").alias("t"), F.bitmap_or_agg("firms").alias("b"))
    totals = by_bucket.agg(
        F.coalesce(F.sum("q"), F.lit(0.0)).alias("total_quantity"), F.coalesce(F.sum("t"), F.lit(0)).alias("transactions"),
        F.coalesce(F.sum(F.when(F.col("bucket").isNotNull(), F.bitmap_count("b"))), F.lit(0)).alias("unique_firms"))
    countries = rows.agg(F.countDistinct("country").alias("countries"))
    return totals.join(countries)  # one row each
