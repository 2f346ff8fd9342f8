"""Readers for the base dataset, the lookup files, the published table and stats."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermatch import codes
from ledgermatch.operators.harmonize import OUTPUT_TYPES
from ledgermatch.operators.lookups import CACHE_COLUMNS
from ledgermatch.sources import versions
from ledgermatch.sources.paths import exists
from ledgermatch.sources.registry import CSV_OPTIONS

#: Order key of a row, set at ingestion (operators.numbering).
SEQ_TYPE = T.LongType()

#: Folder column of the matched table, a copy of its registry.
FOLDER = "registry_folder"

#: Null marker of the cache as CSV, so that a null and a blank survive the round trip.
CSV_NULL = "\\N"

#: The 14 published columns.
PUBLISHED_SCHEMA = T.StructType([T.StructField(c, OUTPUT_TYPES.get(c, T.StringType())) for c in codes.OUTPUT_COLUMNS])

#: Base of earlier matched rows, as far as the job needs it.
BASE_SCHEMA = T.StructType([T.StructField("seq", SEQ_TYPE), *[T.StructField(c, T.StringType()) for c in (
    "company", "official_name", "factset_entity_id", "registry", "ret_date", "serialnumber")],
    T.StructField("quantity", T.DoubleType()), *[T.StructField(c, T.StringType()) for c in (
        "country", "projectname", "projecttype", "vintage", "isocode")]])

CACHE_SCHEMA = T.StructType([
    T.StructField("company_raw", T.StringType()),
    T.StructField("company_normalized", T.StringType()),
    T.StructField("official_name", T.StringType()),
    T.StructField("factset_entity_id", T.StringType()),
    T.StructField("batch", T.IntegerType()),
    T.StructField("ord_firm", T.StringType()),
    T.StructField("ord_seq", SEQ_TYPE),
])


def load_base(spark: SparkSession, path: str, schema: T.StructType = BASE_SCHEMA) -> DataFrame:
    """Parquet base of earlier matched rows; an empty frame of the base shape when absent (a first run)."""
    if exists(spark, path):
        return spark.read.parquet(path)
    return spark.createDataFrame([], schema)


def load_cache(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Known-match cache; empty when absent."""
    if not exists(spark, path):
        return spark.createDataFrame([], CACHE_SCHEMA)
    if fmt == "csv":
        return (spark.read.options(**CSV_OPTIONS).option("multiLine", True).option("nullValue", CSV_NULL)
                .option("emptyValue", "").schema(CACHE_SCHEMA).option("enforceSchema", False).csv(path))
    return spark.read.schema(CACHE_SCHEMA).parquet(path).select(*CACHE_COLUMNS)


def load_current_cache(spark: SparkSession, root: str) -> DataFrame:
    """The version in use of a versioned cache (``MatchingJob.publish(cache_root=...)``); empty before the first."""
    path = versions.current_path(spark, root)
    return spark.createDataFrame([], CACHE_SCHEMA) if path is None else load_cache(spark, path)


def load_firms(spark: SparkSession, path: str) -> DataFrame | None:
    """Firm universe Parquet, or None when absent (enrichment then gives "")."""
    return spark.read.parquet(path) if exists(spark, path) else None


def firms_by_id(spark: SparkSession, path: str, ids: list[str]) -> DataFrame:
    """Rows of the firm universe (``sinks.write_firms``) with one of some ids; the reader gets them as a pushed-down filter."""
    return spark.read.parquet(path).filter(F.col("factset_entity_id").isin(ids))


def read_published_csv(spark: SparkSession, path: str, schema: T.StructType = PUBLISHED_SCHEMA) -> DataFrame:
    """A published CSV with typed columns. An empty field is an empty text, or a null number."""
    raw = spark.read.options(**CSV_OPTIONS).option("multiLine", True).schema(schema).option("enforceSchema", False).csv(path)
    return raw.fillna("")


def load_published(spark: SparkSession, csv_path: str | None, parquet_path: str | None) -> DataFrame | None:
    """Published table for the report: CSV if present, else Parquet, else None."""
    if csv_path and exists(spark, csv_path):
        return read_published_csv(spark, csv_path)
    if parquet_path and exists(spark, parquet_path):
        return spark.read.parquet(parquet_path).drop(FOLDER)
    return None


STATS_GROUP = T.StructType([
    T.StructField("total", T.LongType()), T.StructField("matched", T.LongType()),
    T.StructField("total_mtco2", T.DoubleType()), T.StructField("matched_mtco2", T.DoubleType()),
])
STATS_SCHEMA = T.StructType([
    T.StructField("last_updated", T.StringType()),
    T.StructField("total_retirements", T.LongType()),
    T.StructField("matched_retirements", T.LongType()),
    T.StructField("unique_firms", T.LongType()),
    T.StructField("total_mtco2", T.DoubleType()),
    T.StructField("matched_mtco2", T.DoubleType()),
    T.StructField("registries", T.MapType(T.StringType(), STATS_GROUP)),
    T.StructField("years", T.MapType(T.StringType(), STATS_GROUP)),
    T.StructField("match_methods", T.MapType(T.StringType(), T.LongType())),
])


def load_stats(spark: SparkSession, path: str) -> DataFrame:
    """Summary stats JSON (one document) with an explicit schema."""
    return spark.read.schema(STATS_SCHEMA).option("multiLine", True).json(path)

