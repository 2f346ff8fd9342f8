"""Writers for the published outputs. Each returns the path(s) it wrote."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermatch import codes
from ledgermatch.operators import report
from ledgermatch.sources import tables
from ledgermatch.sources.registry import CSV_OPTIONS


#: Folders that a task of ``write_matched`` fills side by side; rows of more folders are sorted by folder first.
OPEN_FOLDERS = 16
_OPEN_FOLDERS_CONF = "spark.sql.maxConcurrentOutputFileWriters"


def write_matched(df: DataFrame, path: str) -> str:
    """Matched table as Parquet in folders by registry.

    The folders are named by a copy of the column, so ``registry`` itself stays
    in the files with its type and blank values. The few folders are written side
    by side, so a task does not hold and sort all of its wide rows first.
    """
    conf = df.sparkSession.conf
    before = conf.get(_OPEN_FOLDERS_CONF, None)
    conf.set(_OPEN_FOLDERS_CONF, str(OPEN_FOLDERS))
    try:
        df.withColumn(tables.FOLDER, F.col("registry")).write.mode("overwrite").partitionBy(tables.FOLDER).parquet(path)
    finally:
        conf.unset(_OPEN_FOLDERS_CONF) if before is None else conf.set(_OPEN_FOLDERS_CONF, before)
    return path


def read_matched(spark, path: str, schema) -> DataFrame:
    """The matched table as written, without the folder column."""
    return spark.read.schema(schema).parquet(path).drop(tables.FOLDER)


def csv_writer(df: DataFrame):
    """CSV with empty fields for nulls and blanks, quotes doubled inside quoted fields."""
    return (df.write.mode("overwrite").options(**CSV_OPTIONS).option("nullValue", "").option("emptyValue", ""))


def write_matched_csv(df: DataFrame, path: str) -> str:
    """Matched rows only, key columns, CSV with header."""
    cols = [c for c in codes.OUTPUT_COLUMNS if c in df.columns]
    csv_writer(df.filter(report.is_matched_loose()).select(*cols)).csv(path)
    return path


def write_cache(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Known-match cache; the CSV tells nulls from blanks."""
    if fmt == "csv":
        df.write.mode("overwrite").options(**CSV_OPTIONS).option("nullValue", tables.CSV_NULL).csv(path)
    else:
        df.write.mode("overwrite").parquet(path)
    return path


def write_firms(df: DataFrame, path: str, files: int | None = None, group_bytes: int = 8 << 20, page_rows: int = 2000) -> str:
    """The firm universe laid out for lookups by id.

    Rows are ranged and sorted by id, so a file and a row group hold one interval
    of ids, and every row group has a Bloom filter of its ids: a lookup of a few
    ids skips the groups whose statistics or filter rule them out. ``files`` is
    the number of ranges (default: the shuffle partitions).
    """
    key = "factset_entity_id"
    ranged = df.repartitionByRange(files, key) if files else df.repartitionByRange(key)
    (ranged.sortWithinPartitions(key).write.mode("overwrite")
     .option(f"parquet.bloom.filter.enabled#{key}", "true").option("parquet.block.size", group_bytes)
     .option("parquet.page.row.count.limit", page_rows).parquet(path))
    return path


def stats_document(df: DataFrame, last_updated: str | None = None) -> DataFrame:
    """One-row frame holding the summary stats as a JSON string.

    KPIs and the per-registry, per-year and per-method groups come from one
    GROUPING SETS pass and are folded into maps of small structs by a single
    aggregate over its (few) rows.
    """
    day = last_updated or _dt.date.today().isoformat()
    roll = report.summary_rollup(df)
    grp = F.struct(F.col("total"), F.col("matched"), F.col("total_mtco2"), F.col("matched_mtco2"))
    is_all = F.col("dim") == "all"

    def entries(dim: str, value) -> F.Column:
        return F.map_from_entries(F.collect_list(F.when(F.col("dim") == dim, F.struct("key", value))))

    doc = roll.agg(
        F.max(F.when(is_all, F.col("total"))).alias("total_retirements"),
        F.max(F.when(is_all, F.col("matched"))).alias("matched_retirements"),
        F.max(F.when(is_all, F.col("unique_firms"))).alias("unique_firms"),
        F.max(F.when(is_all, F.col("total_mtco2"))).alias("total_mtco2"),
        F.max(F.when(is_all, F.col("matched_mtco2"))).alias("matched_mtco2"),
        entries("registry", grp).alias("registries"),
        entries("year", grp).alias("years"),
        entries("method", F.col("total")).alias("match_methods"),
    )
    return doc.select(F.to_json(F.struct(
        F.lit(day).alias("last_updated"), "total_retirements", "matched_retirements", "unique_firms",
        "total_mtco2", "matched_mtco2", "registries", "years", "match_methods")).alias("value"))


def write_json_text(doc: DataFrame, paths: list[str]) -> list[str]:
    """One-row text column written as a single file to each path."""
    for p in paths:
        doc.coalesce(1).write.mode("overwrite").text(p)
    return paths


def map_document(df: DataFrame, firms: DataFrame | None, mode: str = "row") -> DataFrame:
    """Map JSON: project and HQ countries as struct-of-arrays in ISO3 order."""
    proj = report.map_project(df, mode=mode).withColumn("kind", F.lit("project"))
    hq = report.map_hq(df, firms, mode="column" if mode == "column" else "row") \
        .withColumn("kind", F.lit("hq"))
    both = proj.unionByName(hq)

    def arrays(kind: str) -> F.Column:
        pairs = F.sort_array(F.collect_list(F.when(F.col("kind") == kind, F.struct("iso3", "tonnes"))))
        return F.struct(F.transform(pairs, lambda x: x["iso3"]).alias("iso3"),
                        F.transform(pairs, lambda x: x["tonnes"]).alias("tonnes"))

    return both.agg(arrays("project").alias("project_countries"), arrays("hq").alias("hq_countries")) \
        .select(F.to_json(F.struct("project_countries", "hq_countries")).alias("value"))


def write_report_csv(df: DataFrame, path: str) -> str:
    """Report export (S15), all rows: display columns minus the excluded ones."""
    csv_writer(df.select(*export_columns(df))).csv(path)
    return path


def export_columns(df: DataFrame) -> list[str]:
    return [c for c in report.display_columns(df) if c not in codes.REPORT_EXCLUDED_EXPORT_COLUMNS]


def ingest_document(ledger: DataFrame, version: str, day: str | None = None) -> DataFrame:
    """One-row frame with the ingest record as JSON: version, date, rows per registry and in all."""
    counts = ledger.groupBy("registry_key").agg(F.count("*").alias("rows"))  # one row per registry
    entry = F.struct("registry_key", "rows")
    return counts.agg(F.to_json(F.struct(
        F.lit(version).alias("version"), F.lit(day or _dt.date.today().isoformat()).alias("date"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total_rows"),
        F.map_from_entries(F.sort_array(F.collect_list(entry))).alias("rows"))).alias("value"))
