"""Registry exports: per-registry files read as all-string columns, then one mixed ledger."""

from __future__ import annotations

import logging
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermatch import codes
from ledgermatch.sources.paths import exists, folder_names

log = logging.getLogger(__name__)

#: Quoted fields may hold line breaks, commas and doubled quotes.
CSV_OPTIONS = {"header": True, "quote": '"', "escape": '"'}


def _all_string(df: DataFrame) -> DataFrame:
    """Every column as text; a timestamp keeps the shape that the date parser reads."""
    return df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])


def read_export(spark: SparkSession, path: str, fmt: str = "csv",
                columns: list[str] | None = None, splittable: bool = False) -> DataFrame:
    """One registry export with every column as text.

    Columns are taken by the names in the header, in whatever order they stand
    and without a pass over the data to infer types; of a known column list those
    that the export has are kept, others of the export are not read. The files of
    one export must agree on their header. Parquet columns are cast. A CSV file is read by one task, since a quoted field may hold line breaks;
    ``splittable`` says that the caller knows there are none. Large exports are
    better landed as Parquet.
    """
    if fmt == "csv":
        reader = spark.read.options(**CSV_OPTIONS).option("multiLine", not splittable)
        header = reader.csv(path).columns
        # Read again by that header: files of the export that have another one are an error, not shifted columns.
        schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
        df = reader.schema(schema).option("enforceSchema", False).csv(path)
    else:
        df = _all_string(spark.read.format(fmt).load(path))
    return df.select(*[F.col(f"`{c}`") for c in columns if c in df.columns]) if columns else df


def _mixed(frames: dict[str, DataFrame]) -> tuple[DataFrame | None, dict[str, set[str]]]:
    """Union of the exports (missing columns -> null) tagged with ``registry_key``, and each one's own columns."""
    out = None
    for reg, df in frames.items():
        df = df.withColumn("registry_key", F.lit(reg))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out, {reg: set(df.columns) for reg, df in frames.items()}


def load_registries(spark: SparkSession, sources: dict[str, tuple[str, str]],
                    columns: dict[str, list[str]] | None = None, splittable: bool = False
                    ) -> tuple[DataFrame | None, dict[str, set[str]]]:
    """Mixed ledger from ``{registry: (path, format)}``; a missing file is skipped, all rows of the others are kept.

    A listed column that an export lacks is null for its rows and not among its own columns, so the next field of a
    fallback chain is taken; columns that are not listed are left out.
    """
    frames = {}
    for reg, (path, fmt) in sources.items():
        if reg not in codes.REGISTRIES:
            raise ValueError(f"Unknown registry: {reg}. Must be one of {codes.REGISTRIES}")
        if not exists(spark, path):
            log.warning("%s: %s not found", reg, path)
            continue
        frames[reg] = read_export(spark, path, fmt, (columns or {}).get(reg), splittable)
    mixed, own = _mixed(frames)
    listed = dict.fromkeys(c for reg in frames for c in (columns or {}).get(reg) or ())
    absent = {} if mixed is None else {c: F.lit(None).cast("string") for c in listed if c not in mixed.columns}
    return (mixed.withColumns(absent) if absent else mixed), own


def _version_key(version: str) -> list:
    """Numbers in a version's name count as numbers: ``v9`` comes before ``v10``, ``2026-2`` before ``2026-10``."""
    return [(int(part), "") if part.isdigit() else (-1, part) for part in re.split(r"(\d+)", version) if part]


def latest_snapshot(spark: SparkSession, root: str) -> str | None:
    """The highest version among the ``snapshot=<version>`` folders under ``root``, numbers compared as numbers."""
    versions = [n.removeprefix("snapshot=") for n in folder_names(spark, root) if n.startswith("snapshot=")]
    return max(versions, key=_version_key, default=None)


def load_snapshot(spark: SparkSession, root: str, version: str | None = None, fmt: str = "parquet"
                  ) -> tuple[DataFrame | None, dict[str, set[str]]]:
    """All registries of one snapshot laid out as ``root/snapshot=<v>/registry=<key>/``; the latest by default.

    The verra sheet keeps real retirements only (date not null). A sheet that is
    missing or cannot be read is logged and skipped; the others are loaded.
    """
    version = version or latest_snapshot(spark, root)
    frames = {}
    for reg in codes.SNAPSHOT_SHEETS.values():
        path = f"{root}/snapshot={version}/registry={reg}"
        if not exists(spark, path):
            log.warning("snapshot %s: no sheet for %s", version, reg)
            continue
        try:
            df = read_export(spark, path, fmt)
        except Exception as exc:  # noqa: BLE001 - a bad sheet must not stop the others
            log.warning("snapshot %s: sheet %s cannot be read: %s", version, reg, str(exc)[:200])
            continue
        if reg == "verra" and codes.VERRA_RETIREMENT_DATE in df.columns:
            df = df.filter(F.col(f"`{codes.VERRA_RETIREMENT_DATE}`").isNotNull())
        frames[reg] = df
    return _mixed(frames)
