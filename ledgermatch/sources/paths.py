"""Questions about paths, put to the path's own Hadoop file system (local, shared or remote alike)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _resolved(spark: SparkSession, path: str):
    jvm, jsc = spark.sparkContext._jvm, spark.sparkContext._jsc
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _resolved(spark, path)
    return fs.exists(p)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly under ``path`` (a snapshot root: one per version)."""
    fs, p = _resolved(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())
