"""A table in numbered version folders with one pointer file: a new version is written beside the old one, then switched to.

``root/v000001/``, ``root/v000002/`` ... and ``root/CURRENT``, which names the version in use. A run reads the pointer at its
start. The pointer is replaced by a rename, which a file system with an atomic rename (HDFS, local disks) does in one step;
a run that dies before leaves the old version in use and a folder that nothing names.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

from ledgermatch.sources.paths import _resolved, exists, folder_names

POINTER = "CURRENT"


def _numbers(spark: SparkSession, root: str) -> list[int]:
    return [int(n[1:]) for n in folder_names(spark, root) if n[:1] == "v" and n[1:].isdigit()]


def current_version(spark: SparkSession, root: str) -> str | None:
    """Name of the version in use; None before the first one."""
    pointer = f"{root}/{POINTER}"
    if not exists(spark, pointer):
        return None
    fs, path = _resolved(spark, pointer)
    stream = fs.open(path)
    try:
        return bytes(stream.readAllBytes()).decode().strip()
    finally:
        stream.close()


def current_path(spark: SparkSession, root: str) -> str | None:
    version = current_version(spark, root)
    return None if version is None else f"{root}/{version}"


def _switch(spark: SparkSession, root: str, version: str) -> None:
    jvm = spark.sparkContext._jvm
    fs, made = _resolved(spark, f"{root}/.{POINTER}-{uuid.uuid4().hex}")
    out = fs.create(made)
    out.write(bytearray(version.encode()))
    out.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(made), fs.makeQualified(jvm.org.apache.hadoop.fs.Path(f"{root}/{POINTER}")), how)


def write_version(spark: SparkSession, root: str, write: Callable[[str], object]) -> str:
    """Let ``write`` fill a new version folder, then switch to it; returns its path.

    The number is one above every folder there is, those of dead runs included. If ``write`` fails, nothing is switched.
    One writer at a time: two would take the same number, and the later one's write fails on the folder it finds.
    """
    version = f"v{max(_numbers(spark, root), default=0) + 1:06d}"
    write(f"{root}/{version}")
    _switch(spark, root, version)
    return f"{root}/{version}"
