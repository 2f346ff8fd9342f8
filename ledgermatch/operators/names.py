"""Name normal form on a frame, exact for any Unicode text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermatch.functions.text import blank_to_empty, normalize_folded
from ledgermatch.functions.unicode_fold import fold


def normalize_names(df: DataFrame, col: str, out: str, suffixes: list[str] | None = None,
                    only_when: Column | None = None) -> DataFrame:
    """Add ``out`` = normal form of ``col`` (``""`` for null).

    ``only_when`` limits the work to the rows that need it (others get null).
    """
    text = blank_to_empty(F.col(col))
    if only_when is not None:
        text = F.when(only_when, text)
    folded = df.withColumn("__folded", fold(text))
    return folded.withColumn(out, normalize_folded(F.col("__folded"), suffixes)).drop("__folded")


def fold_accents(df: DataFrame, col: str, out: str) -> DataFrame:
    """Accent-folded copy of a text column (NFKD, combining marks dropped)."""
    return df.withColumn(out, fold(F.col(col)))
