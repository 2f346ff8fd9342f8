"""Firm search by regular expression with an inverted index of trigrams.

The report's firm search matches a regular expression against the name of every row. Distinct names are few next to rows,
and most names lack the letters that a search asks for: the index maps each trigram to the names that hold it. A search's
required trigrams choose candidates, ``rlike`` decides, and the names that match pick their rows. A search without a
required trigram tries all names.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GRAM = 3
_BREAK = "\x00"


#: The letters beyond ASCII that are equal to an ASCII letter but for case, and these letters: fixed values of Unicode.
_CASED, _PLAIN = "\u0130\u0131\u017f\u212a", "iisk"


def folded(name: str) -> Column:
    """The name as a search for ASCII letters that ignores case sees it."""
    return F.lower(F.translate(F.col(name), _CASED, _PLAIN))


def build_index(view: DataFrame, name_col: str = "matched_name") -> DataFrame:
    """(gram, name): a row for each distinct trigram of each distinct name."""
    names = view.select(F.col(name_col).alias("name")).filter(F.col("name").isNotNull()).distinct()
    places = F.sequence(F.lit(1), F.length("_f") - (GRAM - 1))
    grams = F.array_distinct(F.transform(places, lambda i: F.substr(F.col("_f"), i, F.lit(GRAM))))
    return names.withColumn("_f", folded("name")).filter(F.length("_f") >= GRAM).select(F.explode(grams).alias("gram"), "name")


def required_grams(pattern: str) -> list[str]:
    """Trigrams that every match of ``pattern`` holds, as far as they are plain to see; [] where nothing is sure.

    What groups and classes hold and a character that may be left out do not count. A pattern with an escape, a flag, a
    look-around, letters beyond ASCII or alternatives outside groups is not looked into.
    """
    if not pattern.isascii() or "\\" in pattern or "(?" in pattern:
        return []
    plain, before = re.sub(r"\[[^\[\]]+\]", _BREAK, pattern), None
    while plain != before:
        plain, before = re.sub(r"\([^()]*\)", _BREAK, plain), plain
    if re.search(r"[()\[\]|]", plain):
        return []
    plain = re.sub(r".(?:[?*]|\{[^}]*\})", _BREAK, plain)
    runs = re.split(rf"[{_BREAK}.^$?*+{{}}]", plain.lower())
    return sorted({run[i:i + GRAM] for run in runs for i in range(len(run) - GRAM + 1)})


def search_names(index: DataFrame, names: DataFrame, pattern: str) -> DataFrame:
    """(name): the distinct names that ``pattern`` matches without regard to case."""
    needed = required_grams(pattern)
    if needed:
        held = index.filter(F.col("gram").isin(needed)).groupBy("name").agg(F.count("*").alias("n"))
        names = held.filter(F.col("n") == len(needed)).select("name")
    return names.filter(F.col("name").rlike("(?iu)" + pattern)).select("name")


def search_rows(view: DataFrame, index: DataFrame, names: DataFrame, pattern: str, name_col: str = "matched_name") -> DataFrame:
    """Rows of the view whose name the search finds; ``names`` is the distinct names (``name``) of the view."""
    found = search_names(index, names, pattern).select(F.col("name").alias("_found"))
    return view.join(found, F.col(name_col) == F.col("_found"), "left_semi")
