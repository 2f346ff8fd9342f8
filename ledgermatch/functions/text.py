"""Name cleaning, normalisation and free-text extraction as Column expressions.

All functions are JVM regular expressions under ``(?U)`` so that ``\\s``,
``\\d`` and ``\\b`` are Unicode-aware like Python's ``re``. Python also counts
the separators U+001C..U+001F as whitespace, Java does not, so they are added
to every whitespace class. Nothing here leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgermatch import codes

WS = r"\s\x1c-\x1f"          # body of a Python-compatible whitespace class
NOT_WS = f"[^{WS}]"

# FIXED VALUES: patterns of the name rules
CNPJ = r"\d{2}\.\d{3}\.\d{3}/\d{4}-\d{2}"
SSN_LIKE = r"\d{3}-\d{2}-\d{4}"
EIN = rf"ein[:{WS}]*\d+-\d+"
BEHALF_PATTERN = (rf"(?iUd)(?:on behalf of|for the benefit of|representing)[{WS}]+(.+?)"
                  rf"(?:[{WS}]*(?:for|to|regarding|in respect|$))")
RETIRED_PATTERN = rf"(?iUd)(?:retired for|retired by)[{WS}]+(.+?)(?:[{WS}]*(?:for|to|$))"
BEHALF_PATTERN_BOUNDED = (rf"(?iUd)(?:on behalf of|for the benefit of|representing)[{WS}]+(.+?)"
                          rf"(?:[{WS}]*(?:\b(?:for|to|regarding|in respect)\b|$))")
RETIRED_PATTERN_BOUNDED = rf"(?iUd)(?:retired for|retired by)[{WS}]+(.+?)(?:[{WS}]*(?:\b(?:for|to)\b|$))"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def py_strip(col) -> Column:
    """Python ``str.strip()``: Unicode whitespace at both ends."""
    return F.regexp_replace(_c(col), rf"(?U)^[{WS}]+|[{WS}]+\z", "")


def collapse_ws(col) -> Column:
    return F.regexp_replace(_c(col), rf"(?U)[{WS}]+", " ")


def blank_to_empty(col) -> Column:
    return F.coalesce(_c(col), F.lit(""))


def _squeeze(col) -> Column:
    """Collapse runs of spaces and trim; valid once all whitespace is a plain space."""
    return F.trim(F.regexp_replace(_c(col), " {2,}", " "))


def clean_name(col) -> Column:
    """Basic cleaning of a raw beneficiary string; null -> ``""``.

    Whitespace is collapsed to single spaces first (Unicode-aware), which makes
    Python's strip the same as ``trim`` and lets the later patterns use a plain
    space for ``\\s``; the result equals the step-by-step rule.
    """
    s = F.trim(collapse_ws(blank_to_empty(col)))
    s = F.regexp_replace(s, rf"(?U) *{CNPJ} *", " ")
    s = F.regexp_replace(s, r"(?U) *[-–] *\d{5,}\z", "")
    s = F.regexp_replace(s, r"[^ ]+@[^ ]+\.[^ ]+", "")
    s = F.regexp_replace(s, r"https?://[^ ]+", "")
    return _squeeze(s)


def _regex_escape(text: str) -> str:
    return "".join(ch if ch.isalnum() or ch == " " else "\\" + ch for ch in text)


def suffix_pattern(suffixes: list[str] | None = None) -> str:
    suffixes = codes.LEGAL_SUFFIXES_CONFIG if suffixes is None else suffixes
    return r"(?U)\b(" + "|".join(_regex_escape(s) for s in suffixes) + r")\b"


def normalize_folded(folded, suffixes: list[str] | None = None) -> Column:
    """Steps after the accent fold: lower, drop ids, punctuation, suffixes.

    Whitespace is collapsed first (it only separates words in every later step),
    so the later classes can use a plain space.
    """
    s = collapse_ws(F.lower(_c(folded)))
    s = F.regexp_replace(s, rf"(?U)\b{CNPJ}\b", "")
    s = F.regexp_replace(s, rf"(?U)\b{SSN_LIKE}\b", "")
    s = F.regexp_replace(s, r"(?U)\bein[: ]*\d+-\d+\b", "")
    s = F.regexp_replace(s, r"(?U)[^\p{L}\p{N}_ ]", " ")
    s = F.regexp_replace(s, suffix_pattern(suffixes), "")
    return _squeeze(s)


def extract_on_behalf(col, word_bounded: bool = False) -> Column:
    """Entity named in free text ("on behalf of X", "retired by X"), else null."""
    p1, p2 = ((BEHALF_PATTERN_BOUNDED, RETIRED_PATTERN_BOUNDED) if word_bounded
              else (BEHALF_PATTERN, RETIRED_PATTERN))

    def candidate(pattern: str, guard: str) -> Column:
        hit = py_strip(F.regexp_extract(_c(col), pattern, 1))
        hit = F.regexp_replace(hit, r"[.,;:]+\z", "")
        # the guard holds whenever the pattern can match (same case-insensitive flags)
        return F.when(_c(col).rlike(guard) & (F.length(hit) > 3), hit)

    return F.coalesce(candidate(p1, "(?iu)on behalf of|for the benefit of|representing"),
                      candidate(p2, "(?iu)retired for|retired by"))


def exact_key(col) -> Column:
    """Cache key of the exact lookup: lower, then strip."""
    return py_strip(F.lower(_c(col)))


def first_json_array(col) -> Column:
    """First balanced ``[...]`` by bracket depth (not string-aware); none -> null.

    The text from the first ``[`` is split before every bracket, so each piece
    starts with one; a left fold over the pieces (as many as there are
    brackets, not characters) tracks the depth and the end position. No
    regular expression can count depth.
    """
    text = _c(col)
    start = F.instr(text, "[")
    tail = F.substring(text, start, F.length(text))  # whole remaining text
    pieces = F.split(tail, r"(?=[\[\]])")
    init = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("end"), F.lit(0).alias("pos"))

    def step(acc, piece):
        done = acc["end"] > 0
        opening = F.substring(piece, 1, 1) == "["
        depth = F.when(done, acc["depth"]).when(opening, acc["depth"] + 1).otherwise(acc["depth"] - 1)
        end = F.when(done, acc["end"]).when(~opening & (depth == 0), acc["pos"] + 1).otherwise(F.lit(0))
        return F.struct(depth.alias("depth"), end.alias("end"), (acc["pos"] + F.length(piece)).alias("pos"))

    end = F.aggregate(pieces, init, step)["end"]
    return F.when((start > 0) & (end > 0), F.substring(tail, 1, end))
