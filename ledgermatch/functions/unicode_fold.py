"""Accent folding: NFKD decomposition with combining marks dropped.

Spark has no Unicode normalisation function, so the fold is made of expressions,
with tables derived once on the driver from ``unicodedata`` by rule:

* code points that fold to at most one character become one ``translate``
  (whole-stage codegen);
* code points that expand to several characters (ligatures, fractions, Roman
  numerals, Hangul syllables, ...) are expanded first, in the rare texts that
  hold one: Hangul by arithmetic on the code point, the others by a literal table.
"""

from __future__ import annotations

import functools
import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Hangul syllables are numbered lead by lead, vowel by vowel, tail by tail (the first without one): fixed values of Unicode.
_HANGUL, _HANGUL_END = 0xAC00, 0xD7A4
_LEADS = "".join(map(chr, range(0x1100, 0x1113)))
_VOWELS = "".join(map(chr, range(0x1161, 0x1176)))
_TAILS = "".join(map(chr, range(0x11A8, 0x11C3)))


def py_fold(text: str) -> str:
    """The rule in plain Python, for the tables and for tests."""
    decomposed = unicodedata.normalize("NFKD", text)
    return "".join(ch for ch in decomposed if not unicodedata.combining(ch))


def _is_surrogate(cp: int) -> bool:
    return 0xD800 <= cp <= 0xDFFF


@functools.lru_cache(maxsize=1)
def fold_tables() -> tuple[str, str, str]:
    """(matching, replacement, multi) derived from unicodedata.

    ``matching`` lists the mapped code points first (each with its one-char
    replacement at the same position) and then the deleted ones, which is how
    ``translate`` deletes characters. ``multi`` are the code points that expand.
    """
    mapped_src, mapped_dst, deleted, multi = [], [], [], []
    for cp in range(sys.maxunicode + 1):
        if _is_surrogate(cp):
            continue
        ch = chr(cp)
        folded = py_fold(ch)
        if folded == ch:
            continue
        if len(folded) == 0:
            deleted.append(ch)
        elif len(folded) == 1:
            mapped_src.append(ch)
            mapped_dst.append(folded)
        else:
            multi.append(cp)
    matching = "".join(mapped_src) + "".join(deleted)
    replacement = "".join(mapped_dst)
    return matching, replacement, "".join(chr(cp) for cp in multi)


def _char_class(code_points: list[int]) -> str:
    """Java regex ranges (without the brackets) of sorted code points."""
    parts = []
    start = prev = code_points[0]
    for cp in [*code_points[1:], None]:
        if cp is not None and cp == prev + 1:
            prev = cp
            continue
        parts.append(f"\\x{{{start:X}}}-\\x{{{prev:X}}}")
        start = prev = cp
    return "".join(parts)


def fold_single(col: Column) -> Column:
    """Fold every code point whose decomposition is at most one character."""
    matching, replacement, _ = fold_tables()
    return F.translate(col, matching, replacement)


def has_multi_char_fold(col: Column) -> Column:
    """True when the text holds a code point that folds to several characters.

    A ``translate`` that deletes those code points (one hash lookup per
    character) is much cheaper on long texts than a regular expression with
    hundreds of ranges; the length changes exactly when one is present.
    """
    _, _, multi = fold_tables()
    return F.length(F.translate(col, multi, "")) != F.length(col)


def _hangul(syllable: Column) -> Column:
    """The two or three letters of a Hangul syllable: a lead, a vowel and a tail of fixed runs of code points."""
    at = F.ascii(syllable) - F.lit(_HANGUL)
    vowels, tails = len(_VOWELS), len(_TAILS) + 1

    def letter(of: str, place: Column) -> Column:
        return F.substr(F.lit(of), place.cast("int"), F.lit(1))

    lead = letter(_LEADS, F.floor(at / (vowels * tails)) + 1)
    vowel = letter(_VOWELS, F.floor(at % (vowels * tails) / tails) + 1)
    return F.concat(lead, vowel, F.when(at % tails == 0, "").otherwise(letter(_TAILS, at % tails)))


def expand_multi(col: Column) -> Column:
    """The text with every code point that folds to several characters replaced by these."""
    _, _, multi = fold_tables()
    listed = "".join(ch for ch in multi if not _HANGUL <= ord(ch) < _HANGUL_END)
    among = _char_class([ord(ch) for ch in multi])
    expansions = F.lit([py_fold(ch) for ch in listed])

    def piece(p: Column) -> Column:
        place = F.position(p, F.lit(listed))
        other = F.when(place > 0, F.element_at(expansions, F.greatest(place, F.lit(1)))).otherwise(p)
        return F.when(F.length(p) != 1, p).when(F.ascii(p).between(_HANGUL, _HANGUL_END - 1), _hangul(p)).otherwise(other)

    # Single code points that expand, and the runs between them.
    pieces = F.regexp_extract_all(col, F.lit(f"(?s)[{among}]|[^{among}]+"), F.lit(0))
    return F.array_join(F.transform(pieces, piece), "")


def fold(col: Column) -> Column:
    """NFKD with the combining marks dropped, for any text; null stays null."""
    return fold_single(F.when(has_multi_char_fold(col), expand_multi(col)).otherwise(col))
