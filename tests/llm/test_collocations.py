"""Phrase collocations against a plain count of every phrase."""

from __future__ import annotations

import re
from collections import Counter

import pytest

from ledgermatch.llm import collocations as c

PIECES = re.compile("[.,;:!?\x0a-\x0d]")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, max_words=3, min_count=10, covered=50, top=2000):
    f, n = {}, Counter()
    for lang, text in rows:
        for piece in PIECES.split((text or "").translate(UPPER)):
            words = [w for w in re.split("[\x20\x09]+", piece) if w]
            n[lang or "und"] += len(words)
            for size in range(1, max_words + 1):
                f.setdefault(lang or "und", Counter()).update(tuple(words[i:i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, counts in f.items():
        good = {p: a for p, a in counts.items() if len(p) > 1 and a >= min_count}
        cover = Counter()
        for p, a in good.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    cover[p[i:i + size]] = max(cover[p[i:i + size]], a)
        found = []
        for p, a in good.items():
            if 100 * cover[p] >= covered * a and cover[p]:
                continue
            cuts = [(1_000_000 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            found.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def run(spark, rows, **kw):
    docs = spark.createDataFrame([(i, text, lang, "x", 1) for i, (lang, text) in enumerate(rows)],
                                 "doc_id long, text string, lang string, phrase string, n long")
    return sorted(tuple(r) for r in c.collocations(docs, **kw).collect())


@pytest.mark.parametrize("max_words", [2, 3, 4])
def test_against_plain_counts(spark, max_words):
    texts = ["the old Mill by the river was shut; the old mill by the river, again\tand again.", "New York city hall. new york City\nHALL new york",
             "a a a a a a a b a a a", "Ünder der Brücke ünder der brücke; of the of the of the", "one", "x\x0by\x0cz", "word " * 30]
    rows = [("en", t) for t in texts * 6] + [(None, t) for t in texts * 5] + [("und", texts[0])] * 4 + [("de", texts[3])] * 3
    assert run(spark, rows, max_words=max_words, min_count=5) == plain(rows, max_words, 5)


def test_nulls_ties_empty_and_top(spark):
    rows = [("en", None), ("en", ""), ("en", " \t ...!?"), (None, None)] + [("en", "p q. r s. t u")] * 12
    want = plain(rows, top=2)
    assert run(spark, rows, top=2) == want and [w[2] for w in want] == ["p q", "r s"]
    assert run(spark, []) == [] and run(spark, rows[:4]) == []


def test_long_text_and_many_flushes(spark, monkeypatch):
    monkeypatch.setattr(c, "BLOCK", 50)
    rows = [("en", " ".join(f"w{i % 7} v{i % 3}" + ("," if i % 11 == 0 else "") for i in range(4000)))]
    assert run(spark, rows) == plain(rows)


def test_a_filter_that_lets_all_through_changes_nothing(spark, monkeypatch):
    """Rare phrases that share a bit with frequent ones are counted by their text all the same."""
    monkeypatch.setattr(c, "FILTER_BITS", 7)
    rows = [("en", f"a b c x{i} y{i}. b c d") for i in range(40)]
    assert run(spark, rows) == plain(rows)


def test_chunks_cover_each_start_once():
    pieces = [f"w{i % 5} w{i % 3} w{i % 7} w{i}".encode().split() * (i % 4 + 1) for i in range(60)]
    for window in (1, 2, 3):
        starts = []
        for chunk in c._chunks(pieces, window):
            words = chunk.split(b" ")
            own = len(words) - 1 - window if not words[-1] else len(words)
            assert own > 0
            starts += words[:own]
        assert starts == [w for p in pieces for w in p]
