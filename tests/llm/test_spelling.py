"""Spelling variants against plain comparison of all pairs of words."""

from __future__ import annotations

import random
import re
from collections import Counter
from zlib import crc32

from ledgermatch.llm import spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def near(a: str, b: str) -> bool:
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_groups(words: dict[str, int], times: int = 2):
    forms, out = {}, []
    for w, n in words.items():
        found = sorted((-words[v], v) for v in words if near(w, v))
        form = found[0][1] if found and -found[0][0] >= times * n else None
        forms[w] = form
        out.append((w, form, n, len(found), words[form] if form else None))

    def root(w):
        while forms[w] is not None:
            w = forms[w]
        return w
    return sorted((w, f, root(w), n, k, m) for w, f, n, k, m in out)


def plain_words(rows, min_length=5, min_count=3):
    counts = Counter()
    for doc, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(UPPER)
            h = crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= min_length and n >= min_count}


def groups(spark, words):
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    return sorted(tuple(r) for r in spelling.group_variants(df).collect())


def test_groups_of_random_words(spark):
    rng = random.Random(5)
    base = ["".join(rng.choice("abcdé") for _ in range(rng.randint(5, 9))) for _ in range(250)]
    words = {}
    for w in base:
        words[w] = rng.randint(3, 400)
        for _ in range(3):
            i, kind = rng.randrange(len(w)), rng.randrange(3)
            v = w[:i] + (rng.choice("abcdé") if kind else "") + w[i + (kind != 2):]
            words.setdefault(v, rng.randint(3, 60))
    words |= {"aaaaaa": 9, "aaaaa": 9, "aaaaaaa": 18, "x" * 70: 8, "x" * 69: 4, "x" * 35 + "y" + "x" * 34: 3}
    assert groups(spark, words) == plain_groups(words)


def test_tiles_of_one_key(spark, monkeypatch):
    """Words of one key that fill many tiles, and keys that run over the ends of Arrow batches."""
    monkeypatch.setattr(spelling, "TILE", 4)
    words = {f"com{a}{b}ny": 3 + i for i, (a, b) in enumerate((a, b) for a in "abcdefghij" for b in "abcdefghij")}
    words |= {f"com{a}ny": 50 for a in "abcdefghij"}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert groups(spark, words) == plain_groups(words)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_beyond_latin_and_ties(spark):
    words = {"при вет"[:3] + "мер": 9, "пример": 9, "примеръ": 30, "\U0001f600bcde": 5, "\U0001f601bcde": 10, "bcdef": 5, "acdef": 10, "ccdef": 10}
    assert groups(spark, words) == plain_groups(words)
    assert groups(spark, {}) == []


def test_chains_of_forms(spark):
    words = {"a" * 5 + "b" * i: 4 ** (20 - i) for i in range(18)}
    got = groups(spark, words)
    assert got == plain_groups(words) and {r[2] for r in got} == {"aaaaa"}


def test_words_with_slips(spark):
    rng = random.Random(2)
    vocabulary = ["Garden", "gardens", "ÉCLAIR", "éclair", "straße", "naïve", "one×two", "UPPER", "x" * 300, "ab"]
    rows = [(i % 300, " ".join(rng.choice(vocabulary) + rng.choice(["", "-", "1", "\n"]) for _ in range(rng.randint(0, 60)))) for i in range(600)]
    rows += [(7, None), (None, "Garden garden GARDEN"), (None, ""), (8, "日本語 gardenグarden"), (9, "gardengarden" * 2000)]
    df = spark.createDataFrame([(d, t, "w", 1) for d, t in rows], "doc_id long, text string, word string, n long")
    assert {r.word: r.n for r in spelling.count_words(df).collect()} == plain_words(rows)


def test_long_text_is_searched_in_blocks(spark, monkeypatch):
    text = "Garden paths éééééé " * 300
    monkeypatch.setattr(spelling, "BLOCK", 11)
    assert [r for part in spelling._runs(text.lower().encode()) for r in part] == [
        r.encode() for r in RUN.findall(text.lower())]
