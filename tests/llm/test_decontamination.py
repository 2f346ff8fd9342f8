"""Decontamination against brute force."""

from __future__ import annotations

import hashlib
import random
import re

from conftest import SF_SMALL
from ledgermatch.llm import decontaminate
from ledgermatch.llm.queries import QUERIES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(docs, items):
    windows = {}
    for item_id, text in items:
        w = words(text)
        n = min(13, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i:i + n]), set()).add(item_id)
    sizes = {len(w) for w in windows}
    out = []
    for doc_id, text in docs:
        w = words(text)
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in windows:
                    hit |= set(range(i, i + n))
                    found |= windows[tuple(w[i:i + n])]
        names = ",".join(sorted(str(x) for x in found if x is not None))
        out.append((doc_id, len(w), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


def result(df):
    return sorted(map(tuple, df.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()), key=repr)


def test_query_against_brute_force(spark):
    for sf in (SF_SMALL, SF_SMALL.replace("0.001", "0.01")):
        docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
        items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
        want = brute(docs, items)
        assert any(r[5] for r in want)
        assert result(QUERIES["op6_decontamination"](spark, sf)) == want


def test_random_passages(spark):
    rng = random.Random(11)
    for vocabulary in (3, 40, 2000):  # few words: hashes repeat within a window
        names = [f"v{i}" for i in range(vocabulary)]
        items = [(i, " ".join(rng.choice(names) for _ in range(rng.choice((0, 1, 4, 7, 12, 13, 14, 20, 45))))) for i in range(25)]
        docs = []
        for d in range(60):
            parts = []
            for _ in range(rng.randrange(1, 6)):
                source = rng.choice(items)[1].split()
                a = rng.randrange(len(source) + 1)
                parts += source[a:a + rng.choice((5, 12, 13, 14, 30))] + [rng.choice(names) for _ in range(rng.randrange(0, 25))]
            docs.append((d, "; ".join(parts).upper() if d % 2 else " ".join(parts)))
        got = decontaminate.contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
        assert result(got) == brute(docs, items)


def test_odd_rows(spark, monkeypatch):
    passage = " ".join(f"p{i}" for i in range(20))
    items = [(1, passage), (1, "another text of the same item"), (2, None), (3, ""), (None, passage + " more"), (4, "Short one!"), (5, passage)]
    docs = [(1, None, "x"), (2, "", "x"), (3, "...", "x"), (None, f"a b {passage} c", "x"), (4, f"a b {passage} c", "x"), (4, f"a b {passage} c", "x"),
            (4, "other text, same id", "x"), (5, "a short-one here", "x"), (6, "ANOTHER\x00text of\nthe same item", "x"), (7, "q " * 3000 + passage, "x")]
    df = spark.createDataFrame(docs, "doc_id long, text string, n_words string").selectExpr("*", "1 AS item")
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "3 AS doc_id")
    want = brute([d[:2] for d in docs], items)
    assert result(decontaminate.contamination(df, bench)) == want
    monkeypatch.setattr(decontaminate, "MAX_BROADCAST_HASHES", 0)
    assert result(decontaminate.contamination(df, bench)) == want
    clean = decontaminate.clean_documents(df, bench)
    assert clean.columns == df.columns
    assert sorted((r.text or "" for r in clean.collect())) == ["", "", "...", "other text, same id", "q " * 3000 + passage]
    assert decontaminate.contamination(df.limit(0), bench).collect() == []
    assert all(r.n_hit == 0 for r in decontaminate.contamination(df, bench.limit(0)).collect())
