"""Counts of the quality rules against plain Python, thresholds against exact quartiles, verdicts on labelled texts."""

from __future__ import annotations

import re

from conftest import SF_SMALL
from ledgermatch.llm import quality_rules as rules
from ledgermatch.llm.queries import QUERIES

SF = SF_SMALL.replace("0.001", "0.01")


def counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen = {}
    for i in range(len(words) - 4):
        seen.setdefault(tuple(words[i:i + 5]), []).append(i)
    hit = {i + k for at in seen.values() if len(at) > 1 for i in at for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit))


def test_counts_of_all_documents(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = QUERIES["op4_quality_rules"](spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        want = counts(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (r.base_failed and r.kept)


def test_thresholds_are_the_quartile_fences(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    keys = {r.doc_id: (r.lang, r.source) for r in docs.select("doc_id", "lang", "source").collect()}
    rows = [(r, *keys[r.doc_id]) for r in QUERIES["op4_quality_rules"](spark, SF).collect()]
    passed = [x for x in rows if not x[0].base_failed]

    def fence(group, m):
        v = sorted(r[m] for r, _, _ in group if r[m] > 0 or m not in rules.RARE)
        q1, q2, q3 = (v[max(0, -(-p * len(v) // 4) - 1)] if v else 0.0 for p in (1, 2, 3))
        return (q2 if m in rules.RARE else q3) + rules.FENCE * max(q3 - q1, rules.LEAST_SPREAD[m])

    for r, lang, source in rows:
        for group in ([x for x in passed if x[1:] == (lang, source)], [x for x in passed if x[1] == lang], passed):
            if len(group) >= 50:
                break
        assert r.kept == (not r.base_failed and all(r[m] <= fence(group, m) for m in rules.LEAST_SPREAD))


def test_limits_follow_the_sketches(spark):
    """In groups of 50 texts and more the least spread hardly ever decides."""
    docs = spark.read.parquet(f"{SF.replace('0.01', '0.1')}/documents.parquet")
    counted = rules.with_counts(docs.select("text", "lang", "source")).select("__doc.lang", "__doc.source", "__q.*").where("NOT base_failed")
    from pyspark.sql import functions as F
    spreads = counted.groupBy("lang", "source").agg(F.count("*").alias("n"), *[
        (F.percentile_approx(F.when(F.col(m) > 0, F.col(m)) if m in rules.RARE else m, 0.75) -
         F.percentile_approx(F.when(F.col(m) > 0, F.col(m)) if m in rules.RARE else m, 0.25)).alias(m) for m in rules.LEAST_SPREAD]).where("n >= 50").collect()
    bound = {m: sum((r[m] or 0.0) < least for r in spreads) for m, least in rules.LEAST_SPREAD.items()}
    print(len(spreads), bound)
    assert len(spreads) > 50 and all(n < 0.25 * len(spreads) for n in bound.values())


def test_labelled_texts(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    got = [r for r in QUERIES["op4_quality_rules"](spark, SF).collect() if r.doc_id in labels]
    good = [r.kept for r in got if labels[r.doc_id] and not r.base_failed]
    bad = [r.kept for r in got if not labels[r.doc_id]]
    assert sum(good) >= 0.99 * len(good) and sum(bad) <= 0.2 * len(bad)


def test_odd_rows(spark):
    many = " ".join(f"w{i}" for i in range(30))
    rows = [(1, None, "en", "a", "x"), (2, "", None, None, "x"), (3, " \t\n\x0b\x0c\r ", "en", "a", None), (4, "a b c d e a b c d e", "en", "a", "x"),
            (5, f"{many}\n{many}\n \n \n", "en", None, "x"), (6, "x " * 5000, None, "b", "x"), (7, "é\x85b # $", "en", "a", "x"), (None, many, "en", "a", "x"),
            (8, many, "en", "a", "x"), (8, many, "en", "a", "x"), (9, "1 2 3 4 5 1 2 3 4 5 6 1 2 3 4 5", "en", "a", "x"), (10, "a a a a a a a a a a a", "en", "a", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_words string")
    got = {r.doc_id: r for r in rules.judge_documents(df).collect()}
    for doc_id, text, *_ in rows:
        r = got[doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts(text), doc_id
    left = rules.filter_documents(df)
    assert left.columns == df.columns
    assert sorted((r.doc_id for r in left.collect()), key=repr) == sorted([None, 8, 8], key=repr)
    assert rules.judge_documents(df.limit(0)).collect() == [] and rules.filter_documents(df.limit(0)).collect() == []
