"""The unit model of op9 against a plain computation from its definition."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np

from ledgermatch.llm import kneser_ney


def plain_ppl(trusted, texts, table):
    """Log perplexity per character: pairs over continuation counts over spellings, interpolated."""
    def units(t):
        return ["", *kneser_ney._UNIT.findall(t), "\0"]

    def discounts(c):
        n1, n2, n3, n4 = (sum(v == i for v in c.values()) for i in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2) if n1 else 0.5
        raw = [1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 0.5, 3 - 4 * y * n4 / n3 if n3 else 0.5]
        return [min(max(d, 0.1), i) for i, d in enumerate(raw, 1)]

    two = Counter(p for t in trusted for u in [units(t)] for p in zip(u, u[1:]))
    one = Counter(b for _, b in two)
    d2, d1 = discounts(two), discounts(one)
    whole = sum(one.values())
    freed1 = sum(d1[min(c, 3) - 1] for c in one.values())

    def p1(b):
        own = one[b] - d1[min(one[b], 3) - 1] if one[b] else 0
        return own / whole + freed1 / whole * math.exp(kneser_ney.spellings([b], table)[0])

    def p2(a, b):
        after = [c for (x, _), c in two.items() if x == a]
        if not after:
            return p1(b)
        c = two[(a, b)]
        own = c - d2[min(c, 3) - 1] if c else 0
        return (own + sum(d2[min(x, 3) - 1] for x in after) * p1(b)) / sum(after)

    return [-sum(math.log(p2(a, b)) for u in [units(t)] for a, b in zip(u, u[1:])) / len(t) for t in texts]


def trusted_ids(spark, n):
    labels = spark.createDataFrame([(i, 1, 0) for i in range(n)], "doc_id long, quality int, toxic int")
    return labels, {r.label_id: r.held for r in kneser_ney.trusted_labels(labels).collect()}


def test_scores_against_the_definition(spark):
    words = "the cat sat on a mat and then it ran off, to see 12 dogs!".split()
    rng = np.random.default_rng(5)
    texts = [" ".join(rng.choice(words, int(n))) + ("\n\nété" if n % 3 == 0 else "") for n in rng.integers(1, 40, 60)] + ["unseen units only ##", " ", "\n"]
    labels, held = trusted_ids(spark, 40)
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string").repartition(3)
    trusted = [t for i, t in enumerate(texts) if held.get(i) is False]
    table = kneser_ney.train(spark.createDataFrame([(t,) for t in trusted], "text string"))
    want = plain_ppl(trusted, texts, table)
    got = {r.doc_id: r.perplexity for r in kneser_ney.judge_documents(docs, labels).collect()}
    assert all(math.isclose(math.log(got[i]), w, rel_tol=1e-4) for i, w in enumerate(want))


def test_more_trusted_text_teaches_more(spark):
    """Units of one character class differ, and what is counted grows with the trusted text."""
    texts = [f"part {i} of {i * 7} costs {i * 31}" for i in range(400)]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    few, many = (kneser_ney.count_pairs(df.limit(n)).count() for n in (100, 400))
    assert many > 3 * few
    labels, held = trusted_ids(spark, 100)
    known = next(i for i in range(10, 100) if not held[i])
    rows = [(i, t, "en") for i, t in enumerate(texts[:100])] + [(1000, f"part {known} of {known * 7} costs {known * 31}", "en"), (1001, "part 98 of 13 costs 1234"[:len(texts[known])], "en")]
    got = {r.doc_id: r.perplexity for r in kneser_ney.judge_documents(spark.createDataFrame(rows, "doc_id long, text string, lang string"), labels).collect()}
    assert math.isclose(got[1000], got[known]) and got[1001] > got[1000]


def test_toxic_texts_are_not_trusted(spark):
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 1), (3, 1, None), (4, 1, 0), (4, 1, 1), (5, 0, 0), (6, 1, 0), (6, None, 1), (7, None, 0), (None, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    assert {r.label_id for r in kneser_ney.trusted_labels(labels).collect()} == {1, 3}


def test_limit_is_the_quantile_of_held_out_texts(spark):
    held = spark.createDataFrame([("en", 1.0 + i / 1000, 400) for i in range(200)], "lang string, __ppl double, __n long")
    for r in kneser_ney._limits(held).collect():
        over = sum(r["median"] + r["limit"] / 20 < 1.0 + i / 1000 for i in range(200))
        assert r["limit"] < 2.0 and 0 < over <= 2


def test_rounds_and_shards_change_no_score(spark, monkeypatch):
    """Many rounds of texts and many shards of keys give the scores of one round; a round's blocks are gone afterwards."""
    words = "the cat sat on a mat and then it ran off, to see 12 dogs!".split()
    rng = np.random.default_rng(9)
    texts = [" ".join(rng.choice(words, int(n))) for n in rng.integers(1, 60, 120)] + [None, "", "once more", "once more"]
    labels, _ = trusted_ids(spark, 60)
    docs = spark.createDataFrame([(i if i < 122 else 500, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string").repartition(5)

    def scores():
        return sorted(((r.doc_id, r.perplexity and round(r.perplexity, 6), r.kept) for r in kneser_ney.judge_documents(docs, labels).collect()), key=repr)

    one = scores()
    monkeypatch.setattr(kneser_ney, "ROUND_CHARS", 3000)
    monkeypatch.setattr(kneser_ney, "SHARD_KEYS", 3)
    assert kneser_ney.shard_bits(100) == 6 and scores() == one


def test_number_of_shards_follows_the_keys():
    for n in (0, 10 ** 6, 10 ** 8, 10 ** 11, 10 ** 14):
        assert n / 2 ** kneser_ney.shard_bits(n) <= 2 * kneser_ney.SHARD_KEYS


def test_units_found_at_once_are_those_of_the_pattern(monkeypatch):
    rng = np.random.default_rng(3)
    texts = ["".join(rng.choice(list(" \t\n_a1é.,#日\U0001f600̀\x00\x1c²"), int(n))) for n in rng.integers(0, 30, 500)]
    long = "ab" * kneser_ney.LONG_UNIT
    texts += ["", long + " " + long + "a " + long[1:], "\0", " ", "\n"]
    monkeypatch.setattr(kneser_ney, "UNIT_CHARS", 1000)
    for some in (texts, [""]):
        units = kneser_ney._Units()
        row, lengths = units.of(some)
        names, at = list(units), 0
        for text, n in zip(some, lengths, strict=True):
            assert [names[i] for i in row[at:at + n]] == ["", *kneser_ney._UNIT.findall(text), "\0"]
            at += n
        assert at == len(row)


def test_a_round_shuffles_its_questions_and_not_the_model(spark):
    texts = spark.createDataFrame([(f"part {i} of {i * 7} costs {i * 31}",) for i in range(200)], "text string")
    model = kneser_ney.unit_model(texts, 100)
    asked = spark.createDataFrame([], "block long, pair boolean, shard long, keys binary")
    found = kneser_ney.look_up(asked, model.pairs, 1, np.uint32)
    assert found._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(shard") == 1
    assert found.collect() == []
    model.drop(spark)
    assert not any(spark.catalog.tableExists(t) for t in model.tables)


def test_helpers_of_the_model_take_little_memory():
    import tracemalloc
    rng = np.random.default_rng(3)
    words = [f"w{k * 2654435761 % 2 ** 32:x}" for k in range(300_000)]
    texts = [" ".join(words[k:k + 500]) for k in range(0, len(words), 500)]
    table = rng.normal(size=kneser_ney.CLASSES ** kneser_ney.ORDER).astype(np.float32)
    whole = sum(map(len, texts))

    def peak(f):
        tracemalloc.start()
        out = f()
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return out, most / whole

    kneser_ney.grams(["a"]), kneser_ney.spellings(["a"], table)
    (codes, lengths), most = peak(lambda: kneser_ney.grams(texts))
    assert len(codes) == whole == lengths.sum() and most < 35  # bytes a character; 44 with 64-bit places
    spelled, most = peak(lambda: kneser_ney.spellings(words, table))
    assert most < 25  # 53 with all units at once
    one = np.array([kneser_ney.spellings([w], table)[0] for w in words[::30_000]])
    assert np.allclose(spelled[::30_000], one)
    assert [p for part in kneser_ney.parts(texts) for p in part] == texts and max(sum(map(len, p)) for p in kneser_ney.parts(texts)) < 1.1 * kneser_ney.UNIT_CHARS


def test_rows_go_to_python_in_small_batches(spark):
    import pyarrow as pa
    from ledgermatch.llm import common

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["x"])

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    rows = spark.range(0, 3000, 1, 1).selectExpr("repeat('x', 10000) AS text")
    with common.small_batches(spark):
        found = [r.x for r in rows.mapInArrow(sizes, "x long").collect()]
    assert max(found) < 1.1 * common.SLICE_BYTES and sum(found) >= 30_000_000
    assert spark.conf.get(key, None) == before
    for v in ([], [5], [3, 1, 3, 2, 1]):
        assert common.distinct(np.array(v, np.uint64)).tolist() == sorted(set(v))
