"""Near-miss matching, firm search, the facet cube, the firm layout and the Unicode fold."""

from __future__ import annotations

import random
import re
import sys
import unicodedata

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, one_col
from ledgermatch.functions.unicode_fold import fold, py_fold
from ledgermatch.operators import facet_cube, name_search, names, near_miss, report
from ledgermatch.plans.queries import CUBE_CHOICES, FACET_CHOICE, Context
from ledgermatch.sources import sinks, tables


@pytest.fixture(scope="module")
def ctx(spark):
    return Context.get(spark, SF_SMALL)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


# ------------------------------------------------------------------ near misses

CACHE = "company_raw string, company_normalized string, official_name string, factset_entity_id string, batch int, ord_firm string, ord_seq long"


@pytest.mark.parametrize("k", [1, 2])
def test_near_misses_against_all_pairs(spark, k):
    rng = random.Random(k)
    words = ["".join(rng.choice("abcé") for _ in range(rng.randint(4, 8))) for _ in range(300)]
    cache = [(w, w, f"Firm {i}", None if i % 17 == 0 else "" if i % 13 == 0 else f"E{i}", i % 2, f"F{i % 5}", i) for i, w in enumerate(words[:150])]
    cache += [("x", None, "n", "E", 0, "", 1), ("x", "", "n", "E", 0, "", 2), (words[0], words[0], "again", "E900", 9, "", 900)]
    missed = [*words[150:], "", None, "abcab" * 30, words[200], "ab"]
    keys = {}
    for row in sorted((r for r in cache if r[1]), key=lambda r: (r[4], r[5], r[6])):
        keys[row[1]] = ((row[4], row[5], row[6]), row[2], row[3])
    want = {}
    for name in {m for m in missed if m}:
        if not near_miss.MIN_LENGTH <= len(py_fold(name)) <= near_miss.MAX_LENGTH:
            continue
        near = sorted((d, v[0], key) for key, v in keys.items() if v[2] and near_miss.MIN_LENGTH <= len(key) and (d := distance(py_fold(name), key)) <= k)
        if near:
            d, _, key = near[0]
            want[name] = (keys[key][1], keys[key][2], d, "medium" if d <= 1 else "low")
    got = near_miss.near_misses(one_col(spark, missed, "raw_name"), spark.createDataFrame(cache, CACHE), k).collect()
    assert {r.raw_name: (r.matched_name, r.factset_entity_id, r.distance, r.confidence) for r in got} == want and len(got) == len(want)
    assert len(want) > 5


def test_near_misses_form_no_block_of_pairs(ctx):
    text = plan(near_miss.near_misses(ctx.job.unmatched(), ctx.cache, 1))
    assert "CartesianProduct" not in text and "NestedLoop" not in text and "xxhash64" in text


def test_names_and_keys_are_not_broadcast_on_an_estimate(spark):
    from ledgermatch.operators import lookups, matching
    cache = spark.createDataFrame([("acme one", "acme one", "Acme", "E1", 0, "E1", 1)], CACHE)
    missed = spark.createDataFrame([("acme two",), ("acme on",), (None,)], "raw_name string")
    base = spark.createDataFrame([(1, "acme one", "Acme", "E1"), (2, "acme one", None, "E1")], "seq long, company string, official_name string, factset_entity_id string")
    found = matching.match_cache(missed, cache, "raw_name")
    frames = {1: near_miss.near_misses(missed, cache, 1), 3: near_miss.with_near_misses(found, cache, 1)}
    assert {n: f.count() for n, f in frames.items()} == {1: 1, 3: 3}
    for df in (*frames.values(), found, lookups.known_matches(base)):
        assert "SortMergeJoin" in plan(df) and "Broadcast" not in plan(df)


def test_the_run_matches_nearly_only_when_asked(ctx):
    plain = ctx.job.cache_results()
    job = ctx.new_job(near_edits=1).after_new_rows_of(ctx.job)
    near = job.cache_results()
    assert plain.filter("match_method = 'cache_near'").count() == 0
    changed = near.join(plain.select("raw_name", F.col("match_method").alias("before")), "raw_name").filter("match_method <> before")
    assert {(r.match_method, r.before) for r in changed.select("match_method", "before").distinct().collect()} == {("cache_near", "unmatched")}
    assert near.count() == plain.count()


# ------------------------------------------------------------------ firm search

PATTERNS = ["firm 1", "FIRM", "(alpha|beta) corp", "alp?ha", "corp$", "^beta", "co+rp", "a.pha", "x{2}yz", "[ab]eta corp", "a|b", r"\bcorp\b", "straße",
            "STRASSE", "müller", "kelvin", "ist", "ab", "", "no such firm", "mas{0,2}k", "be(ta)?corp"]
NAMES = ["Firm 1", "firm 12", "Alpha Corp", "Beta corp", "alha", "Coorp", "xxyz", "Straße", "STRASSE", "Müller & Co", "Kelvin Corp", "İstanbul ist",
         "ſtrasse", "mask", "masssk", "", "ab", None, "beta", "betacorp"]


def test_searches_against_the_report_filter(spark):
    view = spark.createDataFrame([(n, i) for i, n in enumerate(NAMES * 2)], "matched_name string, seq int")
    index = name_search.build_index(view)
    distinct = view.select(F.col("matched_name").alias("name")).filter("name IS NOT NULL").distinct()
    for pattern in PATTERNS:
        want = sorted(r.seq for r in (report.faceted_filter(view, firm_search=pattern) if pattern else view.filter("matched_name IS NOT NULL")).collect())
        got = sorted(r.seq for r in name_search.search_rows(view, index, distinct, pattern).collect())
        assert got == want, pattern


def test_required_grams():
    need = name_search.required_grams
    assert need("abc.def") == ["abc", "def"] and need("ab{2,3}cde") == ["cde"] and need("a+?bcde") == ["bcd", "cde"]
    for nothing in ("ab", "a|bcd", r"\bfirm", "(a|b", "[]a]bcd", "(?!x)abc", "été", "a?b?c?"):
        assert need(nothing) == [], nothing
    rng = random.Random(0)
    for _ in range(3000):
        pattern = "".join(rng.choice(["a", "b", "c", "ab", ".", "?", "*", "+", "(a|b)", "(abc)", "[ab]", "[^a]", "{2}", "^", "$", "|"]) for _ in range(rng.randint(1, 8)))
        try:
            found = re.compile(pattern, re.I)
        except re.error:
            continue
        for _ in range(5):
            text = "".join(rng.choice("abcABC") for _ in range(rng.randint(0, 9)))
            if found.search(text):
                assert all(g in text.lower() for g in need(pattern)), (pattern, text)


# ------------------------------------------------------------------ cube

def test_cube_against_the_rows(spark, ctx):
    view = ctx.report()
    firms = facet_cube.firm_numbers(view)
    numbers = sorted(r.firm for r in firms.collect())
    assert numbers == list(range(len(numbers)))
    cube = facet_cube.build_cube(view, firms)
    choices = [*CUBE_CHOICES.values(), {k: v for k, v in FACET_CHOICE.items() if k != "firm_search"}, dict(countries=["nowhere"])]
    for choice in choices:
        want = report.report_metrics(report.faceted_filter(view, **choice)).first()
        got = facet_cube.metrics(cube, **choice).collect()
        assert len(got) == 1 and all(got[0][c] == pytest.approx(want[c]) for c in ("total_quantity", "transactions", "unique_firms", "countries"))


def test_cube_with_many_firms_and_nulls(spark):
    rows = spark.range(70_000).selectExpr("concat('E', id) AS factset_entity_id", "cast(2000 + id % 3 AS int) AS retirement_year", "'x' AS hq_country_name",
                                          "if(id % 2 = 0, 'BR', null) AS country", "'k' AS project_category", "1.0 AS quantity")
    rows = rows.unionByName(rows.limit(5).withColumn("factset_entity_id", F.lit(None).cast("string")))
    cube = facet_cube.build_cube(rows, facet_cube.firm_numbers(rows))
    got = facet_cube.metrics(cube).first()
    assert (got.transactions, got.unique_firms, got.countries) == (70_005, 70_000, 1)
    assert facet_cube.metrics(cube, year_range=(2001, 2001)).first().unique_firms == rows.filter("retirement_year = 2001").agg(F.countDistinct("factset_entity_id")).first()[0]
    assert facet_cube.metrics(cube.limit(0)).first().transactions == 0


# ------------------------------------------------------------------ layout

def test_a_lookup_reads_few_row_groups(spark, ctx):
    firms = spark.range(200_000).selectExpr("concat('F', lpad(id * 7919 % 200000, 6, '0')) AS factset_entity_id", "repeat(md5(cast(id AS string)), 6) AS entity_proper_name")
    path = sinks.write_firms(firms, ctx.scratch("laid_out"), files=4, group_bytes=1 << 20)
    ids = [f"F{i:06d}" for i in range(1000, 1010)]
    found = tables.firms_by_id(spark, path, ids)
    assert "PushedFilters: [In(factset_entity_id" in plan(found)
    assert sorted(r.factset_entity_id for r in found.collect()) == ids
    executed = found._jdf.queryExecution().executedPlan()
    read = []

    def walk(node):
        if node.nodeName().startswith("Scan"):
            read.append(node.metrics().apply("numOutputRows").value())
        for i in range(node.children().size()):
            walk(node.children().apply(i))
    spark_plan = executed.executedPlan() if executed.nodeName().startswith("Adaptive") else executed
    walk(spark_plan)
    assert read and sum(read) < 0.1 * 200_000


# ------------------------------------------------------------------ fold

def test_fold_on_every_assigned_code_point(spark):
    points = [cp for cp in range(sys.maxunicode + 1) if not 0xD800 <= cp <= 0xDFFF and unicodedata.category(chr(cp)) != "Cn"]
    step = 400
    rows = [(i, "a" + "".join(chr(cp) + "b" for cp in points[i:i + step])) for i in range(0, len(points), step)]
    df = spark.createDataFrame(rows, "i int, x string")
    for r in df.withColumn("y", fold(F.col("x"))).collect():
        assert r.y == py_fold(r.x), r.i


def test_fold_odd_texts(spark):
    texts = [None, "", "ﬁ", "한국어 각", "\U0001f600ﬁ\U0001f600", "x" * 50_000 + "ﬃ", "\nﬁ\r\n한", "가" * 3000]
    got = {r.x: r.y for r in one_col(spark, texts).withColumn("y", fold(F.col("x"))).collect()}
    assert got == {t: None if t is None else py_fold(t) for t in texts}


def test_no_python_under_name_queries(spark, ctx):
    from __spark_entry__ import queries
    docs = one_col(spark, ["a"], "text")
    for df in (names.fold_accents(docs, "text", "y"), names.normalize_names(docs, "text", "y"), queries()["cache_match"](spark, SF_SMALL)):
        assert "Python" not in plan(df) and "Arrow" not in plan(df)
