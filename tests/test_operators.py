"""Operator behaviour on small hand-made frames (the survey's edge-row table)."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ledgermatch import codes
from ledgermatch.operators import enrich, extract, harmonize, incremental, matching, report, resolve


def test_quantity_and_year(spark):
    df = spark.createDataFrame([(v,) for v in ["1e3", "1,000", "1d", "nan", "", None, " 42 ", "-3.5", ".5"]],
                               "q string")
    got = [r["v"] for r in df.select(harmonize.to_quantity("q").alias("v")).collect()]
    assert got == [1000.0, 0.0, 0.0, 0.0, 0.0, 0.0, 42.0, -3.5, 0.5]
    years = spark.createDataFrame([("2021",), ("2021.0",), ("x",), (None,)], "y string")
    assert [r[0] for r in years.select(harmonize.to_year("y")).collect()] == [2021, 2021, None, None]


def test_dates(spark):
    df = spark.createDataFrame([("garbage",), (None,), ("03/02/2001",), ("2001-02-03 10:00:00",)], "d string")
    got = df.select(F.year(harmonize.parse_timestamp("d", day_first=True)).alias("y"),
                    F.month(harmonize.parse_timestamp("d", day_first=True)).alias("m"),
                    F.month(harmonize.parse_timestamp("d", day_first=False)).alias("m2")).collect()
    assert [tuple(r) for r in got] == [(None, None, None), (None, None, None), (2001, 2, 3), (2001, 2, 2)]


DATES = [
    ("2021-01-05T10:00:00", "2021-01-05 10:00:00"), ("2021-01-05T10:00:00Z", "2021-01-05 10:00:00"), ("2021-01-05 10:00:00.123", "2021-01-05 10:00:00"),
    ("2021-01-05T23:30:00.5+02:00", "2021-01-05 23:30:00"), ("2021/01/05", "2021-01-05 00:00:00"), ("2021/1/5 7:08", "2021-01-05 07:08:00"),
    ("Jan 5, 2021", "2021-01-05 00:00:00"), ("january 5 2021", "2021-01-05 00:00:00"), ("5 JAN 2021", "2021-01-05 00:00:00"), ("05-Jan-2021", "2021-01-05 00:00:00"),
    ("31/12/2020", "2020-12-31 00:00:00"), ("2021-13-01", None), ("Foo 5, 2021", None), ("2021", None), ("", None), ("2021-02-30", None),
]


def test_date_shapes(spark):
    df = spark.createDataFrame([(d,) for d, _ in DATES], "d string")
    got = df.select(harmonize.parse_timestamp("d", day_first=True).cast("string").alias("t")).collect()
    assert [r["t"] for r in got] == [t for _, t in DATES]


def test_typed_timestamp_keeps_its_value(spark):
    df = spark.sql("SELECT CAST(TIMESTAMP '2021-01-05 10:00:00.123' AS STRING) AS d")
    assert df.select(F.year(harmonize.parse_timestamp("d"))).first()[0] == 2021


def test_tonnes_labels(spark):
    cases = [(1.3076e9, "1307.6M"), (999_600.0, "1000K"), (1e6, "1.0M"), (1_250_000.0, "1.2M"), (2500.0, "2K"), (1500.0, "2K"), (999.0, "999"), (0.0, "0")]
    df = spark.createDataFrame([(v,) for v, _ in cases], "t double")
    assert [r[0] for r in df.select(report.fmt_tonnes("t")).collect()] == [s for _, s in cases]


def _ledger(spark, rows, columns):
    schema = ", ".join(f"`{c}` string" for c in columns)
    return spark.createDataFrame(rows, schema)


def test_gold_using_entity_fallthrough(spark):
    cols = ["registry_key", "* Using Entity", "Using Entity", "Note"]
    df = _ledger(spark, [("gold", "", "Second Co", None),
                         ("gold", None, "Second Co", "on behalf of Third Corp"),
                         ("gold", "  ", None, None)], cols)
    got = [r["parsed"] for r in extract.with_beneficiary(df, {"gold": set(cols)}).collect()]
    assert got[0]["raw_name"] == "Second Co" and got[0]["source_field"] == "* Using Entity"
    assert got[1]["raw_name"] == "Third Corp" and got[1]["source_field"] == "Note"
    assert got[2] is None


def test_verra_text_fallback_kept_when_blank(spark):
    cols = ["registry_key", "Retirement Beneficiary", "Retirement Details"]
    df = _ledger(spark, [("verra", None, "on behalf of x@y.com")], cols)
    got = extract.with_beneficiary(df, {"verra": set(cols)}).collect()[0]["parsed"]
    assert got["raw_name"] == "" and got["source_field"] == "Retirement Details" and got["registry"] == "Verra"


def test_unknown_registry_fails(spark):
    with pytest.raises(ValueError):
        extract.registry_case(spark.range(1), {"nope": set()}, lambda r, c: F.lit(1))


def test_anti_join_keeps_null_serials_and_matches_text(spark):
    new = spark.createDataFrame([("1",), (None,), ("2",), ("2",)], "s string")
    base = spark.createDataFrame([(1,)], "serialnumber int")
    out = incremental.anti_join_serials(new, F.col("s"), incremental.base_serials(base))
    assert sorted([r["s"] for r in out.collect()], key=str) == ["2", "2", None]
    # rerunning on its own output with those serials as base gives no non-null new rows
    base2 = out.filter(F.col("s").isNotNull()).withColumnRenamed("s", "serialnumber")
    again = incremental.anti_join_serials(out, F.col("s"), incremental.base_serials(base2))
    assert [r["s"] for r in again.collect()] == [None]


def test_cache_lookup_last_row_wins_and_blank_exact_hit(spark):
    seq = "bigint"
    cache = spark.createDataFrame([
        ("Acme", "acme", "Acme One", "E1", 0, "E1", 1),
        ("ACME ", "acme", "Acme Two", "E2", 0, "E2", 2),
        ("Blank Co", "blank", "Nobody", "", 0, "", 3),
        ("Other", "blank", "Somebody", "E3", 0, "E3", 4),
    ], f"company_raw string, company_normalized string, official_name string, factset_entity_id string, "
       f"batch int, ord_firm string, ord_seq {seq}")
    names = spark.createDataFrame([("acme",), ("Acme Inc",), ("Blank Co",), ("",), ("blank co.",)],
                                  "raw_beneficiary string")
    got = {r["raw_name"]: (r["factset_entity_id"], r["match_method"])
           for r in matching.match_cache(names, cache).collect()}
    assert got["acme"] == ("E2", "cache_exact")          # last row per exact key wins
    assert got["Acme Inc"] == ("E2", "cache_normalized")  # normal form, last row wins
    assert got["Blank Co"] == ("", "cache_exact")         # exact hit with blank id: final
    assert got[""] == (None, "unmatched")
    assert got["blank co."] == ("E3", "cache_normalized")


def test_project_category_rules(spark):
    df = spark.createDataFrame([("Industrial gas",), ("Landfill biogas",), (None,), ("REDD+",),
                                ("Fleet fuel",), ("unknown",)], "t string")
    got = [r[0] for r in df.select(enrich.project_category("t")).collect()]
    assert got == ["Industrial Processes", "Renewable Energy", "Other", "Forestry & Land Use", "Transport",
                   "Other"]


def test_top_k_ties_keep_lower_key(spark):
    df = spark.createDataFrame([("b", 5.0), ("a", 5.0), ("c", 1.0)], "country string, quantity double")
    got = [tuple(r) for r in report.top_by(df, "country", n=2).collect()]
    assert got == [("a", 5.0), ("b", 5.0)]


def test_map_modes(spark):
    df = spark.createDataFrame([("E1", "Viet Nam", "", 10.0), ("E1", "Vietnam", "VNM", 5.0), ("", "Peru", "", 7.0)],
                               "factset_entity_id string, country string, isocode string, quantity double")
    col = {r["iso3"]: r["tonnes"] for r in report.map_project(df, mode="column").collect()}
    row = {r["iso3"]: r["tonnes"] for r in report.map_project(df, mode="row").collect()}
    assert col == {"": 10, "VNM": 5}
    assert row == {"VNM": 15}


def test_resolver_batches_and_failures(spark, tmp_path):
    names = spark.createDataFrame([(f"Name {i:03d}", i) for i in range(65)], "raw_name string, n int")
    calls = str(tmp_path)

    def resolver(reqs, context):
        import os
        import uuid
        with open(os.path.join(calls, uuid.uuid4().hex), "w") as f:
            f.write(str(len(reqs)))
        assert context == "firms"
        if reqs[0]["name"] == "Name 020":
            raise RuntimeError("down")
        if reqs[0]["name"] == "Name 040":
            return "no list here"
        items = [{"index": i + 1, "parent_name": f"P {r['name']}", "factset_entity_id": "E1", "confidence": "high"} for i, r in enumerate(reqs)]
        return items[:-1]

    out = resolve.resolve_batches(names, resolver, "raw_name", batch_size=20, context="firms")
    got = {r["raw_name"]: r for r in out.collect()}
    out.collect()
    assert len(got) == 65
    for i in range(65):
        r = got[f"Name {i:03d}"]
        if 20 <= i < 60:  # the second call fails, the third reply cannot be read
            assert (r["match_method"], r["confidence"], r["matched_name"]) == ("llm_error", "none", None)
            assert r["reasoning"] == ("down" if i < 40 else "")
        elif i in (19, 64):  # no item for the last line
            assert (r["match_method"], r["confidence"], r["factset_entity_id"]) == ("llm", "none", None)
        else:
            assert (r["matched_name"], r["factset_entity_id"], r["match_method"]) == (f"P Name {i:03d}", "E1", "llm")
    import os
    sizes = sorted(open(os.path.join(calls, f)).read() for f in os.listdir(calls))
    assert sizes == ["20", "20", "20", "5"]  # each batch is sent once, however often the result is read


def test_batches_do_not_depend_on_partitions(spark):
    names = spark.createDataFrame([(f"n{i:04d}",) for i in range(101)], "raw_name string")
    seen = set()
    for parts in (1, 7):
        rows = resolve.batched(names.repartition(parts), batch_size=20).collect()
        assert sorted((r["batch"], r["line"]) for r in rows) == [(i // 20, i % 20 + 1) for i in range(101)]
        seen.add(tuple(sorted((r["raw_name"], r["batch"], r["line"]) for r in rows)))
    assert len(seen) == 1
    assert resolve.resolve_batches(names.limit(0), lambda r, c: "[]").collect() == []


def test_repeated_index_takes_the_last_item(spark):
    names = spark.createDataFrame([("a",), ("b",)], "raw_name string")
    reply = '[{"index": 1, "parent_name": "old"}, {"index": 1, "parent_name": "new", "confidence": "low"}]'
    got = {r["raw_name"]: (r["matched_name"], r["confidence"]) for r in resolve.resolve_batches(names, lambda r, c: reply).collect()}
    assert got == {"a": ("new", "low"), "b": (None, "none")}


def test_sanitize_and_output_shape(spark):
    df = spark.createDataFrame([("nan", None, "None", 2021)], "raw_beneficiary string, registry string, "
                               "matched_name string, retirement_year int")
    out = harmonize.sanitize(harmonize.project_output(df))
    assert out.columns == codes.OUTPUT_COLUMNS
    row = out.collect()[0]
    assert row["raw_beneficiary"] == "" and row["registry"] == "" and row["matched_name"] == ""
    assert row["quantity"] == 0.0 and row["retirement_year"] == 2021


def test_job_with_resolver_end_to_end(spark):
    from conftest import SF_SMALL
    from ledgermatch.plans.queries import Context
    c = Context.get(spark, SF_SMALL)
    job = c.new_job(resolver=resolve.local_resolver())
    out = job.output()
    methods = {r["match_method"] for r in out.select("match_method").distinct().collect()}
    assert "llm" in methods and "cache_exact" in methods and "original" in methods
    assert out.count() == c.output().count()
    cache2 = job.updated_cache()
    assert cache2.filter("batch = 1").count() > 0
