"""What the plans must not hold: second scans, sorts before aggregating, hot keys."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgermatch.operators import enrich, incremental, lookups, matching, report
from ledgermatch.plans.queries import Context


@pytest.fixture(scope="module")
def ctx(spark):
    return Context.get(spark, SF_SMALL)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def scans(df) -> int:
    return len(re.findall(r"FileScan ", plan(df)))


def test_distinct_names_by_hash_aggregation(ctx):
    text = plan(ctx.job.names())
    assert "SortAggregate" not in text and "HashAggregate" in text and scans(ctx.job.names()) == 1


def test_context_of_unmatched_names_sorts_no_rows_to_aggregate(ctx):
    """Sort aggregates may only stand over the small cache."""
    for part in plan(ctx.job.unmatched()).split("SortAggregate")[1:]:
        assert "ord_seq" in part.split("\n")[0] or "batch" in part.split("\n")[0]


def test_known_matches_start_from_distinct_triples(ctx):
    text = plan(lookups.known_matches(ctx.base_raw))
    assert "known_triples" in text and "landed-base" not in text


def test_each_builder_input_is_read_once(ctx):
    assert scans(lookups.public_firms(ctx.coverage, ctx.identifiers)) == 2  # coverage, identifiers


def test_cache_match_reads_the_names_once(ctx):
    names = ctx.job.names()
    assert len(re.findall(r"new_rows-", plan(matching.match_cache(names, ctx.cache, "raw_name")))) == scans(names)


def test_facets_gather_no_set(ctx):
    view = report.report_view(ctx.output())
    text = plan(report.facets(view))
    assert "collect_set" not in text and scans(report.facets(view)) == 1


def test_snapshot_diff_is_one_join(ctx):
    df = ctx.ledger.select("registry_key", F.col("Serial Number").alias("serial"))
    text = plan(incremental.snapshot_diff(df, df.limit(10)))
    assert len(re.findall(r"LeftAnti", text)) == 1


def test_rows_without_firm_get_keys_of_their_own(spark):
    rows = spark.range(200).select(F.when(F.col("id") < 5, F.concat(F.lit("E"), "id")).otherwise("").alias("factset_entity_id"))
    rows = rows.unionByName(spark.sql("SELECT CAST(NULL AS STRING) AS factset_entity_id"))
    firms = spark.createDataFrame([("E1", "US", 1), ("E1", "BR", 2), ("", "XX", 3)], "factset_entity_id string, iso_country string, seq long")
    got = enrich.hq_country(rows, firms)
    assert got.count() == 201
    assert sorted(r.hq_country for r in got.collect() if r.hq_country) == ["BR"]
    assert "_key" not in got.columns


def test_numbered_rows_are_shuffled_once(spark):
    import random

    from ledgermatch.operators.numbering import number_rows
    values = [(random.Random(i).choice([None, 1, 2, 3, 500, i]), i) for i in range(3000)]
    rows = spark.createDataFrame(values, "k int, i int").repartition(7)
    numbered = number_rows(rows, ["k", F.col("i") * -1], "_at")
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan  # ranges are not shuffled again once they are written
    assert numbered.columns == ["k", "i", "_at"]
    want = sorted(values, key=lambda r: (r[0] is not None, r[0] or 0, -r[1]))
    assert [(r.k, r.i, r["_at"]) for r in numbered.orderBy("_at").collect()] == [(k, i, n) for n, (k, i) in enumerate(want)]
    assert number_rows(rows.where("false"), ["k"]).count() == 0


def test_ledger_rows_are_written_once_and_exports_without_a_shuffle(spark, monkeypatch):
    from ledgermatch.operators import numbering
    from ledgermatch.plans import fixtures as fx
    monkeypatch.setattr(fx, "_LANDED", {})
    monkeypatch.setattr(fx, "_NUMBERED", {}, raising=False)
    names, real_path, real_written = [], fx.scratch_path, numbering.written
    monkeypatch.setattr(fx, "scratch_path", lambda s, name: names.append(name) or real_path(s, name))
    monkeypatch.setattr(numbering, "written", lambda df, name: names.append(name) or real_written(df, name))
    raw, base = fx.registry_ledger(spark, SF_SMALL), fx.base(spark, SF_SMALL)
    assert sorted(names) == ["landed-base", "landed-ledger_raw", "numbered"]
    seqs = [r.seq for r in raw.select("seq").orderBy("seq").collect()]
    assert seqs == list(range(len(seqs))) and 0 < base.count() < len(seqs)


def test_matched_table_is_written_without_a_sort_by_folder(spark, tmp_path):
    from ledgermatch.sources import sinks
    conf = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(conf)
    seen = []
    rows = spark.range(200).select(F.concat(F.lit("r"), (F.col("id") % 40).cast("string")).alias("registry"), "id")
    class Writer:
        def __init__(self, df):
            self.sparkSession = df.sparkSession
            self.df = df

        def withColumn(self, *a):
            seen.append(int(spark.conf.get(conf)))
            return self.df.withColumn(*a)

    path = sinks.write_matched(Writer(rows), str(tmp_path / "many"))  # more folders than are open at a time
    assert seen == [sinks.OPEN_FOLDERS] and spark.conf.get(conf) == before
    back = sinks.read_matched(spark, path, rows.schema)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect()))


def test_many_new_serials_do_not_shuffle_the_rows_that_are_known(spark, monkeypatch):
    monkeypatch.setattr(incremental, "SMALL_ROWS", 100)
    rows = spark.range(20000).select(
        "id", F.when(F.col("id") % 50 != 0, F.concat(F.lit("S"), (F.col("id") % 9000).cast("string"))).alias("serial"))
    serials = spark.range(300).select(F.concat(F.lit("S"), (F.col("id") * 7).cast("string")).alias("_serial"))
    want = sorted(r.id for r in rows.collect() if r.serial is None or (int(r.serial[1:]) % 7 == 0 and int(r.serial[1:]) < 2100))
    for most in (incremental.MOST_BITS, 64):  # a map of few bits keeps more rows; the join is exact
        monkeypatch.setattr(incremental, "MOST_BITS", most)
        found = incremental.rows_of_serials(rows, F.col("serial"), serials)
        assert sorted(r.id for r in found.collect()) == want and found.columns == rows.columns
        kept = incremental.maybe_of_serials(rows, F.col("serial"), serials, 300)
        assert set(want) <= {r.id for r in kept.collect()}
        if most > 64:
            assert kept.count() < len(want) + 3000


def test_the_schema_of_the_published_table_needs_no_run(ctx):
    from ledgermatch.plans.job import ORDER_COLUMNS, TABLE_SCHEMA
    assert [(f.name, f.dataType) for f in TABLE_SCHEMA] == [(f.name, f.dataType) for f in ctx.output().schema]
    assert TABLE_SCHEMA.names[-2:] == ORDER_COLUMNS


def test_ranged_rows_are_numbered_where_the_join_left_them(spark, monkeypatch):
    import random

    from ledgermatch.operators import numbering
    rnd = random.Random(3)
    lines = [(rnd.choice([None, 1, 2, 2 ** 60 + i % 3, i]), i) for i in range(2000)]
    orders = [(k, f"o{k}") for k in {k for k, _ in lines if k is not None and k % 7}]
    plans, real = [], numbering.written
    monkeypatch.setattr(numbering, "written", lambda df, name: plans.append(df._jdf.queryExecution().executedPlan().toString()) or real(df, name))
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(name)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        right = spark.createDataFrame(orders, "o long, text string")
        left, bounds = spark.createDataFrame(lines, "k long, i int"), numbering.key_bounds(right, "o")
        left, right = numbering.in_key_ranges(left, "k", bounds), numbering.in_key_ranges(right, "o", bounds)
        both = left.join(right, (left["_range"] == right["_range"]) & (F.col("k") == F.col("o"))).drop(right["_range"])
        numbered = numbering.number_ranges(both, ["k", F.col("i") * -1], "_at")
        got = [(r.k, r.i, r.text, r["_at"]) for r in numbered.orderBy("_at").collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    want = sorted(((k, i) for k, i in lines if k is not None and k % 7), key=lambda r: (r[0], -r[1]))
    assert got == [(k, i, f"o{k}", n) for n, (k, i) in enumerate(want)] and numbered.columns == ["k", "i", "o", "text", "_at"]
    # One shuffle a side; the numbers need none. The session's setting is as before.
    assert plans[0].count("Exchange") == 2 and "rangepartitioning" not in plans[0] and spark.conf.get(name) == before
    none = spark.createDataFrame([], "o long, text string")
    assert numbering.number_ranges(numbering.in_key_ranges(none, "o", numbering.key_bounds(none, "o")), ["o"]).count() == 0


def test_ledger_derivation_sorts_no_wide_rows_into_ranges(spark, monkeypatch):
    from ledgermatch.operators import numbering
    from ledgermatch.plans import fixtures as fx
    monkeypatch.setattr(fx, "_NUMBERED", {}, raising=False)
    plans, real = [], numbering.written
    monkeypatch.setattr(numbering, "written", lambda df, name: plans.append(df._jdf.queryExecution().executedPlan().toString()) or real(df, name))
    fx.ledger_rows(spark, SF_SMALL)
    assert len(plans) == 1 and "rangepartitioning" not in plans[0]


def test_bucketed_base_holds_the_whole_base(ctx):
    assert ctx.bucketed_base().columns == [*ctx.base_raw.columns, incremental.BUCKET_KEY]
    assert ctx.bucketed_base().count() == ctx.base_raw.count()


def test_snapshot_diff_shuffles_a_text_serial_once(spark):
    rows = [(1, "verra", "a"), (2, "verra", None), (3, "gold", "a"), (4, "verra", "\0b"), (5, "verra", "c"), (5, "verra", "c"), (6, None, "a")]
    new = spark.createDataFrame(rows, "seq int, registry_key string, serial string")
    old = spark.createDataFrame([(9, "verra", "a"), (9, "verra", "\0b"), (9, "gold", "c"), (9, "gold", None)], new.schema)
    found = incremental.snapshot_diff(new, old)
    key = lambda r: str(r)
    assert found.columns == new.columns and sorted(map(tuple, found.collect()), key=key) == sorted([r for r in rows if r[0] > 1], key=key)
    for line in plan(found).splitlines():
        if "AS _serial#" in line and "Project" in line:
            assert not re.search(r"[\[ ]serial#\d+L?[,\]]", line), line
    assert "SortMergeJoin" in plan(found) and "BroadcastHashJoin" not in plan(found)
    numbers = spark.createDataFrame([(1, "x", 5), (2, "x", 6), (3, "x", None)], "seq int, registry_key string, serial int")
    left = incremental.snapshot_diff(numbers, numbers.limit(0).unionByName(numbers.where("serial = 5")))
    assert left.schema == numbers.schema and sorted(r.seq for r in left.collect()) == [2, 3]


def test_a_written_table_leaves_no_shuffle_files(spark):
    from ledgermatch.session import FREE_SHUFFLES, written
    (name,) = FREE_SHUFFLES
    before = spark.conf.get(name)

    def shuffles() -> set[str]:
        files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
        return {f for f in (files.apply(i).getName() for i in range(files.size())) if f.startswith("shuffle_")}

    rows, old = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), shuffles()
    back = written(rows, "grouped")
    assert not shuffles() - old and spark.conf.get(name) == before
    # the frame itself may be read and written again
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect())) == sorted(map(tuple, written(rows, "grouped").collect()))


def test_a_query_lands_the_inputs_that_it_reads(spark, monkeypatch):
    from ledgermatch.plans import fixtures as fx
    names, real = [], fx.landed
    monkeypatch.setattr(fx, "landed", lambda s, d, name: names.append(name) or real(s, d, name))
    c = Context(spark, SF_SMALL)
    assert names == ["ledger_raw"]  # all that a first run reads
    assert c.base_raw.columns and c.coverage.columns and c.identifiers.columns and c.base_raw is c.base_raw
    assert names == ["ledger_raw", "base", "entity_coverage", "entity_identifiers"]
