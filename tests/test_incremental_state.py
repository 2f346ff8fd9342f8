"""What a run keeps for the next one: new serials, the bucketed base, stream state, versioned tables, merged roll-ups, counts."""

from __future__ import annotations

import gzip
import hashlib
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgermatch.operators import harmonize, incremental, report, resolve, rollups
from ledgermatch.plans import fixtures as fx
from ledgermatch.plans.queries import Context
from ledgermatch.sources import fingerprint, sinks, tables, versions
from ledgermatch.streaming.ingest import stream_new_rows


@pytest.fixture(scope="module")
def ctx(spark):
    return Context.get(spark, SF_SMALL)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# ------------------------------------------------------------------ J1, J2

def serial_column():
    return next(iter({c for c in fx.REGISTRY_COLUMNS["verra"] if "erial" in c}))


LEDGER = f"registry_key string, `{serial_column()}` string, seq long, extra string"
COLUMNS = {"verra": {serial_column()}}


def base(spark, serials):
    return spark.createDataFrame([(s, i) for i, s in enumerate(serials)], "serialnumber string, n long")


def test_new_rows_with_nulls_repeats_and_odd_serials(spark, monkeypatch):
    serials = ["b", "a", "b", None, None, "z", "new", "new", "\u0000odd", ""]
    led = spark.createDataFrame([("verra", s, i, "x") for i, s in enumerate(serials)], LEDGER)
    for small in (10, 0):  # broadcast, and a join that shuffles
        monkeypatch.setattr(incremental, "SMALL_ROWS", small)
        got = sorted(r.seq for r in incremental.find_new_rows(led, base(spark, ["b", None, "c"]), COLUMNS).collect())
        assert got == [1, 3, 4, 5, 6, 7, 8, 9], small


def test_the_wide_ledger_is_not_shuffled(ctx):
    text = plan(incremental.find_new_rows(ctx.ledger, ctx.base_raw, fx.REGISTRY_COLUMNS))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    assert not re.search(r"Exchange hashpartitioning", text)


def test_the_bucketed_base_is_not_shuffled(spark, ctx):
    kept = ctx.bucketed_base()
    own = ctx.ledger.select(harmonize.registry_serial(ctx.ledger, fx.REGISTRY_COLUMNS).alias("_serial")).filter("_serial IS NOT NULL").distinct()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        text = plan(own.join(incremental.base_serials(kept), "_serial", "left_anti"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # One exchange: the ledger's serials. The base is joined as it lies in its buckets.
    assert "Bucketed: true" in text and text.count("Exchange hashpartitioning") == 1


def test_bucketed_base_deals_out_rows_without_serial(spark, ctx):
    rows = base(spark, [None] * 400 + ["a"])
    kept = incremental.write_bucketed(rows, "dealt_base", 8, ctx.scratch("dealt_base"))
    sizes = [r["count"] for r in kept.groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == 401 and max(sizes) < 150
    assert [r._serial for r in incremental.base_serials(kept).collect()] == ["a"]


# ------------------------------------------------------------------ stream

def land(spark, folder, name, rows):
    spark.createDataFrame(rows, LEDGER).coalesce(1).write.parquet(f"{folder}/{name}")


def test_stream_state(spark, ctx):
    root = ctx.scratch("landing")
    schema = spark.createDataFrame([], LEDGER).schema
    known = base(spark, ["old"])

    def run():
        out = stream_new_rows(spark, f"{root}/*", schema, known, COLUMNS, f"{root}_out")
        return sorted(r.seq for r in out.collect())

    land(spark, root, "one", [("verra", "a", 1, "x"), ("verra", "a", 2, "x"), ("verra", None, 3, "x"), ("verra", "old", 4, "x")])
    assert run() == [1, 2, 3]  # a serial that stands twice in one micro-batch stays twice
    assert run() == [1, 2, 3]  # nothing landed
    land(spark, root, "again", [("verra", "a", 11, "x"), ("verra", "old", 14, "x")])
    assert run() == [1, 2, 3]  # a re-landed file gives nothing, after a restart of the query
    land(spark, root, "more files", [("verra", "b", 21, "x"), ("verra", "a", 22, "x"), ("verra", None, 23, "x"), ("verra", "\u0000odd", 24, "x")])
    assert run() == [1, 2, 3, 21, 23, 24]


def test_stream_reads_no_earlier_output():
    import inspect

    from ledgermatch.streaming import ingest
    body = inspect.getsource(ingest.stream_new_rows)
    assert "dropDuplicates" in body and "parquet(rows_path)" not in body[body.index("def per_batch"):body.index("keys = _keys")]


# ------------------------------------------------------------------ versions

def test_versions_switch_and_survive_a_dead_run(spark, ctx):
    root = ctx.scratch("versions")
    assert versions.current_version(spark, root) is None and tables.load_current_cache(spark, root).count() == 0
    versions.write_version(spark, root, lambda p: spark.range(3).write.parquet(p))

    def dies(path):
        spark.range(7).write.parquet(path)
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        versions.write_version(spark, root, dies)
    assert versions.current_version(spark, root) == "v000001" and spark.read.parquet(versions.current_path(spark, root)).count() == 3
    assert versions.write_version(spark, root, lambda p: spark.range(5).write.parquet(p)).endswith("v000003")
    assert spark.read.parquet(versions.current_path(spark, root)).count() == 5
    for n in range(8):  # v9 and v10 are told apart by their number
        versions.write_version(spark, root, lambda p, n=n: spark.range(n).write.parquet(p))
    assert versions.current_version(spark, root) == "v000011"


def test_two_runs_chain_through_the_versioned_cache(spark, ctx):
    import dataclasses
    root = ctx.scratch("chained")
    versions.write_version(spark, root, lambda p: sinks.write_cache(ctx.cache, p))
    hits = []
    for n in (1, 2):
        job = dataclasses.replace(ctx.new_job(resolver=resolve.local_resolver()), cache=tables.load_current_cache(spark, root))
        paths = job.after_new_rows_of(ctx.job).publish(ctx.scratch(f"chained_run{n}"), "2026-01-01", cache_root=root)
        assert paths["known_matches"].endswith(f"v{n + 1:06d}")
        counts = {r.stage: r.value for r in job.stage_counts().collect()}
        hits.append(counts["cache_hits"])
    assert hits[1] > hits[0] and tables.load_current_cache(spark, root).agg(F.max("batch")).first()[0] == 2


# ------------------------------------------------------------------ counts of a run

def test_counts_are_observed_not_scanned(spark, ctx):
    job = ctx.new_job()
    job.write_output(ctx.scratch("observed"))
    counts = job.stage_counts()
    assert "Scan parquet" not in plan(counts)
    got = {r.stage: r.value for r in counts.collect()}
    out = job.output()
    assert got["combined_rows"] == out.count() and got["base_rows"] == out.filter("src = 0").count()
    assert got["unique_names"] == got["cache_hits"] + got["cache_misses"] == job.names().count()
    assert sum(v for k, v in got.items() if k.startswith("new_rows_")) == job.new_rows().count()


def test_counts_of_an_empty_run(spark, ctx):
    from ledgermatch.plans.job import MatchingJob
    job = MatchingJob(ctx.ledger.limit(0), fx.REGISTRY_COLUMNS, ctx.base_raw.limit(0), ctx.cache.limit(0), None)
    job.write_output(ctx.scratch("empty_run"))
    got = {r.stage: r.value for r in job.stage_counts().collect()}
    assert got["combined_rows"] == got["parsed_rows"] == got["unique_names"] == 0


def test_the_run_builds_the_resolver_context(spark, ctx):
    def needs_context(requests, context=""):
        if context.count("\n") != 11 or "|" not in context:
            raise RuntimeError("no firms to choose from")
        return [{"index": i, "confidence": "none"} for i, _ in enumerate(requests, 1)]

    job = ctx.new_job(resolver=needs_context, context_firms=12).after_new_rows_of(ctx.job)
    assert {r.match_method for r in job.resolver_results().select("match_method").distinct().collect()} == {"llm"}
    assert ctx.new_job(resolver_context="mine").context() == "mine"


# ------------------------------------------------------------------ roll-ups

def test_merged_runs_equal_the_full_rollup(spark, ctx):
    root = ctx.scratch("kept_rollup")
    out = ctx.output()
    parts = [out.filter(f"seq % 3 = {i}") for i in range(3)]
    for i, part in enumerate(parts):
        got = rollups.update_rollup(spark, root, f"run {i}", part)
    again = rollups.update_rollup(spark, root, "run 1", parts[1])

    def rows(df):
        return sorted((r.dim, r.key, r.total, r.matched, r.unique_firms, r.total_mtco2, r.matched_mtco2) for r in df.collect())
    assert rows(got) == rows(again) == rows(report.summary_rollup(out))


def test_an_update_reads_the_state_and_its_own_rows(spark, ctx):
    root = ctx.scratch("lean_rollup")
    rollups.update_rollup(spark, root, "1", ctx.output().filter("src = 0"))
    sums, firms, _ = rollups.state(spark, root)
    new = spark.read.parquet(sinks.write_matched(ctx.output().filter("src = 1").limit(50), ctx.scratch("fifty")))
    text = plan(rollups.merge_sums(sums, rollups.partial_sums(new)))
    assert len(re.findall("FileScan", text)) == 2


def test_rollup_of_nothing_and_of_nulls(spark, ctx):
    schema = "registry string, match_method string, retirement_year int, factset_entity_id string, quantity double"
    empty = rollups.update_rollup(spark, ctx.scratch("no_rows"), "1", spark.createDataFrame([], schema))
    assert empty.count() == 0
    odd = spark.createDataFrame([(None, None, None, None, None), ("V", "m", 2000, "E1", 2e6), ("V", "m", 2000, "E1", None)], schema)
    got = {(r.dim, r.key): r for r in rollups.update_rollup(spark, ctx.scratch("odd_rows"), "1", odd).collect()}
    assert got[("all", "")].total == 3 and got[("all", "")].unique_firms == 1 and got[("registry", None)].total == 1
    assert got[("year", "2000")].total_mtco2 == 2.0 and ("year", None) not in got


# ------------------------------------------------------------------ hashes of files

def test_file_hashes(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for name, data in {"a.bin": b"one", "in/b.bin": b"", "in/c.txt": b"text"}.items():
        (tmp_path / name).write_bytes(data)
    got = {os.path.basename(r.path): (r.length, r.sha256) for r in fingerprint.file_hashes(spark, str(tmp_path)).collect()}
    assert got == {n: (len(d), hashlib.sha256(d).hexdigest()) for n, d in {"a.bin": b"one", "c.txt": b"text"}.items()}
    assert fingerprint.file_hashes(spark, str(tmp_path), "*.bin").count() == 1
    with pytest.raises(ValueError, match="c.txt"):
        fingerprint.file_hashes(spark, str(tmp_path), max_bytes=3)


def test_large_files_are_hashed_in_pieces(spark, tmp_path, monkeypatch):
    data = {"r.bin": random.Random(1).randbytes(300_000), "a [1] b{}.bin": b"\r\n\n\xff\xfe\n\0\r", "end.bin": b"text\n\n", "in/no.bin": b"\xc3(" * 900,
            "bom.bin": b"\xef\xbb\xbfmark", "bom_end.bin": b"\xef\xbb\xbf\n\n", "only.bin": b"\n" * 9, "p.gz": gzip.compress(b"packed" * 50), "small": b"x\n", "none": b""}
    (tmp_path / "in").mkdir()
    for name, text in data.items():
        (tmp_path / name).write_bytes(text)
    conf = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(conf)
    want = {n: (len(d), hashlib.sha256(d).hexdigest()) for n, d in data.items() if d}
    plain = fingerprint.file_hashes(spark, str(tmp_path))
    pieces = fingerprint.file_hashes(spark, str(tmp_path), whole_bytes=4)
    for found in (plain, pieces):
        assert {os.path.relpath(r.path.removeprefix("file:"), tmp_path): (r.length, r.sha256) for r in found.collect()} == want
    assert pieces.schema == plain.schema and spark.conf.get(conf) == before
    assert sorted(r.path for r in pieces.collect()) == sorted(r.path for r in plain.collect())
    # What no row can hold is not read as a value; only where the reader would unpack it this is an error.
    monkeypatch.setattr(fingerprint, "MAX_BYTES", 5)
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", 5)
    with pytest.raises(ValueError, match="p.gz"):
        fingerprint.file_hashes(spark, str(tmp_path), whole_bytes=4)
    try:
        found = fingerprint.file_hashes(spark, str(tmp_path), "*.bin", whole_bytes=4)
        assert {os.path.relpath(r.path.removeprefix("file:"), tmp_path): (r.length, r.sha256) for r in found.collect()} == {n: v for n, v in want.items() if n.endswith(".bin")}
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")


def test_hashes_of_the_given_files(spark):
    from __spark_entry__ import queries
    got = {r.file: (r.length, r.sha256) for r in queries()["file_hashes"](spark, SF_SMALL).collect()}
    want = {}
    for folder, _, names in os.walk(SF_SMALL):
        for name in names:
            if name.endswith(".parquet"):
                data = open(os.path.join(folder, name), "rb").read()
                want[os.path.relpath(os.path.join(folder, name), SF_SMALL)] = (len(data), hashlib.sha256(data).hexdigest())
    assert got == want
