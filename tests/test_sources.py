"""Readers and writers on the files that real runs meet."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ledgermatch import codes
from ledgermatch.plans.job import MatchingJob
from ledgermatch.session import checkpoint_dir
from ledgermatch.sources import paths, registry, sinks, tables
from ledgermatch.streaming.ingest import stream_new_rows

VERRA = '''Serial Number,Retirement Beneficiary,Retirement/Cancellation Date,Retirement Details
s1,"Acme
Holdings",2021-01-05,plain
s2,"The ""Acme"" Co, Ltd",2021/01/05,"a, b"
s3,Other,,"third"
'''


def test_csv_with_quotes_breaks_and_empty_dates(spark, tmp_path):
    (tmp_path / "verra.csv").write_text(VERRA)
    sources = {"verra": (str(tmp_path / "verra.csv"), "csv"), "gold": (str(tmp_path / "none.csv"), "csv")}
    for columns in (None, {"verra": VERRA.splitlines()[0].split(",")}):
        mixed, present = registry.load_registries(spark, sources, columns)
        rows = {r["Serial Number"]: r for r in mixed.collect()}
        assert set(present) == {"verra"} and set(rows) == {"s1", "s2", "s3"}  # the row without a date stays
        assert rows["s1"]["Retirement Beneficiary"] == "Acme\nHoldings"
        assert rows["s2"]["Retirement Beneficiary"] == 'The "Acme" Co, Ltd' and rows["s2"]["Retirement Details"] == "a, b"
        assert rows["s3"][codes.VERRA_RETIREMENT_DATE] is None
    with pytest.raises(ValueError):
        registry.load_registries(spark, {"nope": ("x", "csv")})
    assert registry.load_registries(spark, {})[0] is None


def test_snapshot_versions_and_bad_sheets(spark, tmp_path):
    root = str(tmp_path)
    assert registry.latest_snapshot(spark, f"{root}/none") is None
    for version, date in (("2026-01", None), ("2026-02", "2020-01-01")):
        spark.createDataFrame([("a", date), ("b", "2020-01-02")], f"`Serial Number` string, `{codes.VERRA_RETIREMENT_DATE}` string") \
            .write.parquet(f"{root}/snapshot={version}/registry=verra")
    bad = tmp_path / "snapshot=2026-02" / "registry=gold"
    bad.mkdir()
    (bad / "part.parquet").write_text("no table")
    mixed, present = registry.load_snapshot(spark, root)
    assert set(present) == {"verra"} and mixed.count() == 2
    assert registry.load_snapshot(spark, root, "2026-01")[0].count() == 1  # undated verra rows go


def test_paths_ask_the_file_system_of_the_path(spark, tmp_path):
    assert paths.exists(spark, str(tmp_path)) and paths.exists(spark, f"file://{tmp_path}")
    assert not paths.exists(spark, f"file://{tmp_path}/none") and not paths.exists(spark, f"{tmp_path}/none")


def test_blank_and_number_like_registry_survive(spark, tmp_path):
    df = spark.createDataFrame([("", 1.0), ("2021", 2.0), ("Verra", 3.0)], "registry string, quantity double")
    path = sinks.write_matched(df, str(tmp_path / "t"))
    assert sorted(map(tuple, sinks.read_matched(spark, path, df.schema).collect())) == [("", 1.0), ("2021", 2.0), ("Verra", 3.0)]


def test_published_csv_is_typed_and_blank_for_null(spark, tmp_path):
    row = {c: "x" for c in codes.OUTPUT_COLUMNS} | {"factset_entity_id": "E1", "quantity": 1.5, "retirement_year": None, "country": "",
                                                   "projectname": 'a "b", c\nd'}
    df = spark.createDataFrame([row], tables.PUBLISHED_SCHEMA)
    path = sinks.write_matched_csv(df, str(tmp_path / "csv"))
    text = "".join(p.read_text() for p in (tmp_path / "csv").glob("part-*.csv"))
    assert "\\N" not in text
    back = tables.load_published(spark, path, None)
    assert back.schema["retirement_year"].dataType.simpleString() == "int"
    assert back.first().asDict() == row
    assert tables.load_published(spark, f"{path}/none", None) is None


def test_first_run_without_base_cache_and_firms(spark, tmp_path):
    none = str(tmp_path / "none")
    columns = ["Serial Number", "Retirement Beneficiary", "Quantity Issued", codes.VERRA_RETIREMENT_DATE]
    ledger = spark.createDataFrame([("s1", "Acme", "5", "2021-01-05", "verra", 1)],
                                   ", ".join(f"`{c}` string" for c in columns) + ", registry_key string, seq long")
    job = MatchingJob(ledger, {"verra": set(columns)}, tables.load_base(spark, none), tables.load_cache(spark, none), tables.load_firms(spark, none))
    paths_ = job.publish(str(tmp_path / "out"), "2026-01-01")
    (row,) = tables.load_published(spark, None, paths_["matched_retirements"]).collect()
    assert (row["raw_beneficiary"], row["registry"], row["retirement_year"], row["quantity"], row["match_method"]) == ("Acme", "Verra", 2021, 5.0, "unmatched")
    assert set(paths_) == {"matched_retirements", "matched_retirements_csv", "summary_stats", "docs/summary_stats", "map_data"}
    assert all(paths.exists(spark, p) for p in paths_.values())


def test_scratch_folder_is_refused_off_local(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError):
        checkpoint_dir(Session())


def test_stream_restarts_and_reads_partition_folders(spark, tmp_path):
    landing, out = tmp_path / "landing", str(tmp_path / "out")
    schema = "`Serial Number` string, n int, registry_key string"
    columns = {"verra": {"Serial Number", "n"}, "gold": {"Serial Number", "n"}}
    base = spark.createDataFrame([("s0",)], "serialnumber string")

    def land(rows):
        spark.createDataFrame(rows, schema).write.mode("append").partitionBy("registry_key").parquet(str(landing))

    def run():
        typed = spark.createDataFrame([], schema).schema
        got = stream_new_rows(spark, str(landing), typed, base, columns, out, max_files_per_trigger=1)
        return sorted((r["Serial Number"] or "", r["n"], r["registry_key"]) for r in got.collect())

    land([("s0", 1, "verra"), ("s1", 2, "verra"), ("s2", 3, "gold")])
    first = run()
    assert first == [("s1", 2, "verra"), ("s2", 3, "gold")]
    assert run() == first  # nothing new has landed
    land([("s1", 9, "verra"), ("s3", 4, "gold"), (None, 5, "verra")])  # s1 lands again
    assert run() == sorted(first + [("s3", 4, "gold"), ("", 5, "verra")])
    # The last micro-batch is retried after its write: its folder is overwritten, not added to.
    import json
    import os
    state = tmp_path / "out" / "state" / "commits"
    last = max((f for f in os.listdir(state) if f.isdigit()), key=int)
    assert json.loads((state / last).read_text().splitlines()[1]) is not None
    for name in (last, f".{last}.crc"):
        os.remove(state / name)
    assert run() == sorted(first + [("s3", 4, "gold"), ("", 5, "verra")])
    assert spark.read.parquet(f"{out}/rows").select(F.count("*")).first()[0] == 4


def test_export_columns_are_taken_by_the_header(spark, tmp_path):
    from ledgermatch.sources import registry
    from ledgermatch.plans import fixtures as fx
    verra, gold = ({r: sorted(fx.REGISTRY_COLUMNS[r]) for r in ("verra", "gold")}[r] for r in ("verra", "gold"))
    lacking = verra[0]
    own = ["Unheard of", *reversed(verra[1:])]  # one column more, one less, another order
    (tmp_path / "verra").mkdir()
    (tmp_path / "verra" / "a.csv").write_text(",".join(f'"{c}"' for c in own) + "\n" + ",".join(f'"{c} 1"' for c in own) + "\n")
    (tmp_path / "gold").mkdir()
    (tmp_path / "gold" / "a.csv").write_text(",".join(f'"{c}"' for c in gold) + "\n" + ",".join(f'"{c} 2"' for c in gold) + "\n")
    mixed, present = registry.load_registries(spark, {"verra": (str(tmp_path / "verra"), "csv"), "gold": (str(tmp_path / "gold"), "csv")},
                                              {"verra": verra, "gold": gold})
    rows = {r.registry_key: r.asDict() for r in mixed.collect()}
    assert "Unheard of" not in mixed.columns and lacking in mixed.columns and lacking not in present["verra"]
    assert all(rows["verra"][c] == f"{c} 1" for c in verra[1:]) and rows["verra"][lacking] is None
    assert all(rows["gold"][c] == f"{c} 2" for c in gold)


def test_snapshot_versions_are_compared_as_numbers(spark, tmp_path):
    from ledgermatch.sources import registry
    assert registry.latest_snapshot(spark, str(tmp_path)) is None
    for group, last in ((["v9", "v10", "v2"], "v10"), (["2026-2", "2026-10", "2025-12"], "2026-10"), (["b", "a", "3"], "3")):
        root = tmp_path / group[0]
        for v in group:
            (root / f"snapshot={v}").mkdir(parents=True)
        assert registry.latest_snapshot(spark, str(root)) == last
