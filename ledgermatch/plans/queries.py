"""Registered queries: one per operator group of the survey, over the derived inputs.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame. Inputs are the
registry-shaped tables Spark derives from the driver's tables (see
``fixtures``); derived inputs, lookups and the parsed stage are shared per
session and scale through ``Context``. Sink queries write to a fresh folder
under the session's checkpoint folder and return what they read back.
"""

from __future__ import annotations

import dataclasses
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermatch import codes
from ledgermatch.functions.text import clean_name, extract_on_behalf
from ledgermatch.operators import (enrich, extract, facet_cube, harmonize, incremental, matching, name_search, names, near_miss,
                                   report, resolve, rollups)
from ledgermatch.plans import fixtures as fx
from ledgermatch.plans.job import TABLE_SCHEMA, MatchingJob, build_cache, build_firms
from ledgermatch.session import scratch_path, written
from ledgermatch.sources import registry as reg_src
from ledgermatch.sources import fingerprint, sinks, tables, versions

class Context:
    """Derived inputs, written lookups, the matching job and its published table.

    The data flow is the original one: the lookup builders write the cache and
    the firm universe, the job reads them and publishes the matched table, and
    the roll-ups and the report read the published table. Each written table is
    a Parquet folder under the session's checkpoint folder (shared storage on a
    cluster), so later plans start from files, not from a long lineage.
    """

    _cache: dict = {}

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.ledger = fx.registry_ledger(spark, sf_dir)
        self._memo: dict = {}

    def _once(self, name: str, build) -> DataFrame:
        if name not in self._memo:
            self._memo[name] = build()
        return self._memo[name]

    # A query lands the inputs that it reads: a first run has neither a base nor a firm universe.
    @property
    def base_raw(self) -> DataFrame:
        return self._once("base_raw", lambda: fx.base(self.spark, self.sf_dir))

    @property
    def coverage(self) -> DataFrame:
        return self._once("coverage", lambda: fx.coverage(self.spark, self.sf_dir))

    @property
    def identifiers(self) -> DataFrame:
        return self._once("identifiers", lambda: fx.identifiers(self.spark, self.sf_dir))

    @property
    def cache(self) -> DataFrame:
        return self._once("cache", lambda: written(build_cache(self.base_raw), "known_matches"))

    @property
    def firms(self) -> DataFrame:
        return self._once("firms", lambda: written(build_firms(self.coverage, self.identifiers), "public_firms"))

    @property
    def job(self) -> MatchingJob:
        return self._once("job", self.new_job)

    def new_job(self, **kw) -> MatchingJob:
        return MatchingJob(self.ledger, fx.REGISTRY_COLUMNS, self.base_raw, self.cache, self.firms, **kw)

    @classmethod
    def get(cls, spark: SparkSession, sf_dir: str) -> "Context":
        key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
        if key not in cls._cache:
            cls._cache[key] = Context(spark, sf_dir)
        return cls._cache[key]

    def bucketed_base(self) -> DataFrame:
        """The base as a table bucketed by its serial (what a deployment keeps between runs)."""
        def build():
            buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            name = f"base_by_serial_{uuid.uuid4().hex}"
            return incremental.write_bucketed(self.base_raw, name, buckets, self.scratch("base_by_serial"))
        return self._once("bucketed_base", build)

    def output(self) -> DataFrame:
        """The published matched table (written once by the job, then read)."""
        def build():
            df = self.job.output()
            path = sinks.write_matched(df, self.scratch("matched_retirements"))
            return sinks.read_matched(self.spark, path, df.schema)
        return self._once("output", build)

    def report(self) -> DataFrame:
        """Report view over the published table, cached like the dashboard's load."""
        return self._once("report", lambda: report.report_view(self.output()).cache())

    def scratch(self, name: str) -> str:
        return scratch_path(self.spark, name)


def _ctx(spark, sf_dir) -> Context:
    return Context.get(spark, sf_dir)


def _order_cols() -> list:
    return ["src", "seq"]


# ------------------------------------------------------------------ sources, sinks

def _messy_exports(c: "Context") -> dict[str, DataFrame]:
    """The exports with what real files hold: quotes, commas and line breaks in texts, verra rows without a date."""
    name = {r: "Name" if r == "verra" else "Project Name" for r in fx.REGISTRY_COLUMNS}
    out = {}
    for r, cols in fx.REGISTRY_COLUMNS.items():
        df = c.ledger.filter(F.col("registry_key") == r)
        text = F.concat(F.lit('The "'), F.col(name[r]), F.lit('", first line,\n"second" line'))
        df = df.withColumn(name[r], text)
        if r == "verra":
            date = codes.VERRA_RETIREMENT_DATE
            df = df.withColumn(date, F.when(F.col("seq") % 7 != 0, F.col(f"`{date}`")))
        out[r] = df.select(*[F.col(f"`{x}`") for x in sorted(cols)])
    return out


def _load_counts(mixed: DataFrame, present: dict) -> DataFrame:
    mixed = mixed.withColumn("_serial", harmonize.registry_serial(mixed, present))
    h = harmonize.harmonize(mixed, present, keep=["registry_key", "_serial"])
    return (h.groupBy("registry_key")
            .agg(F.count("*").alias("rows"), F.count("_serial").alias("serials"), F.sum("quantity").alias("quantity"),
                 F.count("retirement_date").alias("dated"), F.sum(F.length("projectname")).alias("name_chars")))


def q_load_registry(spark, sf_dir):
    """CSV exports with quoted text and undated rows written, then loaded as one mixed ledger; one export is absent."""
    c = _ctx(spark, sf_dir)
    root = c.scratch("exports")
    sources, columns = {}, {}
    for r, df in _messy_exports(c).items():
        sources[r], columns[r] = (f"{root}/{r}", "csv"), df.columns
        if r != "car":
            sinks.csv_writer(df).csv(f"{root}/{r}")
    return _load_counts(*reg_src.load_registries(spark, sources, columns))


def q_load_snapshot(spark, sf_dir):
    """The latest of two snapshots (Parquet), one sheet missing and one unreadable; undated verra rows dropped."""
    c = _ctx(spark, sf_dir)
    root = c.scratch("snapshots")
    exports = _messy_exports(c)
    for r, df in exports.items():
        if r in ("verra", "gold"):
            df.write.parquet(f"{root}/snapshot=2026-02/registry={r}")
    exports["acr"].select(F.lit("not a table").alias("value")).distinct().write.text(f"{root}/snapshot=2026-02/registry=acr")
    exports["car"].select(F.lit("x").alias("Name")).write.parquet(f"{root}/snapshot=2026-01/registry=car")
    return _load_counts(*reg_src.load_snapshot(spark, root))


def q_load_base(spark, sf_dir):
    """Base rows renamed, year parsed, registry normalised, defaults."""
    b = harmonize.prepare_base(_ctx(spark, sf_dir).base_raw)
    return b.select("seq", "raw_beneficiary", "matched_name", "factset_entity_id", "registry",
                    "retirement_year", "match_confidence", "match_method", "serialnumber", "quantity")


def q_cache_match(spark, sf_dir):
    """Cache written as CSV, read back, distinct names matched."""
    c = _ctx(spark, sf_dir)
    path = sinks.write_cache(c.cache, c.scratch("known_matches_csv"), fmt="csv")
    cache = tables.load_cache(spark, path, fmt="csv")
    return matching.match_cache(c.job.names(), cache, "raw_name")


def q_report_load(spark, sf_dir):
    """Published Parquet read back (no CSV present) into the report view."""
    c = _ctx(spark, sf_dir)
    path = sinks.write_matched(c.output(), c.scratch("matched_parquet"))
    pub = tables.load_published(spark, f"{path}/_no_csv_", path)
    view = report.report_view(pub)
    return view.select(*_order_cols(), "matched_name", "factset_entity_id", "registry", "retirement_year",
                       "country", "quantity", "project_category", "hq_country", "hq_country_name")


def q_report_load_csv(spark, sf_dir):
    """The preferred CSV source, written by the run, into the report view and its year filter."""
    c = _ctx(spark, sf_dir)
    csv = sinks.write_matched_csv(c.output(), c.scratch("matched_csv_source"))
    view = report.report_view(tables.load_published(spark, csv, f"{csv}/_no_parquet_"))
    view = report.faceted_filter(view, year_range=(1995, 1999))
    return view.select("matched_name", "factset_entity_id", "registry", "retirement_year", "country", "quantity",
                       "project_category", "hq_country", "hq_country_name")


def q_report_dates(spark, sf_dir):
    """Each date column the report accepts gives the year, the first present one wins."""
    c = _ctx(spark, sf_dir)
    rows = c.output().select("factset_entity_id", "quantity", F.make_date(F.col("retirement_year"), F.lit(3), F.lit(5)).alias("day"))
    out = None
    for column, shape in zip(codes.REPORT_DATE_COLUMNS, ("yyyy-MM-dd", "yyyy/MM/dd", "yyyy-MM-dd'T'HH:mm:ss'Z'", "MMM d, yyyy")):
        view = report.report_view(rows.withColumn(column, F.date_format("day", shape)).drop("day"))
        part = view.groupBy("retirement_year").agg(F.count("*").alias("rows"), F.sum("quantity").alias("quantity")) \
            .select(F.lit(column).alias("column"), "retirement_year", "rows", "quantity")
        out = part if out is None else out.unionByName(part)
    return out


def q_public_firms(spark, sf_dir):
    """Listed-firm universe with ISIN and LEI."""
    f = _ctx(spark, sf_dir).firms
    return f.select("factset_entity_id", "entity_name", "entity_proper_name", "iso_country", "sector_code",
                    "industry_code", "primary_sic_code", "entity_name_normalized", "isin", "lei")


def _published_rows(spark, paths: dict[str, str], schema) -> DataFrame:
    """Every published output of a run read back: (output, key, value) rows."""
    table = sinks.read_matched(spark, paths["matched_retirements"], schema)
    csv = tables.read_published_csv(spark, paths["matched_retirements_csv"])

    def group(name, df):
        return df.groupBy(F.concat_ws("|", "registry", "match_method").alias("key")).agg(F.count("*").alias("value")) \
            .select(F.lit(name).alias("output"), "key", F.col("value").cast("double"))

    out = group("table", table).unionByName(group("csv", csv))
    for name in ("summary_stats", "docs/summary_stats"):
        long = _stats_long(tables.load_stats(spark, paths[name]))
        out = out.unionByName(long.select(F.lit(name).alias("output"), F.concat_ws("|", "dim", "key").alias("key"),
                                          F.col("total").cast("double").alias("value")))
    maps = _map_rows(spark, paths["map_data"])
    out = out.unionByName(maps.select(F.lit("map_data").alias("output"), F.concat_ws("|", "kind", "iso3").alias("key"),
                                      F.col("tonnes").cast("double").alias("value")))
    if "known_matches" in paths:
        cache = tables.load_cache(spark, paths["known_matches"])
        out = out.unionByName(cache.groupBy(F.col("batch").cast("string").alias("key")).agg(F.count("*").cast("double").alias("value"))
                              .select(F.lit("known_matches").alias("output"), "key", "value"))
    return out


def q_pipeline_e2e(spark, sf_dir):
    """A complete run with resolver and cache update, all of its outputs published and read back."""
    c = _ctx(spark, sf_dir)
    job = c.new_job(resolver=resolve.local_resolver())
    paths = job.publish(c.scratch("run"), last_updated="2026-01-01")
    return _published_rows(spark, paths, TABLE_SCHEMA)


def q_pipeline_first_run(spark, sf_dir):
    """M8/S3: the first run: no base, no cache and no firm universe; the published table read back."""
    c = _ctx(spark, sf_dir)
    none = c.scratch("absent")
    job = MatchingJob(c.ledger, fx.REGISTRY_COLUMNS, tables.load_base(spark, f"{none}/base"),
                      tables.load_cache(spark, f"{none}/cache"), tables.load_firms(spark, f"{none}/firms"))
    paths = job.publish(c.scratch("first_run"), last_updated="2026-01-01")
    back = sinks.read_matched(spark, paths["matched_retirements"], TABLE_SCHEMA)
    return back.select(*_order_cols(), *codes.OUTPUT_COLUMNS)


def q_matched_table(spark, sf_dir):
    """The published table as written and read, all rows."""
    return _ctx(spark, sf_dir).output().select(*_order_cols(), *codes.OUTPUT_COLUMNS)


def q_matched_table_types(spark, sf_dir):
    """Blank and number-like registries survive the folders by registry."""
    c = _ctx(spark, sf_dir)
    odd = c.output().withColumn("registry", F.when(F.col("seq") % 3 == 0, "").when(F.col("seq") % 3 == 1, "2021")
                                .otherwise(F.col("registry")))
    path = sinks.write_matched(odd, c.scratch("odd_registry"))
    back = sinks.read_matched(spark, path, odd.schema)
    return back.groupBy("registry").agg(F.count("*").alias("rows"), F.sum("quantity").alias("quantity"))


def q_matched_only_export(spark, sf_dir):
    """Matched rows, key columns, CSV read back with the typed schema."""
    c = _ctx(spark, sf_dir)
    path = sinks.write_matched_csv(c.output(), c.scratch("matched_csv"))
    return tables.read_published_csv(spark, path)


def q_known_matches(spark, sf_dir):
    """The known-match cache built from the base."""
    k = _ctx(spark, sf_dir).cache
    return k.select("company_raw", "company_normalized", "official_name", "factset_entity_id", "batch",
                    "ord_firm", "ord_seq")


def _stats_long(stats: DataFrame) -> DataFrame:
    grp = ["total", "matched", "total_mtco2", "matched_mtco2"]

    def exploded(col: str, dim: str) -> DataFrame:
        e = stats.select(F.explode(col).alias("key", "v"))
        return e.select(F.lit(dim).alias("dim"), "key", *[F.col(f"v.{g}").alias(g) for g in grp],
                        F.lit(None).cast("long").alias("unique_firms"))

    kpi = stats.select(F.lit("all").alias("dim"), F.lit("").alias("key"),
                       F.col("total_retirements").alias("total"), F.col("matched_retirements").alias("matched"),
                       "total_mtco2", "matched_mtco2", "unique_firms")
    methods = stats.select(F.explode("match_methods").alias("key", "total")).select(
        F.lit("method").alias("dim"), "key", "total", *[F.lit(None).cast(t).alias(n) for n, t in
                                                         [("matched", "long"), ("total_mtco2", "double"),
                                                          ("matched_mtco2", "double"), ("unique_firms", "long")]])
    return (kpi.unionByName(exploded("registries", "registry")).unionByName(exploded("years", "year"))
            .unionByName(methods))


def q_summary_json(spark, sf_dir):
    """Stats JSON written to two places, one read back and flattened."""
    c = _ctx(spark, sf_dir)
    doc = sinks.stats_document(c.output(), last_updated="2026-01-01")
    p1, _ = sinks.write_json_text(doc, [c.scratch("summary_stats"), c.scratch("docs_summary_stats")])
    return _stats_long(tables.load_stats(spark, p1))


def q_map_json(spark, sf_dir):
    """Map JSON written and read back as (kind, iso3, tonnes)."""
    c = _ctx(spark, sf_dir)
    doc = sinks.map_document(c.output(), c.firms, mode="row")
    (path,) = sinks.write_json_text(doc, [c.scratch("map_data")])
    return _map_rows(spark, path)


def _map_rows(spark, path: str) -> DataFrame:
    schema = "project_countries struct<iso3:array<string>,tonnes:array<bigint>>, " \
             "hq_countries struct<iso3:array<string>,tonnes:array<bigint>>"
    back = spark.read.schema(schema).json(path)
    out = None
    for kind in ("project_countries", "hq_countries"):
        part = back.select(F.lit(kind).alias("kind"),
                           F.explode(F.arrays_zip(f"{kind}.iso3", f"{kind}.tonnes")).alias("z"))
        part = part.select("kind", F.col("z.iso3").alias("iso3"), F.col("z.tonnes").alias("tonnes"))
        out = part if out is None else out.unionByName(part)
    return out


def q_ingest_log(spark, sf_dir):
    """The ingest record (version, date, rows per registry and in all) written as JSON and read back."""
    c = _ctx(spark, sf_dir)
    (path,) = sinks.write_json_text(sinks.ingest_document(c.ledger, "2026-02", "2026-02-03"), [c.scratch("ingest_log")])
    back = spark.read.schema("version string, date string, total_rows long, rows map<string,long>").json(path)
    per = back.select("version", "date", F.explode("rows").alias("registry_key", "rows"))
    return per.unionByName(back.select("version", "date", F.lit("total").alias("registry_key"), F.col("total_rows").alias("rows")))


def q_fingerprint(spark, sf_dir):
    """SHA-256 of every document text (content hash of a text column)."""
    docs = fx.table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.sha2(F.col("text"), 256).alias("sha256"))


def q_file_hashes(spark, sf_dir):
    """SHA-256 and length of every Parquet file of the input folder."""
    files = fingerprint.file_hashes(spark, sf_dir, "*.parquet")
    return files.select(F.regexp_extract("path", r"([^/]+\.parquet(?:/[^/]+)*)$", 1).alias("file"), "length", "sha256")


def q_rollup_maintained(spark, sf_dir):
    """A1-A5 kept up to date: two runs (the base, then the new rows) merged into the state, the second one sent twice."""
    c = _ctx(spark, sf_dir)
    root = c.scratch("rollup")
    rollups.update_rollup(spark, root, "2026-01", c.output().filter("src = 0"))
    rollups.update_rollup(spark, root, "2026-02", c.output().filter("src = 1"))
    return rollups.update_rollup(spark, root, "2026-02", c.output().filter("src = 1"))


def q_registry_share(spark, sf_dir):
    """Stats JSON read back, registry case variants merged."""
    c = _ctx(spark, sf_dir)
    doc = sinks.stats_document(c.output(), last_updated="2026-01-01")
    (path,) = sinks.write_json_text(doc, [c.scratch("summary_stats_share")])
    stats = tables.load_stats(spark, path)
    per = stats.select(F.explode("registries").alias("registry", "v")).select(
        "registry", F.col("v.total_mtco2").alias("total_mtco2"), F.col("v.matched_mtco2").alias("matched_mtco2"))
    return report.registry_share(per)


def q_report_table(spark, sf_dir):
    """The on-screen table, the first 500 rows of the view in source order."""
    return report.report_table(_ctx(spark, sf_dir).report())


def _exported(spark, view: DataFrame, path: str) -> DataFrame:
    return tables.read_published_csv(spark, sinks.write_report_csv(view, path), view.select(*sinks.export_columns(view)).schema)


def q_report_export_full(spark, sf_dir):
    """The whole report view as CSV, read back."""
    c = _ctx(spark, sf_dir)
    return _exported(spark, c.report(), c.scratch("report_csv"))


def q_report_export_filtered(spark, sf_dir):
    """The report view under a facet choice as CSV, read back."""
    c = _ctx(spark, sf_dir)
    return _exported(spark, report.faceted_filter(c.report(), **FACET_CHOICE), c.scratch("report_csv_filtered"))


# ------------------------------------------------------------------ projections

def q_harmonize(spark, sf_dir):
    """Every ledger row in unified columns."""
    led = _ctx(spark, sf_dir).ledger
    h = harmonize.harmonize(led, fx.REGISTRY_COLUMNS, keep=["seq", "registry_key"])
    return h.select("seq", "registry_key", "quantity", "country", "retirement_year", "projectname",
                    "projecttype", "project_id", "vintage")


def q_combine(spark, sf_dir):
    """Base and new rows in the 14 columns, before enrichment."""
    comb = _ctx(spark, sf_dir).job.combined()
    return comb.select(*_order_cols(), *codes.OUTPUT_COLUMNS)


def q_sanitize(spark, sf_dir):
    """Every string column of the combined rows, null/nan/None -> ""."""
    comb = _ctx(spark, sf_dir).job.combined()
    return harmonize.sanitize(comb.select(*_order_cols(), *codes.OUTPUT_COLUMNS))


def q_project_category(spark, sf_dir):
    """Category of every project type, with row counts."""
    led = _ctx(spark, sf_dir).ledger
    h = harmonize.harmonize(led, fx.REGISTRY_COLUMNS, keep=[])
    return (h.groupBy("projecttype").agg(F.count(F.lit(1)).alias("rows"))
            .withColumn("project_category", enrich.project_category("projecttype")))


# ------------------------------------------------------------------ summaries

def q_summary_by_registry(spark, sf_dir):
    """Rows, matched rows and Mt per registry."""
    return report.summary_by_registry(_ctx(spark, sf_dir).output())


def q_summary_kpis(spark, sf_dir):
    """A1/F2: one KPI row."""
    return report.summary_kpis(_ctx(spark, sf_dir).output())


def q_summary_by_year(spark, sf_dir):
    """A3/O1: per year, null year dropped, ascending."""
    return report.summary_by_year(_ctx(spark, sf_dir).output())


def q_summary_by_method(spark, sf_dir):
    """A4: rows per match method."""
    return report.summary_by_method(_ctx(spark, sf_dir).output())


def q_summary_rollup(spark, sf_dir):
    """A5: all of the above in one GROUPING SETS pass."""
    return report.summary_rollup(_ctx(spark, sf_dir).output())


def _round_log(df: DataFrame) -> DataFrame:
    return df.withColumn("log_tonnes", F.round("log_tonnes", 6))


def q_map_project(spark, sf_dir):
    """A6/J11/F7/P20 (row mode): tonnes by project ISO3."""
    return _round_log(report.map_project(_ctx(spark, sf_dir).output(), mode="row"))


def q_map_project_column(spark, sf_dir):
    """A6 (column mode, parity): grouped by the isocode column, blank a group."""
    return _round_log(report.map_project(_ctx(spark, sf_dir).output(), mode="column"))


def q_map_hq(spark, sf_dir):
    """Tonnes by HQ ISO3; a repeated firm id multiplies rows (parity)."""
    c = _ctx(spark, sf_dir)
    return _round_log(report.map_hq(c.output(), c.firms, mode="column"))


# ------------------------------------------------------------------ extraction, matching

def q_extract_beneficiary(spark, sf_dir):
    """Name and its source field for every ledger row that has one."""
    led = _ctx(spark, sf_dir).ledger
    e = extract.extract_beneficiary(led, fx.REGISTRY_COLUMNS)
    return e.select("seq", "registry_key", "registry", "raw_beneficiary", "source_field")


def q_parse_rate(spark, sf_dir):
    """Parsed / total rows per registry."""
    return extract.parse_rate(_ctx(spark, sf_dir).ledger, fx.REGISTRY_COLUMNS)


def q_new_rows_anti(spark, sf_dir):
    """Ledger rows whose serial is not in the base (null serial always new)."""
    c = _ctx(spark, sf_dir)
    new = c.job.new_raw()
    return new.select("seq", "registry_key",
                      harmonize.registry_serial(new, fx.REGISTRY_COLUMNS).alias("serial"))


def q_new_rows_bucketed(spark, sf_dir):
    """The same against a base bucketed by its serial, which no run shuffles."""
    c = _ctx(spark, sf_dir)
    new = incremental.find_new_rows(c.ledger, c.bucketed_base(), fx.REGISTRY_COLUMNS)
    return new.select("seq", "registry_key", harmonize.registry_serial(new, fx.REGISTRY_COLUMNS).alias("serial"))


def q_snapshot_diff(spark, sf_dir):
    """Per registry, rows of the new snapshot absent from the previous one
    (previous snapshot = rows retired up to 2000), by that registry's serial column."""
    led = _ctx(spark, sf_dir).ledger
    led = led.withColumn("serial", harmonize.registry_serial(led, fx.REGISTRY_COLUMNS))
    h = harmonize.harmonize(led, fx.REGISTRY_COLUMNS, keep=["seq", "registry_key", "serial"])
    diff = incremental.snapshot_diff(h, h.filter(F.col("retirement_year") <= 2000))
    return diff.select("seq", "registry_key", "serial")


def q_unmatched_names(spark, sf_dir):
    """Distinct names the cache could not match, with first sight and context."""
    u = _ctx(spark, sf_dir).job.unmatched()
    return u.select("raw_name", "first_seq", "registry", "country")


def q_cache_lookups(spark, sf_dir):
    """M1: the two keyed views of the cache, last row wins per key."""
    cache = _ctx(spark, sf_dir).cache
    e = matching.exact_lookup(cache).select(F.lit("exact").alias("kind"), F.col("_ekey").alias("key"),
                                            F.col("e_name").alias("official_name"),
                                            F.col("e_id").alias("factset_entity_id"))
    n = matching.normalized_lookup(cache).select(F.lit("normalized").alias("kind"), F.col("_nkey").alias("key"),
                                                 F.col("n_name").alias("official_name"),
                                                 F.col("n_id").alias("factset_entity_id"))
    return e.unionByName(n)


def q_fuzzy_match(spark, sf_dir):
    """M7: names without any cache hit that are one edit from a key; the first such key in cache order. (Two edits: tests.)"""
    c = _ctx(spark, sf_dir)
    missed = c.job.cache_results().filter(F.col("match_method") == "unmatched")
    return near_miss.near_misses(missed, c.cache, 1).select(
        "raw_name", "matched_name", "factset_entity_id", "confidence", "match_method", "distance")


def q_apply_matches(spark, sf_dir):
    """Match columns joined back onto the new rows by raw name."""
    m = _ctx(spark, sf_dir).job.new_matched()
    return m.select("seq", "registry", "raw_beneficiary", "factset_entity_id", "matched_name",
                    "match_confidence", "match_method")


def q_enrich_hq(spark, sf_dir):
    """HQ country per published row (repeated firm id: last row wins)."""
    out = _ctx(spark, sf_dir).output()
    return out.select(*_order_cols(), "factset_entity_id", "hq_country")


def q_review_queue(spark, sf_dir):
    """M6: documented confidence bands as a review flag, counted."""
    out = matching.review_flag(_ctx(spark, sf_dir).output())
    return out.groupBy("match_confidence", "review_flag").agg(F.count(F.lit(1)).alias("rows"))


def q_id_pivot(spark, sf_dir):
    """A10: first ISIN / LEI per listed firm."""
    return _ctx(spark, sf_dir).firms.select("factset_entity_id", "isin", "lei")


def q_universe_coverage(spark, sf_dir):
    """Builder counts."""
    from ledgermatch.operators.lookups import universe_coverage
    c = _ctx(spark, sf_dir)
    return universe_coverage(c.coverage, c.firms, c.cache, c.base_raw)


def q_stage_metrics(spark, sf_dir):
    """Stage counts of a run with a resolver as (stage, value)."""
    c = _ctx(spark, sf_dir)
    job = c.new_job(resolver=resolve.local_resolver()).after_new_rows_of(c.job)
    job.write_output(c.scratch("counted_run"))
    return job.stage_counts()


# ------------------------------------------------------------------ report

def q_report_metrics(spark, sf_dir):
    """Tonnes, rows, firms, countries of the report view."""
    return report.report_metrics(_ctx(spark, sf_dir).report())


CUBE_CHOICES = {"all": {}, "years": dict(year_range=(1996, 1999)),
                "places": dict(hq=["United States", "Brazil", "Germany", "Cyprus", "DR Congo"], countries=["Brazil", "India", "Kenya", "Peru", "Laos"]),
                "kinds": dict(year_range=(1993, 1998), categories=["Renewable Energy", "Other", "Transport"])}


def q_report_metrics_cube(spark, sf_dir):
    """A14/A15/F11 by bitmaps: the report's figures under four facet choices from one small cube."""
    c = _ctx(spark, sf_dir)
    view = c.report()
    firms = written(facet_cube.firm_numbers(view), "firm_numbers")
    cube = written(facet_cube.build_cube(view, firms), "facet_cube")
    out = None
    for name, choice in CUBE_CHOICES.items():
        one = facet_cube.metrics(cube, **choice).select(F.lit(name).alias("choice"), "total_quantity", "transactions", "unique_firms", "countries")
        out = one if out is None else out.unionByName(one)
    return out


FIRM_SEARCHES = ["firm (1|2)[0-9]$", "firm 3", "FIRM", "irm 1[05]", "^firm 4", "7$", "firm 1.?$", "(firm|company) 2", "m 4+$", "none of them"]


def q_firm_search(spark, sf_dir):
    """F12 by an inverted index of trigrams: rows and tonnes that each of ten searches finds."""
    c = _ctx(spark, sf_dir)
    view = c.report()
    names_ = written(view.select(F.col("matched_name").alias("name")).filter("name IS NOT NULL").distinct(), "names")
    index = written(name_search.build_index(view), "name_index")
    out = None
    for pattern in FIRM_SEARCHES:
        rows = name_search.search_rows(view, index, names_, pattern)
        one = rows.agg(F.count("*").alias("rows"), F.coalesce(F.sum("quantity"), F.lit(0.0)).alias("quantity")).select(
            F.lit(pattern).alias("pattern"), "rows", "quantity")
        out = one if out is None else out.unionByName(one)
    return out


def q_firm_layout(spark, sf_dir):
    """The firm universe written in ranges of ids with Bloom filters and read back whole."""
    c = _ctx(spark, sf_dir)
    path = sinks.write_firms(c.firms, c.scratch("firms_by_id"))
    return spark.read.parquet(path).select("factset_entity_id", "entity_proper_name", "iso_country", "isin", "lei")


def q_category_share(spark, sf_dir):
    """Tonnes per category with share."""
    return report.category_share(_ctx(spark, sf_dir).report())


def q_yearly_quantity(spark, sf_dir):
    """Mt per year."""
    return report.yearly_quantity(_ctx(spark, sf_dir).report())


FACET_CHOICE = dict(year_range=(1996, 1999), hq=["United States", "Brazil", "Germany", "Cyprus", "DR Congo"],
                    countries=["Brazil", "India", "Kenya", "South Korea", "Peru", "Laos", "Ghana", "Mexico", "Vietnam"], categories=["Renewable Energy", "Carbon Capture", "Other", "Transport"],
                    firm_search="firm (1|2)[0-9]$")


def q_faceted_filter(spark, sf_dir):
    """report view under one facet choice."""
    v = report.faceted_filter(_ctx(spark, sf_dir).report(), **FACET_CHOICE)
    return v.select(*_order_cols(), "matched_name", "retirement_year", "project_category", "hq_country_name",
                    "quantity")


def q_facets(spark, sf_dir):
    """Facet values as (facet, value) rows."""
    return report.facets(_ctx(spark, sf_dir).report())


def q_tonnes_label(spark, sf_dir):
    """The tonnes label of each order's price at seven scales, so that every branch is met."""
    o = fx.table(spark, sf_dir, "orders").select("o_orderkey", F.explode(F.array(*[F.lit(10.0 ** k) for k in range(-4, 6)])).alias("scale"),
                                                 F.col("o_totalprice"))
    tonnes = F.floor(F.col("o_totalprice") * F.col("scale"))
    return o.select("o_orderkey", "scale", report.fmt_tonnes(tonnes.cast("double")).alias("label"))


def q_top_countries(spark, sf_dir):
    """O3: top 20 project countries by tonnes, ties to the lower name."""
    return report.top_countries(_ctx(spark, sf_dir).report())


def q_top_firms(spark, sf_dir):
    """Top 20 firms by tonnes, ties to the lower name."""
    return report.top_firms(_ctx(spark, sf_dir).report())


# ------------------------------------------------------------------ text functions

NAME_TEXT_COLUMNS = ["Retirement Beneficiary", "* Using Entity", "Using Entity", "Retired on Behalf of",
                     "Account Holder"]
FREE_TEXT_COLUMNS = ["Retirement Details", "Note", "Retirement Reason Details"]


def _distinct_texts(led: DataFrame, cols: list[str]) -> DataFrame:
    arr = F.array(*[F.col(f"`{c}`") for c in cols])
    return led.select(F.explode(arr).alias("text")).filter(F.col("text").isNotNull()).distinct()


def q_clean_name(spark, sf_dir):
    """Every distinct name field text, cleaned."""
    t = _distinct_texts(_ctx(spark, sf_dir).ledger, NAME_TEXT_COLUMNS)
    return t.withColumn("cleaned", clean_name("text"))


def q_extract_on_behalf(spark, sf_dir):
    """Every distinct free-text field, entity extracted (or null)."""
    t = _distinct_texts(_ctx(spark, sf_dir).ledger, FREE_TEXT_COLUMNS)
    return t.withColumn("extracted", extract_on_behalf("text"))


def q_normalize_name(spark, sf_dir):
    """Every distinct extracted name in normal form (configured suffixes)."""
    n = _ctx(spark, sf_dir).job.names().select("raw_name")
    return names.normalize_names(n, "raw_name", "normalized")


def q_fold_accents(spark, sf_dir):
    """Every document text, accent-folded (NFKD, marks dropped)."""
    docs = fx.table(spark, sf_dir, "documents").select("doc_id", "text")
    return names.fold_accents(docs, "text", "folded").select("doc_id", "folded")


def _replies(spark, sf_dir) -> DataFrame:
    """Resolver-style reply texts, one per order, derived from its line items."""
    li = fx.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    ln = F.col("l_linenumber")
    fid = F.when(ln % 3 == 0, F.lit("null")).otherwise(
        F.concat(F.lit('"E'), (F.col("l_partkey") % 50).cast("string"), F.lit('"')))
    conf = F.when(ln == 1, "high").when(ln == 2, "medium").when(ln == 3, "none").otherwise("low")
    reason = F.when(ln == 4, F.lit("see [note]")).when(ln == 6, F.lit("stray ] bracket")).otherwise(F.lit("ok"))
    item = F.concat(F.lit('{"index": '), ln.cast("string"), F.lit(', "parent_name": "Firm '),
                    (F.col("l_partkey") % 50).cast("string"), F.lit('", "factset_entity_id": '), fid,
                    F.lit(', "confidence": "'), conf, F.lit('", "reasoning": "'), reason, F.lit('"}'))
    per = (li.groupBy("l_orderkey")
           .agg(F.array_sort(F.collect_list(F.struct(ln.alias("a"), F.col("l_partkey").alias("b"),
                                                     F.col("l_suppkey").alias("c"), item.alias("item"))))
                .alias("items")))
    body = F.array_join(F.transform("items", lambda x: x["item"]), ", ")
    return per.select("l_orderkey", F.concat(F.lit("Matches for order "), F.col("l_orderkey").cast("string"),
                                             F.lit(": ["), body, F.lit("] [end]")).alias("reply"))


def q_json_array_extract(spark, sf_dir):
    """X11: first balanced [...] of every reply text."""
    from ledgermatch.functions.text import first_json_array
    return _replies(spark, sf_dir).select("l_orderkey", first_json_array("reply").alias("extracted"))


def q_json_results_decode(spark, sf_dir):
    """Reply items decoded, index defaulting to the position; unreadable -> one null row."""
    items = resolve.reply_items(_replies(spark, sf_dir), "reply")
    return items.select("l_orderkey", "parsed", "item_index", "parent_name", "factset_entity_id",
                        "confidence", "reasoning")


def q_resolver_request(spark, sf_dir):
    """Request lines of the unmatched names, batched in name order."""
    u = _ctx(spark, sf_dir).job.unmatched()
    b = resolve.request_lines(resolve.batched(u, "raw_name"), "raw_name", "registry", "country")
    return b.select("raw_name", "batch", "line", "request_line")


def q_resolve_batch(spark, sf_dir):
    """M3: unmatched names resolved in batches of 20 by the local resolver, with the firm context at hand."""
    c = _ctx(spark, sf_dir)
    context = resolve.context_text(resolve.firm_context(c.firms), max_firms=2000)
    r = resolve.resolve_batches(c.job.unmatched(), resolve.local_resolver(), "raw_name",
                                registry_col="registry", country_col="country", context=context)
    return r.select("raw_name", "matched_name", "factset_entity_id", "confidence", "match_method")


def _cache_columns(cache: DataFrame) -> DataFrame:
    return cache.select("company_raw", "company_normalized", "official_name", "factset_entity_id", "batch",
                        "ord_firm", "ord_seq")


def q_cache_update(spark, sf_dir):
    """Accepted resolver results appended, deduplicated, new cache version read back."""
    c = _ctx(spark, sf_dir)
    job = c.new_job(resolver=resolve.local_resolver()).after_new_rows_of(c.job)
    path = sinks.write_cache(job.updated_cache(), c.scratch("known_matches_v2"))
    return _cache_columns(tables.load_cache(spark, path))


def q_cache_versions(spark, sf_dir):
    """M4: the cache as a versioned table; a write that dies changes nothing, the next run starts from the version in use."""
    c = _ctx(spark, sf_dir)
    root = c.scratch("cache_store")
    versions.write_version(spark, root, lambda path: sinks.write_cache(c.cache, path))

    def dies(path: str) -> None:
        sinks.write_cache(c.cache.filter(F.length("company_raw") % 2 == 0), path)
        raise RuntimeError("the run is lost while it writes")

    try:
        versions.write_version(spark, root, dies)
    except RuntimeError:
        pass
    job = dataclasses.replace(c.new_job(resolver=resolve.local_resolver()), cache=tables.load_current_cache(spark, root))
    cache = job.after_new_rows_of(c.job).updated_cache()
    versions.write_version(spark, root, lambda path: sinks.write_cache(cache, path))
    return _cache_columns(tables.load_current_cache(spark, root)).withColumn("version", F.lit(versions.current_version(spark, root)))


def q_cache_update_twice(spark, sf_dir):
    """M4: two updates that give every name another firm; the exact lookup takes the later one."""
    c = _ctx(spark, sf_dir)
    names = c.job.names().select("raw_name", "first_seq")
    cache = c.cache
    for firm in ("E1", "E2"):
        results = names.select("raw_name", "first_seq", F.lit(f"Firm {firm}").alias("matched_name"), F.lit(firm).alias("factset_entity_id"),
                               F.lit("high").alias("confidence"), F.lit("llm").alias("match_method"))
        cache = written(resolve.update_cache(cache, results), "known_matches_next")
    found = matching.match_cache(names, cache, "raw_name")
    return found.select("raw_name", "matched_name", "factset_entity_id", "match_method")


def q_firm_context(spark, sf_dir):
    """The firms for the resolver as rows, all of them."""
    rows = resolve.firm_context(_ctx(spark, sf_dir).firms)
    return rows.select("factset_entity_id", "entity_proper_name", "iso_country", "line")


def q_firm_context_bounded(spark, sf_dir):
    """The same under a caller's bounds: firms of two countries, 500 others, 2,000 in all."""
    rows = resolve.firm_context(_ctx(spark, sf_dir).firms, countries=["US", "BR"], others=500, cap=2000)
    return rows.select("factset_entity_id", "entity_proper_name", "iso_country", "line")


def q_stream_new_rows(spark, sf_dir):
    """J1 as a file stream: availableNow trigger, anti-join per micro-batch."""
    from ledgermatch.streaming.ingest import stream_new_rows
    c = _ctx(spark, sf_dir)
    out = stream_new_rows(spark, fx.landed_path(spark, sf_dir, "ledger_raw"), c.ledger.schema, c.base_raw,
                          fx.REGISTRY_COLUMNS, c.scratch("stream"))
    return out.select("seq", "registry_key",
                      harmonize.registry_serial(out, fx.REGISTRY_COLUMNS).alias("serial"))


QUERIES = {
    "summary_by_registry": q_summary_by_registry,
    "load_registry": q_load_registry,
    "load_snapshot": q_load_snapshot,
    "load_base": q_load_base,
    "cache_match": q_cache_match,
    "report_load": q_report_load,
    "public_firms": q_public_firms,
    "pipeline_e2e": q_pipeline_e2e,
    "matched_only_export": q_matched_only_export,
    "known_matches": q_known_matches,
    "summary_json": q_summary_json,
    "map_json": q_map_json,
    "ingest_log": q_ingest_log,
    "fingerprint": q_fingerprint,
    "file_hashes": q_file_hashes,
    "rollup_maintained": q_rollup_maintained,
    "registry_share": q_registry_share,
    "report_table": q_report_table,
    "report_export_full": q_report_export_full,
    "report_export_filtered": q_report_export_filtered,
    "report_load_csv": q_report_load_csv,
    "report_dates": q_report_dates,
    "tonnes_label": q_tonnes_label,
    "matched_table": q_matched_table,
    "matched_table_types": q_matched_table_types,
    "pipeline_first_run": q_pipeline_first_run,
    "harmonize": q_harmonize,
    "combine": q_combine,
    "sanitize": q_sanitize,
    "project_category": q_project_category,
    "summary_kpis": q_summary_kpis,
    "summary_by_year": q_summary_by_year,
    "summary_by_method": q_summary_by_method,
    "summary_rollup": q_summary_rollup,
    "map_project": q_map_project,
    "map_project_column": q_map_project_column,
    "map_hq": q_map_hq,
    "extract_beneficiary": q_extract_beneficiary,
    "parse_rate": q_parse_rate,
    "new_rows_anti": q_new_rows_anti,
    "new_rows_bucketed": q_new_rows_bucketed,
    "snapshot_diff": q_snapshot_diff,
    "unmatched_names": q_unmatched_names,
    "cache_lookups": q_cache_lookups,
    "fuzzy_match": q_fuzzy_match,
    "apply_matches": q_apply_matches,
    "enrich_hq": q_enrich_hq,
    "review_queue": q_review_queue,
    "id_pivot": q_id_pivot,
    "universe_coverage": q_universe_coverage,
    "stage_metrics": q_stage_metrics,
    "report_metrics": q_report_metrics,
    "report_metrics_cube": q_report_metrics_cube,
    "firm_search": q_firm_search,
    "firm_layout": q_firm_layout,
    "category_share": q_category_share,
    "yearly_quantity": q_yearly_quantity,
    "faceted_filter": q_faceted_filter,
    "facets": q_facets,
    "top_countries": q_top_countries,
    "top_firms": q_top_firms,
    "clean_name": q_clean_name,
    "extract_on_behalf": q_extract_on_behalf,
    "normalize_name": q_normalize_name,
    "fold_accents": q_fold_accents,
    "json_array_extract": q_json_array_extract,
    "json_results_decode": q_json_results_decode,
    "resolver_request": q_resolver_request,
    "resolve_batch": q_resolve_batch,
    "cache_update": q_cache_update,
    "cache_update_twice": q_cache_update_twice,
    "cache_versions": q_cache_versions,
    "firm_context": q_firm_context,
    "firm_context_bounded": q_firm_context_bounded,
    "stream_new_rows": q_stream_new_rows,
}
