"""The incremental matching job and the report view, as lazy DataFrame plans.

``MatchingJob`` wires the operators: base -> new rows (anti-join on serial) ->
beneficiary extraction -> harmonised columns -> cache match over distinct names
(-> optional batch resolver) -> join back -> combine with base -> HQ country ->
sanitise -> the 14 published columns (plus ``src``/``seq``, the source order).
``publish`` writes every output of a run. New rows, the names' cache results
and the resolver's results are written to the shared folder as soon as a later
stage asks for them. The counts of a run are observed while these are written
(Spark's ``Observation``); nothing is read again to count it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermatch import codes
from ledgermatch.operators import enrich, extract, harmonize, incremental, lookups, matching, near_miss, resolve
from ledgermatch.session import written
from ledgermatch.sources import sinks, tables, versions

ORDER_COLUMNS = ["src", "seq"]

#: The published table as it is written: its columns and the order key.
TABLE_SCHEMA = T.StructType([*tables.PUBLISHED_SCHEMA, T.StructField("src", T.IntegerType()), T.StructField("seq", tables.SEQ_TYPE)])


@dataclass
class MatchingJob:
    ledger: DataFrame                      # mixed raw ledger with registry_key and seq
    registry_columns: dict[str, set[str]] | None
    base_raw: DataFrame                    # earlier matched rows, base shape, with seq
    cache: DataFrame                       # known-match cache (lookups.CACHE_COLUMNS)
    firms: DataFrame | None                # firm universe with seq, or None
    suffixes: list[str] | None = None
    resolver: Callable | None = None
    resolver_context: str | None = None     # firm list for the resolver; None: built from the firm universe
    context_firms: int = 2000               # firms that such a list holds at most
    batch_size: int = 20
    near_edits: int = 0                     # edits at which a missed name still takes a cache key; 0: exact and normal form only
    _memo: dict = field(default_factory=dict, repr=False)
    _counts: dict = field(default_factory=dict, repr=False)

    def _observed(self, df: DataFrame, **counts: Column) -> DataFrame:
        """``df`` with counts that are taken while its rows are written; ``_seen`` gives them to the run."""
        watch = Observation()
        self._memo["watch"] = watch
        return df.observe(watch, *[c.cast("long").alias(k) for k, c in counts.items()])

    def _seen(self) -> None:
        self._counts |= {k: v or 0 for k, v in self._memo.pop("watch").get.items()}

    def _written(self, df: DataFrame, name: str, **counts: Column) -> DataFrame:
        out = written(self._observed(df, **counts), name)
        self._seen()
        return out

    def after_new_rows_of(self, other: "MatchingJob") -> "MatchingJob":
        """Take over the new rows that ``other`` has written (and their counts) instead of extracting them again."""
        self._memo["new_rows"] = other.new_rows()
        self._counts |= {k: v for k, v in other._counts.items() if k.startswith("new_rows_") or k == "parsed_rows"}
        return self

    # ---------------------------------------------------------------- stages
    def base(self) -> DataFrame:
        return harmonize.prepare_base(self.base_raw)

    def new_raw(self) -> DataFrame:
        return incremental.find_new_rows(self.ledger, self.base_raw, self.registry_columns)

    def new_rows(self) -> DataFrame:
        """Every new row with its beneficiary struct (or null), in unified columns.

        Written once to the shared folder: the name extraction is the costliest
        step and several branches read it (distinct names, resolver context,
        join back, stage counts). On a first run this is the whole ledger.
        """
        if "new_rows" not in self._memo:
            rows = extract.with_beneficiary(self.new_raw(), self.registry_columns)
            h = harmonize.harmonize(rows, self.registry_columns, keep=["seq", "registry_key", extract.PARSED])
            counts = {f"new_rows_{r}": F.count_if(F.col("registry_key") == r) for r in codes.REGISTRIES}
            self._memo["new_rows"] = self._written(h, "new_rows", **counts, parsed_rows=F.count_if(F.col(extract.PARSED).isNotNull()))
        return self._memo["new_rows"]

    def parsed(self) -> DataFrame:
        """New rows with a beneficiary, with raw_beneficiary, source_field and registry label."""
        return (self.new_rows().filter(F.col(extract.PARSED).isNotNull())
                .withColumn("raw_beneficiary", F.col("parsed.raw_name"))
                .withColumn("source_field", F.col("parsed.source_field"))
                .withColumn("registry", F.col("parsed.registry"))
                .drop(extract.PARSED))

    def names(self) -> DataFrame:
        """Distinct names with the position they were first seen (partial aggregation)."""
        return (self.parsed().groupBy(F.col("raw_beneficiary").alias("raw_name"))
                .agg(F.min("seq").alias("first_seq")))

    def cache_results(self) -> DataFrame:
        """One result per distinct name, written once: the misses, the join back and the counts start from it."""
        if "cache_results" not in self._memo:
            found = matching.match_cache(self.names(), self.cache, "raw_name", self.suffixes)
            if self.near_edits:
                found = near_miss.with_near_misses(written(found, "exact_results"), self.cache, self.near_edits, self.suffixes)
            has = matching.has_id("factset_entity_id")
            self._memo["cache_results"] = self._written(found, "cache_results", unique_names=F.count("*"), cache_hits=F.count_if(has),
                                                        cache_misses=F.count_if(~has))
        return self._memo["cache_results"]

    def unmatched(self) -> DataFrame:
        """Names the cache gave no id, with first sight, registry and country context.

        The few names are kept first; then the rows at their first positions,
        which are unique, give the context.
        """
        miss = self.cache_results().filter(~matching.has_id("factset_entity_id")).select("raw_name")
        first = self.names().join(miss, "raw_name", "left_semi")
        rows = self.parsed().select(F.col("seq").alias("first_seq"), "registry", "country")
        return first.join(rows, "first_seq").select("raw_name", "first_seq", "registry", "country")

    def resolver_results(self) -> DataFrame | None:
        """Resolver results for the unmatched names; replies and results are written down, each name is sent once."""
        if self.resolver is None:
            return None
        if "resolved" not in self._memo:
            found = resolve.resolve_batches(
                self.unmatched(), self.resolver, "raw_name", self.batch_size,
                registry_col="registry", country_col="country", context=self.context())
            self._memo["resolved"] = self._written(found, "resolved", resolver_names=F.count("*"),
                                                   resolver_hits=F.count_if(matching.has_id("factset_entity_id")))
        return self._memo["resolved"]

    def context(self) -> str:
        """Text of the firms that goes with every resolver call: the caller's, else ``context_firms`` of the universe."""
        if self.resolver_context is not None:
            return self.resolver_context
        if self.firms is None:
            return ""
        return resolve.context_text(resolve.firm_context(self.firms), self.context_firms)

    def all_results(self) -> DataFrame:
        """Cache results plus resolver results (the latter only when a resolver is set)."""
        res = self.cache_results()
        more = self.resolver_results()
        if more is not None:
            res = res.filter(matching.has_id("factset_entity_id")).unionByName(
                more.select(*matching.RESULT_COLUMNS))
        return res

    def updated_cache(self, min_confidence: str = "medium") -> DataFrame | None:
        more = self.resolver_results()
        if more is None:
            return None
        with_order = more.join(self.names(), "raw_name", "left")
        return resolve.update_cache(self.cache, with_order, "first_seq",
                                    min_confidence=min_confidence, suffixes=self.suffixes)

    def new_matched(self) -> DataFrame:
        return matching.apply_matches(self.parsed(), self.all_results(), "raw_beneficiary")

    def combined(self) -> DataFrame:
        """Base rows then new rows, 14 columns plus the order key."""
        base = harmonize.project_output(self.base().withColumn("src", F.lit(0)), extra=ORDER_COLUMNS)
        new = harmonize.project_output(self.new_matched().withColumn("src", F.lit(1)), extra=ORDER_COLUMNS)
        return base.unionByName(new)

    def output(self) -> DataFrame:
        """Published table: HQ country from the universe, strings sanitised."""
        enriched = enrich.hq_country(self.combined(), self.firms)
        ordered = enriched.select(*codes.OUTPUT_COLUMNS, *ORDER_COLUMNS)
        return harmonize.sanitize(ordered)

    def write_output(self, path: str) -> str:
        """Write the published table, counting its rows on the way; the counts of the run are complete then."""
        of_base, matched = F.col("src") == 0, F.coalesce(F.col("factset_entity_id") != "", F.lit(False))
        table = self._observed(self.output(), base_rows=F.count_if(of_base), base_matched=F.count_if(of_base & matched),
                               new_matched=F.count_if(~of_base & matched), combined_rows=F.count("*"))
        sinks.write_matched(table, path)
        self._seen()
        return path

    def stage_counts(self) -> DataFrame:
        """(stage, value) counts of the run so far, as they were observed; a registry without new rows has no row."""
        rows = [(k, v) for k, v in self._counts.items() if v or not k.startswith("new_rows_")]
        return self.ledger.sparkSession.createDataFrame(rows, "stage string, value long")

    def publish(self, root: str, last_updated: str | None = None, cache_root: str | None = None) -> dict[str, str]:
        """Write every output of a run under ``root``; returns their paths by name.

        The matched table is written first and the others are made from it. The
        stats document goes to two places; the updated cache only exists with a
        resolver. With ``cache_root`` it is the next version of that versioned
        table, which the next run finds by ``tables.load_current_cache``.
        """
        paths = {n: f"{root}/{n}" for n in ("matched_retirements", "matched_retirements_csv", "summary_stats",
                                            "docs/summary_stats", "map_data")}
        self.write_output(paths["matched_retirements"])
        table = sinks.read_matched(self.ledger.sparkSession, paths["matched_retirements"], TABLE_SCHEMA)
        sinks.write_matched_csv(table, paths["matched_retirements_csv"])
        sinks.write_json_text(sinks.stats_document(table, last_updated), [paths["summary_stats"], paths["docs/summary_stats"]])
        sinks.write_json_text(sinks.map_document(table, self.firms), [paths["map_data"]])
        cache = self.updated_cache()
        if cache is not None and cache_root:
            paths["known_matches"] = versions.write_version(self.ledger.sparkSession, cache_root, lambda path: sinks.write_cache(cache, path))
        elif cache is not None:
            paths["known_matches"] = sinks.write_cache(cache, f"{root}/known_matches")
        return paths


def build_cache(base_raw: DataFrame, suffixes: list[str] | None = None) -> DataFrame:
    """Known-match cache from earlier matched rows (M9)."""
    return lookups.known_matches(base_raw, suffixes)


def build_firms(coverage: DataFrame, identifiers: DataFrame | None,
                suffixes: list[str] | None = None) -> DataFrame:
    """Firm universe."""
    return lookups.public_firms(coverage, identifiers, suffixes)
