"""Roll-ups that a run keeps up to date instead of computing them over all rows again.

The state of the summary is two tables: sums and counts per (dim, key), and one row per (dim, key, firm) for the distinct
firms. A run aggregates its own rows to the same shape and merges; earlier rows are never read. The state is a versioned
table (``sources.versions``): a run that dies leaves the earlier state in use, and a run that is repeated under its id
changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermatch.operators.report import is_matched, megatonnes
from ledgermatch.sources import versions

KEY = ["dim", "key"]


def _exploded(df: DataFrame) -> DataFrame:
    """A row per (dim, key) that a published row counts in: all, registry, method, and year where there is one."""
    m = is_matched()
    q = F.coalesce(F.col("quantity") if "quantity" in df.columns else F.lit(0.0), F.lit(0.0))
    dims = F.array(F.struct(F.lit("all").alias("dim"), F.lit("").alias("key")),
                   F.struct(F.lit("registry").alias("dim"), F.col("registry").alias("key")),
                   F.struct(F.lit("method").alias("dim"), F.col("match_method").alias("key")),
                   F.struct(F.lit("year").alias("dim"), F.col("retirement_year").cast("string").alias("key")))
    rows = df.select(F.explode(dims).alias("d"), m.alias("_m"), q.alias("_q"), F.when(m, F.col("factset_entity_id")).alias("_fid"))
    return rows.select(F.col("d.dim").alias("dim"), F.col("d.key").alias("key"), "_m", "_q", "_fid") \
        .filter(~((F.col("dim") == "year") & F.col("key").isNull()))


def partial_sums(df: DataFrame) -> DataFrame:
    """(dim, key, total, matched, quantity, matched_quantity) of some published rows."""
    return _exploded(df).groupBy(*KEY).agg(
        F.count("*").alias("total"), F.count_if("_m").alias("matched"), F.sum("_q").alias("quantity"),
        F.coalesce(F.sum(F.when(F.col("_m"), F.col("_q"))), F.lit(0.0)).alias("matched_quantity"))


def partial_firms(df: DataFrame) -> DataFrame:
    """(dim, key, factset_entity_id): the matched firms of some published rows, a row each; partial aggregation absorbs repeats."""
    return _exploded(df).filter(F.col("_fid").isNotNull()).select(*KEY, F.col("_fid").alias("factset_entity_id")).distinct()


def merge_sums(*parts: DataFrame) -> DataFrame:
    both = parts[0]
    for p in parts[1:]:
        both = both.unionByName(p)
    return both.groupBy(*KEY).agg(*[F.sum(c).alias(c) for c in ("total", "matched", "quantity", "matched_quantity")])


def finish(sums: DataFrame, firms: DataFrame) -> DataFrame:
    """The state in the shape of ``report.summary_rollup``. Firms are counted from their rows, so a repeat counts once."""
    unique = firms.groupBy(*KEY).agg(F.count("*").alias("unique_firms")).withColumnsRenamed({"dim": "_dim", "key": "_key"})
    same = F.col("dim").eqNullSafe(F.col("_dim")) & F.col("key").eqNullSafe(F.col("_key"))
    return sums.join(unique, same, "left").select(
        "dim", "key", "total", "matched", F.coalesce("unique_firms", F.lit(0)).alias("unique_firms"),
        megatonnes("quantity").alias("total_mtco2"), megatonnes("matched_quantity").alias("matched_mtco2"))


def state(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame, set[str]] | None:
    """(sums, firms, ids of the runs that are in them) of the version in use; None before the first run."""
    path = versions.current_path(spark, root)
    if path is None:
        return None
    runs = {r.run for r in spark.read.schema("run string").json(f"{path}/runs").collect()}  # a row per run
    return spark.read.parquet(f"{path}/sums"), spark.read.parquet(f"{path}/firms"), runs


def update_rollup(spark: SparkSession, root: str, run: str, new_rows: DataFrame) -> DataFrame:
    """Merge the published rows of one run into the state under ``root``; gives the roll-up of all runs so far.

    Reads the state and ``new_rows``, nothing else. A ``run`` that is in the state already is not merged again.
    """
    held = state(spark, root)
    if held and run in held[2]:
        return finish(held[0], held[1])
    sums, firms = partial_sums(new_rows), partial_firms(new_rows)
    runs = {run}
    if held:
        sums, firms, runs = merge_sums(held[0], sums), held[1].unionByName(firms).distinct(), held[2] | runs

    def write(path: str) -> None:
        sums.write.parquet(f"{path}/sums")
        firms.write.parquet(f"{path}/firms")
        spark.createDataFrame([(r,) for r in sorted(runs)], "run string").coalesce(1).write.json(f"{path}/runs")

    versions.write_version(spark, root, write)
    done = state(spark, root)
    return finish(done[0], done[1])
