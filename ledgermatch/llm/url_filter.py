"""Operator 8: URL rules as a sort-merge range join over reversed hosts.

A rule (host, path) fits its host and all subdomains where the url's path starts with the rule's. With
the host's labels reversed ("www.example.com" -> "com.example.www."), the hosts a rule fits are
one interval of keys. Rules of one path form nested intervals, swept in key order, in ranges of the order: a running sum
of opened and closed intervals is the height of the stack, and the rule on its top after an event is
the last one opened at that height. Urls are sorted into the same order, once for every
rule path that their path starts with, and take the rule on top of the stack where they stand; the
ranges of the order are swept independently, each starting with what was active at the end of the one before.
The longest fitting rule (host and path together; then the longer host) decides, without one the default.

Nulls: a null url has an empty host and path. Of equal rules with different verdicts, block wins; rules with a null
or empty host or a null path fit nothing. Repeated urls and page_ids are judged row by row. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgermatch.llm.common import cut, small_side

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def url_host(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")), _UPPER, _LOWER)


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def reversed_host(host: Column) -> Column:
    """The key of a host in bytes; a host's key is a prefix of the keys of its subdomains, and of no other."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit(".")).cast("binary")


def _segments(rules: DataFrame) -> DataFrame:
    """(path, key, top): from ``key`` on, ``top`` is the innermost rule of that path (null in it: none).

    The events stand in order of (path, key) over all paths; a path closes what it opens, so one running sum gives the
    heights of all. Ranges of the order are swept independently, however many rules one path has: the heights start with
    the sums of the ranges before, and the rule on top is the last one opened at that height, in the range or before it.
    """
    rules = rules.where("host <> '' AND path IS NOT NULL").groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    rule = F.struct(F.concat("host", "path").alias("rule"), "verdict", F.length("host").alias("host_length"))
    opened = rules.select("path", reversed_host(F.col("host")).alias("key"), F.lit(1).alias("step"), rule.alias("own"))
    closed = opened.select("path", F.concat("key", F.unhex(F.lit("FF"))).alias("key"), F.lit(-1).alias("step"),
                           F.lit(None).cast(opened.schema["own"].dataType).alias("own"))
    events = cut(opened.unionByName(closed).repartitionByRange("path", "key").withColumn("range", F.spark_partition_id()))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    base = events.groupBy("range").agg(F.sum("step").alias("steps")).select("range", F.coalesce(F.sum("steps").over(before), F.lit(0)).alias("base"))
    here = Window.partitionBy("range").orderBy("path", "key").rowsBetween(Window.unboundedPreceding, 0)
    # One row per range.
    raised = cut(events.withColumn("in_range", F.sum("step").over(here)).join(F.broadcast(base), "range")
                 .withColumn("height", F.col("base") + F.col("in_range")).drop("base", "in_range"))
    # Per range and height the rule opened last: as many rows as ranges times the deepest nesting at most.
    ends = raised.groupBy("range", "height").agg(F.max_by("own", F.when(F.col("own").isNotNull(), F.struct("path", "key"))).alias("own"))
    earlier = Window.partitionBy("height").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("range", "height", F.last("own", ignorenulls=True).over(earlier).alias("carried"))
    same_height = Window.partitionBy("range", "height").orderBy("path", "key").rowsBetween(Window.unboundedPreceding, 0)
    found = raised.withColumn("seen", F.last("own", ignorenulls=True).over(same_height)).join(carried, ["range", "height"])
    return found.select("path", "key", F.struct(F.when(F.col("height") > 0, F.coalesce("seen", "carried")).alias("rule")).alias("top"))


def judge_urls(urls: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row of ``urls`` (page_id, url); rules: (host, path, verdict)."""
    rows = cut(urls.select(F.monotonically_increasing_id().alias("row"), "page_id", url_host(F.col("url")).alias("host"),
                           url_path(F.col("url")).alias("path")))
    segments = _segments(rules)
    paths = rules.where("path IS NOT NULL").select(F.col("path").alias("rule_path")).distinct()
    # One number per length a rule path has, not per rule.
    lengths = sorted(r[0] for r in paths.select(F.length("rule_path")).distinct().collect())
    prefixes = F.explode(F.filter(F.array(*[F.lit(n) for n in lengths]).cast("array<int>"), lambda n: n <= F.length("path")))
    asked = (rows.select("row", "host", "path", prefixes.alias("n"))
             .select("row", reversed_host(F.col("host")).alias("key"), F.expr("substring(path, 1, n)").alias("rule_path"))
             .join(small_side(paths), "rule_path", "left_semi"))
    top_type = segments.schema["top"].dataType
    swept = segments.select(F.col("path").alias("rule_path"), "key", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("row"), "top") \
        .unionByName(asked.select("rule_path", "key", F.lit(1).alias("kind"), "row", F.lit(None).cast(top_type).alias("top")))
    order = ("rule_path", "key", "kind", "row")
    swept = cut(swept.repartitionByRange(*order).withColumn("range", F.spark_partition_id()))
    # What is on top of the stack where a range begins: one row per range.
    place = F.struct("rule_path", "key")
    ends = swept.groupBy("range").agg(F.max_by("top", F.when(F.col("top").isNotNull(), place)).alias("end"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    begins = ends.select("range", F.last("end", ignorenulls=True).over(before).alias("begin"))
    here = Window.partitionBy("range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    found = swept.repartitionByRange("range").withColumn("seen", F.last("top", ignorenulls=True).over(here)) \
        .where("kind = 1").join(F.broadcast(begins), "range") \
        .select("row", F.coalesce("seen", "begin")["rule"].alias("rule")).where("rule IS NOT NULL")
    best = found.groupBy("row").agg(F.max(F.struct(F.length("rule.rule").alias("n"), F.col("rule.host_length").alias("h"),
                                                   F.col("rule.rule").alias("rule"), F.col("rule.verdict").alias("verdict"))).alias("best"))
    return rows.join(best, "row", "left").select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
