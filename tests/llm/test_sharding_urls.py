"""Shards and URL rules against plain Python."""

from __future__ import annotations

import random
import zlib

from conftest import SF_SMALL
from ledgermatch.llm import sharding, url_filter
from ledgermatch.llm.queries import QUERIES, URL_RULES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shards(rows, n=24):
    rows = sorted(((d is not None, d or 0, zlib.crc32((t or "").encode()), len((t or "").encode()) + 8, d) for d, t in rows))
    total, start, out, slots = sum(r[3] for r in rows), 0, [], {}
    for _, _, crc, size, d in rows:
        shard = min(n - 1, (2 * start + size) * n // (2 * total))
        out.append((d, size, crc, "bytes", shard, slots.get(shard, 0), None))
        slots[shard] = slots.get(shard, 0) + 1
        start += size
    return sorted(out, key=repr)


def result(df):
    return sorted(map(tuple, df.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard").collect()), key=repr)


def test_shards_query(spark):
    for sf in (SF_SMALL, SF_SMALL.replace("0.001", "0.01")):
        rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
        got = result(QUERIES["op7_sharding"](spark, sf))
        assert got == shards(rows)
        largest, sums = max(r[1] for r in got), [sum(r[1] for r in got if r[4] == k) for k in range(24)]
        assert max(sums) - min(sums) <= 2 * largest


def test_shards_odd_rows(spark):
    rows = [(None, "a"), (None, None), (3, "é"), (3, "é"), (3, None), (1, "x" * 9000), (2, ""), (9, "end")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, size string")
    assert result(sharding.balanced_shards(df, 5)) == shards(rows, 5)
    assert result(sharding.balanced_shards(df.limit(0))) == []


def parts(url):
    url = url or ""
    if "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([i for i in map(rest.find, "/?#") if i >= 0], default=len(rest))
    path = rest[cut:]
    return rest[:cut].translate(LOWER), path[:min([i for i in map(path.find, "?#") if i >= 0], default=len(path))]


def judged(url, rules):
    host, path = parts(url)
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules
            if h and p is not None and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, 0, None, "allow"))
    return host, path, best[2], best[3]


def test_urls_query(spark):
    for sf in (SF_SMALL, SF_SMALL.replace("0.001", "0.01")):
        rows = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url").collect()
        got = list(map(tuple, QUERIES["op8_url_filter"](spark, sf).collect()))
        assert sorted(got, key=repr) == sorted(((r.page_id, *judged(r.url, URL_RULES)) for r in rows), key=repr)


def test_nested_rules(spark):
    rng = random.Random(4)
    labels = ["a", "b", "aa", "a-b", "com", "é"]
    hosts = [".".join(rng.choice(labels) for _ in range(rng.randrange(1, 5))) for _ in range(60)]
    paths = ["", "/", "/a", "/a/", "/a/b", "/b/"]
    rules = list({(h, p): (h, p, rng.choice(("allow", "block"))) for h, p in ((rng.choice(hosts), rng.choice(paths)) for _ in range(50))}.values())
    odd = [(None, "/", "block"), ("", "", "block"), ("a", None, "block"), (rules[0][0], rules[0][1], "allow")]
    if rules[0][2] == "allow":
        rules[0] = (*rules[0][:2], "block")  # of equal rules the blocking one wins
    urls = [f"http{rng.choice(['', 's'])}://{rng.choice(['', 'X.', 'a.'])}{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(['', 'x', '?q=/a', '#/b'])}" for _ in range(400)]
    urls += [None, "", "no scheme/a", "x://", "x:///a", "u://A.b://c/a", "s://a?x://b/a", "line\n://a/\nb", "://a..b/"] + [urls[0]] * 30
    rows = [(i // 2, u, "x") for i, u in enumerate(urls)] + [(None, "s://a/", "x")]
    got = url_filter.judge_urls(spark.createDataFrame(rows, "page_id long, url string, rule string"),
                                spark.createDataFrame(rules + odd, "host string, path string, verdict string"))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(((i, *judged(u, rules)) for i, u, _ in rows), key=repr)


def test_empty_tables(spark):
    urls = spark.createDataFrame([(1, "s://a/")], "page_id long, url string")
    rules = spark.createDataFrame([("a", "/", "block")], "host string, path string, verdict string")
    assert [tuple(r) for r in url_filter.judge_urls(urls, rules.limit(0)).collect()] == [(1, "a", "/", None, "allow")]
    assert url_filter.judge_urls(urls.limit(0), rules).collect() == []
