"""One path for all rules, and pieces from many workers."""

from __future__ import annotations

import random
import re

from ledgermatch.llm import packing, url_filter
from ledgermatch.llm.queries import tokenizer


def plain_verdict(url, rules):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url)
    host, path = m[1], m[2]
    fits = [(len(h + p), len(h), h + p, v) for (h, p), v in rules.items() if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[2:] if fits else (None, "allow")


def test_many_rules_of_one_path(spark):
    """Nested and neighbouring rules of the path / that fill several ranges."""
    rng = random.Random(4)
    hosts = {".".join(rng.choice("abcd") for _ in range(rng.randint(1, 5))) for _ in range(400)}
    rules = {(h, "/"): rng.choice(["allow", "block"]) for h in hosts} | {(h, "/x"): "block" for h in rng.sample(sorted(hosts), 30)}
    urls = [(i, f"http://{'.'.join(rng.choice('abcde') for _ in range(rng.randint(1, 6)))}/{rng.choice(['', 'x', 'xy', 'y'])}") for i in range(600)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        frame = spark.createDataFrame([(*k, v) for k, v in rules.items()], "host string, path string, verdict string")
        events = url_filter._segments(frame)
        text = events._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(path" not in text
        got = {r.page_id: (r.rule, r.verdict) for r in url_filter.judge_urls(spark.createDataFrame(urls, "page_id long, url string"), frame).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == {i: plain_verdict(u, rules) for i, u in urls}


def test_segments_of_no_rules(spark):
    none = spark.createDataFrame([], "host string, path string, verdict string")
    assert url_filter._segments(none).collect() == []


def test_pieces_of_many_workers(spark):
    """Workers fill sequences by themselves; what they hold at their ends fills sequences over all workers."""
    rng = random.Random(8)
    rows = [(i, " ".join(f"word{rng.randint(0, 50)}" for _ in range(rng.randint(0, 90)))) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = packing.pack(spark, docs, tokenizer("byte_bpe_50k.json"), capacity=64, min_cut=4).collect()
    shared = [p for p in got if p.sequence_id >= packing.SHARED]
    assert 0 < len(shared) < 0.5 * len(got)
    sequences, starts = {}, {}
    for p in got:
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
        starts.setdefault(p.doc_id, []).append((p.start, p.length, p.doc_tokens))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    for places in starts.values():
        at = 0
        for start, length, total in sorted(places):
            assert start == at
            at += length
        assert at == total
    assert len(starts) == 300
    used = [sum(n for _, n in places) for places in sequences.values()]
    assert sum(64 - u for u in used if u & (u - 1)) < 0.15 * sum(used)
