"""Token files and packing against the tokenizers library, and their layout rules."""

from __future__ import annotations

import unicodedata
import zlib

import numpy as np
import pytest

from conftest import SF_SMALL
from ledgermatch.llm import bpe, packing, token_files
from ledgermatch.llm.queries import QUERIES, tokenizer

PATH = tokenizer("byte_bpe_50k.json")
ODD = ["", " ", "\n\n a", "it's 'll'S <|endoftext|> x", "a²b ½ 12٣", "tab\t\tend  \n", "中文 café",
       "x\x1cy \x85z", "don't  _stop_ -- 3.14", "é İ ẞ", " lead", "trail ", "a" * 3000, "\U0001f600!! ok"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(PATH)


def as_bytes(ids):
    return np.array(ids, "<u4").tobytes()


def test_encoder_equals_the_library(library):
    enc = bpe.ByteBpe(PATH)
    assert enc.known
    for text in ODD:
        assert enc.encode(text) == as_bytes(library.encode(text, add_special_tokens=False).ids), text


def test_sure_characters_split_as_in_the_library(library):
    enc = bpe.ByteBpe(PATH)
    sure = [c for c in map(chr, range(0x2100)) if not bpe._UNSURE.search(c)]
    assert len(sure) > 500
    for c in sure:
        for text in (f"a{c}b", f" {c}", f"{c}{c} 1{c}2", f"x {c} y", f"'{c}s"):
            assert enc.encode(text) == as_bytes(library.encode(text, add_special_tokens=False).ids), (unicodedata.name(c, ""), text)


def test_cache_limit_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 3)
    text = "one two three four five six two one and seven"
    assert bpe.ByteBpe(PATH).encode(text) == as_bytes(library.encode(text, add_special_tokens=False).ids)


def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}


def test_token_files_query(spark, library):
    got = {r.doc_id: r for r in QUERIES["op2_token_files"](spark, SF_SMALL).collect()}
    start = 0
    for doc_id, text in sorted(texts(spark).items()):
        ids = library.encode(text, add_special_tokens=False).ids + [0]
        r = got.pop(doc_id)
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(as_bytes(ids)))
        start += len(ids)
    assert not got


def odd_frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, ids string, part string, `a.b` int")


def test_token_files_odd_rows(spark, library):
    rows = [(None, "null id", "x", "y", 1), (3, None, None, None, None), (3, "same id", "x", "y", 2), (1, "", "x", "y", 3)]
    rows += [(10 + i, t, "x", "y", i) for i, t in enumerate(ODD)]
    out = token_files.token_digest(spark, odd_frame(spark, rows), PATH).orderBy("start").collect()
    assert [r.doc_id for r in out] == [None, 1, 3, 3, *range(10, 10 + len(ODD))]
    start = 0
    order = ["null id", "", "", "same id", *ODD]
    for r, text in zip(out, order):
        ids = library.encode(text, add_special_tokens=False).ids + [0]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(as_bytes(ids)))
        start += len(ids)
    assert token_files.token_digest(spark, odd_frame(spark, []), PATH).collect() == []


def check_packing(pieces, want, capacity=2048):
    """``want``: ids of each document in any order; documents are told apart by (doc_id, doc_tokens)."""
    by_sequence, by_doc = {}, {}
    for p in pieces:
        by_sequence.setdefault(p.sequence_id, []).append((p.offset, p.length))
        by_doc.setdefault(p.doc_id, []).append(p)
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    assert set(by_doc) == set(want)
    for doc_id, ids in want.items():
        at = 0
        for p in sorted(by_doc[doc_id], key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(as_bytes(ids[at:at + p.length]))
            at += p.length
        assert at == len(ids)
    used = [sum(n for _, n in places) for places in by_sequence.values()]
    return sum(0 if u & (u - 1) == 0 else capacity - u for u in used), sum(used)


def test_packing_query(spark, library):
    want = {d: library.encode(t, add_special_tokens=False).ids + [1] for d, t in texts(spark).items()}
    padding, tokens = check_packing(QUERIES["op10_packing"](spark, SF_SMALL).collect(), want)
    assert padding < 0.1 * tokens


def test_packing_odd_rows(spark, library):
    rows = [(None, "null id", "x", "y", 1), (3, None, None, None, None)]
    rows += [(10 + i, t, "x", "y", i) for i, t in enumerate(ODD)]
    want = {r[0]: library.encode(r[1] or "", add_special_tokens=False).ids + [1] for r in rows}
    for capacity in (8, 64, 2048):
        got = packing.pack(spark, odd_frame(spark, rows), PATH, capacity=capacity, min_cut=3)
        got = got.selectExpr("*", "crc32(ids) AS ids_crc32").collect()
        check_packing(got, want, capacity)
    assert packing.pack_digest(spark, odd_frame(spark, []), PATH).collect() == []


def test_cut_lengths_cover_and_fit():
    for total in [*range(1, 300), 2047, 2048, 2049, 5000]:
        pieces = packing.cut_lengths(total, 256, 16)
        assert sum(n for n, _, _ in pieces) == total
        assert all(n <= slot and (tail or n == slot) and 256 % slot == 0 for n, slot, tail in pieces)


def test_leftover_runs_are_powers_of_two(spark):
    from pyspark.sql import functions as F
    run, place = packing._block(F.col("i"), F.col("m"), 6)
    df = spark.range(1, 33).withColumnRenamed("id", "m").withColumn("i", F.explode(F.sequence(F.lit(0), F.col("m") - 1)))
    groups = {}
    for r in df.select("m", "i", run.alias("run"), place.alias("place")).collect():
        groups.setdefault((r.m, r.run), []).append(r.place)
    for places in groups.values():
        assert sorted(places) == list(range(len(places))) and len(places) & (len(places) - 1) == 0
