"""Token counts against the tokenizers library."""

from __future__ import annotations

import pytest

from conftest import SF_SMALL
from ledgermatch.llm import token_counts
from ledgermatch.llm.queries import QUERIES, tokenizer

PATH = tokenizer("word_bpe_49k.json")
ODD = ["", " ", "It's 'LL'S <|endoftext|>x<|startoftext|> <|endoftext|>", "a²b ½ 12٣", "中文 CAFÉ cafe\u0301", "İstanbul ΣΑΣ ẞ", "x\x1cy \x85z", "!'s --- 3.14 _a_",
       "A" * 3000, "\U0001f600!! ok", "don't WE'VE i'm", "ﬁ Ⅷ ǅ ŉ"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(PATH)


def number(library, text):
    return len(library.encode(text or "", add_special_tokens=False).ids)


def test_query(spark, library):
    sf = SF_SMALL.replace("0.001", "0.01")
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = QUERIES["op5_token_counts"](spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        n = number(library, texts[r.doc_id])
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 2048)


def test_odd_rows_and_small_blocks(spark, library, monkeypatch):
    rows = [(None, "no id", "x"), (1, None, "x"), (2, "same row", "x"), (2, "same row", "x")] + [(10 + i, t, "x") for i, t in enumerate(ODD)]
    df = spark.createDataFrame(rows, "doc_id long, text string, pieces string")
    want = sorted(((d, len((t or "").encode()), number(library, t)) for d, t, _ in rows), key=repr)
    got = [(r.doc_id, r.n_bytes, r.n_tokens) for r in token_counts.count_tokens(spark, df, PATH).collect()]
    assert sorted(got, key=repr) == want
    assert token_counts.count_tokens(spark, df.limit(0), PATH).collect() == []


def test_packed_frequencies():
    import numpy as np
    for numbers, times in (([], []), ([0], [1]), ([5, 70000, 70001, 9_000_000], [1, 300, 2, 70_000]), (list(range(300)), [255] * 300)):
        got = token_counts.unpacked(token_counts.packed(np.array(numbers, np.uint32), np.array(times, np.int64)))
        assert got[0].tolist() == numbers and got[1].tolist() == times


def test_sure_characters(library):
    split = token_counts.PreTokens(PATH)
    for c in (c for c in map(chr, range(0x2100)) if not token_counts._UNSURE.search(c)):
        for text in (f"a{c}b", f" {c}", f"{c}{c} 1{c}2", f"'{c}s"):
            pieces, extra = split.pieces(text)
            assert sum(map(split.count, pieces)) + extra == number(library, text), text
