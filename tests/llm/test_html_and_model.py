"""Page text, and the language model against a plain computation and held-out labels."""

from __future__ import annotations

import html
import math
import re
from collections import Counter

import numpy as np
import pytest

from conftest import SF_SMALL
from ledgermatch.llm import html_extract, kneser_ney
from ledgermatch.llm.queries import QUERIES

SF = SF_SMALL.replace("0.001", "0.01")


@pytest.fixture(scope="module")
def tree(spark):
    return html_extract.train_tree(spark)


def test_tree_fits_its_table(tree):
    rows = html_extract.labelled()
    assert len(rows) > 500
    assert sum(html_extract.is_main(tree, tuple(x)) == bool(y) for y, x in rows) >= 0.99 * len(rows)


def test_pages_query(spark):
    """The articles of the synthetic pages: what stands between <article> and </article>, block by block."""
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = QUERIES["op1_html_text"](spark, SF).collect()
    assert len(got) == len(pages)
    for r in got:
        inside = re.search(r"<article>(.*?)</article>", pages[r.page_id].html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:p|h1)>", inside)]
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


CASES = {
    "": "",
    "<p>": "",
    "plain text only, with several words in one sentence that go on and on for a while until they end.":
        "plain text only, with several words in one sentence that go on and on for a while until they end.",
    "<article><p>a &lt;b&gt; &amp;amp; c&nbsp;d</p><script>if (a < b) { t = '</p>'; }</script><p>x<!-- <p>no</p> -->y</article>": "a <b> &amp; c d\nxy",
    "<main><p>one<p>two<div class=ad><p>Buy</p></div><p>three<br>four</main><footer>f</footer>": "one\ntwo\nthree four",
    "<article><p title='a > b'>kept</p><p hidden>no</p><p style='display: none'>no</p><aside>no</aside></article>": "kept",
    "<ARTICLE><P>Upper</P><UL><LI>one<LI>two</UL></ARTICLE><NAV>no</NAV>": "Upper\none\ntwo",
    "<body><header><h1>Site</h1></header><article><header><h1>Title</h1></header><p>Text.</p><section class='comments'><p>me too</p></section></article>":
        "Title\nText.",
    "<article><p>a<span class='share'>tweet</span>b</p><style>p{}</style><form><input><label>mail</label></form><noscript>js</noscript></article>": "a\nb",
    "<article><p>a</p><p>unclosed <b>bold <i>text</p></article><div id=cookie-banner>we use</div>": "a\nunclosed bold text",
    "<article><p>1 < 2 and 3 > 2</p><p>x</article": "1 < 2 and 3 > 2\nx",
}


def test_cases(tree):
    for page, text in CASES.items():
        assert html_extract.main_text(page, tree) == text, page


def test_page_odd_rows(spark):
    rows = [(1, "u", None, "x"), (None, None, "<article><p>a</p></article>", "x"), (2, "u", "", "x"), (2, "u", "", "x"),
            (3, "u", "<article>" + "<p>long words here.</p>" * 20000 + "</article>", "x"), (4, "u", "<" * 5000 + "<a " * 3000, "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = {r.page_id: r.text for r in html_extract.extract_text(df).collect()}
    assert got[1] == got[2] == "" and got[None] == "a" and got[3].count("\n") == 19999
    assert html_extract.extract_text(df.limit(0)).collect() == []


def plain_model(texts):
    """Interpolated modified Kneser-Ney straight from its definition."""
    table, n = kneser_ney.class_table(), kneser_ney.ORDER
    counts = {n: Counter()}
    for t in texts:
        c = [0] * (n - 1) + [int(table[min(ord(x), 0x10000)]) for x in t]
        counts[n].update(tuple(c[i:i + n]) for i in range(len(c) - n + 1))
    for k in range(n - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    discounts, totals = {}, {}
    for k, c in counts.items():
        n1, n2, n3, n4 = (sum(v == i for v in c.values()) for i in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2) if n1 else 0.5
        raw = [1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 0.5, 3 - 4 * y * n4 / n3 if n3 else 0.5]
        discounts[k] = [min(max(d, 0.1), i) for i, d in enumerate(raw, 1)]
        totals[k] = {}
        for g, v in c.items():
            s = totals[k].setdefault(g[:-1], [0, 0.0])
            s[0] += v
            s[1] += discounts[k][min(v, 3) - 1]

    def p(g):
        k = len(g)
        if not k:
            return 1 / kneser_ney.CLASSES
        low, s = p(g[1:]), totals[k].get(g[:-1])
        if not s:
            return low
        v = counts[k].get(g, 0)
        return ((v - discounts[k][min(v, 3) - 1]) if v else 0) / s[0] + s[1] / s[0] * low

    return p


def test_model_against_its_definition(spark):
    texts = ["The cat sat on the mat. ", "A second text, with MORE signs!! 12", "été à la mer", "the the the the"]
    got = kneser_ney.train(spark.createDataFrame([(t,) for t in texts], "text string"))
    p = plain_model(texts)
    rng = np.random.default_rng(2)
    some = list(rng.integers(0, kneser_ney.CLASSES ** kneser_ney.ORDER, 400)) + list(kneser_ney.grams(texts)[0][:60])
    for code in map(int, some):
        g = tuple((code >> (kneser_ney.BITS * (kneser_ney.ORDER - 1 - k))) & 31 for k in range(kneser_ney.ORDER))
        assert math.isclose(got[code], math.log(p(g)), rel_tol=1e-5)
    sums = np.exp(got.astype(np.float64)).reshape(-1, kneser_ney.CLASSES).sum(axis=1)
    assert np.allclose(sums, 1, atol=1e-5)


def test_grams_of_several_texts():
    codes, lengths = kneser_ney.grams(["ab", "", "A1"])
    at = kneser_ney.class_table()
    a, b, cap, one = (int(at[ord(c)]) for c in "abA1")
    assert codes.tolist() == [a, (a << 5) | b, cap, (cap << 5) | one] and lengths.tolist() == [2, 0, 2]
    assert kneser_ney.grams([])[0].tolist() == []


def test_classifier_on_labels(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    got = QUERIES["op9_quality_classifier"](spark, SF).collect()
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    good = [r.kept for r in got if labels.get(r.doc_id) == 1]
    bad = [r.kept for r in got if labels.get(r.doc_id) == 0]
    print(sum(good), len(good), sum(bad), len(bad))
    assert sum(good) >= 0.98 * len(good) and sum(bad) <= 0.3 * len(bad)


def test_classifier_odd_rows(spark):
    rows = [(i, f"some ordinary words number {i} stand here. " * 3, "en", "x") for i in range(200)]
    odd = [(1000, None, "en", "x"), (1001, "", "en", "x"), (None, "some ordinary words.", None, "x"), (1002, "#|%$ " * 60, "en", "x"), (1003, "x", "xx", "x"), (1003, "x", "xx", "x")]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string, perplexity string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(200)] + [(None, 1, 0), (5, 0, 0), (6, None, 0), (7, 1, 1)], "doc_id long, quality int, toxic int")
    got = {}
    for r in kneser_ney.judge_documents(docs, labels).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert not got[1000][0].kept and got[1000][0].perplexity is None and not got[1001][0].kept and not got[1002][0].kept
    assert len(got[1003]) == 2 and all(got[i][0].kept for i in range(200))
    left = kneser_ney.filter_documents(docs, labels)
    assert left.columns == docs.columns and left.count() >= 200
    none = kneser_ney.judge_documents(docs, labels.limit(0)).collect()
    assert all(r.kept == bool(r.n_chars) for r in none)
    assert kneser_ney.judge_documents(docs.limit(0), labels).collect() == []
