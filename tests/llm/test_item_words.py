"""Long benchmark items are not broadcast for their words."""

from __future__ import annotations

from ledgermatch.llm import decontaminate


def test_words_bound_the_broadcast(spark, monkeypatch):
    text = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(1, "before it " + text), (2, "none of it")], "doc_id long, text string")
    bench = spark.createDataFrame([(7, text)], "item_id long, text string")
    items = bench.select("item_id", decontaminate.word_hashes(bench.text).alias("words")).withColumnRenamed("item_id", "item")

    def hinted():
        return "strategy=broadcast" in decontaminate._item_words(items)._jdf.queryExecution().analyzed().toString()

    few = sorted(decontaminate.contamination(docs, bench).collect())
    assert hinted()
    monkeypatch.setattr(decontaminate, "MAX_BROADCAST_WORDS", 59)
    assert not hinted()
    assert sorted(decontaminate.contamination(docs, bench).collect()) == few and few[0].n_hit == 60
