"""The pipeline as a whole, against its stages by brute force where they allow it."""

from __future__ import annotations

from conftest import SF_SMALL
import corpus_pipeline
from test_decontamination import brute as brute_contamination
from test_near_duplicates import brute as brute_duplicates
from test_quality_rules import counts

SF = SF_SMALL.replace("0.001", "0.01")


def test_stages(spark, tmp_path):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "quality_classifier", "near_duplicates", "decontamination", "packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES:
        before = [(r.doc_id, r.text) for r in docs.collect()]
        out = stage(spark, docs, SF)
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name == "packing":
            assert sum(r.length for r in docs.collect() if r.start == 0) > 0
            assert {r.doc_id for r in docs.select("doc_id").collect()} == {d for d, _ in before}
            continue
        assert docs.columns == columns
        after = {r.doc_id: r.text for r in docs.collect()}
        assert all(dict(before)[d] == t for d, t in after.items())
        gone = {d for d, _ in before} - set(after)
        if name == "quality_rules":
            failed = {d for d, t in before for c in [counts(t)] if c[0] < 10 or 100 * c[4] > 20 * c[0]}
            assert failed <= gone
            assert sum(labels.get(d) == 1 for d in gone - failed) <= 0.01 * len(labels)
        elif name == "quality_classifier":
            assert sum(labels.get(d) == 1 for d in gone) <= 0.02 * len(labels)
        elif name == "near_duplicates":
            assert gone == {d for d, (_, c) in brute_duplicates(before).items() if c != d}
        else:
            assert gone == {r[0] for r in brute_contamination(before, items) if r[5]} and gone


def test_run_is_its_stages(spark):
    out = corpus_pipeline.run(spark, SF_SMALL)
    assert {"doc_id", "start", "length", "ids", "sequence_id", "offset"} <= set(out.columns)
    assert out.where("octet_length(ids) <> 4 * length").isEmpty() and not out.isEmpty()


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_SMALL)
        assert out.columns == docs.columns and out.collect() == []
    assert corpus_pipeline.pack_sequences(spark, docs, SF_SMALL).collect() == []
