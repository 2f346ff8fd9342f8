"""From raw documents to packed training sequences: five stages, each one operator of ledgermatch.llm.

A stage takes (spark, docs, sf_dir) and returns a frame that is written as Parquet and read again as the
next one's docs. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgermatch.llm import decontaminate, kneser_ney, minhash, packing, quality_rules
from ledgermatch.llm.common import fresh_path, read
from ledgermatch.llm.queries import tokenizer


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the fixed and the adaptive rules pass."""
    return quality_rules.filter_documents(docs)


def apply_quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity under the model of good text is usual for their language."""
    return kneser_ney.filter_documents(docs, read(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return minhash.deduplicate(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages (a twentieth of their words or more)."""
    return decontaminate.clean_documents(docs, read(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the sequences of 2048 tokens, with their ids."""
    return packing.pack(spark, docs, tokenizer("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", apply_quality_rules),
    ("quality_classifier", apply_quality_classifier),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

# The perplexities, the ids and the packing cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = fresh_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
