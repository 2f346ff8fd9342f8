"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgermatch.llm import (collocations, decontaminate, html_extract, kneser_ney, minhash, oracle, packing, quality_rules, sharding,
                             spelling, token_counts, token_files, url_filter, vector_search)
from ledgermatch.llm.common import read

#: (host, path, verdict) of op8.
URL_RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block"))


def tokenizer(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_text(read(spark, sf_dir, "pages"))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_digest(spark, read(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read(spark, sf_dir, "documents"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge_documents(read(spark, sf_dir, "documents"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(spark, read(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")).drop("text_key")


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.balanced_shards(read(spark, sf_dir, "documents"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judge_urls(read(spark, sf_dir, "pages").select("page_id", "url"), rules)


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.judge_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_digest(spark, read(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


def op11_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_search.search_embeddings(read(spark, sf_dir, "embeddings"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read(spark, sf_dir, "documents"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(spelling.count_words(read(spark, sf_dir, "documents")))


QUERIES = {f.__name__: f for f in (
    op1_html_text, op2_token_files, op3_near_duplicates, op4_quality_rules, op5_token_counts, op6_decontamination, op7_sharding,
    op8_url_filter, op9_quality_classifier, op10_packing, op11_vector_search, op12_collocations, op13_spelling_variants)}

# The other queries cannot be expressed: they hold a trained tree or model, or the ids of a tokenizer. Their tests use brute force.
ORACLE_SQL = {
    "op3_near_duplicates": oracle.NEAR_DUPLICATES,
    "op4_quality_rules": oracle.QUALITY_RULES,
    "op6_decontamination": oracle.DECONTAMINATION,
    "op7_sharding": oracle.SHARDING,
    "op8_url_filter": oracle.url_filter(URL_RULES),
    "op11_vector_search": oracle.VECTOR_SEARCH,
    "op12_collocations": oracle.COLLOCATIONS,
    "op13_spelling_variants": oracle.SPELLING_VARIANTS,
}
