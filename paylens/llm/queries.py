"""The registered queries of the training-data operators, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from paylens.llm import (
    conversation_trie,
    fingerprints,
    line_dedup,
    mixing,
    ngram_join,
    packing,
    quality,
    simhash,
    spelling,
    substring,
    token_counts,
    toxicity,
    url_filter,
)
from paylens.llm.common import load


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(load(spark, sf_dir, "documents"))


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(load(spark, sf_dir, "documents"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.url_filter(load(spark, sf_dir, "pages"))


def op4_trie_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(load(spark, sf_dir, "documents"))


def op5_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(load(spark, sf_dir, "documents"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.substring_dedup(load(spark, sf_dir, "documents"))


def op7_minhash_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(load(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(load(spark, sf_dir, "documents"))


def op10_line_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(load(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(load(spark, sf_dir, "documents"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.prefix_trie(load(spark, sf_dir, "conversations"))


def op13_simhash_covering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(load(spark, sf_dir, "documents"))


QUERIES = {
    "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
    "op2_source_mixing": op2_source_mixing,
    "op3_url_filter": op3_url_filter,
    "op4_trie_token_counts": op4_trie_token_counts,
    "op5_pattern_packing": op5_pattern_packing,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_minhash_fingerprints": op7_minhash_fingerprints,
    "op8_toxicity": op8_toxicity,
    "op9_quality_rules": op9_quality_rules,
    "op10_line_winnowing": op10_line_winnowing,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_conversation_trie": op12_conversation_trie,
    "op13_simhash_covering": op13_simhash_covering,
}
