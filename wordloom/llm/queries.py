"""The registered queries of the operators, and their check SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.llm import (
    byte_bpe, dartminhash, hamming_index, hard_negatives, host_trust, html_cut, lexical_search, line_dedup, oracles,
    packing, quality_qda, quality_rules, repeated_bytes, toxicity,
)
from wordloom.llm.tables import read_table


def op1_quality_qda(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    return quality_qda.score_quality(docs, labels)


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.round_trip(read_table(spark, sf_dir, "documents"), path)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge_quality(read_table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept")


def op4_html_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_cut.extract_pages(read_table(spark, sf_dir, "pages"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack_documents(read_table(spark, sf_dir, "documents"), path)


def op6_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dartminhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op7_hamming_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hamming_index.search_nearest(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    return toxicity.score_toxicity(docs, labels).drop("evidence")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.find_similar_lines(read_table(spark, sf_dir, "documents"))


def op10_host_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_trust.judge_pages(read_table(spark, sf_dir, "pages"))


def op11_stratum_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    return lexical_search.search_documents(docs, items)


def op12_box_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine_negatives(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = repeated_bytes.remove_repeated(read_table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["begin"])
    return cut.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {
    "op1_quality_qda": op1_quality_qda,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_quality_rules": op3_quality_rules,
    "op4_html_cut": op4_html_cut,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_dart_minhash": op6_dart_minhash,
    "op7_hamming_index": op7_hamming_index,
    "op8_toxicity": op8_toxicity,
    "op9_line_dedup": op9_line_dedup,
    "op10_host_trust": op10_host_trust,
    "op11_stratum_search": op11_stratum_search,
    "op12_box_negatives": op12_box_negatives,
    "op13_suffix_dedup": op13_suffix_dedup,
}
ORACLES = {
    "op3_quality_rules": oracles.quality_rules(),
    "op10_host_trust": oracles.host_trust(),
    "op11_stratum_search": oracles.lexical_search(),
    "op12_box_negatives": oracles.hard_negatives(),
}
