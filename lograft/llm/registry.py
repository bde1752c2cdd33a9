"""The operators' registered queries and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table_path
from . import (decontaminate, jaccard_join, line_dedup, merkle, merkle_oracle, oracle, packing, quality_rules, sharding,
               substring_dedup, suffix_dedup, token_alignment, token_counts, toxicity, url_filter)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def op1_jaccard_join(spark, sf_dir):
    return jaccard_join.jaccard_join(table(spark, sf_dir, "documents"))


def op2_toxicity(spark, sf_dir):
    got = toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return got.select("doc_id", "held_out", "score", "predicted")


def op3_substring_dedup(spark, sf_dir):
    got = substring_dedup.dedup_substrings(table(spark, sf_dir, "documents"))
    return got.select("doc_id", F.col("n_units").alias("n_words"), "n_removed", "kept_sha256")


def op4_quality_rules(spark, sf_dir):
    judged, _ = quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept")


def op5_line_dedup(spark, sf_dir):
    return line_dedup.digest(table(spark, sf_dir, "documents")).drop("keep_runs")


def op6_best_fit_packing(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op7_url_filter(spark, sf_dir):
    return url_filter.filter_urls(table(spark, sf_dir, "pages")).drop("listed")


def op8_suffix_dedup(spark, sf_dir):
    got = suffix_dedup.dedup_bytes(table(spark, sf_dir, "documents"))
    return got.select("doc_id", F.col("n_units").alias("n_bytes"), "n_removed", "n_spans", "kept_sha256")


def op9_vector_sharding(spark, sf_dir):
    return sharding.shard_rows(table(spark, sf_dir, "documents")).drop("tokens")


def op10_benchmark_decontamination(spark, sf_dir):
    got = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return got.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op11_token_alignment(spark, sf_dir):
    return token_alignment.align(table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark, sf_dir):
    return merkle.manifest(table(spark, sf_dir, "documents"))


def op13_token_counts(spark, sf_dir):
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_jaccard_join, op2_toxicity, op3_substring_dedup, op4_quality_rules, op5_line_dedup, op6_best_fit_packing,
        op7_url_filter, op8_suffix_dedup, op9_vector_sharding, op10_benchmark_decontamination, op11_token_alignment,
        op12_merkle_manifest, op13_token_counts)}
ORACLE_SQL: dict[str, str] = {
    "op1_jaccard_join": oracle.JACCARD,
    "op3_substring_dedup": oracle.SUBSTRINGS,
    "op5_line_dedup": line_dedup.ORACLE_SQL,
    "op7_url_filter": url_filter.ORACLE_SQL,
    "op8_suffix_dedup": oracle.BYTES,
    "op10_benchmark_decontamination": oracle.DECONTAMINATION,
    "op12_merkle_manifest": merkle_oracle.MERKLE,
}
