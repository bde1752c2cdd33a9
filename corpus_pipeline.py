"""The corpus pipeline: quality rules, line dedup, near-duplicate join, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept; ``run`` writes every result as Parquet and reads it again as the next
stage's input.  All stages but the last return the columns of ``documents``.

Defined results: texts without words, null or empty, fail the base quality rule and
go; of equal texts the row with the smallest doc_id stays, rows without a doc_id
come last; null labels and null or empty benchmark items count for nothing; an
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lograft.llm import decontaminate, jaccard_join, line_dedup, packing, quality_rules
from lograft.session import scratch_path, table_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go."""
    labels = spark.read.parquet(table_path(sf_dir, "labels"))
    return quality_rules.keep_good(docs, labels)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Frequent lines stay in one document only."""
    kept = line_dedup.kept(line_dedup.dedup_lines(docs))
    changed = F.col("n_dropped") > 0
    columns = [F.when(changed, F.col("kept_text")).otherwise(F.col("row.text")).alias("text") if c == "text"
               else F.when(changed, F.length("kept_text").cast("long")).otherwise(F.col("row.n_chars")).alias("n_chars")
               if c == "n_chars" else F.col(f"row.{c}") for c in docs.columns]
    return kept.select(*columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the smallest doc_id."""
    return jaccard_join.keep_one(docs, words=5, percent=80)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    benchmark = spark.read.parquet(table_path(sf_dir, "benchmark"))
    return decontaminate.clean(docs, benchmark)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in their bins."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality_rules", quality_stage),
    ("line_dedup", line_stage),
    ("jaccard_join", near_duplicate_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("best_fit_packing", packing_stage),
]

#: The learned list and the n-gram join have no SQL form; tests hold run() against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(table_path(sf_dir, "documents"))
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
