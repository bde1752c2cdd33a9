"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path


def _stored(df: DataFrame) -> DataFrame:
    """Cut the lineage with a table in the shared folder."""
    spark = df.sparkSession
    path = scratch_path(spark, "edges")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, label): the smallest node reachable, for every node of ``edges`` (a, b) with a != b.

    A round only takes minima per node and joins them back, so a node with very
    many neighbours is never gathered.
    """
    current = _stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                      .where(F.col("u") != F.col("v")).distinct())
    before = None
    for _ in range(max_rounds):
        # large star: every larger neighbour of u moves to the smallest of u and its neighbours
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where(F.col("u") != F.col("v")).distinct())
        # small star: the smaller neighbours of u, and u, move to the smallest of them
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(small, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        current = _stored(moved.unionByName(small.select("u", F.col("m").alias("v")))
                          .where(F.col("u") != F.col("v")).distinct())
        state = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError("components did not settle")
    return (current.select(F.col("u").alias("node"), F.col("v").alias("label"))
            .unionByName(current.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()))
