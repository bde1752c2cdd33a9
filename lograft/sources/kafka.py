"""Broker text source (value only), gated on the Kafka connector."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def kafka_text_stream(spark: SparkSession, servers: str, topic: str, group_id: str | None = None,
                      starting: str = "latest", min_partitions: int | None = None,
                      extra: dict | None = None) -> DataFrame:
    """Streaming frame ``value STRING`` (plus ``arrival`` = broker timestamp).

    ``starting`` applies on first start only; a restart resumes from the
    checkpoint's offsets.  Needs the spark-sql-kafka package on the
    classpath; every job in this library accepts any frame with a ``value``
    column instead (tests feed parquet file streams).
    """
    r = (spark.readStream.format("kafka")
         .option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic)
         .option("startingOffsets", starting))
    if group_id:
        r = r.option("kafka.group.id", group_id)
    if min_partitions:
        r = r.option("minPartitions", min_partitions)
    for k, v in (extra or {}).items():
        r = r.option(k, v)
    return r.load().selectExpr("CAST(value AS STRING) AS value", "timestamp AS arrival")


def parquet_text_stream(spark: SparkSession, path: str, schema: str,
                        max_files_per_trigger: int | None = None) -> DataFrame:
    """File-stream stand-in for S1 (message text must not go through text files)."""
    r = spark.readStream.schema(schema).format("parquet")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)
