"""Processing-time windows fire on their timers without further input."""

import time

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from lograft.plans import queries as Q
from lograft.sources.kafka import parquet_text_stream
from lograft.streaming import ptime, registered as R


@pytest.mark.parametrize("salts", [1, 4])
def test_processing_time_windows_fire_and_count_everything(spark, scratch, salts):
    src, out, ck = scratch("pt_src"), scratch("pt_out"), scratch("pt_ck")
    for feed in R.stage_messages(spark, SF_SMALL, src):
        feed()
    stream = parquet_text_stream(spark, src, R.MESSAGE_SCHEMA).select("value")
    table = scratch("pt_table")
    insert = (lambda rows: rows.write.mode("append").parquet(table)) if salts == 1 else None
    q = ptime.processing_time_count_stream(stream, out, ck, window_ms=2000, salts=salts,
                                           interval="500 milliseconds", insert=insert)
    try:
        deadline = time.time() + 90
        expected = {r.stockcode: r.n for r in
                    Q.stock_pairs(spark, SF_SMALL).groupBy("stockcode")
                    .agg(F.count("*").alias("n")).collect()}
        got = {}
        while time.time() < deadline:
            time.sleep(2)
            try:
                c = ptime.read_processing_time_counts(spark, out)
                got = {r.stockcode: r.n for r in
                       c.groupBy("stockcode").agg(F.sum("n").alias("n")).collect()}
            except Exception:  # noqa: BLE001  (no batch written yet)
                continue
            if got == expected:
                break
        assert got == expected
        c = ptime.read_processing_time_counts(spark, out)
        assert c.where((F.col("window_end") - F.col("window_start")) != 2000).count() == 0
        assert c.where(F.col("window_start") % 2000 != 0).count() == 0
    finally:
        q.stop()
    if salts == 1:  # every (window, code) is inserted once, with its whole count
        rows = spark.read.parquet(table)
        assert rows.groupBy("window_start", "stockcode").count().where("count > 1").count() == 0
        assert {r.stockcode: r.n for r in rows.groupBy("stockcode").agg(F.sum("n").alias("n")).collect()} == expected


def test_inserting_partial_counts_is_refused(spark, scratch):
    stream = spark.readStream.format("rate").load().selectExpr("cast(value AS string) AS value")
    with pytest.raises(ValueError):
        ptime.processing_time_count_stream(stream, scratch("pt_o"), scratch("pt_c"), salts=2, insert=print)
