"""W1, faithful form: tumbling *processing-time* windows fired by timers.

The reference counts each stock code in 60 s windows of wall-clock time and
emits ``(code, n)`` when the window's end passes, with no further input
needed.  Spark's ``window()`` is event-time only, so this variant keeps the
count in keyed state and registers a processing-time timer at each window
end (``transformWithStateInPandas``: each key's rows arrive as Arrow
batches and are summed vectorised; RocksDB state store).

Skew: every Arrow batch is summed per code before the shuffle, so a code holding a
third of all rows costs one row per Arrow batch.  ``salts`` > 1 also spreads its
state over several keys ``(stockcode, salt)``; then a window fires in as many
partial counts, maybe in different batches, which ``read_processing_time_counts``
adds up.  Fired windows can be handed to an insert only with one salt, when each
(window, code) fires once with its whole count.
"""

from __future__ import annotations

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from lograft.operators import stockcodes
from lograft.streaming.parts import Mark

OUTPUT_SCHEMA = "stockcode STRING, salt INT, window_start BIGINT, window_end BIGINT, n BIGINT"


class ProcessingTimeWindowCount(StatefulProcessor):
    """Per key: window start (ms) -> count; a timer per open window."""

    def __init__(self, window_ms: int):
        self.window_ms = int(window_ms)

    def init(self, handle) -> None:
        self.handle = handle
        self.counts = handle.getMapState("counts", "window_start LONG", "n LONG")

    def handleInputRows(self, key, rows, timerValues):
        now = timerValues.getCurrentProcessingTimeInMs()
        start = now - now % self.window_ms
        total = int(sum(pdf["n"].sum() for pdf in rows))  # Arrow batches as pandas
        if total:
            k = (start,)
            if self.counts.containsKey(k):
                self.counts.updateValue(k, (self.counts.getValue(k)[0] + total,))
            else:
                self.counts.updateValue(k, (total,))
                self.handle.registerTimer(start + self.window_ms)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        end = expiredTimerInfo.getExpiryTimeInMs()
        k = (end - self.window_ms,)
        if self.counts.containsKey(k):
            n = self.counts.getValue(k)[0]
            self.counts.removeKey(k)
            yield pd.DataFrame({"stockcode": [key[0]], "salt": [int(key[1])],
                                "window_start": [k[0]], "window_end": [end], "n": [n]})

    def close(self) -> None:
        pass


def _sum_batches(batches):
    """(stockcode, n) summed per Arrow batch."""
    for batch in batches:
        sums = pa.Table.from_batches([batch]).group_by("stockcode").aggregate([("n", "sum")])
        yield from sums.rename_columns({"n_sum": "n"}).select(["stockcode", "n"]).combine_chunks().to_batches()


def processing_time_counts(source: DataFrame, window_ms: int = 60_000, salts: int = 1,
                           value_col: str = "value") -> DataFrame:
    """Streaming frame of fired windows: one row per (code, salt, window)."""
    pairs = stockcodes.stockcode_pairs(source.select(value_col), value_col=value_col)
    sums = pairs.select("stockcode", F.col("n").cast("bigint").alias("n")).mapInArrow(_sum_batches, "stockcode string, n bigint")
    salted = sums.select("stockcode", "n", F.floor(F.rand(17) * salts).cast("int").alias("salt"))
    return salted.groupBy("stockcode", "salt").transformWithStateInPandas(
        ProcessingTimeWindowCount(window_ms), OUTPUT_SCHEMA, "Append", "ProcessingTime")


def processing_time_count_stream(source: DataFrame, out_root: str, checkpoint: str,
                                 window_ms: int = 60_000, salts: int = 1,
                                 interval: str = "1 second",
                                 state_partitions: int | None = None, insert=None) -> StreamingQuery:
    """Fired windows under ``<out_root>/batch_id=<id>``; ``insert(rows)`` receives each batch of them once.

    A batch is stored before it is inserted and marked after, so a replay inserts the stored rows, or nothing once they are marked.
    """
    if insert is not None and salts != 1:
        raise ValueError("inserting fired windows needs salts=1: more salts fire partial counts")
    root = out_root.rstrip("/")
    fired = processing_time_counts(source, window_ms, salts)
    fired_, sent = Mark(f"{root}_marks/fired"), Mark(f"{root}_marks/sent")

    def run_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = f"{root}/batch_id={batch_id}"
        if sent.holds(spark, batch_id):
            return
        if not fired_.holds(spark, batch_id):
            batch.groupBy("window_start", "window_end", "stockcode").agg(F.sum("n").alias("n")) \
                .write.mode("overwrite").parquet(rows)
            fired_.set(spark, batch_id)
        if insert is not None:
            insert(spark.read.schema("window_start BIGINT, window_end BIGINT, stockcode STRING, n BIGINT").parquet(rows))
            sent.set(spark, batch_id)

    w = (fired.writeStream.foreachBatch(run_batch).option("checkpointLocation", checkpoint)
         .trigger(processingTime=interval))
    from lograft.streaming.jobs import _start
    return _start(w, source.sparkSession, state_partitions)


def read_processing_time_counts(spark: SparkSession, out_root: str) -> DataFrame:
    """(window, code) counts; a window's salts may fire in different batches."""
    return spark.read.parquet(out_root).groupBy("window_start", "window_end", "stockcode") \
        .agg(F.sum("n").alias("n"))
