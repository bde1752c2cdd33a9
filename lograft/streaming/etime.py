"""Event-time windows that are emitted once: keyed state and event-time timers.

A window of a key is emitted when the watermark passes its end (``late`` is false).
Rows that arrive for a window that has closed are not dropped: their count is
emitted at once as a correction (``late`` is true), so the emitted numbers of a
window always add up to its rows, in any order of arrival.

Spark's stateful operators drop rows behind the watermark.  So the watermark runs on
a column of its own, ``clock``: every Arrow batch is reduced to one row per (key,
window), whose clock is null and never late, and one row that carries the batch's
highest time and no count.  That also makes a hot key one row per Arrow batch.

State holds open windows only; a batch's work does not grow with the windows closed.
"""

from __future__ import annotations

import datetime
import json

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from lograft.streaming.parts import Mark

OUTPUT_SCHEMA = "key STRING, window_start BIGINT, n BIGINT, late BOOLEAN"


class EventWindowCount(StatefulProcessor):
    """Per key: the open windows' counts as one value, and one timer at the first end among them."""

    def __init__(self, window_ms: int):
        self.window_ms = int(window_ms)

    def init(self, handle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "counts STRING")

    def _read(self) -> dict[int, int]:
        return {int(k): n for k, n in json.loads(self.open.get()[0]).items()} if self.open.exists() else {}

    def _store(self, counts: dict[int, int]) -> None:
        if counts:
            self.open.update((json.dumps(counts),))
        else:
            self.open.clear()

    def _out(self, key, counts: dict[int, int], late: bool):
        n = len(counts)
        return pd.DataFrame({"key": [key[0]] * n, "window_start": list(counts), "n": list(counts.values()), "late": [late] * n})

    def handleInputRows(self, key, rows, timerValues):
        watermark, late, new = timerValues.getCurrentWatermarkInMs(), {}, {}
        for frame in rows:
            for start, n in frame.groupby("window_start")["n"].sum().items():
                if n:  # rows that only carry a time count nothing
                    to = late if start + self.window_ms <= watermark else new
                    to[int(start)] = to.get(int(start), 0) + int(n)
        if new:
            counts = self._read()
            before, first = min(counts, default=None), min(*counts, *new) if counts else min(new)
            for start, n in new.items():
                counts[start] = counts.get(start, 0) + n
            if first != before:
                if before is not None:
                    self.handle.deleteTimer(before + self.window_ms)
                self.handle.registerTimer(first + self.window_ms)
            self._store(counts)
        if late:
            yield self._out(key, late, True)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        watermark, counts = timerValues.getCurrentWatermarkInMs(), self._read()
        closed = {s: n for s, n in counts.items() if s + self.window_ms <= watermark}
        left = {s: n for s, n in counts.items() if s not in closed}
        if left:
            self.handle.registerTimer(min(left) + self.window_ms)
        self._store(left)
        if closed:
            yield self._out(key, closed, False)

    def close(self) -> None:
        pass


_CLOCKED = pa.schema([("key", pa.string()), ("window_start", pa.int64()), ("n", pa.int64()), ("clock", pa.timestamp("us", "UTC"))])


def _clocked(batches):
    """Counts per (key, window) of each Arrow batch, then its highest time."""
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        sums = table.group_by(["key", "window_start"]).aggregate([("at", "count")])
        top = pc.max(table["at"]).as_py()
        clock = None if top is None else datetime.datetime.fromtimestamp(top / 1000, datetime.timezone.utc)
        yield pa.RecordBatch.from_arrays([
            pa.array([*sums["key"].to_pylist(), None], pa.string()), pa.array([*sums["window_start"].to_pylist(), 0], pa.int64()),
            pa.array([*sums["at_count"].to_pylist(), 0], pa.int64()),
            pa.array([None] * sums.num_rows + [clock], pa.timestamp("us", "UTC"))], schema=_CLOCKED)


def window_counts(events: DataFrame, time_col: str, key_col: str, window_ms: int, delay: str = "0 seconds") -> DataFrame:
    """Streaming frame of emitted windows (``OUTPUT_SCHEMA``); rows without a time are in no window."""
    at = F.unix_millis(F.col(time_col).cast("timestamp"))
    rows = events.where(F.col(time_col).isNotNull()).select(
        F.col(key_col).alias("key"), (at - F.pmod(at, F.lit(window_ms))).alias("window_start"), at.alias("at"))
    clocked = rows.mapInArrow(_clocked, "key string, window_start bigint, n bigint, clock timestamp").withWatermark("clock", delay)
    return clocked.groupBy("key").transformWithStateInPandas(EventWindowCount(window_ms), OUTPUT_SCHEMA, "Append", "EventTime")


def windows_stream(events: DataFrame, out_root: str, checkpoint: str, time_col: str, key_col: str, window_ms: int,
                   delay: str = "0 seconds", insert=None, available_now: bool = False, interval: str | None = None,
                   state_partitions: int | None = None) -> StreamingQuery:
    """Emitted windows under ``<out_root>/batch_id=<id>``; ``insert(rows)`` gets every window once, when it closes.

    A batch is stored before its windows are inserted and marked after: a replay
    inserts the stored rows, or nothing once they are marked.  Corrections are not
    inserted; they stay in the stored table, beside the windows that they correct.
    """
    from lograft.streaming.jobs import _start, _trigger
    root = out_root.rstrip("/")
    stored, sent = Mark(f"{root}_marks/stored"), Mark(f"{root}_marks/sent")

    def run_batch(batch: DataFrame, batch_id: int) -> None:
        spark, path = batch.sparkSession, f"{root}/batch_id={batch_id}"
        if not stored.holds(spark, batch_id):
            batch.write.mode("overwrite").parquet(path)
            stored.set(spark, batch_id)
        if insert is not None and not sent.holds(spark, batch_id):
            insert(spark.read.schema(OUTPUT_SCHEMA).parquet(path).where(~F.col("late")).drop("late"))
            sent.set(spark, batch_id)

    w = window_counts(events, time_col, key_col, window_ms, delay).writeStream.foreachBatch(run_batch) \
        .option("checkpointLocation", checkpoint)
    return _start(_trigger(w, available_now, interval), events.sparkSession, state_partitions)


def read_windows(spark: SparkSession, out_root: str) -> DataFrame:
    """All emitted rows: each closed window once (``late`` false), and corrections."""
    return spark.read.schema(OUTPUT_SCHEMA + ", batch_id BIGINT").parquet(out_root)


def corrected_windows(spark: SparkSession, out_root: str) -> DataFrame:
    """(key, window_start, n): emitted counts with their corrections added."""
    return read_windows(spark, out_root).groupBy("key", "window_start").agg(F.sum("n").alias("n"))
