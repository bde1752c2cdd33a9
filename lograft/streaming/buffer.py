"""The sink's buffer across micro-batches, in keyed state.

A shard's payloads wait until there are ``batch_rows`` of them or ``linger_ms`` have
passed since the first one came, whichever is first; then they leave as one
``{"data":[...]}`` body.  The payloads are in list state and the deadline is a
processing-time timer, so a buffer survives a restart and is flushed in time though
no more rows arrive.  ``lanes`` > 1 gives a shard several buffers, so that a hot
shard is not one task's work.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from lograft.operators.envelope import BATCH_ROWS

LINGER_MS = 10_000
OUTPUT_SCHEMA = "shard INT, n_rows INT, body STRING"


class EnvelopeBuffer(StatefulProcessor):
    def __init__(self, batch_rows: int = BATCH_ROWS, linger_ms: int = LINGER_MS):
        self.batch_rows, self.linger_ms = int(batch_rows), int(linger_ms)

    def init(self, handle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", "payload STRING")
        self.waiting = handle.getValueState("waiting", "n INT, due LONG")

    def _bodies(self, key, parts: list[list[str]]):
        return pd.DataFrame({"shard": [int(key[0])] * len(parts), "n_rows": [len(p) for p in parts],
                             "body": ['{"data":[' + ",".join(p) + "]}" for p in parts]})

    def handleInputRows(self, key, rows, timerValues):
        # a batch's rows come frame by frame, and full bodies leave before the next frame is read:
        # the worker holds a frame and less than a body, however many rows the batch has
        n, due = self.waiting.get() if self.waiting.exists() else (0, 0)
        new, came = [], False
        for frame in rows:
            new.extend(frame["payload"])
            came = came or bool(new)
            if n + len(new) < self.batch_rows:
                continue
            every = [r[0] for r in self.rows.get()] + new if n else new
            full = len(every) // self.batch_rows * self.batch_rows
            yield self._bodies(key, [every[i:i + self.batch_rows] for i in range(0, full, self.batch_rows)])
            if n:
                self.handle.deleteTimer(due)
                self.rows.clear()
            new, n = every[full:], 0
        if not came:
            return
        if not new:
            self.waiting.clear()
            return
        if not n:
            due = timerValues.getCurrentProcessingTimeInMs() + self.linger_ms
            self.handle.registerTimer(due)
        self.rows.appendList([(p,) for p in new])
        self.waiting.update((n + len(new), due))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        if self.waiting.exists():
            rest = [r[0] for r in self.rows.get()]
            self.rows.clear()
            self.waiting.clear()
            yield self._bodies(key, [rest])

    def close(self) -> None:
        pass


def buffered_envelopes(payloads: DataFrame, batch_rows: int = BATCH_ROWS, linger_ms: int = LINGER_MS, lanes: int = 1,
                       payload_col: str = "payload", shard_col: str = "shard") -> DataFrame:
    """Streaming frame of bodies (shard, n_rows, body) of a stream of payloads; null payloads are left out."""
    rows = payloads.where(F.col(payload_col).isNotNull()).select(
        F.col(shard_col).cast("int").alias("shard"), F.pmod(F.xxhash64(payload_col), F.lit(lanes)).cast("int").alias("lane"),
        F.col(payload_col).alias("payload"))
    return rows.groupBy("shard", "lane").transformWithStateInPandas(
        EnvelopeBuffer(batch_rows, linger_ms), OUTPUT_SCHEMA, "Append", "ProcessingTime")
