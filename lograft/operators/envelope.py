"""A6/K4 data half: stream-load envelopes; X4: label ledger for replay safety."""

from __future__ import annotations

from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BATCH_ROWS = 10000
ENVELOPE_SCHEMA = "struct<data: array<string>>"


def partition_envelopes(df: DataFrame, payload_col: str = "payload",
                        batch_rows: int = BATCH_ROWS, label_prefix: str = "load",
                        shard_col: str | None = None) -> DataFrame:
    """Cut each input partition's rows into ``{"data":[...]}`` bodies of at
    most ``batch_rows`` rows, like a sink task that flushes its buffer.

    Narrow: the bodies are built in the partition from its Arrow batches, no
    payload is moved.  With ``shard_col`` one pass serves all shards, each with
    envelopes of its own.  ``payload`` must already be a JSON document; it is
    embedded without a re-parse.  Output: ``label, part, chunk, n_rows, body``
    and ``shard``.  Labels are stable under task retries because a deterministic
    input yields the same partitions.
    """
    import pyarrow as pa

    def cut(batches):
        part = TaskContext.get().partitionId()
        waiting: dict = {}
        chunks: dict = {}

        def flush(shard):
            rows, chunk = waiting.pop(shard), chunks.get(shard, 0)
            chunks[shard] = chunk + 1
            middle = [label_prefix] if shard is None else [label_prefix, str(shard)]
            return pa.RecordBatch.from_pydict({
                "label": ["-".join([*middle, str(part), str(chunk)])], "part": pa.array([part], pa.int32()),
                "chunk": pa.array([chunk], pa.int64()), "n_rows": pa.array([len(rows)], pa.int32()),
                "body": ['{"data":[' + ",".join(rows) + "]}"], "shard": pa.array([shard], pa.int32())})

        for batch in batches:
            for payload, shard in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if payload is None:
                    continue
                rows = waiting.setdefault(shard, [])
                rows.append(payload)
                if len(rows) >= batch_rows:
                    yield flush(shard)
        for shard in list(waiting):
            yield flush(shard)

    shard = F.col(shard_col).cast("int") if shard_col else F.lit(None).cast("int")
    out = df.select(F.col(payload_col).alias("payload"), shard.alias("shard")).mapInArrow(
        cut, "label string, part int, chunk bigint, n_rows int, body string, shard int")
    return out if shard_col else out.drop("shard")


def flatten_envelopes(env: DataFrame, body_col: str = "body",
                      row_schema: str | None = None) -> DataFrame:
    """Envelope bodies back to one row per document (the round-trip check)."""
    schema = f"struct<data: array<{row_schema}>>" if row_schema else ENVELOPE_SCHEMA
    rows = env.select(*[c for c in env.columns if c != body_col],
                      F.explode(F.from_json(body_col, schema)["data"]).alias("doc"))
    if row_schema:
        return rows.select(*[c for c in rows.columns if c != "doc"], "doc.*")
    return rows


def labelled_load(envelopes: DataFrame, ledger: DataFrame,
                  label_col: str = "label") -> tuple[DataFrame, DataFrame]:
    """Load each label once.  Returns (to_send, new_ledger).

    An anti-join against the ledger of labels already applied; the ledger
    holds one row per envelope (rows / 10,000), and AQE picks a broadcast
    only when its measured size is under the threshold.
    """
    # labels are unique by construction, so only the ledger's labels take part in the join
    fresh = envelopes.join(ledger.select(label_col), on=label_col, how="left_anti")
    new_ledger = ledger.select(label_col).unionByName(fresh.select(label_col))
    return fresh, new_ledger
