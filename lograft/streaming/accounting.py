"""What became of every message and stock-code line of a stream, batch by batch.

The counts are ``observe`` metrics: they are computed in the tasks that write the
batch, cost no pass and no shuffle, and come back with the write itself (no listener
and no port).  The observed part of each write is narrow, so every row is counted in a
task of the write's own stage, where a task that is run again counts once.

A batch's counts are stored under ``<out_root>/accounting/batch_id=<id>`` after its
rows, with overwrite, so a replayed batch replaces rows and counts together.

Defined results: a null message is rejected as ``null_message``; a message with several
bad headers counts under the fault of the first one; outcomes without a row are kept with
0, except that an empty batch has no counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lograft.functions.frames import with_computed
from lograft.functions.javastr import java_trim, pair_pieces
from lograft.functions.logparse import HEADER_FAULTS, LINE_OR_RECORD, header_fault, split_records
from lograft.operators import documents, stockcodes
from lograft.streaming.jobs import _batch_dir, _trigger
from lograft.streaming.parts import read_if_there

LEDGER = "batch_id BIGINT, kind STRING, outcome STRING, n BIGINT"
MESSAGE_FAULTS = ["null_message", *HEADER_FAULTS]


def judged_messages(df: DataFrame, value_col: str = "value") -> DataFrame:
    """T4/T5 with the reason: ``json`` of an accepted message, else ``first_bad`` and ``reason``."""
    first = F.get(split_records(F.col(value_col)), F.col("first_bad"))
    reason = F.when(F.col(value_col).isNull(), "null_message").when(F.col("first_bad").isNotNull(), header_fault(first))
    return documents.with_documents(df, value_col).withColumn("reason", reason).drop("docs")


def judged_lines(df: DataFrame, value_col: str = "value", key: str = "stockcode") -> DataFrame:
    """T6 with what it leaves out: every line of ``key``; ``ok`` when it has exactly two pieces."""
    others = [F.col(c) for c in df.columns if c != value_col]
    lines = df.select(*others, F.explode(F.split(F.col(value_col), LINE_OR_RECORD)).alias("line"))
    parsed = with_computed(lines, {"_pc": pair_pieces(F.col("line"))}, drop=["line"])
    pieces = F.col("_pc")
    return parsed.where(F.lower(java_trim(F.get(pieces, 0))) == F.lit(key)).select(
        *others, (F.size(pieces) == 2).alias("ok"),
        F.when(F.size(pieces) == 2, F.lower(java_trim(F.get(pieces, 1)))).alias("stockcode"))


def write_counted(frame: DataFrame, path: str, outcomes: dict[str, Column], partition_by: list[str]) -> dict[str, int]:
    """Write ``frame`` over ``path`` and return the rows that met each outcome, counted by the write."""
    seen = Observation()
    counted = frame.observe(seen, *[F.count_if(c).alias(f"n{i}") for i, c in enumerate(outcomes.values())])
    counted.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    got = seen.get
    return {name: int(got[f"n{i}"]) for i, name in enumerate(outcomes)}


def write_accounted_batch(batch: DataFrame, batch_id: int, out_root: str, shards: int = 2,
                          provider: Column | None = None, uniqueid: Column | None = None,
                          shard: Column | None = None) -> None:
    """One micro-batch: messages, stock-code events by shard, and the counts of both."""
    root, spark = out_root.rstrip("/"), batch.sparkSession
    if batch.isEmpty():
        return
    reason = F.col("reason")
    messages = judged_messages(batch).withColumn("accepted", reason.isNull())
    counts = {"message": write_counted(
        messages.withColumn("value", F.when(~F.col("accepted"), F.col("value"))), _batch_dir(f"{root}/messages", batch_id),
        {"seen": F.lit(True), "accepted": F.col("accepted"), "rejected": ~F.col("accepted"),
         **{f: F.coalesce(reason == f, F.lit(False)) for f in MESSAGE_FAULTS}}, ["accepted"])}
    # a line that is not a pair goes to no shard and is kept with its reason
    events = stockcodes.synthetic_events(judged_lines(batch), provider, uniqueid, shard, shards) \
        .withColumn("shard", F.when(F.col("ok"), F.col("shard"))).withColumn("payload", F.when(F.col("ok"), F.col("payload")))
    ok = F.col("ok")
    counts["line"] = write_counted(
        events, _batch_dir(f"{root}/events", batch_id),
        {"seen": F.lit(True), "accepted": ok, "not_a_pair": ~ok, "no_shard": ok & F.coalesce(
            ~F.col("shard").between(0, shards - 1), F.lit(True)),
         **{f"shard_{i}": F.coalesce(F.col("shard") == i, F.lit(False)) for i in range(shards)}}, ["shard"])
    rows = [(batch_id, kind, outcome, n) for kind, found in counts.items() for outcome, n in found.items()]
    spark.createDataFrame(rows, LEDGER).coalesce(1).drop("batch_id").write.mode("overwrite") \
        .parquet(_batch_dir(f"{root}/accounting", batch_id))


def accounted_stream(source: DataFrame, out_root: str, checkpoint: str, shards: int = 2, provider: Column | None = None,
                     uniqueid: Column | None = None, shard: Column | None = None, available_now: bool = False,
                     interval: str | None = None) -> StreamingQuery:
    """W7 and T6-T8 over one source with nothing left out of the books.

    ``messages`` (accepted with JSON, rejected with reason and text), ``events`` (payloads by
    shard, lines that are no pair without one) and ``accounting`` are tables partitioned by batch.
    """
    def run_batch(batch: DataFrame, batch_id: int) -> None:
        write_accounted_batch(batch, batch_id, out_root, shards, provider, uniqueid, shard)

    w = source.writeStream.foreachBatch(run_batch).option("checkpointLocation", checkpoint)
    return _trigger(w, available_now, interval).start()


def read_accounting(spark: SparkSession, out_root: str) -> DataFrame:
    """batch_id, kind, outcome, n of every committed batch."""
    return read_if_there(spark, f"{out_root.rstrip('/')}/accounting", LEDGER)


def out_of_balance(ledger: DataFrame, shards: int = 2) -> DataFrame:
    """Batches whose books do not balance: rows seen that are in no outcome, or in two."""
    def n(kind, *outcomes):
        return F.coalesce(F.sum(F.when((F.col("kind") == kind) & F.col("outcome").isin(*outcomes), F.col("n"))), F.lit(0))
    per = ledger.groupBy("batch_id").agg(
        (n("message", "seen") - n("message", "accepted", *MESSAGE_FAULTS)).alias("messages"),
        (n("line", "seen") - n("line", "not_a_pair", "no_shard", *[f"shard_{i}" for i in range(shards)])).alias("lines"))
    return per.where((F.col("messages") != 0) | (F.col("lines") != 0))
