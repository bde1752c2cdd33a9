"""Structured Streaming jobs over any ``value`` stream.

W7 log-to-JSON, W8 search events with daily rollups, W1 windowed counts
(a SUM table; ``etime`` has windows that close), the synthetic-event stream-load pipeline (T6-T8,
K4), continuous routine loads (S2/S3 into duplicate or SUM tables) and the
X1/X2 streaming counts.

Sources are any streaming frame with a ``value STRING`` column (Kafka via
``sources.kafka``; tests use parquet file streams).  Every job keeps its
progress in ``checkpointLocation``; a restart on the same location resumes
from the saved offsets (W3/W4).

Replay safety: ``foreachBatch`` is at-least-once, so each batch writes into
a directory named by its batch id with ``overwrite``; a replayed batch
replaces its own output instead of adding to it.  Tables that merge by key
(A3/A4, M2, K3) are partitioned by day or key bucket, and a batch replaces the
partitions that it touches with staged ones (``parts.PartTable``).
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lograft.operators import documents, envelope, merge, records, rollup, search, stockcodes, \
    variants
from lograft.sinks.files import to_value_frame
from lograft.streaming.parts import Mark, PartTable, bucket_part, day_part, read_if_there


_STARTING = threading.Lock()


def _trigger(writer, available_now: bool, interval: str | None):
    if available_now:
        return writer.trigger(availableNow=True)
    if interval:
        return writer.trigger(processingTime=interval)
    return writer


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _start(writer, spark: SparkSession, state_partitions: int | None = None) -> StreamingQuery:
    """Start a stateful query, with a chosen number of state partitions.

    A stream copies the session's settings when it starts and keeps its state
    partitions in the checkpoint for good, so size them for the state volume.
    Starts are serialised, so that two of them never see each other's settings.
    """
    wanted = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB}
    if state_partitions:
        wanted["spark.sql.shuffle.partitions"] = str(int(state_partitions))
    with _STARTING:
        old = {k: spark.conf.get(k, None) for k in wanted}
        try:
            for k, v in wanted.items():
                spark.conf.set(k, v)
            return writer.start()
        finally:
            for k, v in old.items():
                spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _batch_dir(root: str, batch_id: int) -> str:
    return f"{root.rstrip('/')}/batch_id={batch_id}"


def log_to_json_stream(source: DataFrame, sink_path: str, checkpoint: str,
                       fmt: str = "parquet", sink_partitions: int | None = None,
                       available_now: bool = False, interval: str | None = None,
                       options: dict | None = None) -> StreamingQuery:
    """W7 (T4+T5+K1): accepted messages' JSON arrays as a ``value`` stream.

    Stateless, so the built-in sink is used directly: the file sink commits
    through its own log (exactly once); ``fmt="kafka"`` with topic options is
    the production sink.  ``sink_partitions`` mirrors the reference's sink
    parallelism with a ``repartition``: a ``coalesce`` would be narrow and
    pull the parsing itself into that many tasks.
    """
    docs = documents.log_to_json(source)
    if fmt == "kafka":  # the broker sink takes the value column only
        out = to_value_frame(docs, "json", sink_partitions)
    else:
        out = docs.select(F.col("json").alias("value"),
                          *[c for c in source.columns if c != "value"])
        if sink_partitions:
            out = out.repartition(sink_partitions)
    w = out.writeStream.format(fmt).option("checkpointLocation", checkpoint)
    if fmt != "kafka":
        w = w.option("path", sink_path)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    return _trigger(w.outputMode("append"), available_now, interval).start()


def log_rejects_stream(source: DataFrame, sink_path: str, checkpoint: str,
                       available_now: bool = False, interval: str | None = None) -> StreamingQuery:
    """W7's other half (X6): messages with a bad header, whole, with ``first_bad``.

    A query of its own beside ``log_to_json_stream``, with its own checkpoint, so
    both file sinks commit exactly once and each message is in one of the two.
    """
    w = documents.log_rejects(source).writeStream.format("parquet") \
        .option("checkpointLocation", checkpoint).option("path", sink_path)
    return _trigger(w.outputMode("append"), available_now, interval).start()


def write_host_search_batch(batch: DataFrame, batch_id: int, out_root: str,
                            day_col: str | None = None, as_of: str | None = None,
                            sink_partitions: int | None = None, value_sink=None) -> None:
    """One micro-batch of W8: normalised documents, and A3/A4 merged into the daily tables.

    Documents and rejects go to ``<out_root>/<name>/batch_id=<id>`` with overwrite, so
    running the same batch id again leaves the same files; the daily tables ignore it.
    ``value_sink`` gets a batch at least once: again only if it stopped before its mark.
    ``sink_partitions`` narrows the document output with ``coalesce`` (the
    reference's sink parallelism; also bounds files per batch).
    """
    root = out_root.rstrip("/")
    recs = records.explode_records(batch)
    day = F.col(day_col) if day_col else None
    norm = search.normalize_search(recs, day=day).persist()
    try:
        # Rollups first: their map stages fill the cache at full parallelism;
        # the coalesced document write then only reads cached blocks.
        hot = rollup.hot_stock_daily(norm)
        act = rollup.active_user_daily(norm)
        # T9 rows without a stock code cannot enter the daily table: kept with their reason (M4)
        merge.check_constraints(norm, ["stockcode"], {"stockcode": 128}).where(F.col("reject_reason").isNotNull()) \
            .write.mode("overwrite").parquet(_batch_dir(f"{root}/rejects_events", batch_id))
        if as_of == "batch":  # the window moves with the date of each batch
            as_of = F.current_date()
        if as_of is not None:
            hot, hot_rej = merge.retention_split(hot, as_of)
            act, act_rej = merge.retention_split(act, as_of)
            hot_rej.write.mode("overwrite").parquet(_batch_dir(f"{root}/rejects_hot", batch_id))
            act_rej.write.mode("overwrite").parquet(_batch_dir(f"{root}/rejects_user", batch_id))
        rollup_table(root, "hot_stock_code").apply(hot, batch_id)
        rollup_table(root, "active_user").apply(act, batch_id)
        docs = norm.coalesce(sink_partitions) if sink_partitions else norm
        docs.write.mode("overwrite").parquet(_batch_dir(f"{root}/events", batch_id))
        sent = Mark(f"{root}/sent_values")
        if value_sink is not None and not sent.holds(batch.sparkSession, batch_id):  # K1: a ``value`` frame
            value_sink(to_value_frame(spark_read_batch(batch.sparkSession, f"{root}/events", batch_id), "json"), batch_id)
            sent.set(batch.sparkSession, batch_id)
    finally:
        norm.unpersist()
    if as_of is not None:
        low, _ = merge.retention_bounds(as_of)
        oldest = str(batch.sparkSession.range(1).select(low).first()[0])
        for table in ROLLUP_KEYS:
            rollup_table(root, table).drop_before(batch.sparkSession, oldest)


def spark_read_batch(spark: SparkSession, out_root: str, batch_id: int) -> DataFrame:
    """One committed batch of a table (read back, not recomputed)."""
    return spark.read.parquet(_batch_dir(out_root, batch_id))


def host_search_stream(source: DataFrame, out_root: str, checkpoint: str,
                       day_col: str | None = None, as_of: str | None = None,
                       available_now: bool = False, interval: str | None = None,
                       query_name: str | None = None, sink_partitions: int | None = None,
                       value_sink=None) -> StreamingQuery:
    """W8 (T9+K1, then A3/A4): one ``foreachBatch`` feeds three outputs.

    Per batch: the normalised documents, and the hot-code and active-user sums
    merged into the days that they touch (``write_host_search_batch``).  ``day`` is the message's ``day_col`` when given, else the processing
    date.  With ``as_of`` (a date, or ``"batch"`` for the date of each batch) the
    M3 retention window is applied: out-of-range rows go to ``rejects_*`` and days
    that fell out of the window leave the tables.
    ``value_sink(frame, batch_id)`` receives the committed documents as JSON
    ``value`` rows, for a broker topic.
    """
    def run_batch(batch: DataFrame, batch_id: int) -> None:
        write_host_search_batch(batch, batch_id, out_root, day_col, as_of, sink_partitions, value_sink)

    w = source.writeStream.foreachBatch(run_batch).option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    return _trigger(w, available_now, interval).start()


ROLLUP_KEYS = {"hot_stock_code": "stock_code", "active_user": "usersign"}


def rollup_table(out_root: str, table: str = "hot_stock_code") -> PartTable:
    """A daily SUM table of W8 (A5 semantics), partitioned by day."""
    key = ROLLUP_KEYS[table]
    return PartTable(f"{out_root.rstrip('/')}/{table}", lambda rows: rollup.daily_sum(rows, key), day_part())


def read_rollup(spark: SparkSession, out_root: str, table: str = "hot_stock_code") -> DataFrame:
    return rollup_table(out_root, table).read(spark)


def sum_table(out_root: str, keys: list[str], measure: str = "total_number") -> PartTable:
    """The SUM (aggregate-key) table of a stream, partitioned by day where its keys have a time."""
    def merge_sums(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*keys).agg(F.sum(measure).alias(measure))

    time = next((k for k in ("day", "window_start") if k in keys), None)
    return PartTable(f"{out_root.rstrip('/')}/table", merge_sums, day_part(time) if time else bucket_part(keys))


def sums_stream(source: DataFrame, aggregate, out_root: str, checkpoint: str, keys: list[str],
                available_now: bool = False, interval: str | None = None, after_batch=None) -> StreamingQuery:
    """Run an aggregate as a SUM table: every micro-batch adds its own counts by ``keys``.

    Stateless, so nothing is ever late: a row counts in its window whenever it
    arrives, in any order and after any restart.  ``aggregate(batch)`` returns
    ``keys`` and ``n``; the table is read with ``read_sum_table(..., "n")``.
    """
    table = sum_table(out_root, keys, "n")

    def run_batch(batch: DataFrame, batch_id: int) -> None:
        own = aggregate(batch).select(*keys, "n").persist()
        try:
            table.apply(own, batch_id)
            if after_batch is not None:
                after_batch(own, batch_id)
        finally:
            own.unpersist()

    w = source.writeStream.foreachBatch(run_batch).option("checkpointLocation", checkpoint)
    return _trigger(w, available_now, interval).start()


COUNT_KEYS = ["window_start", "window_end", "stockcode"]


def count_60s_stream(source: DataFrame, out_root: str, checkpoint: str, time_col: str = "arrival",
                     available_now: bool = False, interval: str | None = None, latest: bool = False) -> StreamingQuery:
    """W1 (A1 in a stream): 60 s tumbling counts per stock code, as a SUM table.

    With ``latest`` a second table keeps the latest window of every code
    (``latest_table``, K3); a batch reduces its own counts and merges them.
    ``window_inserts_stream`` has the windows that close and are inserted.
    """
    def count(batch: DataFrame) -> DataFrame:
        return rollup.count_by_window(stockcodes.stockcode_pairs(batch.select("value", time_col)), time_col, "stockcode")

    def after(own: DataFrame, batch_id: int) -> None:
        table = latest_table(out_root)
        table.apply(table.merge(own), batch_id)

    return sums_stream(source, count, out_root, checkpoint, COUNT_KEYS, available_now, interval, after if latest else None)


def latest_table(out_root: str) -> PartTable:
    """Per code its latest window and count (K3/A2), partitioned by buckets of codes.

    States of one window add up; of two windows the later replaces the earlier, so
    a batch need only keep the latest window that it saw.
    """
    def merge_latest(rows: DataFrame) -> DataFrame:
        sums = rows.groupBy(*COUNT_KEYS).agg(F.sum("n").alias("n"))
        return merge.latest_by_key(sums, ["stockcode"], "window_end")

    return PartTable(f"{out_root.rstrip('/')}/latest", merge_latest, bucket_part(["stockcode"]))


def read_counts(spark: SparkSession, out_root: str) -> DataFrame:
    return read_sum_table(spark, out_root, COUNT_KEYS, "n")


def window_inserts_stream(source: DataFrame, out_root: str, checkpoint: str, insert=None, time_col: str = "arrival",
                          delay: str = "0 seconds", available_now: bool = False, interval: str | None = None,
                          state_partitions: int | None = None) -> StreamingQuery:
    """K2: every 60 s window of a code is inserted once, when it has closed (``etime.windows_stream``)."""
    from lograft.streaming import etime
    pairs = stockcodes.stockcode_pairs(source.select("value", time_col))
    return etime.windows_stream(pairs, out_root, checkpoint, time_col, "stockcode", 60_000, delay, insert, available_now,
                                interval, state_partitions)


def event_count_stream(events: DataFrame, out_root: str, checkpoint: str, time_col: str = "ts",
                       key_col: str = "event_type", duration: str = "5 minutes", **kw) -> StreamingQuery:
    """X1 as a SUM table: event-time tumbling counts; no row is late (``etime`` has windows that are emitted once)."""
    return sums_stream(events, lambda b: variants.event_count(b, time_col, key_col, duration), out_root, checkpoint,
                       ["window_start", key_col], **kw)


def word_count_stream(lines: DataFrame, out_root: str, checkpoint: str, text_col: str = "text", **kw) -> StreamingQuery:
    """X2 as a SUM table: counts per word."""
    return sums_stream(lines, lambda b: variants.word_count(b, text_col), out_root, checkpoint, ["word"], **kw)


def running_table(out_root: str) -> PartTable:
    """Per word the count emitted last: a later batch's row replaces the earlier one."""
    return PartTable(f"{out_root.rstrip('/')}/table", lambda rows: merge.latest_by_key(rows, ["word"], "batch_id"),
                     bucket_part(["word"]))


def running_word_count_stream(lines: DataFrame, out_root: str, checkpoint: str, text_col: str = "text",
                              available_now: bool = False, interval: str | None = None,
                              state_partitions: int | None = None) -> StreamingQuery:
    """X2 as the running count: state per word, and a batch emits only the words whose count changed (update mode).

    The rows of a batch are kept under ``<out_root>/changes`` and replace those of
    their words in ``running_table``.
    """
    root = out_root.rstrip("/")

    def run_batch(batch: DataFrame, batch_id: int) -> None:
        batch.select("word", "n", F.lit(batch_id).cast("bigint").alias("batch_id")) \
            .write.mode("overwrite").parquet(_batch_dir(f"{root}/changes", batch_id))
        changed = batch.sparkSession.read.schema("word STRING, n BIGINT, batch_id BIGINT").parquet(
            _batch_dir(f"{root}/changes", batch_id))
        running_table(root).apply(changed, batch_id)

    w = variants.word_count(lines, text_col).writeStream.outputMode("update").foreachBatch(run_batch) \
        .option("checkpointLocation", checkpoint)
    return _start(_trigger(w, available_now, interval), lines.sparkSession, state_partitions)


def read_state(spark: SparkSession, checkpoint: str, variable: str | None = None) -> DataFrame:
    """The state of a stateful query as a table, as of its last batch (key, value, partition_id).

    ``variable`` names one state variable of a query with keyed state of its own.
    """
    reader = spark.read.format("statestore")
    return (reader.option("stateVarName", variable) if variable else reader).load(checkpoint)


def state_layout(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The stateful operators of a checkpoint: name, partitions, first and last batch."""
    return spark.read.format("state-metadata").load(checkpoint).select(
        "operatorId", "operatorName", "stateStoreName", "numPartitions", "minBatchId", "maxBatchId")


def stream_load_stream(source: DataFrame, checkpoint: str, out_root: str | None = None,
                       senders: list | None = None, shards: int = 2,
                       batch_rows: int = envelope.BATCH_ROWS, table: str = "app",
                       provider=None, uniqueid=None, shard=None,
                       available_now: bool = False, interval: str | None = None) -> StreamingQuery:
    """T6 -> T7 -> T8 -> K4/A6 as one job (the synthetic-event pipeline).

    The events are cut into envelopes of at most ``batch_rows`` rows in one pass over
    all shards, labelled ``<table>-<batch id>-<shard>-<partition>-<chunk>``.  T7 draws
    random ids and labels name the partition that cut them, so a batch's (label,
    body) rows are stored once, under ``<out_root>/batch_id=<id>`` or beside the
    checkpoint, and read back: a replayed batch, also one on another number of
    cores, sends equal labels with equal bodies.  ``senders[shard](label, body)`` run
    in the tasks.  A batch that was sent completely is marked and not sent again;
    one that failed half-way is sent again under the same labels, which the
    receiver applies once.  ``provider``/``uniqueid``/``shard`` override T7's random columns.
    """
    from lograft.sinks.stream_load import send_envelopes
    base = (out_root or checkpoint).rstrip("/")
    cut, sent = Mark(f"{base}_marks/cut"), Mark(f"{base}_marks/sent")

    def run_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        bodies = _batch_dir(out_root, batch_id) if out_root else f"{base}_bodies/slot={batch_id % 2}"
        if not cut.holds(spark, batch_id):
            events = stockcodes.synthetic_events(stockcodes.stockcode_pairs(batch), provider=provider, uniqueid=uniqueid,
                                                 shard=shard, shards=shards).select("shard", "payload")
            envelope.partition_envelopes(events, batch_rows=batch_rows, label_prefix=f"{table}-{batch_id}", shard_col="shard") \
                .write.mode("overwrite").partitionBy("shard").parquet(bodies)
            cut.set(spark, batch_id)
        if senders and not sent.holds(spark, batch_id):
            send_envelopes(read_if_there(spark, bodies, "label STRING, body STRING, shard INT"), senders)
            sent.set(spark, batch_id)

    w = source.writeStream.foreachBatch(run_batch).option("checkpointLocation", checkpoint)
    return _trigger(w, available_now, interval).start()


def routine_load_stream(source: DataFrame, parse, out_root: str, checkpoint: str,
                        not_null: list[str] | None = None,
                        max_bytes: dict[str, int] | None = None,
                        sum_keys: list[str] | None = None, measure: str = "total_number",
                        available_now: bool = False, interval: str | None = None) -> StreamingQuery:
    """Continuous load of a text topic into a table (S2/S3 + M1/M4, or A5).

    ``parse`` maps the ``value`` frame to typed columns (``parse_csv_lines``
    or ``parse_json_lines``, with ``bad="flag"`` so that malformed lines are kept
    as rejects).  Malformed lines and rows failing the constraints go to
    ``<out_root>/rejects``.  Without ``sum_keys`` the table keeps duplicates
    (``<out_root>/table/batch_id=<id>``); with them it is a SUM table
    (``read_sum_table``).
    """
    root = out_root.rstrip("/")

    def run_batch(batch: DataFrame, batch_id: int) -> None:
        parsed = parse(batch)
        flagged = "reject_reason" in parsed.columns
        rows = merge.check_constraints(parsed.withColumnRenamed("reject_reason", "_parse") if flagged else parsed,
                                       not_null, max_bytes)
        if flagged:
            rows = rows.withColumn("reject_reason", F.coalesce("_parse", "reject_reason")).drop("_parse")
        rows = rows.persist()
        try:
            rows.where(F.col("reject_reason").isNotNull()) \
                .write.mode("overwrite").parquet(_batch_dir(f"{root}/rejects", batch_id))
            good = rows.where(F.col("reject_reason").isNull()).drop("reject_reason", "line")
            if sum_keys:
                sums = good.groupBy(*sum_keys).agg(F.sum(F.coalesce(F.col(measure).cast("bigint"), F.lit(0))).alias(measure))
                sum_table(root, sum_keys, measure).apply(sums, batch_id)
            else:
                good.write.mode("overwrite").parquet(_batch_dir(f"{root}/table", batch_id))
        finally:
            rows.unpersist()

    w = source.writeStream.foreachBatch(run_batch).option("checkpointLocation", checkpoint)
    return _trigger(w, available_now, interval).start()


def read_sum_table(spark: SparkSession, out_root: str, keys: list[str],
                   measure: str = "total_number") -> DataFrame:
    """A SUM (aggregate-key) table loaded by ``routine_load_stream`` or ``sums_stream``."""
    return sum_table(out_root, keys, measure).read(spark)


def unique_table(out_root: str, keys: list[str], seq_col: str) -> PartTable:
    """A unique-key table (M2): the row with the highest ``seq_col`` replaces the others of its key."""
    return PartTable(f"{out_root.rstrip('/')}/table", lambda rows: merge.latest_by_key(rows, keys, seq_col),
                     bucket_part(keys))


def upsert_stream(rows: DataFrame, out_root: str, checkpoint: str, keys: list[str], seq_col: str,
                  available_now: bool = False, interval: str | None = None) -> StreamingQuery:
    """M2 in a stream: every batch is reduced to one row per key and merged into a stored unique-key table.

    Only the key buckets that the batch touches are read and written.  Order of
    arrival does not matter.
    """
    table = unique_table(out_root, keys, seq_col)

    def run_batch(batch: DataFrame, batch_id: int) -> None:
        table.apply(table.merge(batch), batch_id)

    w = rows.writeStream.foreachBatch(run_batch).option("checkpointLocation", checkpoint)
    return _trigger(w, available_now, interval).start()
