"""Registered streaming queries: run a bounded stream, return its sink as a frame.

Each query renders messages from ``events`` into a parquet folder under the
shared checkpoint folder, runs the streaming job on it with an
``availableNow`` trigger, and reads back what the sink committed.  Results
must equal the batch twin, so the batch twin's oracle checks them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lograft.operators import documents, envelope, stockcodes
from lograft.plans.queries import AS_OF, PROVIDER_TEXT
from lograft.session import scratch_path, table_path
from lograft.sources.kafka import parquet_text_stream
from lograft.sources.messages import load_messages
from lograft.sinks import load_table
from lograft.streaming import accounting, buffer, etime, jobs

MESSAGE_SCHEMA = "msg_id BIGINT, value STRING, arrival TIMESTAMP, day DATE"


#: ``stage_messages`` adds another set of ``files`` for every so many events.
SET_EVENTS = 100_000


def file_sets(spark: SparkSession, sf_dir: str) -> int:
    """How many times its ``files`` ``stage_messages`` writes: the files stay of one size as the input grows.

    A trigger that takes that many times the files has as many batches over any input, and
    each batch has files for all cores, where one ever larger file would be one task's work.
    """
    return max(-(-spark.read.parquet(table_path(sf_dir, "events")).count() // SET_EVENTS), 1)


def stage_messages(spark: SparkSession, sf_dir: str, dest: str, files: int = 4,
                   halves: bool = False) -> list:
    """Render messages into the stream source folder ``dest``.

    Returns callables that each append one slice (``files`` files for each of
    ``file_sets``); with ``halves`` the two slices hold the lower and upper
    msg_id half, so a restart test can feed one, run, then feed the other.  The
    msg_id predicate is pushed through the message aggregate into the scan, so
    each slice reads only its own events.
    """
    msgs, sets = load_messages(spark, sf_dir), file_sets(spark, sf_dir)

    def write(frame, n):
        return lambda: frame.repartition(n * sets).write.mode("append").parquet(dest)

    if not halves:
        return [write(msgs, files)]
    top = spark.read.parquet(table_path(sf_dir, "events")).agg(F.max("event_id")).first()[0]
    mid = (int(top or 0) // 3) // 2
    return [write(msgs.where(F.col("msg_id") <= mid), max(files // 2, 1)),
            write(msgs.where(F.col("msg_id") > mid), max(files // 2, 1))]


def _run(q) -> None:
    q.awaitTermination()
    if q.exception():
        raise RuntimeError(str(q.exception()))


def q_stream_log_to_json(spark, sf_dir) -> DataFrame:
    src, sink, ck = (scratch_path(spark, n) for n in ("w7_src", "w7_sink", "w7_ck"))
    for feed in stage_messages(spark, sf_dir, src):
        feed()
    stream = parquet_text_stream(spark, src, MESSAGE_SCHEMA).select("msg_id", "value")
    _run(jobs.log_to_json_stream(stream, sink, ck, available_now=True))
    out = spark.read.parquet(sink).withColumnRenamed("value", "json")
    return documents.explode_documents(out)


def q_stream_log_rejects(spark, sf_dir) -> DataFrame:
    """T5/X6 in a stream: the messages that ``stream_log_to_json`` does not accept."""
    src, sink, ck = (scratch_path(spark, n) for n in ("x6_src", "x6_sink", "x6_ck"))
    for feed in stage_messages(spark, sf_dir, src):
        feed()
    stream = parquet_text_stream(spark, src, MESSAGE_SCHEMA).select("msg_id", "value")
    _run(jobs.log_rejects_stream(stream, sink, ck, available_now=True))
    return spark.read.parquet(sink).select("msg_id", "first_bad")


def q_stream_accounting(spark, sf_dir) -> DataFrame:
    """What became of every message and stock-code line, added up over the batches,
    and how many batches do not balance."""
    src, out, ck = (scratch_path(spark, n) for n in ("acc_src", "acc_out", "acc_ck"))
    for feed in stage_messages(spark, sf_dir, src, halves=True):  # a restart between the halves
        feed()
        stream = parquet_text_stream(spark, src, MESSAGE_SCHEMA, max_files_per_trigger=file_sets(spark, sf_dir)).select("msg_id", "value")
        _run(accounting.accounted_stream(
            stream, out, ck, available_now=True, provider=F.lit(PROVIDER_TEXT),
            uniqueid=F.concat(F.lit("K"), F.col("msg_id").cast("string")), shard=F.pmod(F.col("msg_id"), F.lit(2))))
    ledger = accounting.read_accounting(spark, out)
    odd = accounting.out_of_balance(ledger).agg(F.count("*").alias("n"))
    return ledger.groupBy("kind", "outcome").agg(F.sum("n").alias("n")).unionByName(
        odd.select(F.lit("batch").alias("kind"), F.lit("out_of_balance").alias("outcome"), "n"))


def _host_search(spark, sf_dir, restart: bool, as_of: str | None = None):
    src, out, ck = (scratch_path(spark, n) for n in ("w8_src", "w8_out", "w8_ck"))
    for feed in stage_messages(spark, sf_dir, src, halves=restart):
        feed()
        stream = parquet_text_stream(spark, src, MESSAGE_SCHEMA, max_files_per_trigger=2 * file_sets(spark, sf_dir)) \
            .select("msg_id", "value", "day")
        _run(jobs.host_search_stream(stream, out, ck, day_col="day", as_of=as_of, available_now=True,
                                     sink_partitions=2))
    return out


def q_stream_host_search(spark, sf_dir) -> DataFrame:
    out = _host_search(spark, sf_dir, restart=False)
    ev = spark.read.parquet(f"{out}/events")
    return ev.select("msg_id", "rec_pos", "stockcode", "code", "usersign", "total_number",
                     F.date_format("day", "yyyy-MM-dd").alias("day"))


def q_stream_hot_stock_daily(spark, sf_dir) -> DataFrame:
    out = _host_search(spark, sf_dir, restart=False)
    return jobs.read_rollup(spark, out, "hot_stock_code").select(
        "stock_code", F.date_format("day", "yyyy-MM-dd").alias("day"), "total_number")


def q_stream_daily_retention(spark, sf_dir) -> DataFrame:
    """M3 in a stream: days outside the window go to the rejects of their batch."""
    out = _host_search(spark, sf_dir, restart=False, as_of=AS_OF)
    return jobs.read_rollup(spark, out, "hot_stock_code").select(
        "stock_code", F.date_format("day", "yyyy-MM-dd").alias("day"), "total_number")


def q_stream_active_user_daily(spark, sf_dir) -> DataFrame:
    out = _host_search(spark, sf_dir, restart=False)
    return jobs.read_rollup(spark, out, "active_user").select(
        "usersign", F.date_format("day", "yyyy-MM-dd").alias("day"), "total_number")


def q_stream_resume(spark, sf_dir) -> DataFrame:
    """Stop after half the files, restart on the same checkpoint."""
    out = _host_search(spark, sf_dir, restart=True)
    ev = spark.read.parquet(f"{out}/events")
    return ev.select("msg_id", "rec_pos", "stockcode", "code", "usersign", "total_number",
                     F.date_format("day", "yyyy-MM-dd").alias("day"))


def _count_60s(spark, sf_dir, latest: bool = False) -> str:
    """The upper half is fed first: arrival order must not matter."""
    src, out, ck = (scratch_path(spark, n) for n in ("w1_src", "w1_out", "w1_ck"))
    for feed in reversed(stage_messages(spark, sf_dir, src, halves=True)):
        feed()
        stream = parquet_text_stream(spark, src, MESSAGE_SCHEMA).select("value", "arrival")
        _run(jobs.count_60s_stream(stream, out, ck, available_now=True, latest=latest))
    return out


#: A message later than all others: its arrival closes their windows, its own stays open.
LAST_WORD = "stockcode=last\n"


def q_stream_count_to_jdbc(spark, sf_dir) -> DataFrame:
    """K2 in a stream, the upper half first: every 60 s window becomes one inserted row
    ``(name, age) = (code, count)`` when it closes.  What comes for a window after that is a
    correction in a table of its own; ``age`` is the inserted number with its corrections.
    The JDBC writer cannot run here (no database may be started), so the rows that it
    would be given go to a stand-in table."""
    src, out, ck, table = (scratch_path(spark, n) for n in ("k2_src", "k2_out", "k2_ck", "k2_table"))

    def insert(rows):
        rows.select("window_start", F.col("key").alias("name"), F.col("n").cast("int").alias("age")).write.mode("append").parquet(table)

    def last():
        late = spark.read.schema(MESSAGE_SCHEMA).parquet(src).agg(F.max("arrival").alias("arrival"))
        late.select(F.lit(-1).cast("bigint").alias("msg_id"), F.lit(LAST_WORD).alias("value"),
                    F.expr("arrival + interval 1 day").alias("arrival"), F.lit(None).cast("date").alias("day")) \
            .write.mode("append").parquet(src)

    for feed in [*reversed(stage_messages(spark, sf_dir, src, halves=True)), last]:
        feed()
        stream = parquet_text_stream(spark, src, MESSAGE_SCHEMA).select("value", "arrival")
        _run(jobs.window_inserts_stream(stream, out, ck, insert, available_now=True, state_partitions=4))
    inserted = spark.read.parquet(table)
    corrections = etime.read_windows(spark, out).where("late").select(
        "window_start", F.col("key").alias("name"), F.col("n").cast("int").alias("age"))
    return inserted.unionByName(corrections).groupBy("window_start", "name").agg(F.sum("age").cast("int").alias("age")) \
        .select("name", "age")


def q_stream_count_60s(spark, sf_dir) -> DataFrame:
    c = jobs.read_counts(spark, _count_60s(spark, sf_dir))
    return c.select(F.unix_seconds("window_start").alias("window_start"), "stockcode", "n")


def q_stream_latest_count(spark, sf_dir) -> DataFrame:
    """K3/A2 in a stream: each code's value in the merged table is replaced by its latest window."""
    latest = jobs.latest_table(_count_60s(spark, sf_dir, latest=True)).read(spark)
    return latest.select("stockcode", "n",
                         (F.unix_seconds("window_end") - 60).alias("window_start"))


def q_stream_shard_load(spark, sf_dir) -> DataFrame:
    """W: T6 -> T7 -> T8 -> K4 in one stream; envelopes flattened back."""
    src, out, ck = (scratch_path(spark, n) for n in ("k4_src", "k4_out", "k4_ck"))
    for feed in stage_messages(spark, sf_dir, src):
        feed()
    stream = parquet_text_stream(spark, src, MESSAGE_SCHEMA, max_files_per_trigger=2 * file_sets(spark, sf_dir)) \
        .select("msg_id", "value")
    _run(jobs.stream_load_stream(
        stream, ck, out_root=out, available_now=True,
        provider=F.lit(PROVIDER_TEXT),
        uniqueid=F.concat(F.lit("K"), F.col("msg_id").cast("string")),
        shard=F.pmod(F.col("msg_id"), F.lit(2))))
    env = spark.read.parquet(out)
    flat = envelope.flatten_envelopes(env, row_schema="struct<uniqueid: string, provider: string>")
    return flat.select(F.col("shard").cast("int").alias("shard"), "uniqueid", "provider",
                       (F.col("n_rows") <= envelope.BATCH_ROWS).alias("envelope_ok"))


def _stage_table(spark, sf_dir, name, dest, split_col, cut, cols):
    """Append a table into a stream source folder in two ordered halves."""
    t = spark.read.parquet(table_path(sf_dir, name)).select(*cols)
    return [lambda: t.where(F.col(split_col) < F.lit(cut)).write.mode("append").parquet(dest),
            lambda: t.where(F.col(split_col) >= F.lit(cut)).write.mode("append").parquet(dest)]


def q_stream_event_count_5min(spark, sf_dir) -> DataFrame:
    """X1 in a stream: the later half of the events first, restart in between."""
    src, out, ck = (scratch_path(spark, n) for n in ("x1_src", "x1_out", "x1_ck"))
    schema = "ts TIMESTAMP_NTZ, event_type STRING"
    cut = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    for feed in reversed(_stage_table(spark, sf_dir, "events", src, "ts", cut, ["ts", "event_type"])):
        feed()
        stream = spark.readStream.schema(schema).parquet(src)
        _run(jobs.event_count_stream(stream, out, ck, available_now=True))
    c = jobs.read_sum_table(spark, out, ["window_start", "event_type"], "n")
    return c.select(F.col("window_start").cast("timestamp_ntz").cast("string").alias("window_start"),
                    "event_type", "n")


def q_stream_event_windows(spark, sf_dir) -> DataFrame:
    """X1 with windows emitted once by event-time timers, the later half of the events first:
    emitted counts with their corrections.  A last event, a day later, closes all windows but its own."""
    src, out, ck = (scratch_path(spark, n) for n in ("xw_src", "xw_out", "xw_ck"))
    cut = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    events = spark.read.parquet(table_path(sf_dir, "events"))

    def last():
        events.agg(F.max("ts").alias("ts")).select(F.expr("ts + interval 1 day").alias("ts"), F.lit("last").alias("event_type")) \
            .write.mode("append").parquet(src)

    for feed in [*reversed(_stage_table(spark, sf_dir, "events", src, "ts", cut, ["ts", "event_type"])), last]:
        feed()
        stream = spark.readStream.schema("ts TIMESTAMP_NTZ, event_type STRING").parquet(src)
        _run(etime.windows_stream(stream, out, ck, "ts", "event_type", 300_000, available_now=True, state_partitions=4))
    return etime.corrected_windows(spark, out).select(
        F.timestamp_millis("window_start").cast("timestamp_ntz").cast("string").alias("window_start"),
        F.col("key").alias("event_type"), "n")


def q_stream_unique_upsert(spark, sf_dir) -> DataFrame:
    """M2 in a stream: the later half of the events first, restart in between."""
    src, out, ck = (scratch_path(spark, n) for n in ("m2_src", "m2_out", "m2_ck"))
    cols = ["user_id", "event_id", "event_type"]
    cut = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    for feed in reversed(_stage_table(spark, sf_dir, "events", src, "ts", cut, ["ts", *cols])):
        feed()
        stream = spark.readStream.schema("user_id BIGINT, event_id BIGINT, event_type STRING").parquet(src)
        _run(jobs.upsert_stream(stream, out, ck, ["user_id"], "event_id", available_now=True))
    return jobs.unique_table(out, ["user_id"], "event_id").read(spark).select(*cols)


def q_stream_word_count(spark, sf_dir) -> DataFrame:
    """X2 in a stream: running word counts over two halves of the documents."""
    src, out, ck = (scratch_path(spark, n) for n in ("x2_src", "x2_out", "x2_ck"))
    top = spark.read.parquet(table_path(sf_dir, "documents")).agg(F.max("doc_id")).first()[0]
    for feed in _stage_table(spark, sf_dir, "documents", src, "doc_id", int(top or 0) // 2,
                             ["doc_id", "text"]):
        feed()
        stream = spark.readStream.schema("doc_id BIGINT, text STRING").parquet(src)
        _run(jobs.word_count_stream(stream.select("text"), out, ck, available_now=True))
    return jobs.read_sum_table(spark, out, ["word"], "n").select("word", "n")


def _running_words(spark, sf_dir) -> tuple[str, str]:
    """The running word count over two halves of the documents, restarted in between."""
    src, out, ck = (scratch_path(spark, n) for n in ("xr_src", "xr_out", "xr_ck"))
    top = spark.read.parquet(table_path(sf_dir, "documents")).agg(F.max("doc_id")).first()[0]
    for feed in _stage_table(spark, sf_dir, "documents", src, "doc_id", int(top or 0) // 2, ["doc_id", "text"]):
        feed()
        stream = spark.readStream.schema("doc_id BIGINT, text STRING").parquet(src)
        _run(jobs.running_word_count_stream(stream.select("text"), out, ck, available_now=True))
    return out, ck


def q_stream_running_word_count(spark, sf_dir) -> DataFrame:
    """X2 as a running count: only changed words are emitted; the last value of each word."""
    out, _ = _running_words(spark, sf_dir)
    return jobs.running_table(out).read(spark).select("word", "n")


def q_stream_state_audit(spark, sf_dir) -> DataFrame:
    """The running counts read from the checkpoint's state."""
    _, ck = _running_words(spark, sf_dir)
    return jobs.read_state(spark, ck).select(F.col("key.word").alias("word"), F.col("value.count").alias("n"))


def q_stream_load_sink(spark, sf_dir) -> DataFrame:
    """T6 -> T7 -> T8 -> A6 -> K4: payloads buffered across micro-batches (10,000 rows or a deadline),
    bodies published by the load sink; flattened back."""
    import time
    src, out, ck = (scratch_path(spark, n) for n in ("ls_src", "ls_out", "ls_ck"))
    for feed in stage_messages(spark, sf_dir, src):
        feed()
    stream = parquet_text_stream(spark, src, MESSAGE_SCHEMA, max_files_per_trigger=file_sets(spark, sf_dir)).select("msg_id", "value")
    events = stockcodes.synthetic_events(
        stockcodes.stockcode_pairs(stream), provider=F.lit(PROVIDER_TEXT),
        uniqueid=F.concat(F.lit("K"), F.col("msg_id").cast("string")), shard=F.pmod(F.col("msg_id"), F.lit(2)))
    q = load_table.load_stream(buffer.buffered_envelopes(events, linger_ms=2000), out, ck, interval="500 milliseconds",
                               state_partitions=4)
    total, read = spark.read.parquet(src).count(), {}
    try:
        # timers keep the stream busy, so it is never idle: wait for all messages, then for the last deadline
        while q.isActive and sum(read.values()) < total:
            time.sleep(0.5)
            read.update({p["batchId"]: p["numInputRows"] for p in q.recentProgress})
        while q.isActive and jobs.read_state(spark, ck, "waiting").count():
            time.sleep(0.5)
        time.sleep(1)  # the batch that flushed is published
    finally:
        q.stop()
    if q.exception():
        raise RuntimeError(str(q.exception()))
    flat = envelope.flatten_envelopes(load_table.read_load(spark, out), row_schema="struct<uniqueid: string, provider: string>")
    return flat.select("shard", "uniqueid", "provider", (F.col("n_rows") <= envelope.BATCH_ROWS).alias("envelope_ok"))


def _routine_load(spark, sf_dir, fmt: str) -> DataFrame:
    from lograft.plans.queries import ROUTINE_LOAD_JSONPATHS, _routine_rows
    from lograft.sources import files
    src, out, ck = (scratch_path(spark, n) for n in (f"rl_{fmt}_src", f"rl_{fmt}_out",
                                                     f"rl_{fmt}_ck"))
    rows = _routine_rows(spark, sf_dir)
    cols = ["user_id", "name", "age"]
    lines = files.render_csv_lines(rows, cols) if fmt == "csv" else \
        files.render_json_lines(rows, cols)
    lines.write.parquet(src)
    parse = files.parse_csv_lines if fmt == "csv" else \
        (lambda df: files.parse_json_lines(df, ROUTINE_LOAD_JSONPATHS))
    _run(jobs.routine_load_stream(parquet_text_stream(spark, src, "value STRING"), parse, out, ck,
                                  not_null=["user_id"], available_now=True))
    return spark.read.parquet(f"{out}/table").select(*cols)


def q_stream_csv_ingest(spark, sf_dir) -> DataFrame:
    """S2 + M1 as a continuous load (duplicate-key table)."""
    return _routine_load(spark, sf_dir, "csv")


def q_stream_json_ingest(spark, sf_dir) -> DataFrame:
    """S3 + M1 as a continuous load with jsonpath mapping."""
    return _routine_load(spark, sf_dir, "json")


STREAM_QUERIES = {
    "stream_log_to_json": q_stream_log_to_json,
    "stream_log_rejects": q_stream_log_rejects,
    "stream_accounting": q_stream_accounting,
    "stream_host_search": q_stream_host_search,
    "stream_hot_stock_daily": q_stream_hot_stock_daily,
    "stream_daily_retention": q_stream_daily_retention,
    "stream_active_user_daily": q_stream_active_user_daily,
    "stream_resume": q_stream_resume,
    "stream_count_60s": q_stream_count_60s,
    "stream_count_to_jdbc": q_stream_count_to_jdbc,
    "stream_latest_count": q_stream_latest_count,
    "stream_shard_load": q_stream_shard_load,
    "stream_unique_upsert": q_stream_unique_upsert,
    "stream_event_count_5min": q_stream_event_count_5min,
    "stream_event_windows": q_stream_event_windows,
    "stream_word_count": q_stream_word_count,
    "stream_running_word_count": q_stream_running_word_count,
    "stream_state_audit": q_stream_state_audit,
    "stream_load_sink": q_stream_load_sink,
    "stream_csv_ingest": q_stream_csv_ingest,
    "stream_json_ingest": q_stream_json_ingest,
}

STREAM_ORACLE_TWINS = {
    "stream_log_to_json": "log_to_json",
    "stream_log_rejects": "log_rejects",
    "stream_host_search": "host_search_events",
    "stream_hot_stock_daily": "hot_stock_daily",
    "stream_daily_retention": "daily_retention",
    "stream_active_user_daily": "active_user_daily",
    "stream_resume": "host_search_events",
    "stream_count_60s": "stockcode_count_60s",
    "stream_latest_count": "stockcode_latest_count",
    "stream_shard_load": "stream_load_batches",
    "stream_unique_upsert": "unique_upsert",
    "stream_event_count_5min": "event_count_5min",
    "stream_event_windows": "event_count_5min",
    "stream_word_count": "word_count",
    "stream_running_word_count": "word_count",
    "stream_state_audit": "word_count",
    "stream_load_sink": "stream_load_batches",
    "stream_csv_ingest": "csv_ingest",
    "stream_json_ingest": "json_ingest",
}
