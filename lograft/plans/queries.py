"""Registered queries: each ``(spark, sf_dir) -> DataFrame`` over the given tables.

Log-message queries render messages from ``events`` (``sources.messages``)
and run the real operator over the text.  Output columns are aliased to the
names used by ``plans.oracle``; dates are rendered ``yyyy-MM-dd`` and window
starts as epoch seconds so results do not depend on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lograft.functions import sqlfunctions
from lograft.operators import documents, envelope, handover, merge, records, rollup, rows, search, \
    stockcodes, variants
from lograft.session import scratch_path, table_path
from lograft.sinks.files import write_csv
from lograft.sources import files, jdbc
from lograft.sources.messages import load_messages

AS_OF = "2024-01-15"
PROVIDER_TEXT = "2024-01-15 00:00:00"
ROUTINE_LOAD_JSONPATHS = {"user_id": ("$.user_id", "bigint"),
                          "name": ("$.name", "string"),
                          "age": ("$.age", "int")}


def _day_text(c="day"):
    return F.date_format(F.col(c), "yyyy-MM-dd").alias(c)


def _table(spark, sf_dir, name):
    return spark.read.parquet(table_path(sf_dir, name))


def search_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    msgs = load_messages(spark, sf_dir).select("msg_id", "value", "day")
    recs = records.explode_records(msgs)
    return search.normalize_search(recs, day=F.col("day"))


def stock_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    msgs = load_messages(spark, sf_dir).select("msg_id", "value", "arrival")
    return stockcodes.stockcode_pairs(msgs)


def deterministic_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T7 with testable columns: shard = pmod(msg_id, 2), fixed provider."""
    pairs = stock_pairs(spark, sf_dir)
    return stockcodes.synthetic_events(
        pairs, provider=F.lit(PROVIDER_TEXT),
        uniqueid=F.concat(F.lit("K"), F.col("msg_id").cast("string")),
        shard=F.pmod(F.col("msg_id"), F.lit(2)))


# ---------------------------------------------------------------- T1-T9
def q_log_records(spark, sf_dir):
    msgs = load_messages(spark, sf_dir).select("msg_id", "value")
    return records.explode_records(msgs)


def q_log_kv(spark, sf_dir):
    return records.explode_pairs(q_log_records(spark, sf_dir))


def q_log_header(spark, sf_dir):
    return records.record_headers(q_log_records(spark, sf_dir))


def q_log_to_json(spark, sf_dir):
    msgs = load_messages(spark, sf_dir).select("msg_id", "value")
    return documents.explode_documents(documents.log_to_json(msgs))


def q_log_rejects(spark, sf_dir):
    msgs = load_messages(spark, sf_dir).select("msg_id", "value")
    return documents.log_rejects(msgs).select("msg_id", "first_bad")


def q_stockcode_pairs(spark, sf_dir):
    return stock_pairs(spark, sf_dir).select("msg_id", "stockcode", "n")


def q_synthetic_events(spark, sf_dir):
    """T7 draws at random: per message the number of payloads and whether each has the right shape."""
    ev = stockcodes.synthetic_events(stock_pairs(spark, sf_dir))
    doc = F.from_json("payload", "uniqueid STRING, provider STRING")
    return ev.select("msg_id", "shard", doc.alias("d")).groupBy("msg_id").agg(
        F.count("*").alias("n"),
        F.every(F.col("d.uniqueid").rlike("^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$")).alias("uuid_ok"),
        F.every(F.col("d.provider").rlike(r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$")).alias("time_ok"),
        F.every(F.col("shard").between(0, 1)).alias("shard_ok"))


def q_shard_split(spark, sf_dir):
    """T8 in one pass: the shard stays a column."""
    return deterministic_payloads(spark, sf_dir).select(F.col("shard").alias("sink"), "payload")


def q_host_search_events(spark, sf_dir):
    return search_rows(spark, sf_dir).select(
        "msg_id", "rec_pos", "stockcode", "code", "usersign", "total_number", _day_text())


# ---------------------------------------------------------------- U1-U3 from SQL text
def q_sql_log_kv(spark, sf_dir):
    """T1 and T2 called in SQL alone."""
    sqlfunctions.register(spark)
    return spark.sql("""
        SELECT m.msg_id, r.rec_pos, p.line_pos, p.key, p.value
        FROM {messages} m, LATERAL log_records(m.value) r, LATERAL log_pairs(r.record) p""",
                     messages=load_messages(spark, sf_dir).select("msg_id", "value"))


def q_sql_log_header(spark, sf_dir):
    """T1 and T3 called in SQL alone."""
    sqlfunctions.register(spark)
    return spark.sql("""
        SELECT msg_id, rec_pos, h.header_ok, h.logtype, h.uniquestr FROM (
          SELECT m.msg_id, r.rec_pos, log_header(r.record) AS h FROM {messages} m, LATERAL log_records(m.value) r)""",
                     messages=load_messages(spark, sf_dir).select("msg_id", "value"))


# ---------------------------------------------------------------- A1-A6
def q_stockcode_count_60s(spark, sf_dir):
    c = rollup.count_by_window(stock_pairs(spark, sf_dir), "arrival", "stockcode")
    return c.select(F.unix_seconds("window_start").alias("window_start"), "stockcode", "n")


def q_stockcode_latest_count(spark, sf_dir):
    c = rollup.count_by_window(stock_pairs(spark, sf_dir), "arrival", "stockcode")
    latest = rollup.latest_window_count(c)
    return latest.select("stockcode", "n",
                         (F.unix_seconds("window_end") - 60).alias("window_start"))


def q_hot_stock_daily(spark, sf_dir):
    return rollup.hot_stock_daily(search_rows(spark, sf_dir)).select(
        "stock_code", _day_text(), "total_number")


def q_active_user_daily(spark, sf_dir):
    return rollup.active_user_daily(search_rows(spark, sf_dir)).select(
        "usersign", _day_text(), "total_number")


def q_sum_merge(spark, sf_dir):
    """A5: stored sums from even messages, merged with the odd messages' rows."""
    rows_ = search_rows(spark, sf_dir).where(F.col("stockcode").isNotNull())
    even = F.pmod(F.col("msg_id"), F.lit(2)) == 0
    stored = rollup.daily_sum(rows_.where(even), "stockcode", "stock_code")
    batch = rows_.where(~even).select(F.col("stockcode").alias("stock_code"), "day",
                                      "total_number")
    merged = rollup.sum_merge(stored, batch, ["stock_code", "day"])
    return merged.select("stock_code", _day_text(), "total_number")


def q_stream_load_batches(spark, sf_dir):
    """Per shard, bodies of <= 10,000 rows; flattened back for the check."""
    env = envelope.partition_envelopes(deterministic_payloads(spark, sf_dir), label_prefix="app", shard_col="shard")
    flat = envelope.flatten_envelopes(env, row_schema="struct<uniqueid: string, provider: string>")
    return flat.select("shard", "uniqueid", "provider", (F.col("n_rows") <= envelope.BATCH_ROWS).alias("envelope_ok"))


# ---------------------------------------------------------------- M1-M4
def q_unique_upsert(spark, sf_dir):
    """M2: events as upserts keyed by user_id (later event_id replaces)."""
    ev = _table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "ts")
    cut = F.col("ts") < F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    cols = ["user_id", "event_id", "event_type"]
    current = merge.latest_by_key(ev.where(cut).select(*cols), ["user_id"], "event_id")
    return merge.upsert_latest(current, ev.where(~cut).select(*cols), ["user_id"], "event_id")


def q_append_duplicates(spark, sf_dir):
    """M1: the same rows appended twice stay twice."""
    table = scratch_path(spark, "duplicate_table")
    for _ in range(2):
        merge.append(_routine_rows(spark, sf_dir), table)
    return spark.read.parquet(table)


def q_daily_retention(spark, sf_dir):
    kept, _ = merge.retention_split(rollup.hot_stock_daily(search_rows(spark, sf_dir)), AS_OF)
    return kept.select("stock_code", _day_text(), "total_number")


def q_load_constraints(spark, sf_dir):
    r = search_rows(spark, sf_dir).select("msg_id", "rec_pos",
                                          F.col("stockcode").alias("stock_code"), "day")
    return merge.check_constraints(r, not_null=["stock_code", "day"],
                                   max_bytes={"stock_code": 128}) \
        .select("msg_id", "rec_pos", "reject_reason")


# ---------------------------------------------------------------- S / K / T10-T11
def _routine_rows(spark, sf_dir):
    return _table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("age"))


def q_csv_ingest(spark, sf_dir):
    lines = files.render_csv_lines(_routine_rows(spark, sf_dir), ["user_id", "name", "age"])
    return files.parse_csv_lines(lines)


def q_json_ingest(spark, sf_dir):
    lines = files.render_json_lines(_routine_rows(spark, sf_dir), ["user_id", "name", "age"])
    return files.parse_json_lines(lines, ROUTINE_LOAD_JSONPATHS)


def _malformed(lines, key):
    """Every fifth line broken: a bad number, a missing column or a column too many."""
    broken = (F.when(F.col(key) % 15 == 0, F.regexp_replace("value", r"(\d+)(\}?)$", "x$1$2"))
              .when(F.col(key) % 15 == 5, F.regexp_replace("value", r",[^,]*$", ""))
              .when(F.col(key) % 15 == 10, F.concat("value", F.lit(",extra"))))
    return lines.select(F.coalesce(broken, F.col("value")).alias("value"))


def q_csv_ingest_rejects(spark, sf_dir):
    """Malformed lines among good ones: all become rejects with their text."""
    rows = _routine_rows(spark, sf_dir)
    lines = rows.select("user_id", F.to_csv(F.struct("user_id", "name", "age")).alias("value"))
    return files.parse_csv_lines(_malformed(lines, "user_id"), bad="flag").where(
        F.col("reject_reason").isNotNull()).select("line", "reject_reason")


def q_json_ingest_rejects(spark, sf_dir):
    """S3: bad values and broken documents become rejects; the load goes on."""
    rows = _routine_rows(spark, sf_dir)
    lines = rows.select("user_id", F.to_json(F.struct("user_id", "name", F.when(
        F.col("user_id") % 15 == 0, F.concat(F.lit("x"), F.col("age").cast("string")))
        .otherwise(F.col("age").cast("string")).alias("age"))).alias("value"))
    cut = F.when(F.col("user_id") % 15 == 5, F.expr("left(value, length(value) - 1)")).otherwise(F.col("value"))
    return files.parse_json_lines(lines.select(cut.alias("value")), ROUTINE_LOAD_JSONPATHS, bad="flag").where(
        F.col("reject_reason").isNotNull()).select("line", "reject_reason")


NESTED_JSONPATHS = {"user_id": ("$.id", "bigint"), "name": ("$.person.name", "string"),
                    "age": ("$.person.home.age", "int"), "second": ("$.tags[1].n", "bigint")}


def q_json_ingest_nested(spark, sf_dir):
    """S3 with nested paths and an array index; broken documents and bad values are flagged, a missing element is null."""
    c = _table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    age = F.concat(F.when(key % 15 == 0, F.lit("x")).otherwise(F.lit("")), F.col("c_nationkey").cast("string"))
    tags = F.array(F.struct(key.alias("n")), F.struct((key * 2).alias("n")))
    lines = c.select(key, F.to_json(F.struct(
        key.alias("id"), F.struct(F.col("c_name").alias("name"), F.struct(age.alias("age")).alias("home")).alias("person"),
        F.when(key % 15 == 10, F.slice(tags, 1, 1)).otherwise(tags).alias("tags"))).alias("value"))
    cut = F.when(key % 15 == 5, F.expr("left(value, length(value) - 1)")).otherwise(F.col("value"))
    return files.parse_json_lines(lines.select(cut.alias("value")), NESTED_JSONPATHS, bad="flag").select(
        *NESTED_JSONPATHS, "reject_reason")


JDBC_SPLITS = 16


def q_jdbc_split_plan(spark, sf_dir):
    """S4 planner on a skewed key with nulls: rows per key and how many rows the planned ranges read."""
    o = F.col("o_orderkey")
    keys = _table(spark, sf_dir, "orders").select(
        F.when(o % 7 != 0, (o % 1000) * (o % 1000) * (o % 1000)).alias("key"))
    plan = jdbc.equi_depth_predicates(keys, "key", JDBC_SPLITS)
    reads = sum((F.coalesce(F.expr(p).cast("int"), F.lit(0)) for p in plan), F.lit(0))
    return keys.select("key", reads.alias("reads")).groupBy("key").agg(
        F.count("*").alias("n_rows"), F.sum("reads").alias("n_read"))


def q_csv_project(spark, sf_dir):
    """S5 -> T11 -> K5: CSV table, SQL projection, CSV result, read back."""
    src = scratch_path(spark, "csv_table")
    out = scratch_path(spark, "csv_result")
    li = _table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("a"), F.col("l_linenumber").alias("b"),
        F.col("l_orderkey").cast("int").alias("c"), F.col("l_partkey").cast("int").alias("d"),
        F.col("l_extendedprice").cast("decimal(20,6)").alias("e"))
    write_csv(li, src, mode="overwrite")
    table = files.read_csv_table(spark, src, view=None)
    result = rows.project_sql(spark, table, "test_table", rows.CSV_PROJECT_SQL)
    write_csv(result, out, mode="overwrite")
    back = spark.read.schema("sum_e DECIMAL(20,6)").option("header", "false").csv(out)
    return back.select(F.col("sum_e").cast("string").alias("sum_e"))


def q_jdbc_age_increment(spark, sf_dir):
    """T10 over the S4 row type; the table after the job is source + copies.

    The JDBC hop itself (S4 read, K2 insert) needs a database, which may not
    be started here; the frame stands in for ``SELECT id, name, age``.
    """
    src = _routine_rows(spark, sf_dir).select(F.col("user_id").alias("id"), "name", "age")
    inc = rows.age_increment(src)
    copies = inc.where(F.col("reject_reason").isNull()).select("name", "age")
    return src.select("name", "age").unionByName(copies)


# ---------------------------------------------------------------- X1, X2, X4
def q_event_count_5min(spark, sf_dir):
    ev = _table(spark, sf_dir, "events").select("ts", "event_type")
    c = variants.event_count(ev, "ts", "event_type", "5 minutes")
    return c.select(F.col("window_start").cast("string").alias("window_start"),
                    "event_type", "n")


def q_word_count(spark, sf_dir):
    return variants.word_count(_table(spark, sf_dir, "documents").select("text"))


def q_labelled_load(spark, sf_dir):
    """The same envelopes offered twice; the ledger lets each load once."""
    env = envelope.partition_envelopes(deterministic_payloads(spark, sf_dir), label_prefix="app", shard_col="shard")
    # Persist once in the shared checkpoint folder: both offers see the same labels.
    env = env.checkpoint(eager=True)
    ledger = spark.createDataFrame([], "label string")
    first, ledger = envelope.labelled_load(env, ledger)
    second, _ = envelope.labelled_load(env, ledger)
    sent = first.unionByName(second)
    flat = envelope.flatten_envelopes(sent, row_schema="struct<uniqueid: string, provider: string>")
    return flat.select("shard", "uniqueid", "provider")


def q_keyed_handover(spark, sf_dir):
    """The payloads of every shard as one gapless sequence in message order."""
    out = handover.keyed_sequence(deterministic_payloads(spark, sf_dir).select("shard", "msg_id", "piece_pos", "payload"),
                                  "shard", ["msg_id", "piece_pos"])
    return out.select("shard", "seq", "payload")


BATCH_QUERIES = {
    "log_records": q_log_records,
    "log_kv": q_log_kv,
    "log_header": q_log_header,
    "log_to_json": q_log_to_json,
    "log_rejects": q_log_rejects,
    "stockcode_pairs": q_stockcode_pairs,
    "synthetic_events": q_synthetic_events,
    "shard_split": q_shard_split,
    "host_search_events": q_host_search_events,
    "stockcode_count_60s": q_stockcode_count_60s,
    "stockcode_latest_count": q_stockcode_latest_count,
    "hot_stock_daily": q_hot_stock_daily,
    "active_user_daily": q_active_user_daily,
    "sum_merge": q_sum_merge,
    "stream_load_batches": q_stream_load_batches,
    "append_duplicates": q_append_duplicates,
    "unique_upsert": q_unique_upsert,
    "daily_retention": q_daily_retention,
    "load_constraints": q_load_constraints,
    "csv_ingest": q_csv_ingest,
    "json_ingest": q_json_ingest,
    "csv_ingest_rejects": q_csv_ingest_rejects,
    "json_ingest_rejects": q_json_ingest_rejects,
    "csv_project": q_csv_project,
    "jdbc_age_increment": q_jdbc_age_increment,
    "event_count_5min": q_event_count_5min,
    "word_count": q_word_count,
    "labelled_load": q_labelled_load,
    "sql_log_kv": q_sql_log_kv,
    "sql_log_header": q_sql_log_header,
    "json_ingest_nested": q_json_ingest_nested,
    "jdbc_split_plan": q_jdbc_split_plan,
    "keyed_handover": q_keyed_handover,
}
