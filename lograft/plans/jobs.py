"""The reference's runnable jobs as end-to-end entry points.

Each job takes a plain options dict (no property-file loader) and wires a
source, the operators and a sink.  Streaming jobs return the running
``StreamingQuery``; batch jobs return when the write has committed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lograft.operators import rows
from lograft.session import scratch_path
from lograft.sinks.files import write_csv
from lograft.sinks.jdbc import write_jdbc
from lograft.sources import files
from lograft.sources.jdbc import read_jdbc
from lograft.sources.kafka import kafka_text_stream, parquet_text_stream
from lograft.streaming import accounting, jobs, ptime

# Fixed value: the source query and column subset of the JDBC job.
JDBC_SOURCE_QUERY = "SELECT id, name, age FROM {table}"
JDBC_INSERT_COLUMNS = ["name", "age"]


def jdbc_age_increment_job(spark: SparkSession, opts: dict) -> DataFrame:
    """S4 -> T10 -> K2: read ``id, name, age``, add one year, insert
    ``(name, age)`` back (the key is left to the database).

    Source and target are the same table, so the read is first written to
    the shared checkpoint folder: a retried insert task then re-reads that
    snapshot, never rows it inserted itself.  Returns the rejected rows.
    """
    url, table = opts["url"], opts.get("table", "test")
    props = {k: v for k, v in opts.items() if k in ("user", "password", "driver")}
    if opts.get("partition_column"):  # parallel range reads
        src = read_jdbc(spark, url, table=table, partition_column=opts["partition_column"],
                        lower_bound=int(opts["lower_bound"]), upper_bound=int(opts["upper_bound"]),
                        num_partitions=_number(opts, "num_partitions"), properties=props).select("id", "name", "age")
    else:
        src = read_jdbc(spark, url, query=JDBC_SOURCE_QUERY.format(table=table), properties=props)
    snap_path = scratch_path(spark, "jdbc_snapshot")
    src.write.parquet(snap_path)
    inc = rows.age_increment(spark.read.parquet(snap_path))
    write_jdbc(inc.where(F.col("reject_reason").isNull()), url, table, JDBC_INSERT_COLUMNS,
               batchsize=int(opts.get("batchsize", 1000)), properties=props)
    return inc.where(F.col("reject_reason").isNotNull())


def csv_project_job(spark: SparkSession, opts: dict) -> None:
    """S5 -> T11 -> K5: declared-schema CSV table, ``SELECT e AS sum_e``, CSV out."""
    table = files.read_csv_table(spark, opts["source"], view=None,
                                 validate_all_columns=opts.get("validate", "false") == "true")
    out = rows.project_sql(spark, table, "test_table", rows.CSV_PROJECT_SQL)
    write_csv(out, opts["target"])


def _number(opts: dict, name: str) -> int | None:
    return int(opts[name]) if opts.get(name) else None


def _source(spark: SparkSession, opts: dict) -> DataFrame:
    if opts.get("kafka.bootstrap.servers"):
        return kafka_text_stream(spark, opts["kafka.bootstrap.servers"], opts["topic"],
                                 group_id=opts.get("group.id"),
                                 starting=opts.get("startingOffsets", "latest"),
                                 min_partitions=_number(opts, "source_parallelism"),
                                 extra={"maxOffsetsPerTrigger": opts["max_offsets_per_trigger"]}
                                 if opts.get("max_offsets_per_trigger") else None)
    return parquet_text_stream(spark, opts["source"], opts.get("schema", "value STRING"))


def log_to_json_job(spark: SparkSession, opts: dict):
    """Messages -> JSON arrays -> broker topic (or files)."""
    src = _source(spark, opts).select("value")
    if opts.get("sink.kafka.bootstrap.servers"):
        return jobs.log_to_json_stream(
            src, "", opts["checkpoint"], fmt="kafka",
            sink_partitions=_number(opts, "sink_parallelism"),
            options={"kafka.bootstrap.servers": opts["sink.kafka.bootstrap.servers"],
                     "topic": opts["sink.topic"]},
            interval=opts.get("interval"))
    return jobs.log_to_json_stream(src, opts["target"], opts["checkpoint"],
                                   sink_partitions=_number(opts, "sink_parallelism"),
                                   interval=opts.get("interval"))


def log_rejects_job(spark: SparkSession, opts: dict):
    """W7's other half: messages with a bad header -> files, with a checkpoint of its own."""
    return jobs.log_rejects_stream(_source(spark, opts).select("value"), opts["target"], opts["checkpoint"],
                                   interval=opts.get("interval"))


def host_search_job(spark: SparkSession, opts: dict):
    """Search events -> normalised documents + daily rollups, and JSON rows to a topic if one is named.

    The daily tables keep seven days before and after each batch's date; ``as_of`` names
    another date, or ``none`` for no window.
    """
    as_of = opts.get("as_of", "batch")
    value_sink = None
    if opts.get("sink.kafka.bootstrap.servers"):
        def value_sink(frame, batch_id):
            (frame.write.format("kafka").option("kafka.bootstrap.servers", opts["sink.kafka.bootstrap.servers"])
             .option("topic", opts["sink.topic"]).save())
    return jobs.host_search_stream(_source(spark, opts).select("value"), opts["target"],
                                   opts["checkpoint"], as_of=None if as_of == "none" else as_of,
                                   interval=opts.get("interval", "60 seconds"),
                                   sink_partitions=_number(opts, "sink_parallelism"), value_sink=value_sink)


def count_60s_job(spark: SparkSession, opts: dict):
    """60 s stock-code counts; ``variant=ptime`` for wall-clock timers.

    With ``jdbc.url`` every window is inserted once, when it closes, as (name, age) = (code, count);
    without it the counts and each code's latest window (K3, ``<target>/latest``) are kept as tables.
    """
    src = _source(spark, opts)
    insert, by_timer = None, opts.get("variant", "arrival") == "ptime"
    key = "stockcode" if by_timer else "key"
    if opts.get("jdbc.url"):
        props = {k[5:]: v for k, v in opts.items() if k in ("jdbc.user", "jdbc.password")}

        def insert(fired):
            write_jdbc(fired.select(F.col(key).alias("name"), F.col("n").cast("int").alias("age")),
                       opts["jdbc.url"], opts.get("jdbc.table", "test"), JDBC_INSERT_COLUMNS, properties=props)
    if by_timer:
        return ptime.processing_time_count_stream(
            src.select("value"), opts["target"], opts["checkpoint"], salts=int(opts.get("salts", 1)),
            interval=opts.get("interval", "1 second"), state_partitions=_number(opts, "state_partitions"), insert=insert)
    if insert is not None:
        return jobs.window_inserts_stream(src.select("value", "arrival"), opts["target"], opts["checkpoint"], insert,
                                          delay=opts.get("delay", "0 seconds"), interval=opts.get("interval", "10 seconds"),
                                          state_partitions=_number(opts, "state_partitions"))
    return jobs.count_60s_stream(src.select("value", "arrival"), opts["target"], opts["checkpoint"],
                                 interval=opts.get("interval", "10 seconds"), latest=True)


def stream_load_job(spark: SparkSession, opts: dict):
    """T6 -> T7 -> T8 -> K4: synthetic events in envelopes, one sender per shard."""
    senders = None
    if opts.get("load_url"):
        from lograft.sinks.stream_load import http_put_sender
        senders = [http_put_sender(opts["load_url"], opts.get("user", ""), opts.get("password", ""))
                   for _ in range(2)]
    return jobs.stream_load_stream(_source(spark, opts).select("value"), opts["checkpoint"],
                                   out_root=opts.get("target"), senders=senders,
                                   table=opts.get("table", "app"),
                                   interval=opts.get("interval", "10 seconds"))


def accounting_job(spark: SparkSession, opts: dict):
    """Messages and events by shard, with the counts of every batch."""
    return accounting.accounted_stream(_source(spark, opts).select("value"), opts["target"], opts["checkpoint"],
                                       shards=int(opts.get("shards", 2)), interval=opts.get("interval", "10 seconds"))


def routine_load_job(spark: SparkSession, opts: dict):
    """A topic of CSV or JSON lines loaded into a duplicate-key or SUM table.

    ``format=csv`` (``columns`` DDL, ``sep``) or ``format=json`` with
    ``jsonpaths`` as a JSON list aligned with the ``columns`` DDL (renaming
    by position).  ``not_null=a,b``, ``max_bytes=name:20``; ``sum_keys=k,day``
    with ``measure`` makes a SUM table.
    """
    import json as _json

    from pyspark.sql.types import _parse_datatype_string
    ddl = opts.get("columns", files.ROUTINE_LOAD_DDL)
    if opts.get("format", "csv") == "json":
        fields = _parse_datatype_string(ddl).fields
        paths = _json.loads(opts["jsonpaths"]) if opts.get("jsonpaths") else \
            [f"$.{f.name}" for f in fields]
        mapping = {f.name: (p, f.dataType.simpleString()) for f, p in zip(fields, paths)}

        def parse(df):
            return files.parse_json_lines(df, mapping, bad="flag")
    else:
        def parse(df):
            return files.parse_csv_lines(df, ddl, sep=opts.get("sep", ","), bad="flag")
    not_null = [c for c in opts.get("not_null", "").split(",") if c]
    max_bytes = {c.split(":")[0]: int(c.split(":")[1])
                 for c in opts.get("max_bytes", "").split(",") if c}
    sum_keys = [c for c in opts.get("sum_keys", "").split(",") if c] or None
    return jobs.routine_load_stream(
        _source(spark, opts).select("value"), parse, opts["target"], opts["checkpoint"],
        not_null=not_null, max_bytes=max_bytes, sum_keys=sum_keys,
        measure=opts.get("measure", "total_number"),
        interval=opts.get("interval", "10 seconds"))


JOBS = {
    "routine-load": routine_load_job,
    "jdbc-age-increment": jdbc_age_increment_job,
    "csv-project": csv_project_job,
    "log-to-json": log_to_json_job,
    "log-rejects": log_rejects_job,
    "host-search": host_search_job,
    "count-60s": count_60s_job,
    "stream-load": stream_load_job,
    "accounting": accounting_job,
}
