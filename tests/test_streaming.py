"""Batch = stream, restart (W3/W4) and replay safety of the foreachBatch sinks."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from lograft.plans import queries as Q
from lograft.sources.messages import load_messages
from lograft.streaming import jobs, registered as R


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_stream_log_to_json_equals_batch(spark):
    assert _rows(R.q_stream_log_to_json(spark, SF_SMALL)) == _rows(Q.q_log_to_json(spark, SF_SMALL))


def test_restart_equals_uninterrupted_run(spark):
    batch = _rows(Q.q_host_search_events(spark, SF_SMALL))
    assert _rows(R.q_stream_resume(spark, SF_SMALL)) == batch
    assert _rows(R.q_stream_host_search(spark, SF_SMALL)) == batch


def test_stream_rollup_equals_batch(spark):
    assert _rows(R.q_stream_hot_stock_daily(spark, SF_SMALL)) == \
        _rows(Q.q_hot_stock_daily(spark, SF_SMALL))


def test_stream_count_60s_equals_batch(spark):
    assert _rows(R.q_stream_count_60s(spark, SF_SMALL)) == \
        _rows(Q.q_stockcode_count_60s(spark, SF_SMALL))


def test_replayed_batch_changes_nothing(spark, scratch):
    out = scratch("replay")
    msgs = load_messages(spark, SF_SMALL).select("msg_id", "value", "day")
    jobs.write_host_search_batch(msgs, 0, out, day_col="day")
    once = _rows(jobs.read_rollup(spark, out, "hot_stock_code"))
    jobs.write_host_search_batch(msgs, 0, out, day_col="day")  # same batch id again
    assert _rows(jobs.read_rollup(spark, out, "hot_stock_code")) == once
    users = jobs.read_rollup(spark, out, "active_user")
    assert users.agg(F.sum("total_number")).first()[0] == \
        spark.read.parquet(f"{out}/events").count()


def test_search_events_reach_the_value_sink_as_json(spark, scratch):
    import json
    out, sent = scratch("vs_out"), []
    msgs = load_messages(spark, SF_SMALL).select("msg_id", "value", "day")
    jobs.write_host_search_batch(msgs, 0, out, day_col="day", as_of="batch",
                                 value_sink=lambda f, i: sent.extend(r.value for r in f.collect()))
    assert len(sent) == spark.read.parquet(f"{out}/events").count() > 0
    assert all("total_number" in json.loads(x) for x in sent)
    # the window of today's date rejects all of these old days, and the table stays empty
    assert jobs.read_rollup(spark, out, "hot_stock_code").count() == 0
    assert spark.read.parquet(f"{out}/rejects_hot").count() > 0


def test_retention_rejects_in_stream_batch(spark, scratch):
    out = scratch("retention")
    msgs = load_messages(spark, SF_SMALL).select("msg_id", "value", "day")
    jobs.write_host_search_batch(msgs, 0, out, day_col="day", as_of="2024-01-15")
    kept = jobs.read_rollup(spark, out, "hot_stock_code")
    days = [r.day.isoformat() for r in kept.select("day").distinct().collect()]
    assert days and min(days) >= "2024-01-08" and max(days) <= "2024-01-22"
    assert spark.read.parquet(f"{out}/rejects_hot").count() > 0


def test_stream_load_with_injected_senders(spark, scratch, tmp_path):
    import json
    import os
    from lograft.sources.kafka import parquet_text_stream
    src, ck = scratch("k4_src"), scratch("k4_ck")
    for feed in R.stage_messages(spark, SF_SMALL, src):
        feed()
    stream = parquet_text_stream(spark, src, R.MESSAGE_SCHEMA).select("msg_id", "value")
    dirs = [tmp_path / "s0", tmp_path / "s1"]
    for d in dirs:
        d.mkdir()

    def make_sender(d):
        d = str(d)

        def send(label, body):
            with open(os.path.join(d, label + ".json"), "w") as fh:
                fh.write(body)
        return send
    q = jobs.stream_load_stream(stream, ck, senders=[make_sender(d) for d in dirs],
                                batch_rows=100, available_now=True)
    q.awaitTermination()
    labels = [f for d in dirs for f in os.listdir(d)]
    assert len(labels) == len(set(labels)) > 2
    sizes = [len(json.load(open(os.path.join(d, f)))["data"]) for d in dirs for f in os.listdir(d)]
    assert max(sizes) <= 100
    assert sum(sizes) == Q.stock_pairs(spark, SF_SMALL).count()


def test_cli_jobs_run_on_file_sources(spark, scratch):
    from lograft.plans.jobs import JOBS
    src, out, ck = scratch("cli_src"), scratch("cli_out"), scratch("cli_ck")
    for feed in R.stage_messages(spark, SF_SMALL, src):
        feed()
    q = JOBS["log-to-json"](spark, {"source": src, "schema": R.MESSAGE_SCHEMA, "target": out,
                                    "checkpoint": ck, "interval": "1 second"})
    q.processAllAvailable()
    q.stop()
    assert spark.read.parquet(out).count() == Q.q_log_to_json(spark, SF_SMALL) \
        .select("msg_id").distinct().count()
    csv_src, csv_dst = scratch("cli_csv"), scratch("cli_csv_out")
    spark.createDataFrame([("x", 1, 2, 3, "1.5")], "a string, b int, c int, d int, e string") \
        .write.csv(csv_src)
    JOBS["csv-project"](spark, {"source": csv_src, "target": csv_dst})
    assert [str(r[0]) for r in spark.read.schema("sum_e DECIMAL(20,6)").csv(csv_dst).collect()] \
        == ["1.500000"]


def test_stream_event_count_equals_batch(spark):
    assert _rows(R.q_stream_event_count_5min(spark, SF_SMALL)) == \
        _rows(Q.q_event_count_5min(spark, SF_SMALL))


def test_stream_word_count_equals_batch(spark):
    assert _rows(R.q_stream_word_count(spark, SF_SMALL)) == _rows(Q.q_word_count(spark, SF_SMALL))


def test_counts_do_not_depend_on_arrival_order(spark, scratch):
    from lograft.sources.kafka import parquet_text_stream
    msgs = load_messages(spark, SF_SMALL)
    want = _rows(Q.q_stockcode_count_60s(spark, SF_SMALL))
    for order in ([0, 1, 2, 3], [3, 2, 1, 0], [2, 0, 3, 1]):
        src, out, ck = scratch("ord_src"), scratch("ord_out"), scratch("ord_ck")
        for k in order:  # each slice is a run of its own; slices interleave in time
            msgs.where(F.col("msg_id") % 4 == k).write.mode("append").parquet(src)
            stream = parquet_text_stream(spark, src, R.MESSAGE_SCHEMA).select("value", "arrival")
            jobs.count_60s_stream(stream, out, ck, available_now=True).awaitTermination()
        got = jobs.read_counts(spark, out).select(
            F.unix_seconds("window_start").alias("window_start"), "stockcode", "n")
        assert _rows(got) == want


def test_replayed_load_sends_equal_bodies_and_a_failed_one_loses_nothing(spark, scratch, tmp_path):
    import os
    from lograft.sources.kafka import parquet_text_stream
    src, ck, out = scratch("rp_src"), scratch("rp_ck"), scratch("rp_out")
    for feed in R.stage_messages(spark, SF_SMALL, src):
        feed()
    folder, flag = str(tmp_path), str(tmp_path / "failed-once")

    def send(label, body):
        if not os.path.exists(flag) and os.listdir(folder):  # the second envelope fails the first time
            open(flag, "w").close()
            raise IOError("receiver down")
        path = os.path.join(folder, label)
        if os.path.exists(path):  # a label offered again must carry the same body
            assert open(path).read() == body
        with open(path, "w") as fh:
            fh.write(body)

    def run():
        stream = parquet_text_stream(spark, src, R.MESSAGE_SCHEMA).select("msg_id", "value")
        q = jobs.stream_load_stream(stream, ck, out_root=out, senders=[send, send], batch_rows=50, available_now=True)
        try:
            q.awaitTermination()
        except Exception:  # noqa: BLE001  (the batch fails once)
            return False
        return q.exception() is None

    while not run():
        assert os.path.exists(flag)
    got = [f for f in os.listdir(folder) if f != "failed-once"]
    bodies = [open(os.path.join(folder, f)).read() for f in got]
    import json
    docs = [d["uniqueid"] for b in bodies for d in json.loads(b)["data"]]
    assert len(docs) == len(set(docs)) == Q.stock_pairs(spark, SF_SMALL).count()


def test_load_answers_are_checked():
    import pytest
    from lograft.sinks.stream_load import check_response
    check_response(200, '{"Status": "Success"}')
    check_response(200, '{"Status": "Label Already Exists"}')
    for status, body in ((500, ""), (200, '{"Status": "Fail", "Message": "too many filtered rows"}'), (200, "")):
        with pytest.raises(IOError):
            check_response(status, body)


def test_bad_lines_become_rejects(spark, scratch):
    from functools import partial
    from lograft.sources import files
    from lograft.sources.kafka import parquet_text_stream
    lines = ["1,Emily,25", "1,Emily", "1,Emily,25,extra", "2,Ben,old", "3,Olivia,28"]
    src, out, ck = scratch("bl_src"), scratch("bl_out"), scratch("bl_ck")
    spark.createDataFrame([(x,) for x in lines], "value string").write.parquet(src)
    jobs.routine_load_stream(parquet_text_stream(spark, src, "value STRING"), partial(files.parse_csv_lines, bad="flag"),
                             out, ck, not_null=["user_id"], available_now=True).awaitTermination()
    assert sorted(r.user_id for r in spark.read.parquet(f"{out}/table").collect()) == [1, 3]
    assert sorted(r.line for r in spark.read.parquet(f"{out}/rejects").collect()) == sorted(lines[1:4])
    js = ['{"user_id":1,"name":"a","age":25}', '{"user_id":2,"name":"b","age":"abc"}', '{"user_id":3,"age":25.5}', '{"user', "[]"]
    df = spark.createDataFrame([(x,) for x in js], "value string")
    mapping = {"user_id": ("$.user_id", "bigint"), "name": ("$.name", "string"), "age": ("$.age", "int")}
    flagged = {r.line: r.reject_reason for r in files.parse_json_lines(df, mapping, bad="flag").collect()}
    assert flagged[js[0]] is None and flagged[js[1]] == "bad:age" and flagged[js[3]] == "malformed"
    assert files.parse_json_lines(df, mapping).where("age = 25").count() >= 1


def test_routine_loads_csv_json_and_sum_table(spark, scratch):
    import json
    from lograft.sources import files
    from lograft.sources.kafka import parquet_text_stream
    lines = ["1,Emily,25", "2,Benjamin,35", "3,Olivia,28", ",NoId,1", "5,AVeryLongNameIndeedOkay,2"]
    src, out, ck = scratch("rl_src"), scratch("rl_out"), scratch("rl_ck")
    spark.createDataFrame([(x,) for x in lines], "value string").write.parquet(src)
    q = jobs.routine_load_stream(parquet_text_stream(spark, src, "value STRING"),
                                 files.parse_csv_lines, out, ck, not_null=["user_id"],
                                 max_bytes={"name": 20}, available_now=True)
    q.awaitTermination()
    assert sorted(r.user_id for r in spark.read.parquet(f"{out}/table").collect()) == [1, 2, 3]
    assert spark.read.parquet(f"{out}/rejects").count() == 2
    # JSON documents with renaming into a SUM table, loaded in two runs
    docs = [{"stockcode": "a", "day": "2024-01-15", "total_number": 1},
            {"stockcode": "a", "day": "2024-01-15", "total_number": 1},
            {"stockcode": None, "day": "2024-01-15", "total_number": 1},
            {"stockcode": "b", "day": "2024-01-16", "total_number": 1}]
    src2, out2, ck2 = scratch("rl2_src"), scratch("rl2_out"), scratch("rl2_ck")
    mapping = {"stock_code": ("$.stockcode", "string"), "day": ("$.day", "date"),
               "total_number": ("$.total_number", "bigint")}
    for half in (docs[:2], docs[2:]):
        spark.createDataFrame([(json.dumps(d),) for d in half], "value string") \
            .write.mode("append").parquet(src2)
        jobs.routine_load_stream(parquet_text_stream(spark, src2, "value STRING"),
                                 lambda df: files.parse_json_lines(df, mapping), out2, ck2,
                                 not_null=["stock_code", "day"], sum_keys=["stock_code", "day"],
                                 available_now=True).awaitTermination()
    got = sorted((r.stock_code, r.day.isoformat(), r.total_number) for r in
                 jobs.read_sum_table(spark, out2, ["stock_code", "day"]).collect())
    assert got == [("a", "2024-01-15", 2), ("b", "2024-01-16", 1)]


def test_cli_stream_jobs_smoke(spark, scratch):
    import json
    from lograft.plans.jobs import JOBS
    src = scratch("cli2_src")
    for feed in R.stage_messages(spark, SF_SMALL, src):
        feed()
    base = {"source": src, "schema": R.MESSAGE_SCHEMA, "interval": "1 second"}
    outs = {}
    for job in ("host-search", "count-60s", "stream-load"):
        out, ck = scratch(f"cli_{job}_out"), scratch(f"cli_{job}_ck")
        q = JOBS[job](spark, {**base, "target": out, "checkpoint": ck, "state_partitions": "4", "as_of": "none"})
        q.processAllAvailable()
        q.stop()
        outs[job] = out
    assert jobs.read_rollup(spark, outs["host-search"], "hot_stock_code").count() > 0
    assert jobs.read_counts(spark, outs["count-60s"]).count() > 0
    env = spark.read.parquet(outs["stream-load"])
    assert env.agg(F.sum("n_rows")).first()[0] == Q.stock_pairs(spark, SF_SMALL).count()
    # routine load of JSON lines with positional jsonpaths into a SUM table
    rl_src, rl_out, rl_ck = scratch("cli_rl_src"), scratch("cli_rl_out"), scratch("cli_rl_ck")
    spark.createDataFrame([(json.dumps({"sc": "a", "d": "2024-01-15", "t": 2}),),
                           (json.dumps({"sc": "a", "d": "2024-01-15", "t": 3}),)],
                          "value string").write.parquet(rl_src)
    q = JOBS["routine-load"](spark, {
        "source": rl_src, "target": rl_out, "checkpoint": rl_ck, "interval": "1 second",
        "format": "json", "columns": "stock_code STRING, day DATE, total_number BIGINT",
        "jsonpaths": json.dumps(["$.sc", "$.d", "$.t"]), "not_null": "stock_code,day",
        "sum_keys": "stock_code,day", "measure": "total_number"})
    q.processAllAvailable()
    q.stop()
    got = jobs.read_sum_table(spark, rl_out, ["stock_code", "day"]).collect()
    assert [(r.stock_code, r.total_number) for r in got] == [("a", 5)]


def test_rejects_and_retention_streams_equal_batch(spark):
    rejected = _rows(R.q_stream_log_rejects(spark, SF_SMALL))
    assert rejected and rejected == _rows(Q.q_log_rejects(spark, SF_SMALL))
    assert _rows(R.q_stream_daily_retention(spark, SF_SMALL)) == _rows(Q.q_daily_retention(spark, SF_SMALL))
