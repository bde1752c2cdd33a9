"""FIXTURES.md sections 1, 2 and 4: literal samples and derived expectations."""

import datetime as dt
import json

from pyspark.sql import functions as F

from lograft.operators import documents, envelope, merge, records, rollup, rows, search, \
    stockcodes, variants
from lograft.sources import files

D = "-" * 10
PLAIN = "正常:<13:12:32.303>45673BD6BC4[1]\na=1\nb=2\n" + D + \
        "异常:<13:12:32.303>45673BD6BA3[0]\nc=3\nd=4"
STOCK = PLAIN.replace("a=1", "stockcode=1").replace("c=3", "stockcode=3")
SEARCH = ("正常:<09:30:00.000>A1[1]\naction=20109\nstockcode=600519\nmobilecode=13800000000\n"
          "uniqueid=DEV1\n" + D + "正常:<09:30:01.000>A2[1]\nAction=10001\nstockcode=1\n"
          "Code=SZ000001\nuniqueid=DEV2\n" + D + "异常:<09:30:02.000>A3[0]\naction=999\n"
          "stockcode=5\n" + D + "正常:<09:30:03.000>A4[1]\naction=20109\ncode=7\n")


def _msgs(spark, *values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "msg_id long, value string")


def test_plain_sample_documents(spark):
    out = documents.log_to_json(_msgs(spark, PLAIN)).first().json
    assert json.loads(out) == [
        {"logtype": "正常", "uniquestr": "45673BD6BC4", "a": "1", "b": "2"},
        {"logtype": "异常", "uniquestr": "45673BD6BA3", "c": "3", "d": "4"}]
    assert stockcodes.stockcode_pairs(_msgs(spark, PLAIN)).count() == 0


def test_stock_sample_pairs_and_synthetic(spark):
    pairs = stockcodes.stockcode_pairs(_msgs(spark, STOCK))
    assert sorted((r.stockcode, r.n) for r in pairs.collect()) == [("1", 1), ("3", 1)]
    syn = stockcodes.synthetic_events(pairs).collect()
    assert len(syn) == 2 and {r.shard for r in syn} <= {0, 1}
    ids = {json.loads(r.payload)["uniqueid"] for r in syn}
    assert len(ids) == 2
    prov = json.loads(syn[0].payload)["provider"]
    dt.datetime.strptime(prov, "%Y-%m-%d %H:%M:%S")
    branches = stockcodes.shard_split(stockcodes.synthetic_events(pairs).cache())
    assert sum(b.count() for b in branches) == 2


def test_search_sample(spark):
    recs = records.explode_records(_msgs(spark, SEARCH))
    norm = search.normalize_search(recs, day=F.lit("2024-01-15"))
    got = [(r.stockcode, r.code, r.usersign, r.total_number) for r in norm.orderBy("rec_pos").collect()]
    assert got == [("600519", None, "13800000000", 1), ("sz000001", None, "dev2", 1),
                   (None, "7", "", 1)]
    docs = [json.loads(r.json) for r in norm.orderBy("rec_pos").collect()]
    assert docs[2] == {"code": "7", "usersign": "", "total_number": 1, "day": "2024-01-15"}
    hot = rollup.hot_stock_daily(norm).collect()
    assert sorted((r.stock_code, r.total_number) for r in hot) == [("600519", 1), ("sz000001", 1)]
    users = rollup.active_user_daily(norm).collect()
    assert sorted((r.usersign, r.total_number) for r in users) == \
        [("", 1), ("13800000000", 1), ("dev2", 1)]


def test_search_edge_cases(spark):
    msg = ("ab>U[1]\naction=20109\nstockcode=a\nstockcode=b\nmobilecode= \nuniqueid=u\n" + D +
           "ab>U[1]\naction=10001\nstockcode=s\ncode= \n" + D + "ab>U[1]\nstockcode=z\n")
    norm = search.normalize_search(records.explode_records(_msgs(spark, msg)),
                                   day=F.lit("2024-01-15"))
    got = [(r.stockcode, r.code, r.usersign) for r in norm.orderBy("rec_pos").collect()]
    assert got == [("b", None, "u"), ("s", "", "")]


def test_bad_record_rejects_message_but_keeps_codes(spark):
    msg = "ab>U[1]\nstockcode=1\n" + D + "x\nstockcode=2\n"
    df = _msgs(spark, msg)
    assert documents.log_to_json(df).count() == 0
    rej = documents.log_rejects(df).first()
    assert rej.first_bad == 1
    assert sorted(r.stockcode for r in stockcodes.stockcode_pairs(df).collect()) == ["1", "2"]


def _ts(s):
    return dt.datetime.fromisoformat(s)


def test_windows_a1_a2(spark):
    pairs = spark.createDataFrame(
        [("1", _ts("2024-01-01 00:00:00"), 1), ("1", _ts("2024-01-01 00:00:59.999"), 1),
         ("1", _ts("2024-01-01 00:01:00"), 1), ("3", _ts("2024-01-01 00:00:30"), 1)],
        "stockcode string, arrival timestamp, n int")
    counts = rollup.count_by_window(pairs)
    got = sorted((r.window_start.minute, r.stockcode, r.n) for r in counts.collect())
    assert got == [(0, "1", 2), (0, "3", 1), (1, "1", 1)]
    latest = {r.stockcode: r.n for r in rollup.latest_window_count(counts).collect()}
    assert latest == {"1": 1, "3": 1}


def test_sum_merge_default_zero(spark):
    d = dt.date(2024, 1, 15)
    stored = spark.createDataFrame([("k", d, 5)], "k string, day date, total_number bigint")
    batch = spark.createDataFrame([("k", d, 2), ("k", d, None)],
                                  "k string, day date, total_number bigint")
    assert [tuple(r) for r in rollup.sum_merge(stored, batch, ["k", "day"]).collect()] == \
        [("k", d, 7)]


def test_unique_upsert(spark):
    cur = spark.createDataFrame([(1, "a", 20, 1)], "id long, name string, age int, seq long")
    new = spark.createDataFrame([(1, "b", 21, 2), (2, "c", 3, 3)],
                                "id long, name string, age int, seq long")
    got = sorted(tuple(r) for r in merge.upsert_latest(cur, new, ["id"], "seq").collect())
    assert got == [(1, "b", 21, 2), (2, "c", 3, 3)]


def test_retention_and_constraints(spark):
    days = [dt.date(2024, 1, d) for d in (7, 8, 22, 23)]
    df = spark.createDataFrame([(d,) for d in days], "day date")
    kept, rej = merge.retention_split(df, "2024-01-15")
    assert sorted(r.day.day for r in kept.collect()) == [8, 22]
    assert sorted(r.day.day for r in rej.collect()) == [7, 23]
    t = spark.createDataFrame([(None, "x"), (1, "é" * 11), (2, "ok")], "user_id long, name string")
    chk = merge.check_constraints(t, not_null=["user_id"], max_bytes={"name": 20})
    reasons = sorted(((r.user_id, r.reject_reason) for r in chk.collect()), key=str)
    assert reasons == [(1, "too_long:name"), (2, None), (None, "null:user_id")]


def test_envelopes_25000_one_bucket(spark):
    df = spark.range(25000).select(
        F.to_json(F.struct(F.col("id").alias("uniqueid"))).alias("payload")).coalesce(1)
    env = envelope.partition_envelopes(df).cache()
    assert sorted(r.n_rows for r in env.collect()) == [5000, 10000, 10000]
    flat = envelope.flatten_envelopes(env, row_schema="struct<uniqueid: long>")
    assert flat.count() == 25000 and flat.select("uniqueid").distinct().count() == 25000
    sent, ledger = envelope.labelled_load(env, spark.createDataFrame([], "label string"))
    again, _ = envelope.labelled_load(env, ledger)
    assert sent.count() == 3 and again.count() == 0


def test_stream_load_sender_called_per_envelope(spark, tmp_path):
    from lograft.sinks.stream_load import send_envelopes
    df = spark.range(12).select(F.to_json(F.struct("id")).alias("payload")).coalesce(1)
    env = envelope.partition_envelopes(df, batch_rows=5)
    out = str(tmp_path)

    def send(label, body):  # runs in the task; writes a marker file
        with open(f"{out}/{label}.json", "w") as fh:
            fh.write(body)
    send_envelopes(env, send)
    import os
    bodies = [json.load(open(os.path.join(out, f))) for f in sorted(os.listdir(out))]
    assert sorted(len(b["data"]) for b in bodies) == [2, 5, 5]


CSV_LINES = ["1,Emily,25", "2,Benjamin,35", "3,Olivia,28", "4,Alexander,60", "5,Ava,17",
             "6,William,69", "7,Sophia,32", "8,James,64", "9,Emma,37", "10,Liam,64"]


def test_csv_and_json_ingest_equal(spark):
    csv_df = files.parse_csv_lines(spark.createDataFrame([(x,) for x in CSV_LINES], "value string"))
    js = [json.dumps({"user_id": int(a), "name": b, "age": int(c)})
          for a, b, c in (x.split(",") for x in CSV_LINES)]
    json_df = files.parse_json_lines(spark.createDataFrame([(x,) for x in js], "value string"),
                                     {"user_id": ("$.user_id", "bigint"), "name": ("$.name", "string"),
                                      "age": ("$.age", "int")})
    a = sorted(tuple(r) for r in csv_df.collect())
    assert a == sorted(tuple(r) for r in json_df.collect())
    assert len(a) == 10 and sum(r[2] for r in a) == 431
    inc = rows.age_increment(csv_df)
    assert inc.where("reject_reason IS NULL").agg(F.sum("age")).first()[0] == 441


def test_json_rename_paths(spark):
    df = spark.createDataFrame([('{"stockcode":"a","day":"2024-01-15","total_number":1,'
                                 '"x":{"y":2}}',)], "value string")
    out = files.parse_json_lines(df, {"stock_code": ("$.stockcode", "string"),
                                      "day": ("$.day", "date"),
                                      "total_number": ("$.total_number", "bigint"),
                                      "y": ("$.x.y", "int")}).first()
    assert (out.stock_code, out.day, out.total_number, out.y) == ("a", dt.date(2024, 1, 15), 1, 2)


def test_csv_table_projection_roundtrip(spark, scratch):
    from lograft.sinks.files import write_csv
    src, dst = scratch("csv_src"), scratch("csv_dst")
    spark.createDataFrame([("x", 1, 2, 3, "1.5"), ("y", 4, 5, 6, "2.25")],
                          "a string, b int, c int, d int, e string") \
        .selectExpr("a", "b", "c", "d", "CAST(e AS DECIMAL(20,6)) e") \
        .write.option("header", "false").csv(src)
    t = files.read_csv_table(spark, src)
    res = rows.project_sql(spark, t, "test_table", rows.CSV_PROJECT_SQL)
    write_csv(res, dst)
    back = spark.read.schema("sum_e DECIMAL(20,6)").csv(dst)
    assert sorted(str(r.sum_e) for r in back.collect()) == ["1.500000", "2.250000"]


def test_int_overflow_is_rejected(spark):
    df = spark.createDataFrame([(1, 2147483647), (2, None), (3, 5)], "id long, age int")
    got = sorted(((r.id, r.age, r.reject_reason) for r in rows.age_increment(df).collect()),
                 key=lambda t: t[0])
    assert got == [(1, None, "bad:age"), (2, None, "bad:age"), (3, 6, None)]


def test_word_count(spark):
    df = spark.createDataFrame([("a b  a\n\nb \n   \n",)], "text string")
    got = {r.word: r.n for r in variants.word_count(df).collect()}
    assert got == {"a": 2, "b": 2, "": 2}


def test_csv_stream_source(spark, scratch):
    src, out, ck = scratch("csvs_src"), scratch("csvs_out"), scratch("csvs_ck")
    spark.createDataFrame([("x", 1, 2, 3, "1.5"), ("y", 4, 5, 6, "2.25")],
                          "a string, b int, c int, d int, e string").write.csv(src)
    stream = files.read_csv_stream(spark, src)
    q = (stream.selectExpr("e AS sum_e").writeStream.format("parquet")
         .option("path", out).option("checkpointLocation", ck).trigger(availableNow=True).start())
    q.awaitTermination()
    assert sorted(str(r.sum_e) for r in spark.read.parquet(out).collect()) == \
        ["1.500000", "2.250000"]


def test_jdbc_job_wiring_with_stand_ins(spark, scratch, monkeypatch):
    """The JDBC hop needs a database (none may run here); the reader and
    writer are replaced by parquet stand-ins to check the job's wiring."""
    from lograft.plans import jobs as J
    table = scratch("jdbc_standin")
    spark.createDataFrame([(1, "Emily", 25), (2, "Ava", 2147483647)],
                          "id long, name string, age int").write.parquet(table)
    seen = {}

    def fake_read(spark_, url, query=None, **kw):
        seen["query"] = query
        return spark_.read.parquet(table)

    def fake_write(df, url, tbl, columns=None, **kw):
        seen["columns"] = columns
        df.select(*columns).write.mode("append").parquet(table + "_inserted")
    monkeypatch.setattr(J, "read_jdbc", fake_read)
    monkeypatch.setattr(J, "write_jdbc", fake_write)
    rejects = J.jdbc_age_increment_job(spark, {"url": "jdbc:none", "table": "test"})
    assert seen["query"] == "SELECT id, name, age FROM test" and seen["columns"] == ["name", "age"]
    assert [tuple(r) for r in spark.read.parquet(table + "_inserted").collect()] == [("Emily", 26)]
    assert [r.id for r in rejects.collect()] == [2]


def test_csv_table_whole_row_validation(spark, scratch):
    src = scratch("csv_bad")
    spark.createDataFrame([("x,1,2,3,1.5",), ("y,notint,5,6,2.25",)], "v string") \
        .write.text(src)
    t = files.read_csv_table(spark, src, view=None, validate_all_columns=True).cache()
    bad = [r.a for r in t.where("_corrupt IS NOT NULL").collect()]
    assert bad == ["y"]
    assert sorted(str(r.e) for r in t.where("_corrupt IS NULL").collect()) == ["1.500000"]


def test_retention_prunes_day_partitions(spark, scratch):
    from conftest import SF_SMALL
    from lograft.plans.queries import search_rows
    path = scratch("hot_table")
    merge.append(rollup.hot_stock_daily(search_rows(spark, SF_SMALL)), path, partition_by=["day"])
    table = spark.read.parquet(path)
    kept, _ = merge.retention_split(table, "2024-01-15")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "day#" in plan
    days = {r.day.isoformat() for r in kept.select("day").distinct().collect()}
    assert days and min(days) >= "2024-01-08" and max(days) <= "2024-01-22"
