"""Every message and stock-code line is counted once, also after a replay."""

from conftest import SF_SMALL
from pyspark.sql import functions as F

from lograft.functions.logparse import header_fault
from lograft.streaming import accounting as A

HEAD = "正常:<10:00:00.000>K1[1]\n"


def _books(spark, out):
    return {(r.batch_id, r.kind, r.outcome): r.n for r in A.read_accounting(spark, out).collect()}


def _write(spark, out, values, batch_id=0, shard=None):
    frame = spark.createDataFrame(list(enumerate(values)), "msg_id INT, value STRING").repartition(3)
    A.write_accounted_batch(frame, batch_id, out, shard=shard if shard is not None else F.pmod("msg_id", F.lit(2)))


def test_matches_oracle(spark):
    from tools.oracle_check import check
    res = check(spark, SF_SMALL, ["stream_accounting"])
    assert res["stream_accounting"][0] == "OK", res


def test_every_outcome_is_counted(spark, scratch):
    out = scratch("acc")
    _write(spark, out, [HEAD + "stockcode=a\nstockcode=b=c\nstockcode=\n", "x\nstockcode=d\n", None,
                        "正常:<10\n", "正常:>[[\n", HEAD, ""])
    got = _books(spark, out)
    message = {o: n for (_, k, o), n in got.items() if k == "message"}
    assert message == {"seen": 7, "accepted": 2, "rejected": 5, "null_message": 1, "short_type": 2, "no_id": 1, "only_brackets": 1}
    line = {o: n for (_, k, o), n in got.items() if k == "line"}
    assert line == {"seen": 4, "accepted": 2, "not_a_pair": 2, "no_shard": 0, "shard_0": 1, "shard_1": 1}
    assert A.out_of_balance(A.read_accounting(spark, out)).count() == 0
    stored = spark.read.parquet(f"{out}/messages")
    assert stored.where("accepted = 'false' AND reason IS NULL").count() == 0
    assert stored.where("accepted = 'true'").select("value").distinct().collect()[0].value is None
    assert spark.read.parquet(f"{out}/events").where("shard IS NULL AND payload IS NOT NULL").count() == 0


def test_faults_are_those_that_reject(spark):
    from lograft.functions.logparse import header_fields
    texts = ["", "x", "正常", "正常>", ">>", "正常>[", "正常>[[>", "正常>a", "😀>a", "😀", "正常>>", "ab>[1]", "\n正常>a"]
    rows = spark.createDataFrame([(t,) for t in texts], "r STRING").select(
        header_fields(F.col("r"))["ok"].alias("ok"), header_fault(F.col("r")).alias("fault")).collect()
    assert all(r.ok == (r.fault is None) for r in rows)
    assert {r.fault for r in rows} == {None, "short_type", "no_id", "only_brackets"}


def test_a_replayed_batch_replaces_its_counts(spark, scratch):
    out = scratch("acc")
    _write(spark, out, [HEAD + "stockcode=a\n", "bad"])
    once = _books(spark, out)
    _write(spark, out, [HEAD + "stockcode=a\n", "bad"])
    assert _books(spark, out) == once
    _write(spark, out, ["bad"], batch_id=1)
    assert _books(spark, out)[1, "message", "seen"] == 1
    assert A.read_accounting(spark, out).where("kind = 'message' AND outcome = 'seen'").agg(F.sum("n")).first()[0] == 3


def test_a_random_shard_is_counted_as_it_is_stored(spark, scratch):
    out = scratch("acc")
    _write(spark, out, [HEAD + "stockcode=a\n" * 50] * 20, shard=F.floor(F.rand() * 2).cast("int"))
    stored = {r.shard: r["count"] for r in spark.read.parquet(f"{out}/events").groupBy("shard").count().collect()}
    got = _books(spark, out)
    assert sum(stored.values()) == 1000
    assert stored == {i: got[0, "line", f"shard_{i}"] for i in (0, 1)}


def test_unknown_shards_and_empty_batches(spark, scratch):
    out = scratch("acc")
    _write(spark, out, [HEAD + "stockcode=a\n", HEAD + "stockcode=b\n"], shard=F.when(F.col("msg_id") == 0, F.lit(7)))
    assert _books(spark, out)[0, "line", "no_shard"] == 2
    A.write_accounted_batch(spark.createDataFrame([], "msg_id INT, value STRING"), 1, out)
    assert A.read_accounting(spark, out).where("batch_id = 1").count() == 0
    assert A.read_accounting(spark, scratch("none")).count() == 0


def test_counting_adds_no_exchange(spark):
    from lograft.operators import stockcodes
    frame = spark.createDataFrame([(1, HEAD)], "msg_id INT, value STRING")
    for counted in (A.judged_messages(frame), stockcodes.synthetic_events(A.judged_lines(frame))):
        plan = counted._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Python" not in plan


def test_batches_of_a_larger_input_have_more_files(spark, scratch, tmp_path, monkeypatch):
    from lograft.streaming import registered as R
    spark.range(1200).select(F.col("id").alias("event_id"), F.timestamp_millis(F.col("id") * 1000).alias("ts"),
                             (F.col("id") % 7).alias("user_id"), F.lit("click").alias("event_type")) \
        .write.parquet(f"{tmp_path}/events.parquet")
    monkeypatch.setattr(R, "SET_EVENTS", 300, raising=False)
    write, tasks = A.write_accounted_batch, []

    def seen(batch, *args):
        tasks.append(batch.rdd.getNumPartitions())
        write(batch, *args)

    monkeypatch.setattr(A, "write_accounted_batch", seen)
    got = {(r.kind, r.outcome): r.n for r in R.q_stream_accounting(spark, str(tmp_path)).collect()}
    assert tasks == [4] * 4  # as many batches as over a small input, each read by more tasks
    assert got["message", "seen"] == 400 and got["message", "accepted"] + got["message", "rejected"] == 400
    assert got["line", "accepted"] == 1200 + len(range(0, 1200, 13)) and got["line", "not_a_pair"] == len(range(0, 1200, 11))
    assert got["batch", "out_of_balance"] == 0
