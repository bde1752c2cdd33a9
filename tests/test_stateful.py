"""Keyed-state streams: event-time windows, the sink's buffer, running counts, the load sink."""

import json
import os
import time

from pyspark.sql import functions as F

from conftest import SF_SMALL
from lograft.plans import queries as Q
from lograft.sinks import load_table
from lograft.streaming import buffer, etime, jobs


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def _windows(spark, scratch, slices):
    src, out, ck = scratch("ew_src"), scratch("ew_out"), scratch("ew_ck")
    inserted = []
    for part in slices:
        spark.createDataFrame(part, "ts string, k string").select(F.col("ts").cast("timestamp").alias("ts"), "k") \
            .coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema("ts TIMESTAMP, k STRING").parquet(src)
        q = etime.windows_stream(stream, out, ck, "ts", "k", 60_000, insert=lambda r: inserted.extend(map(tuple, r.collect())),
                                 available_now=True, state_partitions=2)
        q.awaitTermination()
        assert q.exception() is None
    return etime.read_windows(spark, out), inserted


def test_windows_close_once_and_late_rows_become_corrections(spark, scratch):
    at = lambda m, s=0: f"2024-01-01 00:{m:02d}:{s:02d}"
    early = [(at(0), "a"), (at(0, 30), "a"), (at(0, 30), None), (at(1), "b"), (None, "a")]
    later = [(at(9), "a"), (at(9, 1), "a"), (at(30), "z")]
    minute = lambda m: 1704067200000 + 60_000 * m
    want = {("a", minute(0)): 2, (None, minute(0)): 1, ("b", minute(1)): 1, ("a", minute(9)): 2}
    end = [(at(59), "end")]
    for slices in ([early, later, end], [later, early, end]):
        rows, inserted = _windows(spark, scratch, slices)
        rows = [r for r in rows.collect() if r.key not in ("z", "end")]
        sums = {}
        for r in rows:
            sums[r.key, r.window_start] = sums.get((r.key, r.window_start), 0) + r.n
        assert sums == want
        closed = [(r.key, r.window_start) for r in rows if not r.late]
        assert len(closed) == len(set(closed))
        assert sorted(map(str, ((k, w) for k, w, _ in inserted if k not in ("z", "end")))) == sorted(map(str, closed))
        assert any(r.late for r in rows) == (slices[0] is later)


def test_buffer_fills_over_batches_and_flushes_in_time(spark, scratch):
    src, out, ck = scratch("bf_src"), scratch("bf_out"), scratch("bf_ck")
    for i in range(3):
        spark.range(i * 4000, (i + 1) * 4000).select(F.lit(0).alias("shard"), F.concat(F.lit('{"i":'), "id", F.lit("}")).alias("payload")) \
            .coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema("shard INT, payload STRING").option("maxFilesPerTrigger", 1).parquet(src)
    q = load_table.load_stream(buffer.buffered_envelopes(stream, linger_ms=25_000), out, ck, interval="500 milliseconds", state_partitions=1)
    try:
        until, sizes = time.time() + 120, []
        while time.time() < until and sum(sizes) < 12_000 and q.isActive:
            time.sleep(1)
            if os.path.isdir(load_table.open_folder(f"{out}/published")[1]):
                sizes = sorted(r.n_rows for r in load_table.read_load(spark, out).collect())
    finally:
        q.stop()
    assert sizes == [2000, 10_000]
    found = [d["i"] for r in load_table.read_load(spark, out).collect() for d in json.loads(r.body)["data"]]
    assert sorted(found) == list(range(12_000))


class _State:
    """Stands in for list state, value state, handle or timer values of a buffer."""

    def __init__(self, rows=(), value=None):
        self.kept, self.value, self.timers = [(r,) for r in rows], value, []

    def exists(self):
        return self.value is not None

    def get(self):
        return iter(self.kept) if self.value is None else self.value

    def clear(self):
        self.kept, self.value = [], None

    def appendList(self, rows):
        self.kept += rows

    def update(self, value):
        self.value = value

    def registerTimer(self, due):
        self.timers.append(due)

    def deleteTimer(self, due):
        self.timers.remove(due)

    def getCurrentProcessingTimeInMs(self):
        return 100


def test_full_bodies_leave_the_buffer_before_more_rows_are_read():
    import pandas as pd
    b = buffer.EnvelopeBuffer(batch_rows=4, linger_ms=10)
    b.handle, b.rows, b.waiting = _State(), _State(["a", "b"]), _State(value=(2, 50))
    b.handle.timers = [50]
    read = []

    def frames():
        for i in range(5):
            read.append(i)
            yield pd.DataFrame({"payload": [f"{i}{j}" for j in range(3)]})

    bodies, after = [], []
    for out in b.handleInputRows((0, 0), frames(), _State()):
        assert list(out.n_rows) == [4] * len(out)
        bodies += list(out.body)
        after.append(len(read))
    assert after == [1, 2, 4, 5]
    assert bodies == ['{"data":[a,b,00,01]}', '{"data":[02,10,11,12]}', '{"data":[20,21,22,30]}', '{"data":[31,32,40,41]}']
    assert list(b.rows.kept) == [("42",)] and b.waiting.get() == (1, 110) and b.handle.timers == [110]


def test_running_count_emits_changed_words_only(spark, scratch):
    src, out, ck = scratch("rw_src"), scratch("rw_out"), scratch("rw_ck")
    for text in ("a b a", "b c", "d"):
        spark.createDataFrame([(text,)], "text string").write.mode("append").parquet(src)
        stream = spark.readStream.schema("text STRING").parquet(src)
        jobs.running_word_count_stream(stream, out, ck, available_now=True, state_partitions=2).awaitTermination()
    changes = spark.read.parquet(f"{out}/changes")
    per_batch = [r["count"] for r in changes.groupBy("batch_id").count().orderBy("batch_id").collect() if r["count"]]
    assert per_batch == [2, 2, 1]
    want = [("a", 2), ("b", 2), ("c", 1), ("d", 1)]
    assert _rows(jobs.running_table(out).read(spark).select("word", "n")) == want
    assert _rows(jobs.read_state(spark, ck).select("key.word", "value.count")) == want
    layout = jobs.state_layout(spark, ck).first()
    assert layout.operatorName == "stateStoreSave" and layout.numPartitions == 2


def _bodies(spark, out):
    return {r.label: r.body for r in load_table.read_load(spark, out).collect()}


def test_load_sink_survives_a_failed_task_and_a_replayed_batch(spark, scratch, tmp_path):
    src, out, ck = scratch("ls_src"), scratch("ls_out"), scratch("ls_ck")
    flag = str(tmp_path / "failed")
    spark.range(400).select((F.col("id") % 2).cast("int").alias("shard"), F.lit(1).alias("n_rows"),
                            F.concat(F.lit('{"data":['), "id", F.lit("]}")).alias("body")).repartition(4).write.parquet(src)

    def once(batches):
        from pyspark import TaskContext
        for batch in batches:
            if TaskContext.get().partitionId() == 1 and not os.path.exists(flag):
                yield batch  # some rows are staged before the task fails
                open(flag, "w").close()
                raise IOError("lost")
            yield batch

    def run(parts, fail=False):
        stream = spark.readStream.schema("shard INT, n_rows INT, body STRING").parquet(src).repartition(parts)
        if fail:
            stream = stream.mapInArrow(once, "shard int, n_rows int, body string")
        q = load_table.load_stream(stream, out, ck, "t", available_now=True)
        try:
            q.awaitTermination()
        except Exception:  # noqa: BLE001
            return False
        return q.exception() is None

    assert not run(4, fail=True) and os.path.exists(flag)
    folder = load_table.open_folder(out)[1]
    assert not os.path.isdir(f"{folder}/published")
    assert run(3)  # restarted with another number of tasks
    first = _bodies(spark, out)
    assert len(first) == 400 and sorted(json.loads(b)["data"][0] for b in first.values()) == list(range(400))
    # the batch was published, but Spark had not noted it: it is written again, by other tasks
    commits = load_table.open_folder(ck)[1] + "/commits"
    for name in os.listdir(commits):
        if name.strip(".crc").isdigit() or name.endswith(".crc"):
            os.unlink(os.path.join(commits, name))
    staged = set(os.listdir(f"{folder}/bodies"))
    assert run(7)
    assert _bodies(spark, out) == first
    assert {f for f in os.listdir(f"{folder}/bodies") if f.endswith(".parquet")} == {f for f in staged if f.endswith(".parquet")}
    sent = str(tmp_path / "sent")
    os.mkdir(sent)

    def send(label, body):
        with open(os.path.join(sent, label), "w") as fh:
            fh.write(body)
    load_table.delivery_stream(spark, out, scratch("ls_dck"), [send, send], available_now=True).awaitTermination()
    assert {n: open(os.path.join(sent, n)).read() for n in os.listdir(sent)} == first


def test_stateful_queries_equal_batch(spark):
    from lograft.streaming import registered as R
    assert _rows(R.q_stream_load_sink(spark, SF_SMALL)) == _rows(Q.q_stream_load_batches(spark, SF_SMALL))
