"""Partitioned tables of streams: merging by part, replay, retention."""

import datetime
import random

from pyspark.sql import functions as F

from lograft.operators import merge
from lograft.streaming.parts import Mark, PartTable, bucket_part, day_part

DAYS = [datetime.date(2024, 1, 10) + datetime.timedelta(days=i) for i in range(4)]


def _sums(rows):
    return rows.groupBy("k", "day").agg(F.sum("n").alias("n"))


def _got(table, spark):
    return {(r.k, r.day): r.n for r in table.read(spark).collect()}


def test_sums_over_many_batches_with_replays(spark, scratch):
    pick = random.Random(3)
    table = PartTable(scratch("pt"), _sums, day_part())
    want = {}
    for b in range(5):
        rows = [(pick.choice("abc"), pick.choice([*DAYS[b // 2:b // 2 + 2], None]), pick.randint(1, 9)) for _ in range(12)]
        frame = spark.createDataFrame(rows, "k string, day date, n long")
        for _ in range(2):  # the batch and its replay
            table.apply(_sums(frame), b)
        for k, d, n in rows:
            want[k, d] = want.get((k, d), 0) + n
        assert _got(table, spark) == want


def test_only_touched_parts_are_written(spark, scratch):
    table = PartTable(scratch("pt2"), _sums, day_part())

    def files():
        rows = spark.read.parquet(table.root).select("_metadata.file_path", "table_part").distinct().collect()
        return {str(r.table_part): r.file_path for r in rows}
    one = lambda day: spark.createDataFrame([("a", day, 1)], "k string, day date, n long")
    table.apply(one(DAYS[0]), 0)
    table.apply(one(DAYS[1]), 1)
    before = files()
    table.apply(one(DAYS[1]), 2)
    after = files()
    assert before[str(DAYS[0])] == after[str(DAYS[0])] and before[str(DAYS[1])] != after[str(DAYS[1])]
    plan = table._stored(spark, one(DAYS[0]).schema).where(F.col("table_part").isin(str(DAYS[0])))
    assert "PartitionFilters: [" in plan._jdf.queryExecution().toString() and len(plan.inputFiles()) >= 1


def test_old_days_leave_the_table(spark, scratch):
    table = PartTable(scratch("pt3"), _sums, day_part())
    table.apply(spark.createDataFrame([("a", d, 1) for d in DAYS], "k string, day date, n long"), 0)
    table.drop_before(spark, str(DAYS[2]))
    assert table.parts(spark) == [str(d) for d in DAYS[2:]] and len(_got(table, spark)) == 2


def test_a_batch_stopped_after_staging_is_finished_by_its_replay(spark, scratch, monkeypatch):
    table = PartTable(scratch("pt4"), _sums, day_part())
    frame = spark.createDataFrame([("a", DAYS[0], 1)], "k string, day date, n long")
    table.apply(frame, 0)
    calls = []

    def fail(self, spark, batch_id, note=""):
        real(self, spark, batch_id, note)
        calls.append(batch_id)
        raise RuntimeError("stopped")
    real = Mark.set
    monkeypatch.setattr(Mark, "set", fail)
    try:
        table.apply(frame, 1)
    except RuntimeError:
        pass
    monkeypatch.setattr(Mark, "set", real)
    table.apply(frame, 1)
    assert calls == [1] and _got(table, spark) == {("a", DAYS[0]): 2}


def test_empty_batches_and_unique_rows(spark, scratch):
    table = PartTable(scratch("pt5"), lambda r: merge.latest_by_key(r, ["k"], "seq"), bucket_part(["k"]))
    schema = "k string, seq long, v string"
    table.apply(spark.createDataFrame([], schema), 0)
    assert table.read(spark).count() == 0
    table.apply(spark.createDataFrame([("a", 2, "x"), ("b", 1, None)], schema), 1)
    table.apply(spark.createDataFrame([("a", 1, "late"), ("c", 5, "z")], schema), 2)
    assert sorted(tuple(r) for r in table.read(spark).collect()) == [("a", 2, "x"), ("b", 1, None), ("c", 5, "z")]
