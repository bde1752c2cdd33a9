"""Keyed hand-over, SQL functions, the JDBC split planner and nested JSON paths."""

import datetime

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from javaref import jsplit as plain_split
from lograft.functions import sqlfunctions
from lograft.operators import handover, records
from lograft.plans import queries as Q
from lograft.sources import files, jdbc


def _numbered(df, **kw):
    return handover.keyed_sequence(df, "k", ["v"], partitions=6, **kw)


def test_sequences_are_gapless_and_a_hot_shard_spreads(spark):
    df = spark.range(6000).select(F.when(F.col("id") % 100 > 1, "hot").when(F.col("id") % 100 == 1, "cold").alias("k"),
                                  (F.col("id") * 7919 % 6007).alias("v"))
    out = _numbered(df).withColumn("task", F.spark_partition_id())
    rows = out.collect()
    for k in ("hot", "cold", None):
        mine = sorted((r.seq, r.v) for r in rows if r.k == k)
        assert [s for s, _ in mine] == list(range(len(mine))) and len(mine) == df.where(F.col("k").eqNullSafe(F.lit(k))).count()
        assert [v for _, v in mine] == sorted(v for _, v in mine)
    ranged = df.repartitionByRange(6, "k", "v").where("k = 'hot'").groupBy(F.spark_partition_id()).count().collect()
    assert len(ranged) >= 4 and max(r["count"] for r in ranged) < 3000


def test_the_window_sees_counts_only(spark):
    df = spark.range(10).select(F.lit("a").alias("k"), F.col("id").alias("v"), F.lit("p").alias("payload"))
    plan = _numbered(df)._jdf.queryExecution().optimizedPlan().toString().split("\n")
    at = next(i for i, line in enumerate(plan) if "Window" in line)
    assert any("Aggregate [_range" in line for line in plan[at:]) and "payload" not in plan[at]


def test_numbers_go_on_from_an_earlier_hand_over(spark):
    one = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "k string, v int")
    two = spark.createDataFrame([("a", 5), ("b", 9), ("c", 1), (None, 1)], "k string, v int")
    first = _numbered(one)
    free = handover.next_sequence(first, "k")
    second = _numbered(two, start=free)
    assert sorted(map(tuple, second.collect()), key=str) == [("a", 5, 2), ("b", 9, 1), ("c", 1, 0), (None, 1, 0)]
    after = handover.next_sequence(second, "k", free)
    assert sorted(map(tuple, after.collect()), key=str) == [("a", 3), ("b", 2), ("c", 1), (None, 1)]


def test_ties_repeats_empty_and_clashing_columns(spark):
    tied = spark.createDataFrame([("a", 1, "x"), ("a", 1, "x"), ("a", 1, "y"), ("a", None, "z")], "k string, v int, w string")
    out = _numbered(tied).collect()
    assert sorted(r.seq for r in out) == [0, 1, 2, 3] and len(out) == 4
    assert _numbered(tied.limit(0)).collect() == []
    with pytest.raises(ValueError):
        _numbered(tied.withColumn("_at", F.lit(1)))


EDGES = ["", "----------", "a----------", "----------a", "a--------------------b", "--------------------", "x" * 30,
         "异常:<1>K1[1]\nStockCode= S1\r\nb==\n=c\nd=e=f\n\t k \t=\t v \nK=1=----------AB:<2>id[", "A", "𝄞:<1>u[2]", "AB>[", "AB>[[x",
         "AB>", "AB>x>", "AB:<1>K[1", None, "\n", "ab\n>x["]


def test_sql_functions_equal_the_column_operators(spark):
    sqlfunctions.register(spark)
    msgs = spark.createDataFrame(list(enumerate(EDGES)), "msg_id int, value string")
    recs = records.explode_records(msgs)
    got = spark.sql("SELECT m.msg_id, r.* FROM {m} m, LATERAL log_records(m.value) r", m=msgs)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, recs.collect()))
    for i, text in enumerate(EDGES):
        if text is not None:
            assert [r.record for r in sorted(got.where(F.col("msg_id") == i).collect(), key=lambda r: r.rec_pos)] \
                == plain_split(text, "----------")
    pairs = spark.sql("SELECT r.msg_id, r.rec_pos, p.* FROM {r} r, LATERAL log_pairs(r.record) p", r=recs)
    assert sorted(map(tuple, pairs.collect())) == sorted(map(tuple, records.explode_pairs(recs).collect()))
    heads = spark.sql("SELECT msg_id, rec_pos, h.* FROM (SELECT *, log_header(record) AS h FROM {r})", r=recs)
    assert sorted(map(tuple, heads.collect())) == sorted(map(tuple, records.record_headers(recs).collect()))


def test_sql_functions_stay_in_the_callers_stage(spark):
    plan = Q.q_sql_log_kv(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Python" not in plan and "Arrow" not in plan
    assert plan.count("Exchange") == Q.q_log_kv(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString().count("Exchange")


def test_planned_ranges_cover_a_skewed_key_once_in_equal_depth(spark):
    keys = spark.range(20000).select(F.when(F.col("id") % 9 != 0, F.col("id") * F.col("id") * F.col("id")).alias("k"))
    plan = jdbc.equi_depth_predicates(keys, "k", 8)
    assert len(plan) == 9
    sizes = [keys.where(p).count() for p in plan]
    assert sum(sizes) == 20000 and keys.where("k is null").count() == sizes[-1]
    assert max(sizes[:-1]) <= 2 * sum(sizes[:-1]) / 8
    assert keys.where(" + ".join(f"cast(coalesce({p}, false) as int)" for p in plan) + " != 1").count() == 0


def test_planned_ranges_of_dates_hot_values_and_nothing(spark):
    days = spark.range(100).select(F.expr("date_add(DATE '2024-01-01', cast(id as int))").alias("d"))
    plan = jdbc.equi_depth_predicates(days, "d", 4)
    assert "DATE '2024-" in plan[0] and [days.where(p).count() for p in plan[:-1]] == [25, 25, 25, 25]
    stamps = spark.createDataFrame([(datetime.datetime(2024, 1, 1, h),) for h in range(8)], "t timestamp")
    assert sum(stamps.where(p).count() for p in jdbc.equi_depth_predicates(stamps, "t", 4)) == 8
    hot = spark.range(100).select(F.when(F.col("id") < 60, 5).otherwise(F.col("id")).alias("k"))
    plan = jdbc.equi_depth_predicates(hot, "k", 10)
    assert len(set(plan)) == len(plan) and sum(hot.where(p).count() for p in plan) == 100
    assert jdbc.equi_depth_predicates(hot.where("k is null"), "k", 4) == ["k IS NULL"]
    assert sum(hot.where(p).count() for p in jdbc.equi_depth_predicates(hot, "k", 1)) == 100


def test_nested_paths_read_one_variant(spark):
    lines = ['{"a":{"b":[{"c":1},{"c":"2"}]},"n":"x"}', ' {"a":{"b":[]}}', '[1]', '{"a":', '{"a":{"b":[{"c":1},{"c":"z"}]}}',
             '{"a":{"b":[0,{"c":9999999999}]}}', '"{"', '', None, '{"n":{"o":true}}', '{"a":1}']
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    out = files.parse_json_lines(df, {"c": ("$.a.b[1].c", "int"), "n": ("$.n", "string"), "o": ("$.n.o", "boolean")}, bad="flag")
    assert [(r.c, r.n, r.o, r.reject_reason) for r in out.collect()] == [
        (2, "x", None, None), (None, None, None, None), (None, None, None, "malformed"), (None, None, None, "malformed"),
        (None, None, None, "bad:c"), (None, None, None, "bad:c"), (None, None, None, "malformed"),
        (None, None, None, "malformed"), (None, None, None, "malformed"), (None, '{"o":true}', True, None),
        (None, None, None, None)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Generate") == 1 and "get_json_object" not in plan  # the parse stands in the generator
