"""Property tests: merge and rollup operators against plain-Python models."""

import datetime as dt

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from lograft.operators import merge, rollup

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])
KEYS = st.sampled_from(["a", "b", "c", "hot"])
DAYS = st.sampled_from([dt.date(2024, 1, d) for d in (5, 8, 15, 22, 25)])
MEASURE = st.one_of(st.none(), st.integers(min_value=-5, max_value=1000))
ROWS = st.lists(st.tuples(KEYS, DAYS, MEASURE), max_size=30)
SCHEMA = "k string, day date, total_number bigint"


@SETTINGS
@given(stored=ROWS, batch=ROWS)
def test_sum_merge_matches_model(spark, stored, batch):
    model = {}
    for k, d, m in stored + batch:
        model[(k, d)] = model.get((k, d), 0) + (m or 0)
    st_df = rollup.daily_sum(spark.createDataFrame(stored, SCHEMA), "k")
    got = rollup.sum_merge(st_df.withColumnRenamed("k", "k"), spark.createDataFrame(batch, SCHEMA),
                           ["k", "day"]).collect()
    assert {(r.k, r.day): r.total_number for r in got} == model


@SETTINGS
@given(rows=st.lists(st.tuples(KEYS, st.integers(0, 10**6), st.text(max_size=3)), max_size=30,
                     unique_by=lambda t: t[1]))
def test_upsert_latest_matches_model(spark, rows):
    half = len(rows) // 2
    cur, new = rows[:half], rows[half:]
    schema = "k string, seq long, v string"
    cur_df = merge.latest_by_key(spark.createDataFrame(cur, schema), ["k"], "seq")
    got = merge.upsert_latest(cur_df, spark.createDataFrame(new, schema), ["k"], "seq").collect()
    model = {}
    for k, s, v in rows:
        if k not in model or s > model[k][0]:
            model[k] = (s, v)
    assert {r.k: (r.seq, r.v) for r in got} == model


@SETTINGS
@given(rows=ROWS)
def test_retention_partitions_rows(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    kept, rej = merge.retention_split(df, "2024-01-15")
    lo, hi = dt.date(2024, 1, 8), dt.date(2024, 1, 22)
    assert sorted(map(tuple, kept.collect()), key=str) == \
        sorted([r for r in rows if lo <= r[1] <= hi], key=str)
    assert kept.count() + rej.count() == len(rows)


@SETTINGS
@given(rows=st.lists(st.tuples(st.one_of(st.none(), st.text(max_size=8)),
                               st.integers(0, 5)), max_size=20))
def test_constraints_match_model(spark, rows):
    df = spark.createDataFrame(rows, "name string, x int")
    got = [r.reject_reason for r in
           merge.check_constraints(df, not_null=["name"], max_bytes={"name": 6})
           .orderBy(F.monotonically_increasing_id()).collect()]
    model = [("null:name" if n is None else "too_long:name" if len(n.encode()) > 6 else None)
             for n, _ in rows]
    assert sorted(got, key=str) == sorted(model, key=str)


@SETTINGS
@given(events=st.lists(st.tuples(st.sampled_from(["1", "3", "9"]),
                                 st.integers(0, 600_000)), max_size=40))
def test_window_count_matches_model(spark, events):
    base = dt.datetime(2024, 1, 1)
    rows = [(k, base + dt.timedelta(milliseconds=ms), 1) for k, ms in events]
    df = spark.createDataFrame(rows, "stockcode string, arrival timestamp, n int")
    got = {(r.window_start, r.stockcode): r.n for r in rollup.count_by_window(df).collect()}
    model = {}
    for k, ms in events:
        w = base + dt.timedelta(minutes=ms // 60000)
        model[(w, k)] = model.get((w, k), 0) + 1
    assert got == model


@SETTINGS
@given(n=st.integers(0, 400), parts=st.integers(1, 5), batch_rows=st.integers(1, 60))
def test_envelopes_round_trip(spark, n, parts, batch_rows):
    from lograft.operators import envelope
    df = spark.range(n).repartition(parts).select(
        F.to_json(F.struct(F.col("id").alias("uniqueid"))).alias("payload"))
    env = envelope.partition_envelopes(df, batch_rows=batch_rows).cache()
    rows = env.collect()
    assert all(r.n_rows <= batch_rows for r in rows)
    assert len({r.label for r in rows}) == len(rows)
    flat = envelope.flatten_envelopes(env, row_schema="struct<uniqueid: long>")
    assert sorted(r.uniqueid for r in flat.collect()) == list(range(n))
    env.unpersist()


def test_a_cluster_needs_a_shared_folder():
    import pytest
    from lograft.session import _required, is_local
    assert is_local("local[8]") and is_local("local")
    assert not is_local("yarn") and not is_local("local-cluster[3,2,1000]") and not is_local("spark://h:7077")
    with pytest.raises(RuntimeError):
        _required(None)


def test_checkpoint_folder_comes_from_the_session(spark):
    from lograft.session import ensure_checkpoint_dir, scratch_path
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    root = ensure_checkpoint_dir(spark)
    assert configured.rstrip("/").split("/")[-1] in root
    assert scratch_path(spark, "x").startswith(root.rstrip("/") + "/x-")
