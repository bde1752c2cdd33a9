"""FIXTURES.md section 3 edge cases, one assertion per row, plus a seeded fuzz."""

import json
import random

import pytest
from pyspark.sql import functions as F

import javaref
from lograft.functions.javastr import java_split, java_trim, pair_pieces, pieces_pair
from lograft.functions.logparse import header_fields, split_records
from lograft.operators import documents, records, search, stockcodes

D = "-" * 10


def _one(spark, value, expr):
    df = spark.createDataFrame([(value,)], "x string")
    return df.select(expr(F.col("x")).alias("r")).first()["r"]


@pytest.mark.parametrize("line,expected", [
    ("a=b", ("a", "b")), ("=b", ("", "b")), ("a=b=", ("a", "b")), ("a=b==", ("a", "b")),
    (" A = b\r", ("A", "b")), ("\ta\t=\tB\t", ("a", "B")), ("a= ", ("a", "")),
    ("a=", None), ("a=b=c", None), ("a==b", None), ("=", None), ("", None), ("a=b=\r", None),
])
def test_pair_rules(spark, line, expected):
    two = lambda c: F.when(F.size(pair_pieces(c)) == 2, pieces_pair(pair_pieces(c), lower_key=False))
    r = _one(spark, line, two)
    assert (None if r is None else (r["k"], r["v"])) == expected


@pytest.mark.parametrize("msg,expected", [
    ("", [""]), (D, []), (D + D, []), ("x" + "-" * 11, ["x", "-"]), ("x" + D, ["x"]),
    ("x" + D + D + "y", ["x", "", "y"]), (D + "x", ["", "x"]),
])
def test_record_split(spark, msg, expected):
    assert _one(spark, msg, split_records) == expected


@pytest.mark.parametrize("header,ok,logtype,uniquestr", [
    ("ab>U[1]", True, "ab", "U"), ("ab>[1]", True, "ab", ""), ("ab>>c", True, "ab", ""),
    ("ab>U", True, "ab", "U"), ("ab>", False, None, None), ("ab", False, None, None),
    ("ab>[", False, None, None), ("ab>[[", False, None, None), ("a", False, None, None),
    ("", False, None, None), ("\U0001F600>U[1]", True, "\U0001F600", "U"),
    ("\U0001F600", False, None, None), ("a\U0001F600>U", True, "a\U0001F600", "U"),
])
def test_header_rules(spark, header, ok, logtype, uniquestr):
    r = _one(spark, header, header_fields)
    assert (r["ok"], r["logtype"], r["uniquestr"]) == (ok, logtype, uniquestr)


def test_trim_and_space_split(spark):
    assert _one(spark, "\x00\t a b \r\n", java_trim) == "a b"
    for s, exp in [("a  b ", ["a", "", "b"]), ("", [""]), ("   ", []), (" a", ["", "a"]),
                   ("ab", ["ab"])]:
        assert _one(spark, s, lambda c: java_split(c, " ")) == exp


def test_message_documents_edge_cases(spark):
    msgs = [("ab>U[1]\na=1\na=2\nlogtype=x",), ("x" + D + D + "y",), (D,)]
    df = spark.createDataFrame(msgs, "value string")
    out = [r.json for r in documents.with_documents(df).collect()]
    assert json.loads(out[0]) == [{"logtype": "x", "uniquestr": "U", "a": "2"}]
    assert out[1] is None
    assert out[2] == "[]"


# ---------------------------------------------------------------- fuzz
PIECES = ["a", "b", "A", "=", " ", "\t", "\r", "\n", "\n", "\n", "-", "-" * 10, "-" * 10, ">",
          "[", "]", "x", "正常", "stockcode", "StockCode", "action", "code", "mobilecode",
          "uniqueid", "20109", "10001", "7", "S1", "=", "=", "K9[1]", ":<1>", "ab>",
          "stoc\u212acode", "\u017ftockcode", "act\u0130on", "ACTION", "\x00", "\x0b", "\u00a0",
          "\U0001F600", "==", "= ="]


def _messages(n=600, seed=7):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        k = rnd.randint(0, 24)
        out.append((i, "".join(rnd.choice(PIECES) for _ in range(k))))
    # well-formed ones too, so T9/T4 accept a fair share
    for i in range(n, n + n // 2):
        recs = []
        for _ in range(rnd.randint(1, 3)):
            lines = [f"{rnd.choice(['正常', '异常', 'ab'])}:<1>{rnd.choice(['U', '', '[x'])}[1]"]
            for _ in range(rnd.randint(0, 6)):
                key = rnd.choice(["action", "stockcode", "Code", "mobilecode", "uniqueid", "z",
                                  " Action\t", "stoc\u212acode", "\u017ftockcode", "m\u0130bilecode",
                                  "\x0bcode", "\u00a0code", "uniqueid "])
                val = rnd.choice(["20109", "10001", "999", "", " M1 ", "S2\r", "x=y", "20109==",
                                  " 10001\x0b", "\u212aX", "a=", "=", "\u0130Z"])
                lines.append(f"{key}={val}")
            recs.append("\n".join(lines) + rnd.choice(["\n", ""]))
        out.append((i, D.join(recs)))
    return out


@pytest.fixture(scope="module")
def fuzz_df(spark):
    return spark.createDataFrame(_messages(), "id long, value string").cache()


def test_fuzz_documents(fuzz_df):
    got = {r.id: r.json for r in documents.with_documents(fuzz_df).select("id", "json").collect()}
    msgs = dict((i, v) for i, v in _messages())
    accepted = 0
    for i, v in msgs.items():
        exp = javaref.t4(v)
        assert (json.loads(got[i]) if got[i] is not None else None) == exp, repr(v)
        accepted += exp is not None
    assert accepted > 100


def test_fuzz_stockcodes(fuzz_df):
    rows = stockcodes.stockcode_pairs(fuzz_df).select("id", "stockcode").collect()
    got = {}
    for r in rows:
        got.setdefault(r.id, []).append(r.stockcode)
    for i, v in _messages():
        assert sorted(got.get(i, [])) == sorted(javaref.t6(v)), repr(v)


def test_fuzz_search(fuzz_df):
    recs = records.explode_records(fuzz_df)
    norm = search.normalize_search(recs, day=F.lit("2024-01-15"))
    got = {}
    for r in norm.select("id", "rec_pos", "stockcode", "code", "usersign").collect():
        got.setdefault(r.id, []).append((r.rec_pos, r.stockcode, r.code, r.usersign))
    total = 0
    for i, v in _messages():
        exp = javaref.t9(v)
        total += len(exp)
        assert sorted(got.get(i, []), key=str) == sorted(exp, key=str), repr(v)
    assert total > 50


def test_fuzz_pairs_with_positions(fuzz_df):
    rows = records.explode_pairs(records.explode_records(fuzz_df)) \
        .select("id", "rec_pos", "line_pos", "key", "value").collect()
    got = {}
    for r in rows:
        got.setdefault(r.id, []).append((r.rec_pos, r.line_pos, r.key, r.value))
    for i, v in _messages():
        assert sorted(got.get(i, [])) == sorted(javaref.t2(v)), repr(v)


def test_fuzz_headers(fuzz_df):
    rows = records.record_headers(records.explode_records(fuzz_df)) \
        .select("id", "rec_pos", "header_ok", "logtype", "uniquestr").collect()
    got = {}
    for r in rows:
        got.setdefault(r.id, []).append((r.rec_pos, r.header_ok, r.logtype, r.uniquestr))
    for i, v in _messages():
        assert sorted(got.get(i, []), key=str) == sorted(javaref.t3(v), key=str), repr(v)
