"""Registered training-data queries against their SQL."""

import pytest

from lograft.llm.registry import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_its_sql(spark, name):
    from tools.oracle_check import check
    assert check(spark, "/root/testdata/sf0.001", [name])[name][0] == "OK"


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
