"""Registered queries against their SQL on the smallest data."""

import pytest

import __spark_entry__ as entry
from check import compare

FOLDER = "/root/testdata/sf0.001"
# covered by test_streaming and test_models, in need of classes this data is too small for, or minutes long
ELSEWHERE = ("st08", "st09", "st10", "st11", "m16", "m26", "m28", "a03", "m04", "m11", "m12", "m14", "m15", "m17", "m24", "m25")
QUERIES, CHECKS = entry.queries(), entry.oracle_sql()


def test_every_check_has_a_query():
    assert set(CHECKS) <= set(QUERIES)


@pytest.mark.parametrize("name", [n for n in CHECKS if not n.startswith(ELSEWHERE)])
def test_check(spark, name):
    problem, _ = compare(spark, FOLDER, name, QUERIES[name], CHECKS[name])
    assert problem is None, problem


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 4
    assert abs(sum(r.revenue_share_pct for r in rows) - 100) < 0.3
