"""The join that keeps hot keys apart, against a plain one."""

import pytest

from leasemill.operators import joins


@pytest.mark.parametrize("total", [10, 10_000_000])
def test_join_facts(spark, monkeypatch, total):
    monkeypatch.setattr(joins, "hot_limit", lambda n: 50)
    rows = spark.createDataFrame([("h", i) for i in range(60)] + [(None, i) for i in range(70)] + [("c", 1), ("c", 2), ("none", 3)], "k string, i int")
    facts = spark.createDataFrame([("h", 60, "hot"), (None, 70, "null"), ("c", 2, "cold"), ("unmet", None, "x")], "k string, n int, f string")
    out = joins.join_facts(rows, facts, ["k"], "n", total)
    assert sorted(out.columns) == ["f", "i", "k", "n"]
    got = sorted((r.k or "", r.i, r.f) for r in out.collect())
    assert got == sorted([("h", i, "hot") for i in range(60)] + [("", i, "null") for i in range(70)] + [("c", 1, "cold"), ("c", 2, "cold")])


def test_hot_keys_are_few():
    assert joins.hot_limit(10**12) * (1 / joins.HOT_SHARE) >= 10**12 and joins.hot_limit(0) == joins.LEAST_HOT
