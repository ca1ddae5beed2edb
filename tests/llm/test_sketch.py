"""Problem 5: the guarantee, and that merged parts equal the whole."""

import math
import random
import sys

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from leasemill.llm.sketch import bucket_limit
from leasemill.llm import sketch as S

QS = [0.0, 0.25, 0.5, 0.9, 1.0]
SCHEMA = "day bigint, g string, x double, value string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA)


def check(rows, out, alpha):
    got = {(r.g, r.q): r for r in out.collect()}
    for g in {r[1] for r in rows}:
        mine = [r[2] for r in rows if r[1] == g]
        x = sorted(v for v in mine if v is not None and math.isfinite(v))
        for q in QS:
            r = got[g, q]
            assert (r.n_values, r.n_skipped) == (len(x), len(mine) - len(x))
            if not x:
                assert r.value is None
                continue
            true = x[math.floor(q * (len(x) - 1))]
            if abs(true) < sys.float_info.min:
                assert r.value == 0
                continue
            slack = 1e-9 * abs(true)
            assert abs(r.value - true) <= alpha * abs(true) + slack
            assert r.low - slack <= true <= r.high + slack
    assert len(got) == len({r[1] for r in rows}) * len(QS)


def test_extremes(spark):
    big, small = sys.float_info.max, sys.float_info.min
    for v in (big, -big, big * 0.99, small, -small, small / 2, 1.0, -1.0):
        rows = [(1, "a", v)]
        check(rows, S.percentiles(S.build(frame(spark, rows), ["g"], "x"), ["g"], QS), S.ALPHA)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.one_of(st.none(), st.floats(allow_nan=True, allow_infinity=True, width=64)), max_size=30), alpha=st.sampled_from([0.01, 0.2]))
def test_guarantee(spark, values, alpha):
    rows = [(i % 3, None if i % 2 else "a", v) for i, v in enumerate(values)]
    df = frame(spark, rows)
    check(rows, S.percentiles(S.build(df, ["g"], "x", alpha), ["g"], QS, alpha), alpha)


def test_merge_equals_whole(spark):
    random.seed(2)
    rows = [(random.randrange(4), random.choice(["a", "b", None]), random.choice([None, 0.0, random.lognormvariate(10, 2), -random.random()])) for _ in range(2000)]
    df = frame(spark, rows)
    whole = {tuple(r) for r in S.build(df, ["g"], "x").collect()}
    days = [S.build(df.filter(f"day = {d}"), ["g"], "x") for d in range(4)]
    assert {tuple(r) for r in S.merge(days, ["g"]).collect()} == whole
    assert {tuple(r) for r in S.merge([S.build(df, ["day", "g"], "x")], ["g"]).collect()} == whole
    check(rows, S.percentiles(S.merge(days, ["g"]), ["g"], QS), S.ALPHA)


def test_hot_group_is_bounded(spark):
    df = frame(spark, [(1, "hot", float(i % 97)) for i in range(5000)])
    n = S.build(df, ["g"], "x").count()
    assert n <= 97 <= bucket_limit(S.ALPHA)


def test_empty_and_global(spark):
    none = frame(spark, [])
    assert S.percentiles(S.build(none, ["g"], "x"), ["g"], QS).count() == 0
    r = S.percentiles(S.build(frame(spark, [(1, "a", 4.0)]), [], "x"), [], [0.5]).first()
    assert r.value == pytest.approx(4.0, rel=S.ALPHA)


def test_clashing_key(spark):
    with pytest.raises(ValueError, match="bucket"):
        S.build(frame(spark, []).withColumnRenamed("g", "bucket"), ["bucket"], "x")
    with pytest.raises(ValueError):
        bucket_limit(1.5)
