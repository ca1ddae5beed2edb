"""Validation rules on the four-row table with hand-computed findings, and the exact ranks they rest on."""

from datetime import date

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from leasemill.operators import quality, ranks

SCHEMA = "contract_id bigint, contract_start_date date, contract_end_date date, property_usage_en string, annual_amount double, actual_area double"
D = date


@pytest.fixture(scope="module")
def four(spark):
    return spark.createDataFrame(
        [
            (1, D(2024, 1, 1), D(2024, 12, 31), "Residential", 50000.0, 1000.0),
            (2, D(2024, 2, 1), D(2024, 2, 1), "Commercial", 75000.0, 1500.0),
            (3, D(2024, 3, 1), D(2024, 3, 2), "Residential", -1000.0, 0.0),
            (4, None, None, None, None, None),
        ],
        SCHEMA,
    )


def test_findings(four):
    r = quality.validate(four)
    assert r.summary() == {"is_valid": False, "errors": 3, "warnings": 8, "info": 1}
    assert any("rent <= 0" in e for e in r.errors) and any("end_date <= start_date" in e for e in r.errors)
    assert "1 rents (33.33%) are below 10,000" in r.warnings
    assert r.info == ["4 rows looked at"] and "Errors (3)" in str(r)


def test_strict(four):
    assert quality.validate(four, strict=True).summary() == {"is_valid": False, "errors": 6, "warnings": 5, "info": 1}


def test_empty_and_missing(four):
    assert quality.validate(four.filter("false")).errors == ["DataFrame is empty"]
    r = quality.validate(four.drop("contract_id"))
    assert any("Missing required columns: contract_id" in e for e in r.errors)


def test_type_finding(four):
    r = quality.validate(four.withColumn("annual_amount", four.annual_amount.cast("decimal(10,2)")))
    assert any("should be a number but is decimal(10,2)" in w for w in r.warnings)


def test_outliers(spark):
    rents = [float(100 + i) for i in range(20)] + [1e6]
    df = spark.createDataFrame([(x,) for x in rents], "annual_amount double")
    o = quality.outliers(df).first()
    assert (o.n, o.n_outliers) == (21, 1)


@pytest.mark.parametrize("spread", [0.01, 0.5, 3.0])
def test_outliers_against_brute_force(spark, spread):
    rents = np.exp(np.random.default_rng(int(spread * 10)).normal(9, spread, 3000)).round(2)
    rents = [*rents.tolist(), *[float(np.median(rents))] * 500, 1e300, -5.0, float("nan"), float("inf")]
    valid = sorted(x for x in rents if x > 0)
    q1, q3 = (valid[int((len(valid) - 1) * q + 0.5)] for q in (0.25, 0.75))
    o = quality.outliers(spark.createDataFrame([(x,) for x in rents] + [(None,)], "annual_amount double")).first()
    assert (o.n, o.n_outliers) == (len(valid), sum(x < q1 - 3 * (q3 - q1) or x > q3 + 3 * (q3 - q1) for x in valid))
    assert quality.outliers(spark.createDataFrame([(None,)], "annual_amount double")).first().n == 0


def test_load_stats(spark):
    df = spark.createDataFrame([(50000.0, "Residential"), (75000.0, "Commercial"), (100000.0, "Residential"), (None, "Commercial")], "annual_amount double, property_usage_en string")
    r = quality.load_stats(df).first()
    assert (r.n_rows, r.null_rents, r.min_rent, r.max_rent, r.avg_rent, r.median_rent) == (4, 1, 50000, 100000, 75000, 75000)
    assert sorted((x.property_usage_en, x.n) for x in r.top_usages) == [("Commercial", 2), ("Residential", 2)]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.one_of(st.none(), st.sampled_from([0.0, 1.0, -1.0, 2.5]), st.floats(-1e9, 1e9)), max_size=40))
def test_ranks_are_exact(spark, values):
    df = spark.createDataFrame([(v, i % 2) for i, v in enumerate(values)], "x double, g int")
    got = {r.tag: r.v for r in ranks.nearest_rank(df, df.x, {"a": 0.25, "b": 0.8}).collect()}
    every = sorted(v for v in values if v is not None)
    assert got == ({t: every[int(q * (len(every) - 1) + 0.5)] for t, q in (("a", 0.25), ("b", 0.8))} if every else {})
    found = {(r._all, r.g): r for r in ranks.group_figures(df, ["g"], {"m": df.x, "m2": -df.x}, overall=True).collect()}
    for g in (0, 1, None):
        x = [v for i, v in enumerate(values) if g in (i % 2, None) and v is not None]
        assert ((g is None, g) in found) == bool(x)
        if x:
            m, m2 = found[g is None, g].m, found[g is None, g].m2
            assert (m.n, m.min, m.max, m.median, m2.median) == (len(x), min(x), max(x), pytest.approx(np.median(x)), pytest.approx(-np.median(x)))
            assert m.mean == pytest.approx(np.mean(x)) and m.std == (pytest.approx(np.std(x, ddof=1), abs=1e-6) if len(x) > 1 else None)
    q = spark.range(1).withColumn("q", ranks.nearest_ranks(df, {"lo": (df.x, 0.0), "hi": (df.x, 1.0)})).first().q
    assert (q.lo, q.hi) == ((every[0], every[-1]) if every else (None, None))


def test_medians_with_null_key_hot_value_and_odd_numbers(spark):
    rows = [(None, 7.0)] * 500 + [(None, float(i)) for i in range(100)] + [(1, 3.0), (1, float("nan")), (1, float("inf")), (1, 4.0), (2, None)]
    df = spark.createDataFrame(rows, "g int, x double")
    got = {r.g: r.m for r in ranks.group_figures(df, ["g"], {"m": df.x}).collect()}
    assert {g: m.median for g, m in got.items()} == {None: 7.0, 1: 4.0} and got[1].max == float("inf")
    counts = spark.createDataFrame([(1, 5.0, 10), (1, 6.0, 10), (2, 1.0, 3)], "g int, v double, n bigint")
    assert {r.g: r["median"] for r in ranks.exact_medians(counts, ["g"]).collect()} == {1: 5.5, 2: 1.0}
