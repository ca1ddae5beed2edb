"""Reports, enrichment and star schema on small tables with answers worked out by hand."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from leasemill.functions import exprs as X
from leasemill.operators import enrich, market, star, usage
from leasemill.plans.sqlapi import register_star, run_sql
from leasemill.schema import CONTRACTS

D = date


@pytest.fixture(scope="module")
def small(spark):
    rows = [
        # usage, rent, area, start, end
        ("Residential", 50000.0, 1000.0, D(2024, 1, 1), D(2024, 12, 31)),
        ("Residential", 60000.0, 1000.0, D(2024, 4, 6), D(2024, 5, 6)),
        ("Commercial", 90000.0, 100.0, D(2023, 7, 2), D(2025, 7, 2)),
        ("Commercial", 70000.0, None, None, None),
        (None, 80000.0, 900.0, D(2024, 10, 1), None),
        ("Non-Residential", -5.0, 500.0, D(2024, 12, 1), D(2024, 6, 1)),
        ("Industrial", None, 800.0, D(2024, 2, 29), D(2024, 2, 29)),
        ("Residential", float("nan"), 0.0, D(2024, 3, 1), D(2025, 3, 1)),
    ]
    return spark.createDataFrame(rows, "property_usage_en string, annual_amount double, actual_area double, contract_start_date date, contract_end_date date")


def by(df, key):
    return {r[key]: r.asDict() for r in df.collect()}


def test_usage_report(small):
    rows = usage.usage_report(small, F.lit(D(2025, 1, 1))).collect()
    assert [r.property_usage_en for r in rows] == ["Commercial", "Residential"]
    c, r = rows
    assert (c.no_of_contracts, c.avg_rent, c.median_rent, c.min_rent, c.max_rent) == (2, 80000, 80000, 70000, 90000)
    assert c.market_share_pct == 50 and c.median_area_sqft == 100 and c.avg_psf == 900 and c.report_date == D(2025, 1, 1)
    assert r.std_rent == pytest.approx(7071.0678, abs=1e-3) and r.avg_area_sqft == 1000
    assert rows[0].__fields__[6:8] == ["std_rent", "market_share_pct"]


def test_usage_report_without_area(small):
    out = usage.usage_report(small.drop("actual_area"))
    assert "avg_psf" not in out.columns and out.count() == 2


def test_empty_table_keeps_columns(small):
    none = small.filter("false")
    assert usage.usage_report(none).count() == 0
    assert market.usage_segments(none).columns == market.usage_segments(small).columns
    assert market.market_summary(none).first().total_contracts is None
    assert market.luxury_properties(none).count() == 0
    assert enrich.enrich(none).count() == 0


def test_compare_periods(small):
    now = small.filter(F.year("contract_start_date") == 2024)
    before = small.filter(F.year("contract_start_date") == 2023)
    rows = usage.compare_periods(now, before).collect()
    # Only in the earlier period: first, without a count of its own.
    assert rows[0].property_usage_en == "Commercial" and rows[0].current_contracts is None and rows[0].contract_change_pct is None
    assert rows[1].property_usage_en == "Residential" and rows[1].previous_contracts is None


def test_compare_periods_is_signed(small):
    r = [x for x in usage.compare_periods(small.filter("annual_amount = 50000"), small).collect() if x.property_usage_en == "Residential"][0]
    assert r.contract_change_pct == -50


def test_segments_keep_null_usage(small):
    rows = by(market.usage_segments(small), "property_usage_en")
    assert rows[None]["contract_count"] == 1 and sum(r["market_share_pct"] for r in rows.values()) == pytest.approx(100)


def test_psf_band_drops_other_usages(small):
    got = {(r.property_usage_en, r.psf) for r in market.psf_metrics(small).collect()}
    assert got == {("Residential", 50.0), ("Residential", 60.0)}  # 900 is above the commercial band


def test_missing_columns(small):
    assert market.psf_metrics(small.drop("actual_area")).columns == []
    assert market.area_stats(small).columns == [] and market.high_demand_areas(small).columns == []
    assert market.property_type_stats(small).columns == []
    assert market.rental_trends(small, period="daily").columns == [] and market.rental_trends(small, "nope").columns == []
    with pytest.raises(market.MissingColumns, match="annual_amount"):
        market.usage_segments(small.drop("annual_amount"))


def test_property_type_falls_back(spark):
    df = spark.createDataFrame([("Flat", 10.0), ("Flat", 20.0)], "ejari_property_sub_type_en string, annual_amount double")
    assert market.property_type_stats(df).first().median_rent == 15


def test_area_threshold_and_share(spark):
    rows = [("A", 50000.0, 1000.0)] * 12 + [("B", 50000.0, 1000.0)] * 11 + [("C", 50000.0, 1000.0)] * 9
    df = spark.createDataFrame([(a, r, s, "Residential") for a, r, s in rows], "area_name_en string, annual_amount double, actual_area double, property_usage_en string")
    assert [r.area_name_en for r in market.area_stats(df).collect()] == ["A", "B"]
    top = market.high_demand_areas(df, top_n=1).collect()
    assert len(top) == 1 and top[0].market_share_pct == pytest.approx(12 / 23 * 100)


def test_trends(small):
    months = [r.period for r in market.rental_trends(small).collect()]
    assert months == [D(2023, 7, 1), D(2024, 1, 1), D(2024, 4, 1), D(2024, 10, 1)]
    assert [r.period for r in market.rental_trends(small, period="quarterly").collect()] == [1, 2, 3, 4]
    assert [r.period for r in market.rental_trends(small, period="yearly").collect()] == [2023, 2024]
    assert market.rental_trends(small, period="quarter_start").first().period == D(2023, 7, 1)


def test_summary(small):
    s = market.summary_dict(small)
    assert s["total_contracts"] == 8 and s["max_rent"] == 90000 and s["avg_psf"] == 55
    assert s["usage_breakdown"][0]["contract_count"] == 2 and len(s["usage_breakdown"]) == 3


def test_enrich(small):
    df = small.withColumn("area_name_en", F.lit("X")).withColumn("ejari_property_type_en", F.lit(" \tFlat  "))
    rows = enrich.enrich(df).collect()
    assert len(rows) == 8 and len(rows[0]) == len(df.columns) + 12
    r = {x.annual_amount: x for x in rows if x.annual_amount is not None}
    assert (r[50000.0].contract_duration_days, r[50000.0].contract_duration_category, r[50000.0].contract_season) == (365, "Long-term", "Winter")
    assert r[60000.0].contract_weekday == 6 and r[60000.0].contract_duration_category == "Short-term"
    assert r[-5.0].contract_duration_category == "Short-term" and r[-5.0].usage_category == "Residential"
    assert r[70000.0].contract_season == "Fall" and r[70000.0].contract_duration_category == "Unknown"
    assert r[70000.0].price_per_sqft is None and r[70000.0].is_luxury is False
    assert r[90000.0].is_luxury and r[80000.0].usage_category == "Other"
    assert {x.property_type_normalized for x in rows} == {"flat"} and {x.area_tier for x in rows} == {"Mid-Tier"}


def test_enrich_uses_columns_there_are(small):
    out = enrich.enrich(small.select("contract_start_date"))
    assert out.columns == ["contract_start_date", "contract_year", "contract_quarter", "contract_month", "contract_weekday", "contract_season"]


@pytest.mark.parametrize("text,wanted", [("APT", "Apartment"), (" town house ", "Townhouse"), ("", "Unknown"), (None, "Unknown"), ("semi-detached unit", "Semi-Detached Unit"), ("o'neil  2b", "O'Neil  2B"), ("Plot", "Land")])
def test_property_type(spark, text, wanted):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(X.normal_property_type(F.col("t")).alias("x")).first().x == wanted


def test_tier_and_dates(spark):
    df = spark.createDataFrame([("Deira", "1-3-2024"), ("deira", "31-02-2024"), (None, "01-03-2024")], "a string, d string")
    rows = df.select(X.area_tier(F.col("a")).alias("tier"), X.parse_date(F.col("d")).alias("d")).collect()
    assert [r.tier for r in rows] == ["Budget", "Mid-Tier", "Mid-Tier"]
    assert [r.d for r in rows] == [D(2024, 3, 1), None, D(2024, 3, 1)]


@pytest.fixture(scope="module")
def contracts(spark):
    def row(i, **kw):
        base = dict.fromkeys(CONTRACTS.names)
        base |= {"contract_id": f"C{i % 3}", "line_number": i, "contract_reg_type_id": 1, "annual_amount": 10.0 * i, "property_usage_en": "Residential" if i % 2 else None, "tenant_type_id": i % 2, "area_id": 1, "project_number": 5 if i else None, "ejari_bus_property_type_id": 1, "ejari_property_type_id": 2}
        return tuple((base | kw)[c] for c in CONTRACTS.names)

    return spark.createDataFrame([row(i) for i in range(6)] + [row(5)], CONTRACTS)


def test_fact_has_the_grain_of_the_table(contracts):
    f = star.fact(contracts)
    assert f.count() == 7
    for name in ("contract_type", "property", "project", "location", "tenant"):
        assert star.orphans(f, star.dimension(contracts, name), f"{name}_key").count() == 0
        assert star.key_violations(star.dimension(contracts, name), [f"{name}_key"]).count() == 0


def test_multiplicities_tell_the_size_of_the_written_join(contracts):
    told = sum(r.n_joined for r in star.multiplicities(contracts).collect())
    assert told == star.fact_as_written(contracts).count() > 7


def test_star_is_written_and_its_constraints_hold(contracts, tmp_path):
    written = star.write(contracts, str(tmp_path / "star"))
    bad = {(r.table_name, r.kind, r.column_name): r.n_bad for r in star.constraints(written).collect()}
    assert not any(n for (_, kind, column), n in bad.items() if kind == "primary" or (kind == "foreign" and "date" not in column))
    assert len([k for k in bad if k[1] == "primary"]) == 6 and len([k for k in bad if k[1] == "foreign"]) == 7
    assert bad["fact", "not_null", "annual_amount"] == 0 and bad["fact", "not_null", "is_free_hold"] == 7
    twice = written | {"tenant": written["tenant"].unionByName(written["tenant"]), "project": written["project"].limit(0)}
    bad = {(r.table_name, r.kind, r.column_name): r.n_bad for r in star.constraints(twice).collect()}
    assert bad["tenant", "primary", "tenant_key"] == 2 and bad["fact", "foreign", "project_key"] == 7


def test_multiplicities_are_exact_beyond_doubles(spark):
    df = spark.createDataFrame([tuple({"contract_reg_type_id": 1, "area_id": 1, "tenant_type_id": 1, "project_number": 1, "ejari_bus_property_type_id": 1, "ejari_property_type_id": 1, "contract_id": f"C{i % 97}", "area_name_en": f"A{i % 89}", "project_name_en": f"P{i % 83}", "property_usage_en": f"U{i % 79}", "tenant_type_en": f"T{i % 73}"}.get(c) for c in CONTRACTS.names) for i in range(2000)], CONTRACTS)
    assert sum(int(r.n_joined) for r in star.multiplicities(df).collect()) == 2000 * 97 * 89 * 83 * 79 * 73


def test_sequence_key(contracts):
    df = contracts.select("contract_id", "line_number").distinct()
    keys = sorted(r.k for r in star.sequence_key(df, df.columns, "k", buckets=3).collect())
    assert keys == list(range(1, 7))


def test_views(contracts, spark):
    assert run_sql(contracts, "SELECT count(*) AS n FROM rent_contracts_df WHERE contract_id = 'C0'").first().n == 2
    assert "fact_rent_contract" in register_star(contracts)
    n = spark.sql("SELECT count(*) AS n FROM fact_rent_contract f JOIN dim_tenant t USING (tenant_key)").first().n
    assert n == 7


def test_expiry_and_flags(small):
    day = F.lit(D(2024, 12, 20)).cast("date")
    df = small.withColumn("contract_id", F.lit("x")).withColumn("line_number", F.lit(1))
    assert [r.days_until_expiry for r in star.expiring(df, day).collect()] == [11]
    flags = star.silver(small).collect()
    assert sum(r._has_date_issues for r in flags) == 4 and sum(r._has_amount_issues for r in flags) == 3
