"""The registered queries over a folder of Parquet tables, and the same results as SQL."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leasemill.functions import exprs as X
from leasemill.operators import enrich as E
from leasemill.operators import market as M
from leasemill.operators import parse, profile, quality, ranks, snapshots, star, usage
from leasemill.plans.sqlapi import run_sql
from leasemill.schema import DIMENSIONS, JOIN_KEYS
from leasemill.session import shared_path, store_path
from leasemill.sources.contracts import write_csv_report, write_parquet
from leasemill.settings import (
    AREA_TIERS,
    COMMERCIAL_USAGE,
    LIMITS,
    PROPERTY_TYPES,
    RESIDENTIAL_USAGE,
)

Query = Callable[[SparkSession, str], DataFrame]

#: Day of the expiry reports, fixed so that results repeat.
REPORT_DAY = "2025-04-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "rent_contracts")


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Means, deviations and shares to four decimals. Engines add in different orders, so the last bits of a double differ: the
    figures become decimals of seven places first, which are the same, and these are rounded, halves away from zero. What is
    too large for that, or no number, stays as it is."""
    return df.withColumns({c: F.expr(f"coalesce(cast(round(try_cast(`{c}` AS DECIMAL(38, 7)), 4) AS DOUBLE), `{c}`)") for c in columns})


def rounded_sql(sql: str) -> str:
    """The SQL with each ``round(x, 4)`` done in decimals, as :func:`rounded` does it."""
    out, at = [], 0
    while (start := sql.find("round(", at)) >= 0:
        depth, end = 1, start + 6
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[end], 0)
            end += 1
        inner = rounded_sql(sql[start + 6 : end - 1])
        whole = start == 0 or not (sql[start - 1].isalnum() or sql[start - 1] == "_")
        x = inner.removesuffix(", 4")
        out += [sql[at:start], f"CAST(round(TRY_CAST({x} AS DECIMAL(38, 7)), 4) AS DOUBLE)" if whole and x != inner else f"round({inner})"]
        at = end
    return "".join(out) + sql[at:]


def on_contracts(f: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: f(contracts(spark, sf_dir))


# Contract line used where the result is one row for each line; the figures that matter and a key.
LINE = ["contract_id", "line_number", "load_id", "annual_amount"]


def _usage_report(df: DataFrame) -> DataFrame:
    return rounded(usage.usage_report(df).drop("report_date"), "avg_rent", "median_rent", "std_rent", "market_share_pct", "avg_area_sqft", "median_area_sqft", "avg_psf", "median_psf")


def _compare(df: DataFrame) -> DataFrame:
    year = lambda y: df.filter(F.year("contract_start_date") == y)
    out = usage.compare_periods(year(2024), year(2023)).drop("report_date")
    return rounded(out, "current_avg_rent", "previous_avg_rent", "contract_change_pct", "rent_change_pct")


def _summary(df: DataFrame) -> DataFrame:
    out = M.market_summary(df).withColumn("n_usages", F.size("usage_breakdown").cast("bigint")).withColumn("largest_usage", F.col("usage_breakdown")[0]["property_usage_en"]).drop("usage_breakdown")
    return rounded(out, "avg_rent", "median_rent", "avg_psf", "median_psf")


def _load_stats(df: DataFrame) -> DataFrame:
    out = quality.load_stats(df).withColumn("top_usage", F.col("top_usages")[0]["property_usage_en"]).withColumn("top_usage_n", F.col("top_usages")[0]["n"]).drop("top_usages")
    return rounded(out, "avg_rent", "median_rent")


def _enrich(df: DataFrame) -> DataFrame:
    out = E.enrich(df)
    ints = ["contract_year", "contract_quarter", "contract_month", "contract_weekday", "contract_duration_days"]
    return out.select(*LINE, "price_per_sqft", "area_tier", "property_type_normalized", *[F.col(c).cast("bigint").alias(c) for c in ints], "contract_season", "contract_duration_category", "is_luxury", "usage_category")


def _dim(name: str) -> Query:
    return on_contracts(lambda df: star.dimension(df, name).drop(f"{name}_key"))


#: What the fact query shows of each dimension.
SHOWN = {"contract_type": ["contract_id", "contract_reg_type_en"], "property": ["ejari_property_type_en", "property_usage_en"], "project": ["project_number", "project_name_en"], "location": ["area_id", "area_name_en"], "tenant": ["tenant_type_en"]}


def _fact(df: DataFrame) -> DataFrame:
    """The fact table at its grain, joined back to all five dimensions and, for both dates, to the calendar."""
    out, days = star.fact(df), star.dim_date(df.sparkSession)
    for name, shown in SHOWN.items():
        out = out.join(star.dimension(df, name).select(f"{name}_key", *shown), f"{name}_key")
    for side in ("start", "end"):
        out = out.join(days.select(F.col("date_key").alias(f"{side}_date_key"), F.col("day_of_week").alias(f"{side}_weekday")), f"{side}_date_key", "left")
    return out.select(*[c for shown in SHOWN.values() for c in shown], "contract_start_date", "contract_end_date", "start_date_key", "end_date_key", "start_weekday", "end_weekday", *star.MEASURES)


def _star_written(df: DataFrame) -> DataFrame:
    """The star schema written and read back, then contracts and rents by usage and area from it."""
    t = star.write(df, shared_path(df.sparkSession, "star"))
    joined = t["fact"].join(t["property"].select("property_key", "property_usage_en"), "property_key").join(t["location"].select("location_key", "area_name_en"), "location_key")
    return joined.groupBy("property_usage_en", "area_name_en").agg(F.count("*").alias("n"), F.max("annual_amount").alias("top_rent"))


def _parquet_sink(df: DataFrame) -> DataFrame:
    path = shared_path(df.sparkSession, "sink")
    write_parquet(df, path)
    write_parquet(df.limit(0), path, mode="ignore")  # leaves what is there
    return df.sparkSession.read.parquet(path).select(*LINE, "property_usage_en", "contract_end_date")


def _csv_report(df: DataFrame) -> DataFrame:
    path = shared_path(df.sparkSession, "report")
    write_csv_report(M.usage_segments(df).select("property_usage_en", "contract_count", "max_rent"), path)
    return df.sparkSession.read.schema("property_usage_en string, contract_count bigint, max_rent double").csv(path, header=True, quote='"', escape='"')


def _lacking(df: DataFrame, lacks: str, types: dict[str, str], rules: tuple[str, ...]) -> DataFrame:
    """The findings about the schema of a table that lacks a column and has others in another type."""
    odd = df.drop(lacks).withColumns({c: F.col(c).cast(t) for c, t in types.items()})
    return quality.findings(odd).filter(F.col("rule").isin(*rules)).select("rule", "field", "severity")


def _sql_facade(df: DataFrame) -> DataFrame:
    return run_sql(df, "SELECT area_name_en, count(*) AS n, max(annual_amount) AS top_rent FROM rent_contracts WHERE property_usage_en = 'Residential' GROUP BY area_name_en")


def _types(df: DataFrame) -> DataFrame:
    out = E.with_property_type(E.with_area_tier(df))
    return out.groupBy("area_tier", "property_type").agg(F.count("*").alias("n"))


def labels(spark: SparkSession, sf_dir: str, most: int = 10_000) -> tuple[str, ...]:
    """The valid usage labels, from their table; a label list beyond ``most`` is no list of labels and is refused."""
    rows = table(spark, sf_dir, "usage_labels").select("property_usage_en").filter(F.col("property_usage_en").isNotNull()).distinct().limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} usage labels")
    return tuple(sorted(r[0] for r in rows))


def profile_rules(usage_labels: tuple[str, ...]) -> list[profile.ColumnRule]:
    return [
        profile.ColumnRule("annual_amount", LIMITS.min_annual_rent, LIMITS.max_annual_rent),
        profile.ColumnRule("actual_area", LIMITS.min_property_size, LIMITS.max_property_size),
        profile.ColumnRule("property_usage_en", labels=usage_labels),
    ]


def load_state(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[profile.ColumnRule]]:
    """The count tables of all loads, from the store of this table: loads that an earlier run has counted are not counted
    again (see ``CountStore.refresh``), whatever is asked of them."""
    rules = profile_rules(labels(spark, sf_dir))
    store = profile.CountStore(spark, store_path(spark, f"rent_contracts-{hashlib.sha256(sf_dir.encode()).hexdigest()[:16]}"))
    return store.refresh(contracts(spark, sf_dir), rules, "load_id"), rules


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    state, rules = load_state(spark, sf_dir)
    return profile.departures(state, rules).withColumnRenamed("grp", "load_id")


def _profile_by_load(state: DataFrame, rules: list[profile.ColumnRule]) -> DataFrame:
    out = profile.profile(state, rules).drop("top_num", "top_txt").withColumnRenamed("grp", "load_id")
    return rounded(out, "null_rate", "bad_share", "top_share", "entropy")


def p1_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _profile_by_load(*load_state(spark, sf_dir))


def p1_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile after four runs on one store, each of which finds it by its path: the first half of the loads, one of them
    delivered in part; all loads; the same again; and all but one, which is taken back."""
    rules, rows = profile_rules(labels(spark, sf_dir)), contracts(spark, sf_dir)
    path = shared_path(spark, "resumed")
    half = rows.filter((F.col("load_id") <= 6) & ((F.col("load_id") != 3) | (F.col("line_number") == 1)))
    for part in (half, rows, rows, rows.filter((F.col("load_id") != 2) | F.col("load_id").isNull())):
        state = profile.CountStore(spark, path).refresh(part, rules, "load_id")
    return _profile_by_load(state, rules)


def p1_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How each load differs from the load before it, and from the whole table."""
    state, _ = load_state(spark, sf_dir)
    return rounded(profile.distribution_change(state), "shift", "shift_whole").withColumnRenamed("grp", "load_id")


def p1_rolled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile of the table after its first load is taken back: a state, then a signed delta."""
    rules = profile_rules(labels(spark, sf_dir))
    rows = contracts(spark, sf_dir)
    store = profile.CountStore(spark)
    whole = F.lit(0)
    store.apply(profile.delta(rows, rules, whole))
    state = store.apply(profile.delta(rows.filter(F.col("load_id") == 1), rules, whole, sign=-1))
    out = profile.profile(state, rules).drop("top_num", "top_txt", "grp")
    return rounded(out, "null_rate", "bad_share", "top_share", "entropy")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = snapshots.changes(table(spark, sf_dir, "rent_contract_snapshots"))
    return out.select(F.date_format("snapshot_date", "yyyy-MM-dd").alias("snapshot_date"), "contract_id", "line_number", "change_kind")


def p3_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = snapshots.changes(table(spark, sf_dir, "rent_contract_snapshots"))
    return out.withColumns({c: F.round(c, 2) for c in ("old_annual_amount", "new_annual_amount")})


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.rejects(parse.parse_records(table(spark, sf_dir, "rent_contracts_raw")))


def p4_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.valid_rows(parse.parse_records(table(spark, sf_dir, "rent_contracts_raw")))


def queries() -> dict[str, Query]:
    q: dict[str, Query] = {
        "scan_filter_project": on_contracts(lambda df: df.filter((F.col("property_usage_en") == "Residential") & (F.col("annual_amount") > 100000)).select("contract_id", "line_number", "annual_amount")),
        "filter_valid_rent": on_contracts(lambda df: M.filter_valid_rent(df).select(*LINE)),
        "psf_metrics": on_contracts(lambda df: M.psf_metrics(df).select(*LINE, "actual_area", "property_usage_en", "psf")),
        "area_stats": on_contracts(lambda df: rounded(M.area_stats(df), "avg_rent", "median_rent", "avg_psf", "median_psf", "avg_area")),
        "high_demand_areas": on_contracts(lambda df: rounded(M.high_demand_areas(df), "avg_rent", "median_rent", "avg_psf", "median_psf", "avg_area", "market_share_pct")),
        "property_type_stats": on_contracts(lambda df: rounded(M.property_type_stats(df), "avg_rent", "median_rent", "market_share_pct")),
        "usage_segments": on_contracts(lambda df: rounded(M.usage_segments(df), "avg_rent", "median_rent", "market_share_pct")),
        "luxury_properties": on_contracts(lambda df: M.luxury_properties(df).select(*LINE, "psf", "is_luxury")),
        "trend_monthly": on_contracts(lambda df: rounded(M.rental_trends(df), "avg_rent", "median_rent")),
        "trend_quarterly": on_contracts(lambda df: rounded(M.rental_trends(df, period="quarterly"), "avg_rent", "median_rent").withColumn("period", F.col("period").cast("bigint"))),
        "trend_yearly": on_contracts(lambda df: rounded(M.rental_trends(df, period="yearly"), "avg_rent", "median_rent").withColumn("period", F.col("period").cast("bigint"))),
        "trend_quarter_start": on_contracts(lambda df: rounded(M.rental_trends(df, period="quarter_start"), "avg_rent", "median_rent")),
        "market_summary": on_contracts(_summary),
        "usage_report": on_contracts(_usage_report),
        "compare_periods": on_contracts(_compare),
        "enrich": on_contracts(_enrich),
        "area_tiers_and_types": on_contracts(_types),
        "quantile_nearest": on_contracts(lambda df: ranks.nearest_rank(df.filter(X.valid_rent()), F.col("annual_amount"), {"q25": 0.25, "q50": 0.5, "q75": 0.75, "q80": 0.8})),
        "dq_profile": on_contracts(quality.profile),
        "dq_findings": on_contracts(lambda df: rounded(quality.findings(df).drop("message"), "pct")),
        "dq_findings_strict": on_contracts(lambda df: quality.findings(df, strict=True).select("rule", "field", "severity", "n_bad")),
        "dq_date_order": on_contracts(lambda df: quality.date_order_violations(df).select(*LINE)),
        "dq_outliers": on_contracts(quality.outliers),
        "load_stats": on_contracts(_load_stats),
        "top_usages": on_contracts(quality.top_usages),
        "sql_facade": on_contracts(_sql_facade),
        "dim_contract_type": _dim("contract_type"),
        "dim_property": _dim("property"),
        "dim_project": _dim("project"),
        "dim_location": _dim("location"),
        "dim_tenant": _dim("tenant"),
        "dim_date": lambda spark, sf_dir: star.dim_date(spark),
        "dim_sequence_key": on_contracts(lambda df: star.sequence_key(df.select(*DIMENSIONS["project"]).distinct(), DIMENSIONS["project"], "project_seq").agg(F.count("*").alias("n"), F.min("project_seq").alias("lo"), F.max("project_seq").alias("hi"), F.count_distinct("project_seq").alias("n_keys"))),
        "fact_contract": on_contracts(_fact),
        "fact_contract_as_written": on_contracts(star.multiplicities),
        "star_written": on_contracts(_star_written),
        "dq_constraints": on_contracts(lambda df: star.constraints(star.tables(df))),
        "parquet_sink": on_contracts(_parquet_sink),
        "csv_report": on_contracts(_csv_report),
        "usage_report_today": on_contracts(lambda df: usage.usage_report(df).select("property_usage_en", "no_of_contracts", "report_date")),
        "dq_empty": on_contracts(lambda df: quality.findings(df.filter("false")).select("rule", "severity", "n_bad", "message")),
        "dq_missing_column": on_contracts(lambda df: _lacking(df, "property_usage_en", {}, ("schema",))),
        "dq_types": on_contracts(lambda df: _lacking(df, "source_file", {"contract_amount": "decimal(18,2)", "no_of_prop": "string"}, ("type",))),
        "dq_sample": on_contracts(lambda df: quality.sample(df, 5000).agg(F.count("*").alias("n"))),
        "fallback_property_type": on_contracts(lambda df: M.property_type_stats(df.drop("ejari_property_type_en")).select("ejari_property_sub_type_en", "contract_count", "max_rent")),
        "star_usage_rollup": on_contracts(lambda df: rounded(star.usage_rollup(star.fact(df), star.dimension(df, "property")), "avg_rent")),
        "dq_keys": on_contracts(lambda df: star.key_violations(df, ["contract_id", "line_number"])),
        "dq_orphans": on_contracts(lambda df: star.orphans(star.fact(df), star.dimension(df, "project").filter(F.col("project_number").isNotNull()), "project_key").groupBy("line_number").agg(F.count("*").alias("n"))),
        "expiring_contracts": on_contracts(lambda df: star.expiring(df, F.lit(REPORT_DAY).cast("date")).select(*LINE, "contract_end_date", F.col("days_until_expiry").cast("bigint").alias("days_until_expiry"))),
        "expiring_by_usage": on_contracts(lambda df: rounded(star.expiring_by_usage(df, F.lit(REPORT_DAY).cast("date")), "avg_rent")),
        "silver_contracts": on_contracts(lambda df: star.silver(df).select(*LINE, "_has_date_issues", "_has_amount_issues")),
        "p1_found": p1_found,
        "p1_profile": p1_profile,
        "p1_resumed": p1_resumed,
        "p1_shift": p1_shift,
        "p1_rolled": p1_rolled,
        "p3_found": p3_found,
        "p3_values": p3_values,
        "p4_found": p4_found,
        "p4_valid": p4_valid,
    }
    from leasemill.plans import files

    return q | files.queries()


# ---------------------------------------------------------------------------------------------------------------- SQL

RENT = "annual_amount > 0 AND NOT isnan(annual_amount)"
AREA = "actual_area > 0 AND NOT isnan(actual_area)"
_in = lambda names: "(" + ", ".join(f"'{n}'" for n in names) + ")"
BANDED = f"""SELECT *, annual_amount / actual_area AS psf FROM rent_contracts WHERE {RENT} AND {AREA} AND (
    (property_usage_en IN {_in(RESIDENTIAL_USAGE)} AND annual_amount / actual_area BETWEEN 20 AND 500)
    OR (property_usage_en IN {_in(COMMERCIAL_USAGE)} AND annual_amount / actual_area BETWEEN 30 AND 800))"""
STATS = "count(*) AS contract_count, round(avg(annual_amount), 4) AS avg_rent, round(median(annual_amount), 4) AS median_rent"
FULL = f"{STATS}, min(annual_amount) AS min_rent, max(annual_amount) AS max_rent"
SHARE = "round(count(*) / sum(count(*)) OVER () * 100.0, 4) AS market_share_pct"
AREA_STATS = f"SELECT area_name_en, {FULL}, round(avg(psf), 4) AS avg_psf, round(median(psf), 4) AS median_psf, round(avg(actual_area), 4) AS avg_area FROM banded GROUP BY area_name_en HAVING count(*) >= 10"


def _nearest(source: str, column: str, q: float) -> str:
    return f"(SELECT x FROM (SELECT {column} AS x, row_number() OVER (ORDER BY {column}) AS rn, count(*) OVER () AS n FROM ({source}) WHERE {column} IS NOT NULL) WHERE rn = floor((n - 1) * {q} + 0.5) + 1)"


def _trend(period: str) -> str:
    return f"SELECT {period} AS period, {STATS} FROM rent_contracts WHERE {RENT} AND contract_start_date IS NOT NULL GROUP BY 1"


def _rule_sql() -> list[tuple[str, str, str, str, str]]:
    """(rule, field, severity, predicate, base) as SQL."""
    days = "date_diff('day', contract_start_date, contract_end_date)"
    out = [("required_null", c, "warning", f"{c} IS NULL", "true") for c in ("contract_id", "contract_start_date", "property_usage_en", "annual_amount")]
    for rule, c, low, high in (("rent", "annual_amount", 10000, 5000000), ("size", "actual_area", 200, 50000)):
        there = f"{c} IS NOT NULL"
        out += [(f"{rule}_not_positive", c, "error", f"{c} <= 0", ""), (f"{rule}_below_min", c, "warning", f"{c} < {low}", there), (f"{rule}_above_max", c, "warning", f"{c} > {high}", there)]
    out += [("date_null", c, "warning", f"{c} IS NULL", "true") for c in ("contract_start_date", "contract_end_date")]
    out += [("date_order", "contract_end_date", "error", "contract_end_date <= contract_start_date", ""), ("too_short", "contract_end_date", "warning", f"{days} < 30", ""), ("too_long", "contract_end_date", "warning", f"{days} > 730", "")]
    return out


def _profile_sql() -> str:
    return " UNION ALL ".join(f"SELECT '{r}' AS rule, '{c}' AS field, '{s}' AS severity, count(*) FILTER ({p}) AS n_bad, {f'count(*) FILTER ({b})' if b else 'CAST(NULL AS BIGINT)'} AS n_base FROM rent_contracts" for r, c, s, p, b in _rule_sql())


OUTLIERS = f"""SELECT count(*) AS n, count(*) FILTER (annual_amount < q1 - 3.0 * (q3 - q1) OR annual_amount > q3 + 3.0 * (q3 - q1)) AS n_outliers
FROM rent_contracts, (SELECT {_nearest(f"SELECT * FROM rent_contracts WHERE {RENT}", "annual_amount", 0.25)} AS q1, {_nearest(f"SELECT * FROM rent_contracts WHERE {RENT}", "annual_amount", 0.75)} AS q3) WHERE {RENT}"""


def _findings_sql(strict: bool) -> str:
    pick = "CASE WHEN rule = 'required_null' THEN 'error' ELSE severity END" if strict else "severity"
    pct = "" if strict else ", CASE WHEN n_base IS NOT NULL THEN round(n_bad / n_base * 100.0, 4) END AS pct"
    none = "" if strict else ", CAST(NULL AS DOUBLE) AS pct"
    share = "" if strict else ", round(n_outliers / n * 100.0, 4) AS pct"
    return f"""SELECT rule, field, {pick} AS severity, n_bad{pct} FROM ({_profile_sql()}) WHERE n_bad > 0
    UNION ALL SELECT 'records', '', 'info', count(*){none} FROM rent_contracts
    UNION ALL SELECT 'outliers', 'annual_amount', 'info', n_outliers{share} FROM ({OUTLIERS}) WHERE n >= 10 AND n_outliers > 0"""


def _case_map(column: str, pairs: list[tuple[str, str]], other: str) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in pairs) + f" ELSE {other} END"


def _multiplicity_sql() -> str:
    joins, product = [], []
    for name, keys in JOIN_KEYS.items():
        columns = ", ".join(DIMENSIONS[name])
        joins.append(f"LEFT JOIN (SELECT {', '.join(keys)}, count(*) AS n FROM (SELECT DISTINCT {columns} FROM rent_contracts) GROUP BY ALL) {name} ON " + " AND ".join(f"rc.{k} = {name}.{k}" for k in keys))
        product.append(f"CAST(coalesce({name}.n, 0) AS HUGEINT)")
    return f"SELECT rc.property_usage_en, count(*) AS n_lines, CAST(sum({' * '.join(product)}) AS DECIMAL(38, 0)) AS n_joined FROM rent_contracts rc {' '.join(joins)} GROUP BY 1"


def _constraints_sql() -> str:
    """Keys are made from the content, so the dimensions' keys hold by construction; the calendar ends on both sides."""
    out = [f"SELECT '{n}' AS table_name, 'primary' AS kind, '{n}_key' AS column_name, CAST(0 AS BIGINT) AS n_bad" for n in [*DIMENSIONS, "date"]]
    out += [f"SELECT 'fact', 'foreign', '{n}_key', CAST(0 AS BIGINT)" for n in DIMENSIONS]
    out += [f"SELECT 'fact', 'foreign', '{s}_date_key', count(*) FILTER (contract_{s}_date NOT BETWEEN DATE '{star.FIRST_DAY}' AND DATE '{star.LAST_DAY}') FROM rent_contracts" for s in ("start", "end")]
    for name, columns in star.NOT_NULL.items():
        source = "rent_contracts" if name == "fact" else f"(SELECT DISTINCT {', '.join(DIMENSIONS[name])} FROM rent_contracts)"
        out += [f"SELECT '{name}', 'not_null', '{c}', count(*) FILTER ({c} IS NULL) FROM {source}" for c in columns]
    return " UNION ALL ".join(out)


CELLS = " UNION ALL ".join(f"SELECT load_id, '{c}' AS column_name, {n} AS num, {t} AS txt FROM rent_contracts" for c, n, t in (("annual_amount", "annual_amount", "CAST(NULL AS VARCHAR)"), ("actual_area", "actual_area", "CAST(NULL AS VARCHAR)"), ("property_usage_en", "CAST(NULL AS DOUBLE)", "property_usage_en")))
BAD = "((column_name = 'annual_amount' AND NOT num BETWEEN 10000 AND 5000000) OR (column_name = 'actual_area' AND NOT num BETWEEN 200 AND 50000) OR (column_name = 'property_usage_en' AND txt NOT IN (SELECT property_usage_en FROM usage_labels)))"
LIVE = "(num IS NOT NULL OR txt IS NOT NULL)"

P1_FOUND = f"""WITH cells AS ({CELLS}),
base AS (SELECT load_id, column_name, count(*) AS n, count(*) FILTER ({LIVE}) AS live, count(*) FILTER ({LIVE} AND {BAD}) AS bad,
  median(num) FILTER (num > 0) AS lvl FROM cells GROUP BY ALL),
tops AS (SELECT load_id, column_name, max(c) AS top FROM (SELECT load_id, column_name, num, txt, count(*) AS c FROM cells WHERE {LIVE} GROUP BY ALL) GROUP BY ALL),
mixes AS (SELECT b.load_id, b.column_name, l.property_usage_en AS label, (SELECT count(*) FROM cells c WHERE c.load_id = b.load_id AND c.txt = l.property_usage_en) / b.live AS x
  FROM base b, usage_labels l WHERE b.column_name = 'property_usage_en' AND b.live > 0),
fig AS (
  SELECT load_id, column_name, 'null_rate' AS finding, '' AS label, (n - live) / n AS x FROM base
  UNION ALL SELECT load_id, column_name, CASE WHEN column_name = 'property_usage_en' THEN 'pattern' ELSE 'range' END, '', bad / live FROM base WHERE live > 0
  UNION ALL SELECT load_id, column_name, 'top_share', '', top / live FROM base JOIN tops USING (load_id, column_name) WHERE column_name <> 'property_usage_en'
  UNION ALL SELECT load_id, column_name, 'level', '', lvl FROM base WHERE lvl IS NOT NULL AND column_name <> 'property_usage_en'
  UNION ALL SELECT load_id, column_name, 'mix', label, x FROM mixes),
med AS (SELECT *, median(x) OVER (PARTITION BY column_name, finding, label) AS m FROM fig)
SELECT DISTINCT load_id, column_name, finding FROM med WHERE CASE finding WHEN 'null_rate' THEN abs(x - m) > 0.05 WHEN 'range' THEN x - m > 0.05
  WHEN 'top_share' THEN x - m > 0.10 WHEN 'pattern' THEN x - m > 0.10 WHEN 'mix' THEN abs(x - m) > 0.15 ELSE x > m * 1.6 OR m > x * 1.6 END"""


def _p1_profile_sql(group: str, where: str) -> str:
    lead = f"{group}, " if group else ""
    return f"""WITH cells AS ({CELLS}), kept AS (SELECT * FROM cells WHERE {where}),
    cnt AS (SELECT {lead}column_name, num, txt, count(*) AS c FROM kept GROUP BY ALL)
    SELECT {lead}column_name, CAST(sum(c) AS BIGINT) AS n_rows, CAST(coalesce(sum(c) FILTER (NOT {LIVE}), 0) AS BIGINT) AS n_null,
      round(coalesce(sum(c) FILTER (NOT {LIVE}), 0) / sum(c), 4) AS null_rate, count(*) FILTER ({LIVE}) AS n_distinct, min(num) AS min_num, max(num) AS max_num,
      CAST(coalesce(sum(c) FILTER ({LIVE} AND {BAD}), 0) AS BIGINT) AS n_bad, round(coalesce(sum(c) FILTER ({LIVE} AND {BAD}), 0) / sum(c) FILTER ({LIVE}), 4) AS bad_share,
      max(c) FILTER ({LIVE}) AS top_n, round(max(c) FILTER ({LIVE}) / sum(c) FILTER ({LIVE}), 4) AS top_share,
      round(log2(sum(c) FILTER ({LIVE})) - sum(c * log2(c)) FILTER ({LIVE}) / sum(c) FILTER ({LIVE}), 4) AS entropy
    FROM cnt GROUP BY {lead}column_name"""


P1_SHIFT = f"""WITH cells AS ({CELLS}), live AS (SELECT * FROM cells WHERE {LIVE}),
g AS (SELECT load_id, column_name, num, txt, count(*) AS n FROM live GROUP BY ALL),
w AS (SELECT column_name, num, txt, count(*) AS w FROM live GROUP BY ALL),
gs AS (SELECT load_id, column_name, sum(n) AS g, row_number() OVER (PARTITION BY column_name ORDER BY load_id NULLS FIRST) AS place FROM g GROUP BY load_id, column_name),
ws AS (SELECT column_name, sum(w) AS t FROM w GROUP BY ALL),
d AS (SELECT gs.load_id, gs.column_name, abs(coalesce(g.n, 0) / gs.g - w.w / ws.t) AS x, abs(coalesce(g.n, 0) / gs.g - coalesce(o.n, 0) / os.g) AS y
  FROM gs JOIN w ON gs.column_name = w.column_name JOIN ws ON ws.column_name = w.column_name
  LEFT JOIN g ON g.load_id IS NOT DISTINCT FROM gs.load_id AND g.column_name = w.column_name AND g.num IS NOT DISTINCT FROM w.num AND g.txt IS NOT DISTINCT FROM w.txt
  LEFT JOIN gs os ON os.column_name = gs.column_name AND os.place = gs.place - 1
  LEFT JOIN g o ON o.load_id IS NOT DISTINCT FROM os.load_id AND os.place IS NOT NULL AND o.column_name = w.column_name AND o.num IS NOT DISTINCT FROM w.num AND o.txt IS NOT DISTINCT FROM w.txt)
SELECT load_id, column_name, round(sum(y) / 2, 4) AS shift, round(sum(x) / 2, 4) AS shift_whole FROM d GROUP BY 1, 2"""

P3_BASE = r"""WITH rows AS (SELECT snapshot_date, upper(regexp_replace(regexp_replace(contract_id, '^\s+', ''), '\s+$', '')) AS contract_id, line_number, round(annual_amount, 2) AS a, contract_end_date AS e, loaded_at FROM rent_contract_snapshots),
held AS (SELECT * FROM rows QUALIFY row_number() OVER (PARTITION BY snapshot_date, contract_id, line_number ORDER BY loaded_at DESC) = 1),
days AS (SELECT snapshot_date AS d, lag(snapshot_date) OVER (ORDER BY snapshot_date) AS p FROM (SELECT DISTINCT snapshot_date FROM rows)),
now AS (SELECT days.d, held.* FROM days JOIN held ON held.snapshot_date = days.d WHERE p IS NOT NULL),
old AS (SELECT days.d, held.* FROM days JOIN held ON held.snapshot_date = days.p),
diff AS (SELECT coalesce(n.d, o.d) AS d, coalesce(n.contract_id, o.contract_id) AS contract_id, coalesce(n.line_number, o.line_number) AS line_number,
  CASE WHEN o.d IS NULL THEN 'added' WHEN n.d IS NULL THEN 'removed' ELSE 'changed' END AS change_kind, o.a AS old_annual_amount, o.e AS old_contract_end_date, n.a AS new_annual_amount, n.e AS new_contract_end_date
  FROM now n FULL JOIN old o ON n.d = o.d AND n.contract_id = o.contract_id AND n.line_number = o.line_number
  WHERE o.d IS NULL OR n.d IS NULL OR n.a IS DISTINCT FROM o.a OR n.e IS DISTINCT FROM o.e)
"""

FIELD = r'"(?:[^"]|"")*"|[^",][^",]*|'
P4_BASE = rf"""WITH t AS (SELECT raw_id, regexp_replace(regexp_replace(coalesce(line, ''), '\A\x{{FEFF}}', ''), '\r\z', '') AS s FROM rent_contracts_raw),
sound AS (SELECT raw_id, s, regexp_full_match(s, '(?s)(?:{FIELD})(?:,(?:{FIELD}))*') AS ok FROM t),
cut AS (SELECT *, CASE WHEN ok THEN regexp_extract_all(',' || s, ',({FIELD})', 1) END AS f FROM sound),
vals AS (SELECT *, CASE WHEN len(f) = 12 THEN list_transform(f, lambda x: CASE WHEN x[1] = '"' THEN replace(x[2:-2], '""', '"') ELSE x END) END AS v FROM cut),
j AS (SELECT *, trim(v[5], chr(32) || chr(9) || chr(160)) AS am, trim(v[10], chr(32) || chr(9) || chr(160)) AS ar, trim(v[3], chr(32) || chr(9) || chr(160)) AS sd FROM vals),
r AS (SELECT *, CASE WHEN NOT ok THEN 'quoting' WHEN v IS NULL THEN 'column_count'
  WHEN am NOT IN ('', 'null', 'NULL') AND NOT regexp_full_match(am, '-?[0-9]+(\.[0-9]+)?') THEN 'annual_amount'
  WHEN ar NOT IN ('', 'null', 'NULL') AND NOT regexp_full_match(ar, '-?[0-9]+(\.[0-9]+)?') THEN 'actual_area'
  WHEN sd NOT IN ('', 'null', 'NULL') AND (NOT regexp_full_match(sd, '[0-9]{{2}}-[0-9]{{2}}-[0-9]{{4}}') OR try_strptime(sd, '%d-%m-%Y') IS NULL) THEN 'contract_start_date' END AS reason FROM j)
"""


def _p4_cell(i: int, kind: str) -> str:
    x = f"trim(v[{i}], chr(32) || chr(9) || chr(160))"
    if kind == "text":
        return f"CASE WHEN v[{i}] NOT IN ('', 'null', 'NULL') THEN v[{i}] END"
    if kind == "date":
        return f"CASE WHEN regexp_full_match({x}, '[0-9]{{2}}-[0-9]{{2}}-[0-9]{{4}}') THEN CAST(try_strptime({x}, '%d-%m-%Y') AS DATE) END"
    if kind == "int":
        return f"CASE WHEN regexp_full_match({x}, '-?[0-9]+') THEN TRY_CAST({x} AS BIGINT) END"
    return f"CASE WHEN regexp_full_match({x}, '-?[0-9]+(\\.[0-9]+)?') THEN CAST({x} AS DOUBLE) END"


P4_VALID = P4_BASE + "SELECT raw_id, " + ", ".join(
    f"{_p4_cell(i, k)} AS {c}"
    for i, (c, k) in enumerate(
        [("contract_id", "text"), ("contract_reg_type_en", "text"), ("contract_start_date", "date"), ("contract_end_date", "date"), ("annual_amount", "num"), ("contract_amount", "num"), ("property_usage_en", "text"), ("project_name_en", "text"), ("area_name_en", "text"), ("actual_area", "num"), ("tenant_type_en", "text"), ("line_number", "int")], 1
    )
) + " FROM r WHERE reason IS NULL"


def oracle_sql() -> dict[str, str]:
    line = ", ".join(LINE)
    dims = {f"dim_{n}": f"SELECT DISTINCT {', '.join(c)} FROM rent_contracts" for n, c in DIMENSIONS.items()}
    usage_cte = f"SELECT property_usage_en, {{}} FROM rent_contracts WHERE property_usage_en IS NOT NULL AND {RENT} AND year(contract_start_date) = {{}} GROUP BY 1"
    psf = f"CASE WHEN {RENT} AND {AREA} THEN annual_amount / actual_area END"
    types = [*PROPERTY_TYPES.items()]
    kind = "lower(regexp_replace(regexp_replace(ejari_property_type_en, '^[\\s\\x{A0}]+', ''), '[\\s\\x{A0}]+$', ''))"
    title = "list_reduce(list_transform(regexp_extract_all(lower(ejari_property_type_en), '\\p{L}+|[^\\p{L}]+'), lambda w: upper(w[1]) || w[2:]), lambda a, b: a || b)"
    q = {
        "scan_filter_project": "SELECT contract_id, line_number, annual_amount FROM rent_contracts WHERE property_usage_en = 'Residential' AND annual_amount > 100000",
        "filter_valid_rent": f"SELECT {line} FROM rent_contracts WHERE {RENT}",
        "psf_metrics": f"SELECT {line}, actual_area, property_usage_en, psf FROM ({BANDED})",
        "area_stats": f"WITH banded AS ({BANDED}) {AREA_STATS}",
        "high_demand_areas": f"WITH banded AS ({BANDED}), s AS ({AREA_STATS}) SELECT *, round(contract_count / sum(contract_count) OVER () * 100.0, 4) AS market_share_pct FROM s ORDER BY contract_count DESC, area_name_en NULLS FIRST LIMIT 20",
        "property_type_stats": f"SELECT ejari_property_type_en, {FULL}, {SHARE} FROM rent_contracts WHERE {RENT} GROUP BY 1",
        "usage_segments": f"SELECT property_usage_en, {FULL}, {SHARE} FROM rent_contracts WHERE {RENT} GROUP BY 1",
        "luxury_properties": f"WITH banded AS ({BANDED}), t AS (SELECT {_nearest('SELECT * FROM banded', 'psf', 0.75)} AS p, {_nearest('SELECT * FROM banded', 'annual_amount', 0.8)} AS r) SELECT {line}, psf, psf >= p OR annual_amount >= r AS is_luxury FROM banded, t",
        "trend_monthly": _trend("CAST(date_trunc('month', contract_start_date) AS DATE)"),
        "trend_quarterly": _trend("quarter(contract_start_date)"),
        "trend_yearly": _trend("year(contract_start_date)"),
        "trend_quarter_start": _trend("CAST(date_trunc('quarter', contract_start_date) AS DATE)"),
        "market_summary": f"""WITH banded AS ({BANDED}), u AS (SELECT property_usage_en, count(*) AS c FROM rent_contracts WHERE {RENT} GROUP BY 1)
            SELECT CASE WHEN count(*) FILTER ({RENT}) > 0 THEN count(*) END AS total_contracts, round(avg(annual_amount) FILTER ({RENT}), 4) AS avg_rent, round(median(annual_amount) FILTER ({RENT}), 4) AS median_rent,
            min(annual_amount) FILTER ({RENT}) AS min_rent, max(annual_amount) FILTER ({RENT}) AS max_rent, (SELECT round(avg(psf), 4) FROM banded) AS avg_psf, (SELECT round(median(psf), 4) FROM banded) AS median_psf,
            (SELECT count(*) FROM u) AS n_usages, (SELECT property_usage_en FROM u ORDER BY c DESC, property_usage_en LIMIT 1) AS largest_usage FROM rent_contracts""",
        "usage_report": f"""SELECT property_usage_en, count(*) FILTER ({RENT}) AS no_of_contracts, round(avg(annual_amount) FILTER ({RENT}), 4) AS avg_rent, round(median(annual_amount) FILTER ({RENT}), 4) AS median_rent,
            min(annual_amount) FILTER ({RENT}) AS min_rent, max(annual_amount) FILTER ({RENT}) AS max_rent, round(stddev_samp(annual_amount) FILTER ({RENT}), 4) AS std_rent,
            round(count(*) FILTER ({RENT}) / sum(count(*) FILTER ({RENT})) OVER () * 100.0, 4) AS market_share_pct, round(avg(actual_area) FILTER ({AREA}), 4) AS avg_area_sqft, round(median(actual_area) FILTER ({AREA}), 4) AS median_area_sqft,
            round(avg({psf}), 4) AS avg_psf, round(median({psf}), 4) AS median_psf FROM rent_contracts WHERE property_usage_en IS NOT NULL GROUP BY 1 HAVING count(*) FILTER ({RENT}) > 0""",
        "compare_periods": f"""WITH c AS ({usage_cte.format('count(*) AS n, avg(annual_amount) AS a', 2024)}), p AS ({usage_cte.format('count(*) AS n, avg(annual_amount) AS a', 2023)})
            SELECT property_usage_en, c.n AS current_contracts, round(c.a, 4) AS current_avg_rent, p.n AS previous_contracts, round(p.a, 4) AS previous_avg_rent,
            round((c.n - p.n) / p.n * 100.0, 4) AS contract_change_pct, round((c.a - p.a) / p.a * 100.0, 4) AS rent_change_pct FROM c FULL JOIN p USING (property_usage_en)""",
        "enrich": f"""WITH b AS (SELECT *, {psf} AS price_per_sqft, date_diff('day', contract_start_date, contract_end_date) AS days FROM rent_contracts), v AS (SELECT * FROM b WHERE price_per_sqft IS NOT NULL),
            t AS (SELECT {_nearest('SELECT * FROM v', 'price_per_sqft', 0.75)} AS p, {_nearest('SELECT * FROM v', 'annual_amount', 0.8)} AS r)
            SELECT {line}, price_per_sqft, 'Mid-Tier' AS area_tier, {kind} AS property_type_normalized, year(contract_start_date) AS contract_year, quarter(contract_start_date) AS contract_quarter,
            month(contract_start_date) AS contract_month, isodow(contract_start_date) AS contract_weekday, days AS contract_duration_days,
            CASE WHEN month(contract_start_date) IN (12, 1, 2) THEN 'Winter' WHEN month(contract_start_date) IN (3, 4, 5) THEN 'Spring' WHEN month(contract_start_date) IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END AS contract_season,
            CASE WHEN days IS NULL THEN 'Unknown' WHEN days < 180 THEN 'Short-term' WHEN days < 365 THEN 'Medium-term' ELSE 'Long-term' END AS contract_duration_category,
            coalesce(price_per_sqft >= p OR annual_amount >= r, false) AS is_luxury,
            CASE WHEN regexp_matches(property_usage_en, '(?i)residential') THEN 'Residential' WHEN regexp_matches(property_usage_en, '(?i)commercial') THEN 'Commercial' ELSE 'Other' END AS usage_category FROM b, t""",
        "area_tiers_and_types": f"""SELECT {_case_map('area_name_en', [(a, t) for t, names in AREA_TIERS.items() for a in names], "'Mid-Tier'")} AS area_tier,
            CASE WHEN coalesce(ejari_property_type_en, '') = '' THEN 'Unknown' ELSE {_case_map(kind, types, title)} END AS property_type, count(*) AS n FROM rent_contracts GROUP BY 1, 2""",
        "quantile_nearest": " UNION ALL ".join(f"SELECT '{t}' AS tag, {_nearest(f'SELECT * FROM rent_contracts WHERE {RENT}', 'annual_amount', x)} AS v" for t, x in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75), ("q80", 0.8))),
        "dq_profile": _profile_sql(),
        "dq_findings": _findings_sql(False),
        "dq_findings_strict": _findings_sql(True),
        "dq_date_order": f"SELECT {line} FROM rent_contracts WHERE contract_end_date <= contract_start_date",
        "dq_outliers": OUTLIERS,
        "load_stats": """WITH u AS (SELECT property_usage_en, count(*) AS c FROM rent_contracts GROUP BY 1 ORDER BY c DESC, property_usage_en NULLS FIRST LIMIT 1)
            SELECT count(*) AS n_rows, CAST(43 AS BIGINT) AS n_columns, count(*) FILTER (annual_amount IS NULL) AS null_rents, min(annual_amount) AS min_rent, max(annual_amount) AS max_rent, round(avg(annual_amount), 4) AS avg_rent, round(median(annual_amount), 4) AS median_rent,
            (SELECT property_usage_en FROM u) AS top_usage, (SELECT c FROM u) AS top_usage_n FROM rent_contracts""",
        "top_usages": "SELECT property_usage_en, count(*) AS n FROM rent_contracts GROUP BY 1 ORDER BY n DESC, property_usage_en NULLS FIRST LIMIT 5",
        "sql_facade": "SELECT area_name_en, count(*) AS n, max(annual_amount) AS top_rent FROM rent_contracts WHERE property_usage_en = 'Residential' GROUP BY 1",
        **dims,
        "dim_date": """SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS DATE) AS full_date, CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day_of_month, CAST(quarter(d) AS INTEGER) AS quarter, CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week
            FROM (SELECT unnest(generate_series(DATE '2020-01-01', DATE '2035-12-31', INTERVAL 1 DAY)) AS d)""",
        "dim_sequence_key": f"SELECT count(*) AS n, CAST(1 AS BIGINT) AS lo, count(*) AS hi, count(*) AS n_keys FROM (SELECT DISTINCT {', '.join(DIMENSIONS['project'])} FROM rent_contracts)",
        "fact_contract": "SELECT " + ", ".join([c for shown in SHOWN.values() for c in shown] + [*star.MEASURES, "contract_start_date", "contract_end_date"]) + "".join(f", CAST(strftime(contract_{x}_date, '%Y%m%d') AS INTEGER) AS {x}_date_key, CASE WHEN contract_{x}_date BETWEEN DATE '{star.FIRST_DAY}' AND DATE '{star.LAST_DAY}' THEN CAST(dayofweek(contract_{x}_date) + 1 AS INTEGER) END AS {x}_weekday" for x in ("start", "end")) + " FROM rent_contracts",
        "star_written": "SELECT property_usage_en, area_name_en, count(*) AS n, max(annual_amount) AS top_rent FROM rent_contracts GROUP BY 1, 2",
        "dq_constraints": _constraints_sql(),
        "parquet_sink": f"SELECT {line}, property_usage_en, contract_end_date FROM rent_contracts",
        "csv_report": f"SELECT nullif(property_usage_en, '') AS property_usage_en, count(*) AS contract_count, max(annual_amount) AS max_rent FROM rent_contracts WHERE {RENT} GROUP BY ALL",
        "usage_report_today": f"SELECT property_usage_en, count(*) AS no_of_contracts, current_date AS report_date FROM rent_contracts WHERE {RENT} AND property_usage_en IS NOT NULL GROUP BY 1",
        "dq_empty": "SELECT 'empty' AS rule, 'error' AS severity, CAST(0 AS BIGINT) AS n_bad, 'DataFrame is empty' AS message",
        "dq_missing_column": "SELECT 'schema' AS rule, 'property_usage_en' AS field, 'error' AS severity",
        "dq_types": "SELECT 'type' AS rule, unnest(['contract_amount', 'no_of_prop']) AS field, 'warning' AS severity",
        "dq_sample": "SELECT least(count(*), 5000) AS n FROM rent_contracts",
        "fallback_property_type": f"SELECT ejari_property_sub_type_en, count(*) AS contract_count, max(annual_amount) AS max_rent FROM rent_contracts WHERE {RENT} GROUP BY 1",
        "fact_contract_as_written": _multiplicity_sql(),
        "star_usage_rollup": f"SELECT property_usage_en, count(*) AS contracts, round(avg(annual_amount), 4) AS avg_rent FROM rent_contracts WHERE {RENT} GROUP BY 1",
        "dq_keys": "SELECT contract_id, line_number, count(*) AS n FROM rent_contracts GROUP BY 1, 2 HAVING count(*) > 1 OR contract_id IS NULL OR line_number IS NULL",
        "dq_orphans": "SELECT line_number, count(*) AS n FROM rent_contracts WHERE project_number IS NULL GROUP BY 1",
        "expiring_contracts": f"SELECT {line}, contract_end_date, date_diff('day', DATE '{REPORT_DAY}', contract_end_date) AS days_until_expiry FROM rent_contracts WHERE contract_end_date BETWEEN DATE '{REPORT_DAY}' AND DATE '{REPORT_DAY}' + 15",
        "expiring_by_usage": f"SELECT property_usage_en, count(*) AS contracts, round(avg(annual_amount) FILTER ({RENT}), 4) AS avg_rent FROM rent_contracts WHERE contract_end_date BETWEEN DATE '{REPORT_DAY}' AND DATE '{REPORT_DAY}' + 15 GROUP BY 1",
        "silver_contracts": f"SELECT {line}, contract_start_date IS NULL OR contract_end_date IS NULL OR contract_end_date <= contract_start_date AS _has_date_issues, annual_amount IS NULL OR isnan(annual_amount) OR annual_amount <= 0 AS _has_amount_issues FROM rent_contracts",
        "p1_found": P1_FOUND,
        "p1_profile": _p1_profile_sql("load_id", "true"),
        "p1_resumed": _p1_profile_sql("load_id", "load_id <> 2 OR load_id IS NULL"),
        "p1_shift": P1_SHIFT,
        "p1_rolled": _p1_profile_sql("", "load_id <> 1 OR load_id IS NULL"),
        "p3_found": P3_BASE + "SELECT strftime(d, '%Y-%m-%d') AS snapshot_date, contract_id, line_number, change_kind FROM diff",
        "p3_values": P3_BASE + "SELECT d AS snapshot_date, contract_id, line_number, change_kind, old_annual_amount, old_contract_end_date, new_annual_amount, new_contract_end_date FROM diff",
        "p4_found": P4_BASE + "SELECT raw_id, reason FROM r WHERE reason IS NOT NULL",
        "p4_valid": P4_VALID,
    }
    from leasemill.plans import files

    return {k: rounded_sql(v) for k, v in q.items()} | files.oracle_sql()
