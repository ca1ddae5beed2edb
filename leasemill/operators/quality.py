"""Validation of the contract table in two scans: the first takes all counts and the buckets of the rents, the second the few
rents that decide the quartiles and the bounds of the outlier rule."""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leasemill.functions.buckets import INFINITE, SMALLEST, bucket_text, gamma
from leasemill.functions.exprs import duration_days, valid_rent
from leasemill.operators.ranks import COARSE, group_figures, within
from leasemill.session import persist_table
from leasemill.settings import DATE_FIELDS, LIMITS, NUMERIC_FIELDS, REQUIRED_FIELDS


@dataclass(frozen=True)
class Rule:
    """A counted rule. ``base``: rows the percentage refers to (None: no percentage)."""

    name: str
    field: str
    severity: str
    bad: Column
    base: Column | None
    message: str
    strict_severity: str | None = None


FINDINGS = T.StructType(
    [
        T.StructField("rule", T.StringType()),
        T.StructField("field", T.StringType()),
        T.StructField("severity", T.StringType()),
        T.StructField("n_bad", T.LongType()),
        T.StructField("pct", T.DoubleType()),
        T.StructField("message", T.StringType()),
    ]
)


def missing_required(df: DataFrame) -> list[str]:
    return [c for c in REQUIRED_FIELDS if c not in df.columns]


def rules(df: DataFrame) -> list[Rule]:
    """The counted rules whose columns the table has, in the order of the report."""
    have, every, lim = set(df.columns), F.lit(True), LIMITS
    out: list[Rule] = []
    for c in REQUIRED_FIELDS:
        if c in have:
            out.append(Rule("required_null", c, "warning", F.col(c).isNull(), every, f"{{n:,}} rows ({{pct:.2f}}%) lack the required {c}", "error"))
    if "annual_amount" in have:
        v, there = F.col("annual_amount"), F.col("annual_amount").isNotNull()
        out += [
            Rule("rent_not_positive", "annual_amount", "error", v <= 0, None, "{n:,} rows have rent <= 0"),
            Rule("rent_below_min", "annual_amount", "warning", v < lim.min_annual_rent, there, f"{{n:,}} rents ({{pct:.2f}}%) are below {lim.min_annual_rent:,}"),
            Rule("rent_above_max", "annual_amount", "warning", v > lim.max_annual_rent, there, f"{{n:,}} rents ({{pct:.2f}}%) are above {lim.max_annual_rent:,}"),
        ]
    if "actual_area" in have:
        v, there = F.col("actual_area"), F.col("actual_area").isNotNull()
        out += [
            Rule("size_not_positive", "actual_area", "error", v <= 0, None, "{n:,} rows have size <= 0"),
            Rule("size_below_min", "actual_area", "warning", v < lim.min_property_size, there, f"{{n:,}} areas ({{pct:.2f}}%) are below {lim.min_property_size:,} square feet"),
            Rule("size_above_max", "actual_area", "warning", v > lim.max_property_size, there, f"{{n:,}} areas ({{pct:.2f}}%) are above {lim.max_property_size:,} square feet"),
        ]
    for c in DATE_FIELDS:
        if c in have:
            out.append(Rule("date_null", c, "warning", F.col(c).isNull(), every, f"{{n:,}} rows ({{pct:.2f}}%) have no {c}"))
    if {*DATE_FIELDS} <= have:
        start, end = F.col("contract_start_date"), F.col("contract_end_date")
        days = duration_days(start, end)
        out += [
            Rule("date_order", "contract_end_date", "error", end <= start, None, "{n:,} rows have end_date <= start_date"),
            Rule("too_short", "contract_end_date", "warning", days < lim.min_contract_days, None, f"{{n:,}} contracts last less than {lim.min_contract_days} days"),
            Rule("too_long", "contract_end_date", "warning", days > lim.max_contract_days, None, f"{{n:,}} contracts last more than {lim.max_contract_days} days"),
        ]
    return out


def date_order_violations(df: DataFrame) -> DataFrame:
    """Rows whose end is on or before their start; both dates present."""
    return df.filter(F.col("contract_end_date") <= F.col("contract_start_date"))


#: The bucket of a valid rent, as SQL.
RENT_BUCKET = bucket_text("CAST(annual_amount AS DOUBLE)", COARSE)


def rule_aggregates(df: DataFrame) -> list[Column]:
    """``n_rows`` and, for each counted rule, ``n_<i>`` and ``base_<i>``."""
    aggs = [F.count("*").alias("n_rows")]
    for i, r in enumerate(rules(df)):
        aggs.append(F.count_if(r.bad).alias(f"n_{i}"))
        aggs.append(F.count_if(r.base if r.base is not None else F.lit(False)).alias(f"base_{i}"))
    return aggs


def profile(df: DataFrame) -> DataFrame:
    """(rule, field, severity, n_bad, n_base) of every counted rule, hits or not; one scan."""
    rs = rules(df)
    items = [
        F.struct(F.lit(r.name).alias("rule"), F.lit(r.field).alias("field"), F.lit(r.severity).alias("severity"), F.col(f"n_{i}").alias("n_bad"), F.when(F.lit(r.base is not None), F.col(f"base_{i}")).alias("n_base"))
        for i, r in enumerate(rs)
    ]
    return df.agg(*rule_aggregates(df)).select(F.inline(F.array(*items)))


def bucketed_counts(df: DataFrame) -> DataFrame:
    """The counts of all rules by the bucket ``_b`` of the rent (null: no valid rent), stored: one scan, and a bounded table."""
    bucket = F.when(valid_rent(), F.expr(RENT_BUCKET)) if "annual_amount" in df.columns else F.lit(None).cast("int")
    return persist_table(df.groupBy(bucket.alias("_b")).agg(*rule_aggregates(df)), "rules")


def _outlier_counts(df: DataFrame, counts: DataFrame) -> DataFrame:
    """One row (n, n_outliers). The buckets of the quartiles tell within which rents the bounds of the rule lie: rents of
    other buckets are outliers or not by their bucket alone, and only the rest are read again."""
    held = counts.filter(F.col("_b").isNotNull())
    sums = {r._b: r.n_rows for r in held.select("_b", "n_rows").collect()}  # one row for each bucket, bounded
    total, spark = sum(sums.values()), df.sparkSession
    if not total:
        return spark.createDataFrame([(0, 0)], "n bigint, n_outliers bigint")
    upto = dict(zip(sorted(sums), accumulate(sums[b] for b in sorted(sums))))
    asked = {t: math.floor((total - 1) * q + 0.5) for t, q in (("q1", 0.25), ("q3", 0.75))}
    b1, b3 = (next(b for b, n in upto.items() if n > asked[t]) for t in ("q1", "q3"))
    g, k = gamma(COARSE), LIMITS.outlier_iqr_multiplier
    # One bucket more on either side, for the rounding of a bucket's number. Bounds beyond all doubles are infinite.
    edge = lambda b: math.exp(min(b * math.log(g), 709.0)) if b < INFINITE else math.inf
    (l1, h1), (l3, h3) = ((edge(b - 2), edge(b + 1)) for b in (b1, b3))
    place = lambda x: -INFINITE if not x > SMALLEST else INFINITE if math.isinf(x) else math.ceil(math.log(x) / math.log(g))
    low = (place(l1 - k * (h3 - l1)) - 2, place(h1 - k * (l3 - h1)) + 2)
    high = (place(l3 + k * (l3 - h1)) - 2, place(h3 + k * (h3 - l1)) + 2)
    b = F.expr(RENT_BUCKET)
    near = b.isin(b1, b3) | b.between(*low) | b.between(*high)
    rents = df.filter(valid_rent() & near).groupBy(F.col("annual_amount").cast("double").alias("v")).agg(F.count("*").alias("n"))
    rents = persist_table(rents.withColumns({"_s": F.lit(1), "_b": F.expr(bucket_text("v", COARSE))}), "rents")
    places = [(t, n, upto[x] - sums[x], x) for (t, n), x in zip(asked.items(), (b1, b3))]
    quartile = lambda t: F.max(F.when(F.col("rank_tag") == t, F.col("v")))
    cells = F.array(*[F.struct(F.lit(t).alias("rank_tag"), F.lit(n).cast("bigint").alias("rank"), F.lit(below).cast("bigint").alias("below"), F.lit(x).alias("_at")) for t, n, below, x in places])
    found = within(rents.select("*", F.inline(cells)).filter(F.col("_at") == F.col("_b")), []).agg(F.struct(quartile("q1").alias("q1"), quartile("q3").alias("q3"))).scalar()
    reach = k * (F.col("q.q3") - F.col("q.q1"))
    out = (F.col("v") < F.col("q.q1") - reach) | (F.col("v") > F.col("q.q3") + reach)
    unsure = lambda x: low[0] <= x <= low[1] or high[0] <= x <= high[1]
    sure = sum(n for x, n in sums.items() if (x < low[0] or x > high[1]) and not unsure(x))
    decided = F.col("_b").between(*low) | F.col("_b").between(*high)
    return rents.withColumn("q", found).agg(F.lit(total).cast("bigint").alias("n"), (F.coalesce(F.sum(F.when(out & decided, F.col("n"))), F.lit(0)) + sure).cast("bigint").alias("n_outliers"))


def outliers(df: DataFrame) -> DataFrame:
    """One row (n, n_outliers) over rows with a valid rent: outside q1 - k*iqr .. q3 + k*iqr by nearest-rank quartiles."""
    return _outlier_counts(df, bucketed_counts(df.select("annual_amount")))


def findings(df: DataFrame, strict: bool = False) -> DataFrame:
    """Findings with hits: (rule, field, severity, n_bad, pct, message). An empty table gives its one error.

    ``strict`` raises the severity of missing required values only. Schema findings need no job; the table is scanned twice,
    the first time when this is called.
    """
    spark = df.sparkSession
    schema_rows = []
    missing = missing_required(df)
    if missing:
        schema_rows.append(("schema", ",".join(missing), "error", len(missing), None, f"Missing required columns: {', '.join(missing)}"))
    numeric = (T.LongType, T.IntegerType, T.DoubleType, T.FloatType)
    for c in NUMERIC_FIELDS:
        if c in df.columns and not isinstance(df.schema[c].dataType, numeric):
            schema_rows.append(("type", c, "warning", None, None, f"{c} should be a number but is {df.schema[c].dataType.simpleString()}"))
    rs = rules(df)
    stored = bucketed_counts(df)
    names = [c for c in stored.columns if c != "_b"]
    counts = stored.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names]).withColumn("total", F.col("n_rows"))
    items = []
    for i, r in enumerate(rs):
        n, pct = F.col(f"n_{i}"), F.try_divide(F.col(f"n_{i}"), F.col(f"base_{i}")) * F.lit(100.0)
        text = F.lit(r.message)
        text = F.replace(text, F.lit("{n:,}"), F.format_number(n, 0))
        text = F.replace(text, F.lit("{pct:.2f}"), F.coalesce(F.format_string("%.2f", pct), F.lit("")))
        severity = r.strict_severity if strict and r.strict_severity else r.severity
        items.append(F.struct(F.lit(r.name).alias("rule"), F.lit(r.field).alias("field"), F.lit(severity).alias("severity"), n.alias("n_bad"), (pct if r.base is not None else F.lit(None).cast("double")).alias("pct"), text.alias("message")))
    total = F.col("total")
    info = F.struct(F.lit("records").alias("rule"), F.lit("").alias("field"), F.lit("info").alias("severity"), total.alias("n_bad"), F.lit(None).cast("double").alias("pct"), F.concat(F.format_number(total, 0), F.lit(" rows looked at")).alias("message"))
    empty = F.struct(F.lit("empty").alias("rule"), F.lit("").alias("field"), F.lit("error").alias("severity"), total.alias("n_bad"), F.lit(None).cast("double").alias("pct"), F.lit("DataFrame is empty").alias("message"))
    out = (
        counts.select("total", F.explode(F.array(empty, info, *items)).alias("x"))
        .filter(F.when(total == 0, F.col("x.rule") == "empty").otherwise((F.col("x.rule") != "empty") & (F.col("x.n_bad") > 0)))
        .select("x.*")
    )
    if schema_rows:
        out = out.unionByName(spark.createDataFrame(schema_rows, FINDINGS))
    if "annual_amount" in df.columns:
        o = _outlier_counts(df, stored).filter((F.col("n") >= LIMITS.min_outlier_sample) & (F.col("n_outliers") > 0))
        pct = F.col("n_outliers") / F.col("n") * F.lit(100.0)
        message = F.concat(F.format_number("n_outliers", 0), F.lit(" rents ("), F.format_string("%.2f", pct), F.lit("%) lie far outside the quartiles"))
        out = out.unionByName(o.select(F.lit("outliers").alias("rule"), F.lit("annual_amount").alias("field"), F.lit("info").alias("severity"), F.col("n_outliers").alias("n_bad"), pct.alias("pct"), message.alias("message")))
    return out


@dataclass
class ValidationResult:
    """Messages by severity; valid as long as there is no error."""

    errors: list[str] = field(default_factory=list)
    warnings: list[str] = field(default_factory=list)
    info: list[str] = field(default_factory=list)

    @property
    def is_valid(self) -> bool:
        return not self.errors

    def summary(self) -> dict:
        return {"is_valid": self.is_valid, "errors": len(self.errors), "warnings": len(self.warnings), "info": len(self.info)}

    def __str__(self) -> str:
        lines = [f"Validation {'passed' if self.is_valid else 'failed'}"]
        for title, items in (("Errors", self.errors), ("Warnings", self.warnings), ("Info", self.info)):
            if items:
                lines += [f"{title} ({len(items)}):", *(f"  - {x}" for x in items)]
        return "\n".join(lines)


def sample(df: DataFrame, rows: int) -> DataFrame:
    """Some rows of the table, at most so many, in no defined order; for a quick look."""
    return df.limit(rows)


def validate(df: DataFrame, strict: bool = False, sample_rows: int | None = None) -> ValidationResult:
    """Run the rules and gather the messages: at most one row for each rule comes to the driver.

    The whole table is validated; ``sample_rows`` looks at that many rows only, for a quick look.
    """
    rows = findings(df if sample_rows is None else sample(df, sample_rows), strict).collect()
    if any(r["rule"] == "empty" for r in rows):
        return ValidationResult(errors=["DataFrame is empty"])
    result = ValidationResult()
    for r in rows:
        {"error": result.errors, "warning": result.warnings, "info": result.info}[r["severity"]].append(r["message"])
    return result


def load_stats(df: DataFrame, top: int = 5) -> DataFrame:
    """One row: rows, columns, missing rents (null or NaN), min, max, mean and median of the rent, and the most frequent
    usages. Two scans."""
    rent = F.col("annual_amount")
    keys = ["property_usage_en"] if "property_usage_en" in df.columns else []
    found = group_figures(df, keys, {"every": F.lit(0.0), "rent": rent}, overall=True)
    whole = lambda c: F.max(F.when(F.col("_all"), F.col(c)))
    n_rows, n_rents = (F.coalesce(whole(c), F.lit(0)) for c in ("every.n", "rent.n"))
    stats = [n_rows.alias("n_rows"), F.lit(len(df.columns)).cast("bigint").alias("n_columns"), (n_rows - n_rents).alias("null_rents")]
    stats += [whole(f"rent.{c}").alias(f"{name}_rent") for c, name in (("min", "min"), ("max", "max"), ("mean", "avg"), ("median", "median"))]
    if keys:
        usage = F.struct(F.col("every.n").alias("n"), "property_usage_en")
        # Most rows first; of usages with as many, the null one and then the first by name.
        before = lambda a, b: F.when(a["n"] != b["n"], F.when(a["n"] > b["n"], -1).otherwise(1)).when(a["property_usage_en"].eqNullSafe(b["property_usage_en"]), 0).when(a["property_usage_en"].isNull(), -1).when(b["property_usage_en"].isNull(), 1).when(a["property_usage_en"] < b["property_usage_en"], -1).otherwise(1)
        stats.append(F.slice(F.array_sort(F.collect_list(F.when(~F.col("_all"), usage)), before), 1, top).alias("top_usages"))
    return found.agg(*stats)


def top_usages(df: DataFrame, top: int = 5) -> DataFrame:
    """The usages with most rows: (property_usage_en, n)."""
    return df.groupBy("property_usage_en").agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.asc_nulls_first("property_usage_en")).limit(top)
