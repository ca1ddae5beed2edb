"""Star schema: six dimensions and the fact table.

Surrogate keys are 128-bit hashes of the whole natural content (two of 10^13 rows share one once in some 10^12 tables), so the fact table gets its keys by computing the same hash:
one row for each contract line, nulls included, without a join or a shuffle. ``sequence_key`` gives dense numbers where
those are wanted. ``multiplicities`` reports what the published equality joins would yield, without running them: they
fan out, because the dimensions are distinct over more columns than are joined.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leasemill.functions.exprs import date_key, duration_days, valid_rent
from leasemill.schema import DIMENSIONS, JOIN_KEYS, MEASURES
from leasemill.sources.contracts import write_parquet

FIRST_DAY, LAST_DAY = "2020-01-01", "2035-12-31"


def content_key(columns: list[str]) -> Column:
    """Two hashes of the columns by position, as a struct of 16 bytes; a null differs from every value."""
    parts = ", ".join(f"`{c}` IS NULL, `{c}`" for c in columns)
    return F.expr(f"struct(xxhash64({parts}) AS hi, xxhash64(17, {parts}) AS lo)")


def content_bucket(columns: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[x for c in columns for x in (F.col(c).isNull(), F.col(c))]), F.lit(buckets))


def dimension(df: DataFrame, name: str) -> DataFrame:
    """The distinct content of a dimension with its key; nulls compare equal."""
    columns = DIMENSIONS[name]
    return df.select(*columns).distinct().select(content_key(columns).alias(f"{name}_key"), *columns)


def sequence_key(df: DataFrame, columns: list[str], name: str, buckets: int = 256) -> DataFrame:
    """Dense numbers 1..n in a fixed order (hash bucket, then the columns, nulls first), numbered bucket by bucket so
    that no task sorts the whole table. Rows that are equal in all columns are numbered in any order."""
    marked = df.withColumn("_bucket", content_bucket(columns, buckets))
    before = Window.partitionBy(F.lit(0)).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = marked.groupBy("_bucket").agg(F.count("*").alias("_n")).select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    number = F.row_number().over(Window.partitionBy("_bucket").orderBy(*[F.asc_nulls_first(c) for c in columns]))
    # at most ``buckets`` rows are broadcast
    return marked.withColumn("_row", number).join(F.broadcast(offsets), "_bucket").withColumn(name, F.col("_offset") + F.col("_row")).drop("_bucket", "_row", "_offset")


def dim_date(spark, first: str = FIRST_DAY, last: str = LAST_DAY) -> DataFrame:
    """The calendar, both days included; day_of_week 1 is Sunday."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"), F.expr("interval 1 day"))).alias("full_date"))
    d = F.col("full_date")
    return days.select(
        date_key(d).alias("date_key"),
        "full_date",
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.day(d).alias("day_of_month"),
        F.quarter(d).alias("quarter"),
        F.dayofweek(d).alias("day_of_week"),
    )


def fact(df: DataFrame) -> DataFrame:
    """One row for each contract line: the keys of its five dimensions, dates with their keys, and the measures."""
    keys = [content_key(columns).alias(f"{name}_key") for name, columns in DIMENSIONS.items()]
    start, end = F.col("contract_start_date"), F.col("contract_end_date")
    return df.select(*keys, start, end, date_key(start).alias("start_date_key"), date_key(end).alias("end_date_key"), *MEASURES)


def multiplicities(df: DataFrame) -> DataFrame:
    """Contract lines by usage and the rows the published equality joins would make of them.

    ``n_joined`` is the sum over the lines of the product of the numbers of dimension rows with their join key; a null key
    joins nothing. Exact, in decimals, and linear in the table; numbers beyond 38 digits are an error.
    """
    lines = df
    for name, keys in JOIN_KEYS.items():
        per_key = dimension(df, name).groupBy(*keys).agg(F.count("*").alias(f"_n_{name}")).filter(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
        lines = lines.join(per_key, keys, "left")
    # Equal factors are multiplied once.
    factors = [F.coalesce(F.col(f"_n_{n}"), F.lit(0)).alias(f"_n_{n}") for n in JOIN_KEYS]
    lines = lines.select("property_usage_en", *factors).groupBy("property_usage_en", *[f"_n_{n}" for n in JOIN_KEYS]).agg(F.count("*").alias("_n"))
    product = reduce(lambda a, b: a * b, [F.col(f"_n_{n}").cast("decimal(38,0)") for n in JOIN_KEYS], F.col("_n").cast("decimal(38,0)"))
    return lines.groupBy("property_usage_en").agg(F.sum("_n").alias("n_lines"), F.sum(product).cast("decimal(38,0)").alias("n_joined"))


def fact_as_written(df: DataFrame) -> DataFrame:
    """The published inner joins on a part of each dimension's columns. The result fans out by the product of the
    multiplicities (see :func:`multiplicities`, which gives its size beforehand); meant for small tables only."""
    out = df
    for name, keys in JOIN_KEYS.items():
        out = out.join(dimension(df, name).select(f"{name}_key", *keys), keys)
    return out.select(*[f"{n}_key" for n in DIMENSIONS], "contract_start_date", "contract_end_date", *MEASURES)


def usage_rollup(facts: DataFrame, properties: DataFrame) -> DataFrame:
    """Fact joined to the property dimension, contracts and rents by usage."""
    valid = facts.filter(valid_rent())
    return (
        valid.join(properties.select("property_key", "property_usage_en"), "property_key")
        .groupBy("property_usage_en")
        .agg(F.count("*").alias("contracts"), F.avg("annual_amount").alias("avg_rent"))
        .orderBy(F.desc("contracts"), F.asc_nulls_first("property_usage_en"))
    )


def key_violations(df: DataFrame, key: list[str]) -> DataFrame:
    """Primary-key check: keys that are null or occur more than once, with their number."""
    null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key])
    return df.groupBy(*key).agg(F.count("*").alias("n")).filter((F.col("n") > 1) | null)


def orphans(facts: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None) -> DataFrame:
    """Foreign-key check: fact rows whose key, if they have one, the dimension lacks."""
    found = facts.filter(F.col(key).isNotNull())
    return found.join(dim.select(F.col(dim_key or key).alias(key)), key, "left_anti")


#: Columns that the published tables declare as never null, besides keys.
NOT_NULL = {
    "contract_type": ["contract_reg_type_id"],
    "property": ["ejari_bus_property_type_id", "ejari_property_type_id"],
    "project": ["project_number"],
    "location": ["area_id"],
    "tenant": ["tenant_type_id"],
    "fact": MEASURES,
}


def constraints(tables: dict[str, DataFrame]) -> DataFrame:
    """Every constraint of the published tables and the rows that break it: table_name, kind (primary, foreign, not_null),
    column_name, n_bad. ``tables``: the tables of :func:`tables`, as built or as written."""
    out: list[DataFrame] = []

    def told(bad: DataFrame, table: str, kind: str, column: str) -> None:
        out.append(bad.agg(F.count("*").alias("n_bad")).select(F.lit(table).alias("table_name"), F.lit(kind).alias("kind"), F.lit(column).alias("column_name"), "n_bad"))

    facts = tables["fact"]
    for name in [*DIMENSIONS, "date"]:
        told(key_violations(tables[name], [f"{name}_key"]), name, "primary", f"{name}_key")
    for name in DIMENSIONS:
        told(orphans(facts, tables[name], f"{name}_key"), "fact", "foreign", f"{name}_key")
    for side in ("start_date_key", "end_date_key"):
        told(orphans(facts, tables["date"], side, "date_key"), "fact", "foreign", side)
    for name, columns in NOT_NULL.items():
        cells = F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("n_bad")) for i, c in enumerate(columns)]))
        nulls = tables[name].agg(*[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(columns)])
        out.append(nulls.select(F.lit(name).alias("table_name"), F.lit("not_null").alias("kind"), cells))
    return reduce(DataFrame.unionByName, out)


def tables(df: DataFrame) -> dict[str, DataFrame]:
    """The dimensions, the calendar (``date``) and the fact table of a contract table."""
    return {n: dimension(df, n) for n in DIMENSIONS} | {"date": dim_date(df.sparkSession), "fact": fact(df)}


def write(df: DataFrame, root: str) -> dict[str, DataFrame]:
    """Write the star schema below ``root``, one Parquet table each, and read it back."""
    for name, t in tables(df).items():
        write_parquet(t, f"{root}/{name}")
    return {name: df.sparkSession.read.parquet(f"{root}/{name}") for name in [*DIMENSIONS, "date", "fact"]}


def expiring(df: DataFrame, day: Column, days: int = 15) -> DataFrame:
    """Contracts that end from ``day`` to ``day`` + ``days``, both included, with ``days_until_expiry``; soonest first."""
    end = F.col("contract_end_date")
    return (
        df.filter(end.between(day, F.date_add(day, days)))
        .withColumn("days_until_expiry", duration_days(day, end))
        .orderBy("days_until_expiry", "contract_id", "line_number")
    )


def expiring_by_usage(df: DataFrame, day: Column, days: int = 15) -> DataFrame:
    """Contracts about to end, and their mean rent, by usage."""
    end = F.col("contract_end_date")
    return (
        df.filter(end.between(day, F.date_add(day, days)))
        .groupBy("property_usage_en")
        .agg(F.count("*").alias("contracts"), F.avg(F.when(valid_rent(), F.col("annual_amount"))).alias("avg_rent"))
    )


def silver(df: DataFrame) -> DataFrame:
    """The table with flags for unusable dates (missing, or end on or before start) and amounts (missing, or not above 0)."""
    start, end, rent = F.col("contract_start_date"), F.col("contract_end_date"), F.col("annual_amount")
    return df.withColumns(
        {
            "_has_date_issues": start.isNull() | end.isNull() | (end <= start),
            "_has_amount_issues": rent.isNull() | F.isnan(rent) | (rent <= 0),
        }
    )


def audited(df: DataFrame) -> DataFrame:
    """Adds where and when a row was loaded."""
    return df.withColumns({"_source_file": F.input_file_name(), "_loaded_at": F.current_timestamp()})
