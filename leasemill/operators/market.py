"""Market reports over the contract table. Every function takes and returns a DataFrame. Those with medians scan the table
twice, the first time when they are called (see ``ranks``); the others run no job.

A missing optional column gives an empty frame without columns; no valid rows give an empty result with its columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leasemill.functions.exprs import psf, psf_in_band, valid_area, valid_rent
from leasemill.operators.ranks import group_figures, nearest_ranks
from leasemill.settings import LIMITS


class MissingColumns(ValueError):
    """A column without which the report has no meaning."""


def require(df: DataFrame, *columns: str) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise MissingColumns(f"Missing required columns: {', '.join(missing)}")
    return df


def nothing(df: DataFrame) -> DataFrame:
    """The empty frame without columns."""
    return df.sparkSession.createDataFrame([], T.StructType([]))


RENT_STATS = ["contract_count", "avg_rent", "median_rent", "min_rent", "max_rent"]


def rent_stats(value: str = "rent") -> list[Column]:
    """The figures of a rent as columns, from its struct."""
    return [F.col(f"{value}.{c}").alias(name) for name, c in zip(RENT_STATS, ("n", "mean", "median", "min", "max"))]


def stats_by(rows: DataFrame, key: str, more: dict[str, Column] | None = None) -> DataFrame:
    """Rent figures of each group of rows with a valid rent, and the structs of further values (see ``group_figures``)."""
    found = group_figures(rows, [key], {"rent": F.col("annual_amount")} | (more or {}))
    return found.select(key, *rent_stats(), *(more or {}))


def share_of(count: str) -> Column:
    """Share in per cent of the sum over all result rows; the result has one row for each group, so one task sums little."""
    return F.col(count) / F.sum(count).over(Window.partitionBy(F.lit(0))) * F.lit(100.0)


def filter_valid_rent(df: DataFrame) -> DataFrame:
    return require(df, "annual_amount").filter(valid_rent())


def psf_metrics(df: DataFrame) -> DataFrame:
    """All input columns and ``psf``, for rows with a valid rent and area whose psf lies in the band of their class."""
    require(df, "annual_amount", "property_usage_en")
    if "actual_area" not in df.columns:
        return nothing(df)
    rows = df.filter(valid_rent() & valid_area()).withColumn("psf", psf())
    return rows.filter(psf_in_band(F.col("property_usage_en"), F.col("psf")))


def area_stats(df: DataFrame, area: str = "area_name_en") -> DataFrame:
    """Figures of each area with at least ten contracts, the largest first."""
    if area not in df.columns or "actual_area" not in df.columns:
        return nothing(df)
    stats = stats_by(psf_metrics(df), area, {"by_foot": F.col("psf"), "size": F.col("actual_area")})
    return (
        stats.filter(F.col("contract_count") >= LIMITS.min_area_sample_size)
        .select(area, *RENT_STATS, F.col("by_foot.mean").alias("avg_psf"), F.col("by_foot.median").alias("median_psf"), F.col("size.mean").alias("avg_area"))
        .orderBy(F.desc("contract_count"), F.asc_nulls_first(area))
    )


def high_demand_areas(df: DataFrame, area: str = "area_name_en", top_n: int = LIMITS.top_n_areas) -> DataFrame:
    """The areas with most contracts; the share is of all areas in ``area_stats``, not of the top ones."""
    stats = area_stats(df, area)
    if not stats.columns:
        return stats
    return (
        stats.withColumn("market_share_pct", share_of("contract_count"))
        .orderBy(F.desc("contract_count"), F.asc_nulls_first(area))
        .limit(top_n)
    )


def property_type_stats(df: DataFrame) -> DataFrame:
    """By property type, or by subtype where the table has no type."""
    kind = next((c for c in ("ejari_property_type_en", "ejari_property_sub_type_en") if c in df.columns), None)
    if kind is None:
        return nothing(df)
    return (
        stats_by(filter_valid_rent(df), kind)
        .select(kind, *RENT_STATS)
        .withColumn("market_share_pct", share_of("contract_count"))
        .orderBy(F.desc("contract_count"), F.asc_nulls_first(kind))
    )


def usage_segments(df: DataFrame) -> DataFrame:
    """By usage; contracts without a usage form a group of their own."""
    require(df, "annual_amount", "property_usage_en")
    return (
        stats_by(filter_valid_rent(df), "property_usage_en")
        .select("property_usage_en", *RENT_STATS)
        .withColumn("market_share_pct", share_of("contract_count"))
        .orderBy(F.desc("contract_count"), F.asc_nulls_first("property_usage_en"))
    )


def luxury_thresholds(df: DataFrame, psf_col: str = "psf") -> Column:
    """``psf_p`` and ``rent_p``: nearest-rank percentiles over the given rows, as one scalar subquery; null without rows."""
    return nearest_ranks(df, {"psf_p": (F.col(psf_col), LIMITS.luxury_psf_percentile), "rent_p": (F.col("annual_amount"), LIMITS.luxury_rent_percentile)})


def luxury_properties(df: DataFrame) -> DataFrame:
    """Rows of ``psf_metrics`` with ``is_luxury``: psf or rent at or above its percentile over these rows."""
    rows = psf_metrics(df)
    if not rows.columns:
        return rows
    flag = (F.col("psf") >= F.col("_limits.psf_p")) | (F.col("annual_amount") >= F.col("_limits.rent_p"))
    return rows.withColumn("_limits", luxury_thresholds(rows)).withColumn("is_luxury", flag).drop("_limits")


def rental_trends(df: DataFrame, date_column: str = "contract_start_date", period: str = "monthly") -> DataFrame:
    """Count, mean and median by period. ``monthly`` and ``yearly`` are time series; ``quarterly`` pools quarters 1 to 4 of
    all years; ``quarter_start`` is the time series of quarters. Any other period gives the frame without columns."""
    d = F.col(date_column)
    periods = {
        "monthly": F.trunc(d, "month"),
        "quarterly": F.quarter(d),
        "yearly": F.year(d),
        "quarter_start": F.trunc(d, "quarter"),
    }
    if date_column not in df.columns or period not in periods:
        return nothing(df)
    rows = filter_valid_rent(df).filter(d.isNotNull()).withColumn("period", periods[period])
    return stats_by(rows, "period").select("period", *RENT_STATS[:3]).orderBy("period")


def market_summary(df: DataFrame) -> DataFrame:
    """One row. ``total_contracts`` counts all rows and is null where no rent is valid; ``usage_breakdown`` is an array of
    structs in the order of ``usage_segments``."""
    require(df, "annual_amount", "property_usage_en")
    # Every row counts, whatever its rent: "every" is a number in all of them.
    values = {"every": F.lit(0.0), "rent": F.when(valid_rent(), F.col("annual_amount"))}
    if "actual_area" in df.columns:
        values["banded"] = F.when(psf_in_band(F.col("property_usage_en"), psf()), psf())
    found = group_figures(df, ["property_usage_en"], values, overall=True)
    whole = lambda c: F.max(F.when(F.col("_all"), F.col(c)))
    n = F.col("rent.n")
    segment = F.struct(n.alias("contract_count"), "property_usage_en", *[c for c in rent_stats()[1:]])
    one = found.agg(
        F.when(F.coalesce(whole("rent.n"), F.lit(0)) > 0, whole("every.n")).alias("total_contracts"),
        *[whole(f"rent.{c}").alias(f"{name}_rent") for c, name in (("mean", "avg"), ("median", "median"), ("min", "min"), ("max", "max"))],
        *([whole("banded.mean").alias("avg_psf"), whole("banded.median").alias("median_psf")] if "banded" in values else []),
        F.coalesce(whole("rent.n"), F.lit(0)).alias("_n"),
        F.sort_array(F.collect_list(F.when(~F.col("_all") & (n > 0), segment)), asc=False).alias("_segments"),
    )
    with_share = F.transform("_segments", lambda x: x.withField("market_share_pct", F.try_divide(x["contract_count"], F.col("_n")) * F.lit(100.0)))
    return one.withColumn("usage_breakdown", with_share).drop("_n", "_segments")


def summary_dict(df: DataFrame) -> dict:
    """``market_summary`` as a plain dictionary, empty parts left out."""
    row = market_summary(df).first().asDict(recursive=True)
    return {k: v for k, v in row.items() if v is not None and v != []}
