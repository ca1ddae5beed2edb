"""Property usage report and the comparison of two periods."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leasemill.functions.exprs import pct_change, psf, valid_area, valid_rent
from leasemill.operators.market import require, share_of
from leasemill.operators.ranks import group_figures


def usage_report(df: DataFrame, report_date: Column | None = None) -> DataFrame:
    """Rent, area and unbanded psf by usage. Ordered by count.

    Area figures ignore whether the rent is valid; usages without any valid rent do not come out. All figures come from two
    scans, the first of which is run when this is called (see ``ranks``); no group, however large, is held in memory.
    """
    require(df, "annual_amount", "property_usage_en")
    key = "property_usage_en"
    values = {"rent": F.when(valid_rent(), F.col("annual_amount"))}
    shown = {"no_of_contracts": "rent.n", "avg_rent": "rent.mean", "median_rent": "rent.median", "min_rent": "rent.min", "max_rent": "rent.max", "std_rent": "rent.std"}
    more = {}
    if "actual_area" in df.columns:
        values |= {"area": F.when(valid_area(), F.col("actual_area")), "psf": psf()}
        more = {"avg_area_sqft": "area.mean", "median_area_sqft": "area.median", "avg_psf": "psf.mean", "median_psf": "psf.median"}
    found = group_figures(df.filter(F.col(key).isNotNull()), [key], values).filter(F.col("rent.n") > 0)
    picked = [F.col(c).alias(name) for name, c in (shown | more).items()]
    return (
        found.select(key, *picked)
        .withColumn("market_share_pct", share_of("no_of_contracts"))
        .select(key, *shown, "market_share_pct", *more)
        .withColumn("report_date", F.current_date() if report_date is None else report_date)
        .orderBy(F.desc_nulls_first("no_of_contracts"), key)
    )


def compare_periods(current: DataFrame, previous: DataFrame, report_date: Column | None = None) -> DataFrame:
    """Full outer comparison by usage with signed changes in per cent; usages only in the earlier period come first."""

    def side(df: DataFrame, name: str) -> DataFrame:
        return (
            require(df, "annual_amount", "property_usage_en")
            .filter(F.col("property_usage_en").isNotNull() & valid_rent())
            .groupBy("property_usage_en")
            .agg(F.count("*").alias(f"{name}_contracts"), F.avg("annual_amount").alias(f"{name}_avg_rent"))
        )

    c = F.col
    return (
        side(current, "current")
        .join(side(previous, "previous"), "property_usage_en", "full_outer")
        .withColumns(
            {
                "contract_change_pct": pct_change(c("current_contracts"), c("previous_contracts")),
                "rent_change_pct": pct_change(c("current_avg_rent"), c("previous_avg_rent")),
                "report_date": F.current_date() if report_date is None else report_date,
            }
        )
        .orderBy(F.desc_nulls_first("current_contracts"), "property_usage_en")
    )
