"""Enrichment: twelve derived columns, one row out for each row in, in one projection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leasemill.functions import exprs as X
from leasemill.operators.market import luxury_thresholds
from leasemill.settings import DEFAULT_AREA_TIER


def enrich(df: DataFrame) -> DataFrame:
    """Adds, as far as the columns they need exist: price_per_sqft; area_tier; property_type_normalized; contract_year,
    contract_quarter, contract_month, contract_weekday, contract_season; contract_duration_days, contract_duration_category;
    is_luxury; usage_category. The tier is the constant default; :func:`with_area_tier` has the tiers by name.

    Luxury thresholds are nearest-rank percentiles over all rows with a psf, without the bands of the market report.
    """
    have = set(df.columns)
    has_psf = {"annual_amount", "actual_area"} <= have
    new = {}
    if has_psf:
        new["price_per_sqft"] = X.psf()
    if "area_name_en" in have:
        new["area_tier"] = F.lit(DEFAULT_AREA_TIER)
    if "ejari_property_type_en" in have:
        new["property_type_normalized"] = X.strip(F.lower(F.col("ejari_property_type_en")))
    if "contract_start_date" in have:
        start = F.col("contract_start_date")
        new |= {
            "contract_year": F.year(start),
            "contract_quarter": F.quarter(start),
            "contract_month": F.month(start),
            "contract_weekday": X.iso_weekday(start),
            "contract_season": X.season(start),
        }
        if "contract_end_date" in have:
            days = X.duration_days(start, F.col("contract_end_date"))
            new |= {"contract_duration_days": days, "contract_duration_category": X.duration_band(days)}
    out = df.withColumns(new)
    if has_psf:
        rows = df.withColumn("psf", X.psf()).filter(F.col("psf").isNotNull())
        lux = (F.col("price_per_sqft") >= F.col("_limits.psf_p")) | (F.col("annual_amount") >= F.col("_limits.rent_p"))
        out = out.withColumn("_limits", luxury_thresholds(rows)).withColumn("is_luxury", F.when(lux, True).otherwise(False)).drop("_limits")
    if "property_usage_en" in have:
        out = out.withColumn("usage_category", X.usage_category(F.col("property_usage_en")))
    return out


def with_area_tier(df: DataFrame, area: str = "area_name_en") -> DataFrame:
    """The market tier of each row's area, by exact name."""
    return df.withColumn("area_tier", X.area_tier(F.col(area)))


def with_property_type(df: DataFrame, column: str = "ejari_property_type_en") -> DataFrame:
    """The normal form of each row's property type."""
    return df.withColumn("property_type", X.normal_property_type(F.col(column)))
