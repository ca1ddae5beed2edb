"""Scalar expressions of the contract domain, as Columns that stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from leasemill.settings import (
    AREA_TIERS,
    COMMERCIAL_USAGE,
    DEFAULT_AREA_TIER,
    LIMITS,
    NULL_TOKENS,
    PROPERTY_TYPES,
    RESIDENTIAL_USAGE,
)

#: White space at either end, Unicode spaces included (``trim`` takes blanks only).
EDGE_SPACE = r"(?U)^\s+|\s+$"


def valid_rent(rent: str = "annual_amount") -> Column:
    """Rent present and above 0; NaN counts as missing."""
    c = F.col(rent)
    return (c > 0) & ~F.isnan(c)


def valid_area(area: str = "actual_area") -> Column:
    c = F.col(area)
    return (c > 0) & ~F.isnan(c)


def psf(rent: str = "annual_amount", area: str = "actual_area") -> Column:
    """Rent for a square foot; null unless both are valid. ``try_divide``: the branches of a ``when`` may be evaluated early."""
    return F.when(valid_rent(rent) & valid_area(area), F.try_divide(F.col(rent), F.col(area)))


def is_residential(usage: Column) -> Column:
    return usage.isin(RESIDENTIAL_USAGE)


def is_commercial(usage: Column) -> Column:
    return usage.isin(COMMERCIAL_USAGE)


def psf_in_band(usage: Column, value: Column) -> Column:
    """Inside the band of its class, bounds included; rows of neither class are out."""
    return (is_residential(usage) & value.between(LIMITS.min_psf_residential, LIMITS.max_psf_residential)) | (
        is_commercial(usage) & value.between(LIMITS.min_psf_commercial, LIMITS.max_psf_commercial)
    )


def strip(c: Column) -> Column:
    return F.regexp_replace(c, EDGE_SPACE, "")


def null_tokens(c: Column) -> Column:
    """The text, or null for one of the texts that stand for null."""
    return F.when(~c.isin(NULL_TOKENS), c)


def parse_date(c: Column) -> Column:
    """dd-MM-yyyy, one-digit days and months allowed; anything else is null."""
    return F.try_to_timestamp(c, F.lit("d-M-yyyy")).cast("date")


def iso_weekday(d: Column) -> Column:
    """1 Monday to 7 Sunday."""
    return F.weekday(d) + 1


def season(d: Column) -> Column:
    """A missing date falls to the last branch, as every other month does."""
    m = F.month(d)
    return (
        F.when(m.isin(12, 1, 2), "Winter").when(m.isin(3, 4, 5), "Spring").when(m.isin(6, 7, 8), "Summer").otherwise("Fall")
    )


def duration_days(start: Column, end: Column) -> Column:
    return F.datediff(end, start)


def duration_band(days: Column) -> Column:
    return (
        F.when(days.isNull(), "Unknown").when(days < 180, "Short-term").when(days < 365, "Medium-term").otherwise("Long-term")
    )


def usage_category(usage: Column) -> Column:
    """By text contained, residential first; null and anything else is Other."""
    return (
        F.when(usage.rlike("(?i)residential"), "Residential").when(usage.rlike("(?i)commercial"), "Commercial").otherwise("Other")
    )


def area_tier(area: Column) -> Column:
    """Tier of an area by exact name."""
    pairs = [F.lit(x) for tier, areas in AREA_TIERS.items() for area_name in areas for x in (area_name, tier)]
    return F.coalesce(F.element_at(F.create_map(*pairs), area), F.lit(DEFAULT_AREA_TIER))


def title_case(c: Column) -> Column:
    """A letter after anything but a letter is upper case, any other lower case (``initcap`` splits at blanks only)."""
    parts = F.regexp_extract_all(F.lower(c), F.lit(r"(\p{L}+|[^\p{L}]+)"), 1)
    return F.array_join(F.transform(parts, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substr(w, F.lit(2)))), "")


def normal_property_type(c: Column) -> Column:
    """Normal form of a property type: known spellings by table, others in title case, empty and null Unknown."""
    pairs = [F.lit(x) for item in PROPERTY_TYPES.items() for x in item]
    known = F.element_at(F.create_map(*pairs), strip(F.lower(c)))
    return F.when(c.isNull() | (c == ""), "Unknown").otherwise(F.coalesce(known, title_case(c)))


def pct_change(now: Column, before: Column) -> Column:
    """Signed change in per cent; null where a side is missing or the base is 0."""
    return F.try_divide(now - before, before) * F.lit(100.0)


def date_key(d: Column) -> Column:
    """yyyymmdd as an integer."""
    return F.date_format(d, "yyyyMMdd").cast("int")
