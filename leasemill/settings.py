"""Thresholds and lookup values that are part of the query semantics."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Limits:
    # The bounds of the published rules.
    min_annual_rent: int = 10000
    max_annual_rent: int = 5000000
    min_property_size: int = 200
    max_property_size: int = 50000
    min_psf_residential: int = 20
    max_psf_residential: int = 500
    min_psf_commercial: int = 30
    max_psf_commercial: int = 800
    min_contract_days: int = 30
    max_contract_days: int = 730
    luxury_psf_percentile: float = 0.75
    luxury_rent_percentile: float = 0.80
    outlier_iqr_multiplier: float = 3.0
    min_outlier_sample: int = 10
    min_area_sample_size: int = 10
    top_n_areas: int = 20


LIMITS = Limits()

# The usage labels of the two classes, matched exactly.
RESIDENTIAL_USAGE = [
    "Residential",
    "Residential - Apartment",
    "Residential - Villa",
    "Residential - Townhouse",
    "Residential - Studio",
]
COMMERCIAL_USAGE = [
    "Commercial",
    "Commercial - Office",
    "Commercial - Retail",
    "Commercial - Warehouse",
]

# Market tier of an area; any other area is Mid-Tier.
DEFAULT_AREA_TIER = "Mid-Tier"
AREA_TIERS = {
    "Premium": [
        "Downtown Dubai",
        "Dubai Marina",
        "Palm Jumeirah",
        "Emirates Hills",
        "Jumeirah Beach Residence",
        "Business Bay",
        "Dubai Hills Estate",
        "Arabian Ranches",
    ],
    "Mid-Tier": [
        "Jumeirah Village Circle",
        "Jumeirah Village Triangle",
        "Dubai Sports City",
        "Motor City",
        "The Greens",
        "The Views",
        "Discovery Gardens",
        "Mirdif",
    ],
    "Budget": [
        "International City",
        "Deira",
        "Bur Dubai",
        "Al Nahda",
        "Al Qusais",
    ],
    "Emerging": [
        "Dubai South",
        "Dubailand",
        "Dubai Production City",
    ],
}

# Spelling of a property type -> its normal form.
PROPERTY_TYPES = {
    "apt": "Apartment",
    "apartment": "Apartment",
    "flat": "Apartment",
    "villa": "Villa",
    "townhouse": "Townhouse",
    "town house": "Townhouse",
    "penthouse": "Penthouse",
    "studio": "Studio",
    "office": "Office",
    "shop": "Retail",
    "retail": "Retail",
    "warehouse": "Warehouse",
    "land": "Land",
    "plot": "Land",
}

# Fields the validation rules look at.
REQUIRED_FIELDS = ["contract_id", "contract_start_date", "property_usage_en", "annual_amount"]
NUMERIC_FIELDS = ["annual_amount", "contract_amount", "no_of_prop"]
DATE_FIELDS = ["contract_start_date", "contract_end_date"]

# Texts that stand for null in delivered CSV files.
NULL_TOKENS = ["null", "NULL", ""]

PARQUET_CODEC = "zstd"
PARQUET_CODEC_LEVEL = "3"
FETCH_RETRIES = 3
FETCH_TIMEOUT_S = 30
FETCH_BACKOFF_BASE = 2
FETCH_CHUNK_BYTES = 8192
