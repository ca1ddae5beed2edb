"""Explicit schemas; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _L, _D, _DATE = T.StringType(), T.LongType(), T.DoubleType(), T.DateType()

CONTRACT_COLUMNS: list[tuple[str, T.DataType]] = [
    ("contract_id", _S),
    ("contract_reg_type_id", _L),
    ("contract_reg_type_en", _S),
    ("contract_reg_type_ar", _S),
    ("contract_start_date", _DATE),
    ("contract_end_date", _DATE),
    ("annual_amount", _D),
    ("contract_amount", _D),
    ("no_of_prop", _L),
    ("line_number", _L),
    ("is_free_hold", _L),
    ("ejari_bus_property_type_id", _L),
    ("ejari_bus_property_type_en", _S),
    ("ejari_bus_property_type_ar", _S),
    ("ejari_property_type_id", _L),
    ("ejari_property_type_en", _S),
    ("ejari_property_type_ar", _S),
    ("ejari_property_sub_type_id", _L),
    ("ejari_property_sub_type_en", _S),
    ("ejari_property_sub_type_ar", _S),
    ("property_usage_en", _S),
    ("property_usage_ar", _S),
    ("project_number", _L),
    ("project_name_ar", _S),
    ("project_name_en", _S),
    ("master_project_ar", _S),
    ("master_project_en", _S),
    ("area_id", _L),
    ("area_name_en", _S),
    ("area_name_ar", _S),
    ("actual_area", _D),
    ("nearest_landmark_en", _S),
    ("nearest_metro_en", _S),
    ("nearest_mall_en", _S),
    ("nearest_landmark_ar", _S),
    ("nearest_metro_ar", _S),
    ("nearest_mall_ar", _S),
    ("tenant_type_id", _L),
    ("tenant_type_en", _S),
    ("tenant_type_ar", _S),
]

CONTRACTS = T.StructType([T.StructField(n, t) for n, t in CONTRACT_COLUMNS])

#: The columns of one raw record, in their order, with their target types.
RAW_COLUMNS: list[tuple[str, T.DataType]] = [
    ("contract_id", _S),
    ("contract_reg_type_en", _S),
    ("contract_start_date", _DATE),
    ("contract_end_date", _DATE),
    ("annual_amount", _D),
    ("contract_amount", _D),
    ("property_usage_en", _S),
    ("project_name_en", _S),
    ("area_name_en", _S),
    ("actual_area", _D),
    ("tenant_type_en", _S),
    ("line_number", _L),
]

#: Natural content of each dimension; a surrogate key is put before it.
DIMENSIONS: dict[str, list[str]] = {
    "contract_type": ["contract_id", "contract_reg_type_id", "contract_reg_type_en", "contract_reg_type_ar"],
    "property": [
        "ejari_bus_property_type_id",
        "ejari_property_type_id",
        "ejari_bus_property_type_en",
        "ejari_bus_property_type_ar",
        "ejari_property_type_en",
        "ejari_property_type_ar",
        "ejari_property_sub_type_en",
        "ejari_property_sub_type_ar",
        "property_usage_en",
        "property_usage_ar",
    ],
    "project": ["project_number", "project_name_ar", "project_name_en", "master_project_ar", "master_project_en"],
    "location": [
        "area_id",
        "area_name_en",
        "area_name_ar",
        "actual_area",
        "nearest_landmark_en",
        "nearest_metro_en",
        "nearest_mall_en",
        "nearest_landmark_ar",
        "nearest_metro_ar",
        "nearest_mall_ar",
    ],
    "tenant": ["tenant_type_id", "tenant_type_en", "tenant_type_ar"],
}

#: Columns the published fact load joins on.
JOIN_KEYS: dict[str, list[str]] = {
    "contract_type": ["contract_reg_type_id"],
    "project": ["project_number"],
    "property": ["ejari_bus_property_type_id", "ejari_property_type_id"],
    "location": ["area_id"],
    "tenant": ["tenant_type_id"],
}

MEASURES = ["annual_amount", "contract_amount", "no_of_prop", "line_number", "is_free_hold"]
