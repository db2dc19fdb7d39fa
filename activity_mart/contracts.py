"""Column contracts: types, table specifications and fixed values.

Everything here is a value the outputs have to agree on; no logic.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
MONEY_TOTAL = T.DecimalType(28, 2)
RAW_NUMBER = T.DecimalType(38, 10)
PERCENT = T.DecimalType(9, 2)

LENDER_ID = ["lender", "lender_city", "lender_state"]
GEOGRAPHY_ID = ["project_state", "project_county"]
AMOUNTS = ["approved_loans", "approved_dollars", "approved_sba_guaranty_dollars"]

MISSING = "missing_required_value"
INVALID = "invalid_amount"


@dataclass(frozen=True)
class ExtractSpec:
    """One source extract: its section in the delivery, header renames and required text."""

    name: str
    section: str
    columns: dict[str, str] = field(hash=False)
    required_text: tuple[str, ...]

    @property
    def required(self) -> list[str]:
        return [*self.required_text, *AMOUNTS]


_LENDER_HEADERS = {"Lender": "lender", "Lender City": "lender_city", "Lender State": "lender_state"}
_AMOUNT_HEADERS = {
    "Approved Loans": "approved_loans",
    "Approved Dollars": "approved_dollars",
    "Approved SBA Guaranty Dollars": "approved_sba_guaranty_dollars",
}

LENDER_EXTRACT = ExtractSpec(
    "sba_lender_activity", "Lender", {**_LENDER_HEADERS, **_AMOUNT_HEADERS}, tuple(LENDER_ID)
)
COUNTY_EXTRACT = ExtractSpec(
    "sba_lender_county_activity",
    "Lender_ProjCnty",
    {
        **_LENDER_HEADERS,
        "Project State": "project_state",
        "Project County": "project_county",
        **_AMOUNT_HEADERS,
    },
    (*LENDER_ID, *GEOGRAPHY_ID),
)
DISTRICT_EXTRACT = ExtractSpec(
    "sba_district_office_activity",
    "Lender_DO",
    {**_LENDER_HEADERS, "DO Code": "do_code", "SBA DO Name": "sba_do_name", **_AMOUNT_HEADERS},
    (*LENDER_ID, "do_code", "sba_do_name"),
)
EXTRACTS = {spec.name: spec for spec in (LENDER_EXTRACT, COUNTY_EXTRACT, DISTRICT_EXTRACT)}


def _fields(*pairs: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in pairs])


_AMOUNT_FIELDS = (
    ("approved_loans", T.LongType()),
    ("approved_dollars", MONEY),
    ("approved_sba_guaranty_dollars", MONEY),
    ("avg_loan_size", MONEY),
    ("guaranty_rate_pct", PERCENT),
)


def cleaned_schema(spec: ExtractSpec) -> T.StructType:
    return _fields(*[(name, T.StringType()) for name in spec.required_text], *_AMOUNT_FIELDS)


REJECTS = _fields(
    ("source_table", T.StringType()),
    ("rejection_reason", T.StringType()),
    ("lender", T.StringType()),
    ("approved_loans", RAW_NUMBER),
    ("approved_dollars", RAW_NUMBER),
    ("raw", T.StringType()),
)
DIM_LENDER = _fields(
    ("lender_key", T.LongType()),
    ("lender_name", T.StringType()),
    ("lender_city", T.StringType()),
    ("lender_state", T.StringType()),
)
DIM_GEOGRAPHY = _fields(
    ("geography_key", T.LongType()),
    ("state", T.StringType()),
    ("county", T.StringType()),
    ("region", T.StringType()),
)
DIM_DATE = _fields(
    ("date_key", T.IntegerType()),
    ("reporting_period", T.DateType()),
    ("year", T.IntegerType()),
    ("quarter", T.StringType()),
    ("month", T.IntegerType()),
    ("period_label", T.StringType()),
)
FACT = _fields(
    ("lender_key", T.LongType()),
    ("geography_key", T.LongType()),
    ("date_key", T.IntegerType()),
    ("reporting_period", T.DateType()),
    ("approved_loan_count", T.LongType()),
    ("approved_dollars", MONEY),
    ("guaranty_dollars", MONEY),
)
QUALITY_REPORT = _fields(
    ("check_name", T.StringType()),
    ("status", T.StringType()),
    ("failed_count", T.LongType()),
    ("details", T.StringType()),
)

# --- fixed values -----------------------------------------------------------

REPORTING_PERIOD = "2024-09-30"
FISCAL_YEAR_START_MONTH = 10
NULL_TOKENS = ("", "NULL", "null")
UNKNOWN_REGION = "Unknown"

# The region of every state and territory.
STATE_REGIONS = {
    "AK": "West",
    "AL": "South",
    "AR": "South",
    "AS": "Territory",
    "AZ": "West",
    "CA": "West",
    "CO": "West",
    "CT": "Northeast",
    "DC": "South",
    "DE": "South",
    "FL": "South",
    "GA": "South",
    "GU": "Territory",
    "HI": "West",
    "IA": "Midwest",
    "ID": "West",
    "IL": "Midwest",
    "IN": "Midwest",
    "KS": "Midwest",
    "KY": "South",
    "LA": "South",
    "MA": "Northeast",
    "MD": "South",
    "ME": "Northeast",
    "MI": "Midwest",
    "MN": "Midwest",
    "MO": "Midwest",
    "MP": "Territory",
    "MS": "South",
    "MT": "West",
    "NC": "South",
    "ND": "Midwest",
    "NE": "Midwest",
    "NH": "Northeast",
    "NJ": "Northeast",
    "NM": "West",
    "NV": "West",
    "NY": "Northeast",
    "OH": "Midwest",
    "OK": "South",
    "OR": "West",
    "PA": "Northeast",
    "PR": "Territory",
    "RI": "Northeast",
    "SC": "South",
    "SD": "Midwest",
    "TN": "South",
    "TX": "South",
    "UT": "West",
    "VA": "South",
    "VI": "Territory",
    "VT": "Northeast",
    "WA": "West",
    "WI": "Midwest",
    "WV": "South",
    "WY": "West",
}
REGIONS = ["Northeast", "Midwest", "South", "West", "Territory", UNKNOWN_REGION]

CHECK_DETAILS = {
    "missing_required_values": "No nulls expected after cleaning selected SBA source sheets.",
    "duplicate_rows": "Exact duplicate source rows should not appear after cleaning.",
    "non_negative_amounts": "Approved loans and dollars must be non-negative.",
    "guaranty_not_above_approved": "SBA guaranty dollars should not exceed approved dollars.",
    "dim_lender_unique_key": "Each lender dimension key must be unique.",
    "dim_geography_unique_key": "Each geography dimension key must be unique.",
    "fact_lender_key_not_null": "Every fact row must match DimLender.",
    "fact_geography_key_not_null": "Every fact row must match DimGeography.",
    "dim_geography_valid_state_codes": "Project states should map to valid U.S. state or territory codes.",
    "fact_non_negative_amounts": "Fact table financial fields must be non-negative.",
    "fact_guaranty_not_above_approved": "Fact guaranty dollars should not exceed approved dollars.",
}
