"""Staging views: cleaned extracts renamed to model names and typed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from activity_mart.contracts import MONEY, REPORTING_PERIOD


def _amounts() -> list:
    return [
        F.col("approved_loans").cast("bigint").alias("approved_loan_count"),
        F.col("approved_dollars").cast(MONEY).alias("approved_dollars"),
        F.col("approved_sba_guaranty_dollars").cast(MONEY).alias("guaranty_dollars"),
    ]


def _lender_id() -> list:
    return [F.col("lender").alias("lender_name"), F.col("lender_city"), F.col("lender_state")]


def stage_lender(lenders: DataFrame) -> DataFrame:
    return lenders.select(*_lender_id(), *_amounts())


def stage_county(counties: DataFrame) -> DataFrame:
    """County staging; an extract without a period belongs to the default one."""
    if "reporting_period" in counties.columns:
        period = F.col("reporting_period").cast("date")
    else:
        period = F.lit(REPORTING_PERIOD).cast("date")
    return counties.select(
        *_lender_id(), "project_state", "project_county", period.alias("reporting_period"), *_amounts()
    )


def stage_district(districts: DataFrame) -> DataFrame:
    return districts.select(
        *_lender_id(),
        F.col("do_code").cast("string").alias("do_code"),
        F.col("sba_do_name").alias("district_office_name"),
        *_amounts(),
    )
