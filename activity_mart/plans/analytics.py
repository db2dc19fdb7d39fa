"""The named business queries over the cleaned extracts.

Totals used as share denominators are scalar subqueries: one number per query,
no join and no window over the whole table. Every LIMIT carries the natural key
as a tie-breaker, so results repeat.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from activity_mart.contracts import (
    COUNTY_EXTRACT,
    DISTRICT_EXTRACT,
    GEOGRAPHY_ID,
    LENDER_EXTRACT,
    LENDER_ID,
    MONEY,
    MONEY_TOTAL,
    PERCENT,
)
from activity_mart.functions.numeric import plain_ratio, rounded_percent, rounded_ratio
from activity_mart.operators.distincts import totals_with_distincts


def _sums() -> list[Column]:
    return [
        F.sum("approved_loans").alias("approved_loans"),
        F.sum("approved_dollars").cast(MONEY_TOTAL).alias("approved_dollars"),
        F.sum("approved_sba_guaranty_dollars").cast(MONEY_TOTAL).alias("approved_sba_guaranty_dollars"),
    ]


def _average() -> Column:
    return rounded_ratio(F.col("approved_dollars"), F.col("approved_loans"), 2, MONEY).alias("avg_loan_size")


def _guaranty_rate() -> Column:
    return rounded_percent(
        F.col("approved_sba_guaranty_dollars"), F.col("approved_dollars"), PERCENT
    ).alias("guaranty_rate_pct")


def total_dollars(rows: DataFrame) -> Column:
    """The table's approved dollars as a scalar subquery."""
    return rows.agg(F.sum("approved_dollars").cast(MONEY_TOTAL)).scalar()


def largest(rows: DataFrame, n: int, ties: list[str]) -> DataFrame:
    """The ``n`` rows with the most approved dollars, ties cut by natural key."""
    return rows.orderBy(F.desc("approved_dollars"), *ties).limit(n)


def top_dollars(lenders: DataFrame, n: int = 10) -> DataFrame:
    """One row: the approved dollars of the ``n`` largest lender rows."""
    return largest(lenders, n, LENDER_ID).agg(
        F.sum("approved_dollars").cast(MONEY_TOTAL).alias("top_approved_dollars")
    )


def top_share(lenders: DataFrame, n: int = 10) -> DataFrame:
    """One row: dollars of the ``n`` largest lender rows and their share of the total."""
    return top_dollars(lenders, n).select(
        "top_approved_dollars",
        rounded_percent(F.col("top_approved_dollars"), total_dollars(lenders), PERCENT).alias("top_share_pct"),
    )


def kpi_summary(lenders: DataFrame, counties: DataFrame) -> DataFrame:
    """One row of headline figures over the lender and county extracts."""
    totals = lenders.agg(F.count("*").alias("lender_count"), *_sums())
    places = counties.select(*GEOGRAPHY_ID).distinct()
    known = F.col("project_state").isNotNull() & F.col("project_county").isNotNull()
    reach = places.agg(
        F.struct(
            F.count_distinct("project_state").alias("states"), F.count_if(known).alias("counties")
        )
    ).scalar()
    return totals.select(
        "lender_count",
        reach["states"].alias("project_state_count"),
        reach["counties"].alias("project_county_count"),
        "approved_loans",
        "approved_dollars",
        "approved_sba_guaranty_dollars",
        _average(),
        _guaranty_rate(),
        rounded_percent(top_dollars(lenders).scalar(), F.col("approved_dollars"), PERCENT).alias(
            "top_10_lender_share_pct"
        ),
    )


def top_lenders(lenders: DataFrame, n: int = 15) -> DataFrame:
    """The largest lender rows with their ratios and market share."""
    shown = largest(lenders, n, LENDER_ID).select(
        *LENDER_ID,
        "approved_loans",
        F.col("approved_dollars").cast(MONEY_TOTAL).alias("approved_dollars"),
        F.col("approved_sba_guaranty_dollars").cast(MONEY_TOTAL).alias("approved_sba_guaranty_dollars"),
    )
    return shown.select(
        "*",
        _average(),
        _guaranty_rate(),
        rounded_percent(F.col("approved_dollars"), total_dollars(lenders), PERCENT).alias("market_share_pct"),
    ).orderBy(F.desc("approved_dollars"), *LENDER_ID)


def _activity_by(rows: DataFrame, by: list[str]) -> DataFrame:
    return rows.groupBy(*by).agg(F.count_distinct("lender").alias("lender_count"), *_sums())


def _exposure(grouped: DataFrame, by: list[str], denominator: DataFrame) -> DataFrame:
    return grouped.select(
        *by,
        "lender_count",
        "approved_loans",
        "approved_dollars",
        "approved_sba_guaranty_dollars",
        _average(),
        _guaranty_rate(),
        rounded_percent(F.col("approved_dollars"), total_dollars(denominator), PERCENT).alias(
            "exposure_share_pct"
        ),
    )


def state_activity(counties: DataFrame, denominator: DataFrame) -> DataFrame:
    """Per project state, with its share of the dollars in ``denominator``.

    The reference figure divides by the lender extract; pass the county extract to
    divide by its own total instead.
    """
    by = ["project_state"]
    return _exposure(_activity_by(counties, by), by, denominator).orderBy(F.desc("approved_dollars"), *by)


def county_concentration(counties: DataFrame, denominator: DataFrame, n: int = 20) -> DataFrame:
    """The largest project counties, with their share of the dollars in ``denominator``."""
    grouped = largest(_activity_by(counties, GEOGRAPHY_ID), n, GEOGRAPHY_ID)
    return _exposure(grouped, GEOGRAPHY_ID, denominator).orderBy(F.desc("approved_dollars"), *GEOGRAPHY_ID)


def geographic_reach(lenders: DataFrame, counties: DataFrame, n: int = 20) -> DataFrame:
    """The largest lenders with the states and counties they lend in."""
    # Deduplicate to one row per place first: the counts then need no second distinct.
    places = counties.select(*LENDER_ID, *GEOGRAPHY_ID).distinct()
    known = F.col("project_state").isNotNull() & F.col("project_county").isNotNull()
    reach = places.groupBy(*LENDER_ID).agg(
        F.count_distinct("project_state").alias("project_states"),
        F.count_if(known).alias("project_counties"),
    )
    top = largest(lenders.join(reach, LENDER_ID), n, LENDER_ID)
    dollars = F.col("approved_dollars")
    return top.select(
        *LENDER_ID,
        "approved_loans",
        dollars.cast(MONEY_TOTAL).alias("approved_dollars"),
        "project_states",
        "project_counties",
        rounded_ratio(dollars, F.col("project_states"), 2, MONEY).alias("avg_dollars_per_state"),
        rounded_ratio(dollars, F.col("project_counties"), 2, MONEY).alias("avg_dollars_per_county"),
    ).orderBy(F.desc("approved_dollars"), *LENDER_ID)


def office_activity(districts: DataFrame, n: int = 20) -> DataFrame:
    """The largest district offices."""
    by = ["do_code", "sba_do_name"]
    return (
        largest(_activity_by(districts, by), n, by)
        .select(
            *by,
            "lender_count",
            "approved_loans",
            "approved_dollars",
            "approved_sba_guaranty_dollars",
            _average(),
            _guaranty_rate(),
        )
        .orderBy(F.desc("approved_dollars"), *by)
    )


def widest_reach(reach: DataFrame) -> DataFrame:
    """Among the rows of ``geographic_reach``, the lender in the most states."""
    return reach.orderBy(F.desc("project_states"), F.desc("approved_dollars"), *LENDER_ID).limit(1)


def concentration_curve(lenders: DataFrame, n: int = 50) -> DataFrame:
    """Cumulative share of dollars held by the ``n`` largest lender rows."""
    top = largest(lenders, n, LENDER_ID)
    # The window sees n rows at most: the limit below it is the top-k operator.
    position = W.orderBy(F.desc("approved_dollars"), *LENDER_ID)
    running = F.sum("approved_dollars").over(position.rowsBetween(W.unboundedPreceding, W.currentRow))
    return top.select(
        F.row_number().over(position).alias("lender_rank"),
        *LENDER_ID,
        F.col("approved_dollars").cast(MONEY_TOTAL).alias("approved_dollars"),
        (plain_ratio(running, total_dollars(lenders)) * 100).alias("cumulative_share_pct"),
    ).orderBy("lender_rank")


# --- unrounded intermediate models over the staging views --------------------


def _model_ratios(total: Column, share: str) -> list[Column]:
    dollars = F.col("approved_dollars")
    return [
        plain_ratio(dollars, F.col("approved_loan_count")).alias("avg_loan_size"),
        plain_ratio(F.col("guaranty_dollars"), dollars).alias("guaranty_rate"),
        plain_ratio(dollars, total).alias(share),
    ]


def lender_metrics(staged_lenders: DataFrame) -> DataFrame:
    """Every staged lender row with unrounded ratios and its share of the table."""
    return staged_lenders.select(
        "lender_name",
        "lender_city",
        "lender_state",
        "approved_loan_count",
        "approved_dollars",
        "guaranty_dollars",
        *_model_ratios(total_dollars(staged_lenders), "lender_share"),
    )


def state_metrics(staged_counties: DataFrame) -> DataFrame:
    """Per project state with unrounded ratios and its share of the county table itself."""
    states = staged_counties.groupBy("project_state").agg(
        F.count_distinct("lender_name").alias("lender_count"),
        F.sum("approved_loan_count").alias("approved_loan_count"),
        F.sum("approved_dollars").cast(MONEY_TOTAL).alias("approved_dollars"),
        F.sum("guaranty_dollars").cast(MONEY_TOTAL).alias("guaranty_dollars"),
    )
    return states.select("*", *_model_ratios(total_dollars(staged_counties), "exposure_share"))


def executive_kpis(fact: DataFrame) -> DataFrame:
    """One row over the fact: totals, ratios and the distinct keys in use."""
    sums = [
        F.sum("approved_loan_count").alias("total_loan_count"),
        F.sum("approved_dollars").cast(MONEY_TOTAL).alias("total_approved_dollars"),
        F.sum("guaranty_dollars").cast(MONEY_TOTAL).alias("total_guaranty_dollars"),
    ]
    found = totals_with_distincts(fact, sums, {"lender_key": "active_lenders", "geography_key": "active_geographies"})
    dollars = F.col("total_approved_dollars")
    return found.select(
        *[c for c in found.columns if c.startswith("total_")],
        plain_ratio(dollars, F.col("total_loan_count")).alias("average_loan_size"),
        plain_ratio(F.col("total_guaranty_dollars"), dollars).alias("guaranty_rate"),
        "active_lenders",
        "active_geographies",
    )


def run_analytics(extracts: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All named queries over the three cleaned extracts."""
    lenders = extracts[LENDER_EXTRACT.name]
    counties = extracts[COUNTY_EXTRACT.name]
    return {
        "kpi_summary": kpi_summary(lenders, counties),
        "top_lenders": top_lenders(lenders),
        "project_state_activity": state_activity(counties, lenders),
        "county_concentration": county_concentration(counties, lenders),
        "lender_geographic_reach": geographic_reach(lenders, counties),
        "district_office_activity": office_activity(extracts[DISTRICT_EXTRACT.name]),
    }
