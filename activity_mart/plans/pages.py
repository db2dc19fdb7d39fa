"""Report-page datasets: each function returns the frames behind one page."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from activity_mart.functions.numeric import plain_ratio
from activity_mart.operators.measures import (
    DOLLARS,
    GUARANTY,
    LOANS,
    Slicers,
    active_lenders,
    base_measures,
    failed_checks,
    page_totals,
    ratio_measures,
    rejected_count,
    top_lender_share,
)
from activity_mart.operators.star import Star


def overview_page(star: Star, where: Slicers | None = None) -> dict[str, DataFrame]:
    """Cards, the ten largest lender names and dollars by state."""
    totals = page_totals(star, [[], ["lender_name"], ["state"]], where)
    share = top_lender_share(star, [], where, totals=totals)
    cards = ratio_measures(totals.base([])).select(
        "*",
        active_lenders(star, where).scalar().alias("active_lenders"),
        share.select("top_lender_share").scalar().alias("top_10_lender_share"),
    )
    names = totals.base(["lender_name"]).select("lender_name", DOLLARS)
    states = totals.base(["state"]).select("state", DOLLARS)
    return {
        "cards": cards,
        "top_lenders": names.orderBy(F.desc(DOLLARS), "lender_name").limit(10),
        "states": states.orderBy(F.desc(DOLLARS), "state"),
    }


def lender_page(star: Star, where: Slicers | None = None) -> DataFrame:
    """Per lender name: dollars, loans, average size, guaranty rate and share.

    One row per lender also gives the points of the size-against-dollars scatter.
    """
    totals = page_totals(star, [[], ["lender_name"]], where)
    rows = ratio_measures(totals.base(["lender_name"]))
    everyone = totals.all_lenders([]).scalar()
    return rows.withColumn("lender_share", plain_ratio(F.col(DOLLARS), everyone)).drop(GUARANTY)


def region_rollup(star: Star, where: Slicers | None = None) -> DataFrame:
    """Dollars and loans by region and state with region and grand totals.

    ``level`` is 0 for a state, 1 for a region total, 3 for the grand total.
    """
    return _rolled(base_measures(star, ["region", "state"], where))


def _rolled(states: DataFrame) -> DataFrame:
    return states.rollup("region", "state").agg(
        F.grouping_id().cast("int").alias("level"),
        F.sum(DOLLARS).cast("decimal(28,2)").alias(DOLLARS),
        F.sum(LOANS).alias(LOANS),
    )


def geography_page(star: Star, where: Slicers | None = None) -> dict[str, DataFrame]:
    """By state, rolled up by region, and by county with average loan size."""
    totals = page_totals(star, [["region", "state"], ["state"], ["state", "county"]], where)
    counties = ratio_measures(totals.base(["state", "county"]))
    return {
        "states": totals.base(["state"]).select("state", DOLLARS, LOANS),
        "regions": _rolled(totals.base(["region", "state"])),
        "counties": counties.select("state", "county", DOLLARS, LOANS, "average_loan_size"),
    }


def quality_page(star: Star, report: DataFrame, rejected: DataFrame) -> dict[str, DataFrame]:
    """Cards on the model's own health and the two tables behind them."""
    cards = star.fact.agg(F.count("*").alias("fact_rows")).select(
        "fact_rows",
        failed_checks(report).scalar().alias("failed_checks"),
        rejected_count(rejected).scalar().alias("rejected_records"),
        star.dim_date.agg(F.max("reporting_period")).scalar().alias("reporting_period"),
    )
    return {"cards": cards, "report": report, "rejected": rejected}
