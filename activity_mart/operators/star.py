"""Star schema: two keyed dimensions, a date dimension and the county-grain fact."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from activity_mart.contracts import (
    DIM_DATE,
    DIM_GEOGRAPHY,
    DIM_LENDER,
    FACT,
    FISCAL_YEAR_START_MONTH,
    REPORTING_PERIOD,
    UNKNOWN_REGION,
)
from activity_mart.operators.keys import dense_key, require_unique
from activity_mart.operators.spread import PLACE, lookup_join, numbered
from activity_mart.plans.staging import stage_county, stage_lender
from activity_mart.sources.store import side_by_side, stored


@dataclass(frozen=True)
class Star:
    fact: DataFrame
    dim_lender: DataFrame
    dim_geography: DataFrame
    dim_date: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {
            "fact_lending_activity": self.fact,
            "dim_lender": self.dim_lender,
            "dim_geography": self.dim_geography,
            "dim_date": self.dim_date,
        }


def dim_lender(lenders: DataFrame) -> DataFrame:
    """Distinct lender, city and state of the lender extract, keyed in natural order."""
    names = ["lender_name", "lender_city", "lender_state"]
    members = stage_lender(lenders).select(*names).distinct()
    return dense_key(members, names, "lender_key").to(DIM_LENDER)


def dim_geography(counties: DataFrame, regions: DataFrame) -> DataFrame:
    """Distinct state and county of the county extract; an unlisted state is Unknown."""
    require_unique(regions, ["state"], "region lookup")
    members = (
        stage_county(counties)
        .select(F.col("project_state").alias("state"), F.col("project_county").alias("county"))
        .distinct()
    )
    keyed = dense_key(members, ["state", "county"], "geography_key")
    lookup = regions.select("state", "region")
    return (
        keyed.join(lookup, "state", "left")
        .withColumn("region", F.coalesce("region", F.lit(UNKNOWN_REGION)))
        .to(DIM_GEOGRAPHY)
    )


def date_key(period: Column) -> Column:
    return F.date_format(period, "yyyyMMdd").cast("int")


def dim_date(periods: DataFrame, fiscal_start: int = FISCAL_YEAR_START_MONTH) -> DataFrame:
    """One row per distinct ``reporting_period``; quarter and label follow the fiscal year."""
    period = F.col("reporting_period")
    fiscal = F.add_months(period, (13 - fiscal_start) % 12)
    quarter = F.concat(F.lit("Q"), F.quarter(fiscal))
    label = F.concat(
        F.lit("FY"),
        F.year(fiscal),
        F.lit(" "),
        F.when(F.month(fiscal) == 12, "Year End").otherwise(quarter),
    )
    return (
        periods.select(period.cast("date").alias("reporting_period"))
        .distinct()
        .select(
            date_key(period).alias("date_key"),
            period,
            F.year(period).alias("year"),
            quarter.alias("quarter"),
            F.month(period).alias("month"),
            label.alias("period_label"),
        )
        .to(DIM_DATE)
    )


def _fact_joins(counties: DataFrame, lenders: DataFrame, geographies: DataFrame, how: str) -> DataFrame:
    """County rows with both surrogate keys; the lookup sides hold natural keys once."""
    places = geographies.select(
        "geography_key",
        F.col("state").alias("project_state"),
        F.col("county").alias("project_county"),
    )
    staged = stage_county(counties)
    named = lookup_join(numbered(staged), lenders, ["lender_name", "lender_city", "lender_state"], how, staged)
    # Shares of places come from the extract too: the second lookup does not run the first one twice.
    return lookup_join(named, places, ["project_state", "project_county"], how, staged).drop(PLACE)


def fact_left(
    counties: DataFrame, lenders: DataFrame, geographies: DataFrame, validate: bool = True
) -> DataFrame:
    """Every county row; a lender or place without a dimension row gets a null key."""
    if validate:
        require_unique(lenders, ["lender_name", "lender_city", "lender_state"], "dim_lender")
        require_unique(geographies, ["state", "county"], "dim_geography")
    joined = _fact_joins(counties, lenders, geographies, "left")
    return joined.withColumn("date_key", date_key(F.col("reporting_period"))).to(FACT)


def fact_inner(
    counties: DataFrame, lenders: DataFrame, geographies: DataFrame, dates: DataFrame
) -> DataFrame:
    """Only county rows whose lender, place and period all have a dimension row."""
    joined = _fact_joins(counties, lenders, geographies, "inner")
    if "reporting_period" in counties.columns:
        return joined.join(dates.select("date_key", "reporting_period"), "reporting_period").to(FACT)
    # One default period for all rows: joining on a constant would be a cross join.
    current = dates.where(F.col("reporting_period") == F.lit(REPORTING_PERIOD).cast("date"))
    keyed = joined.withColumn("date_key", current.select("date_key").scalar())
    return keyed.where(F.col("date_key").isNotNull()).to(FACT)


def by_period(fact: DataFrame) -> DataFrame:
    """The fact's rows gathered by period before a write partitioned by it.

    Each period then has as many files as its size asks for, and not one from each task: a hot period is
    split at the advisory partition size (with small periods that hash beside it) and small ones share a task.
    With one period every task writes one file anyway, and the shuffle would be for nothing.
    """
    return fact.hint("rebalance", "date_key")


def build_star(
    lenders: DataFrame,
    counties: DataFrame,
    regions: DataFrame,
    fiscal_start: int = FISCAL_YEAR_START_MONTH,
    save: Callable[..., DataFrame] = stored,
) -> Star:
    """The four tables, each written once by ``save`` and read back.

    ``lenders`` and ``counties`` are read several times, so hand in tables, not
    long plans. The dimensions are distinct by construction and need no guard.
    """
    dims = side_by_side(
        counties.sparkSession,
        {
            "dim_lender": lambda: save(dim_lender(lenders), "dim_lender"),
            "dim_geography": lambda: save(dim_geography(counties, regions), "dim_geography"),
            "dim_date": lambda: save(dim_date(stage_county(counties), fiscal_start), "dim_date"),
        },
    )
    fact = fact_left(counties, dims["dim_lender"], dims["dim_geography"], validate=False)
    if dims["dim_date"].limit(2).count() > 1:
        fact = by_period(fact)
    fact_table = save(fact, "fact_lending_activity", partition_by=["date_key"])
    return Star(fact_table, **dims)
