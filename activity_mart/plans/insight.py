"""Headline sentences, KPI cards and ranked-bar data from the named queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from activity_mart.contracts import LENDER_ID
from activity_mart.functions.display import money_short, percent_one, percent_two, thousands
from activity_mart.functions.text import ellipsis, title_case
from activity_mart.plans.analytics import largest, widest_reach

# Fixed sentence texts; {n} is replaced by the n-th value of the sentence.
HEADLINES = {
    "totals": "{program} {period} activity totals {0} across {1} approved loans and {2} lenders.",
    "guaranty": "The SBA guaranty amount is {0}, equal to {1} of approved dollars.",
    "concentration": "The top 10 lenders account for {0} of approved dollars, "
    "so concentration is meaningful but no single lender dominates.",
    "lender": "{0} is the largest lender by approved dollars at {1} ({2} of total).",
    "state": "{0} is the largest project state at {1} ({2} of approved dollars).",
    "county": "{0}, {1} is the largest county exposure at {2}.",
    "office": "{0} is the largest SBA district office view at {1}.",
    "reach": "{0} has the widest geographic reach among top lenders, "
    "spanning {1} project states and territories.",
}
LABEL_LIMIT = 34


def _sentence(position: int, text: str, *values: Column) -> list[Column]:
    pattern = text.replace("%", "%%")
    for index in range(len(values)):
        pattern = pattern.replace(f"{{{index}}}", f"%{index + 1}$s")
    return [F.lit(position).alias("position"), F.format_string(pattern, *values).alias("fact")]


def headline_facts(analytics: dict[str, DataFrame], program: str, period: str) -> DataFrame:
    """Eight numbered sentences; ``program`` and ``period`` name the delivery."""
    kpi = analytics["kpi_summary"]
    lender = largest(analytics["top_lenders"], 1, LENDER_ID)
    state = largest(analytics["project_state_activity"], 1, ["project_state"])
    county = largest(analytics["county_concentration"], 1, ["project_state", "project_county"])
    office = largest(analytics["district_office_activity"], 1, ["do_code", "sba_do_name"])
    reach = widest_reach(analytics["lender_geographic_reach"])
    dollars = money_short(F.col("approved_dollars"))
    opening = HEADLINES["totals"].replace("{program}", program).replace("{period}", period)

    figures = F.array(
        *[
            F.struct(*_sentence(position, text, *values))
            for position, text, values in (
                (1, opening, (dollars, thousands(F.col("approved_loans")), thousands(F.col("lender_count")))),
                (
                    2,
                    HEADLINES["guaranty"],
                    (
                        money_short(F.col("approved_sba_guaranty_dollars")),
                        percent_two(F.col("guaranty_rate_pct")),
                    ),
                ),
                (3, HEADLINES["concentration"], (percent_two(F.col("top_10_lender_share_pct")),)),
            )
        ]
    )
    parts = [
        kpi.select(F.inline(figures)),
        lender.select(
            *_sentence(4, HEADLINES["lender"], F.col("lender"), dollars, percent_two(F.col("market_share_pct")))
        ),
        state.select(
            *_sentence(
                5, HEADLINES["state"], F.col("project_state"), dollars, percent_two(F.col("exposure_share_pct"))
            )
        ),
        county.select(
            *_sentence(6, HEADLINES["county"], F.col("project_county"), F.col("project_state"), dollars)
        ),
        office.select(*_sentence(7, HEADLINES["office"], title_case(F.col("sba_do_name")), dollars)),
        reach.select(
            *_sentence(8, HEADLINES["reach"], F.col("lender"), F.col("project_states").cast("string"))
        ),
    ]
    return reduce(DataFrame.unionByName, parts).orderBy("position")


def completion_line(kpi: DataFrame) -> DataFrame:
    """One line of key figures for the run log."""
    return kpi.select(
        F.format_string(
            "KPIs: %s approved across %s loans, guaranty rate %s, top-10 share %s",
            money_short(F.col("approved_dollars")),
            thousands(F.col("approved_loans")),
            percent_two(F.col("guaranty_rate_pct")),
            percent_two(F.col("top_10_lender_share_pct")),
        ).alias("line")
    )


def kpi_cards(kpi: DataFrame) -> DataFrame:
    """Eight labelled, formatted figures in display order."""
    cards = (
        ("Approved dollars", money_short(F.col("approved_dollars"))),
        ("Approved loans", thousands(F.col("approved_loans"))),
        ("Active lenders", thousands(F.col("lender_count"))),
        ("SBA guaranty", money_short(F.col("approved_sba_guaranty_dollars"))),
        ("Guaranty rate", percent_one(F.col("guaranty_rate_pct"))),
        ("Avg loan size", money_short(F.col("avg_loan_size"))),
        ("Project states", F.col("project_state_count").cast("string")),
        ("Top 10 lender share", percent_one(F.col("top_10_lender_share_pct"))),
    )
    rows = [
        F.struct(F.lit(position).alias("position"), F.lit(label).alias("label"), value.alias("value"))
        for position, (label, value) in enumerate(cards, start=1)
    ]
    return kpi.select(F.inline(F.array(*rows)))


def _bars(chart: str, rows: DataFrame, ties: list[str], label: Column, note: Column) -> DataFrame:
    # The window ranks ten rows.
    position = F.row_number().over(W.orderBy(F.desc("approved_dollars"), *ties))
    return largest(rows, 10, ties).select(
        F.lit(chart).alias("chart"),
        position.alias("position"),
        label.alias("label"),
        F.col("approved_dollars").alias("value"),
        money_short(F.col("approved_dollars")).alias("value_text"),
        note.alias("note"),
    )


def ranked_bars(analytics: dict[str, DataFrame]) -> DataFrame:
    """Label, value and note of the ten longest bars for lenders, states and offices."""
    loans = F.concat(thousands(F.col("approved_loans")), F.lit(" loans"))

    def shared(column: str) -> Column:
        return F.concat(percent_one(F.col(column)), F.lit(" share, "), loans)

    offices = F.concat(loans, F.lit(", "), percent_one(F.col("guaranty_rate_pct")), F.lit(" guaranty"))
    parts = [
        _bars(
            "lenders",
            analytics["top_lenders"],
            LENDER_ID,
            ellipsis(F.col("lender"), LABEL_LIMIT),
            shared("market_share_pct"),
        ),
        _bars(
            "states",
            analytics["project_state_activity"],
            ["project_state"],
            F.col("project_state"),
            shared("exposure_share_pct"),
        ),
        _bars(
            "offices",
            analytics["district_office_activity"],
            ["do_code", "sba_do_name"],
            ellipsis(title_case(F.col("sba_do_name")), LABEL_LIMIT),
            offices,
        ),
    ]
    return reduce(DataFrame.unionByName, parts)
