from __future__ import annotations

import math
from decimal import ROUND_HALF_UP, Decimal

import frames
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from activity_mart.contracts import MONEY, MONEY_TOTAL
from activity_mart.functions.numeric import rounded_ratio
from activity_mart.plans import analytics, insight
from activity_mart.plans.staging import stage_county
from activity_mart.testbed import tables

AMOUNT = st.integers(-(10**14), 10**14).map(lambda cents: Decimal(cents) / 100)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(AMOUNT, AMOUNT), min_size=50, max_size=200))
def test_rounded_ratio_is_exact(spark, pairs):
    frame = spark.createDataFrame(pairs, "n decimal(28,2), d decimal(28,2)")
    found = frame.select("n", "d", rounded_ratio(F.col("n"), F.col("d"), 2, MONEY_TOTAL).alias("r")).collect()
    for row in found:
        if row.d == 0:
            assert row.r is None
        else:
            exact = (abs(row.n) * 200 + abs(row.d)) // (2 * abs(row.d)) / Decimal(100)
            assert row.r == (-exact if (row.n < 0) != (row.d < 0) else exact)


def test_rounding_goes_half_away_from_zero(spark):
    pairs = [("1.00", "8.00"), ("-1.00", "8.00"), ("5.00", "1000.00"), ("2.00", "3.00")]
    frame = spark.createDataFrame(pairs, "n string, d string").select(
        F.col("n").cast(MONEY).alias("n"), F.col("d").cast(MONEY).alias("d")
    )
    found = [r.r for r in frame.select(rounded_ratio(F.col("n"), F.col("d"), 2, MONEY).alias("r")).collect()]
    expected = [(Decimal(n) / Decimal(d)).quantize(Decimal("0.01"), ROUND_HALF_UP) for n, d in pairs]
    assert found == expected


def test_share_denominator_is_a_choice(spark):
    # The lender extract holds 3.2M, the county extract 4.0M.
    counties = [*frames.COUNTIES, ("Harbor Union", "Portland", "ME", "NH", "COOS", 1, "1000000.00", "0.00")]
    rows, lenders = frames.counties(spark, counties), frames.lenders(spark)
    by_lender = {r.project_state: r.exposure_share_pct for r in analytics.state_activity(rows, lenders).collect()}
    by_itself = {r.project_state: r.exposure_share_pct for r in analytics.state_activity(rows, rows).collect()}
    assert (by_lender["ME"], by_itself["ME"]) == (Decimal("37.50"), Decimal("30.00"))


def test_composite_distinct_is_not_fooled_by_delimiters(spark):
    counties = [("A", "B", "C", "x|y", "z", 1, "1", "1"), ("A", "B", "C", "x", "y|z", 1, "1", "1")]
    kpi = analytics.kpi_summary(frames.lenders(spark), frames.counties(spark, counties)).first()
    assert (kpi.project_state_count, kpi.project_county_count) == (2, 2)


def test_ties_are_cut_by_natural_key(spark):
    rows = [(f"Bank {i:02d}", "A", "TX", 1, "5.00", "1.00") for i in range(30)]
    found = [r.lender for r in analytics.top_lenders(frames.lenders(spark, rows)).collect()]
    assert found == [f"Bank {i:02d}" for i in range(15)]


def test_curve_rises_and_meets_the_top_ten_share(spark, sf_dir):
    lenders = tables.lender_extract(spark, "/root/testdata/sf0.01")
    curve = analytics.concentration_curve(lenders).collect()
    shares = [r.cumulative_share_pct for r in curve]
    assert [r.lender_rank for r in curve] == list(range(1, 51)) and shares == sorted(shares)
    kpi = analytics.kpi_summary(lenders, tables.county_extract(spark, "/root/testdata/sf0.01")).first()
    assert math.isclose(shares[9], float(kpi.top_10_lender_share_pct), abs_tol=0.005)
    assert (kpi.approved_loans, kpi.approved_dollars) == (60000, Decimal("3183256271.63"))


def test_known_totals_of_the_star(spark):
    star = tables.star(spark, "/root/testdata/sf0.01")
    sums = star.fact.agg(F.sum("lender_key"), F.sum("geography_key"), F.sum("guaranty_dollars")).first()
    assert tuple(sums) == (618970, 771344, Decimal("3024008734.24"))


def test_state_shares_sum_to_one(spark, sf_dir):
    staged = stage_county(tables.county_extract(spark, sf_dir))
    assert math.isclose(sum(r.exposure_share for r in analytics.state_metrics(staged).collect()), 1.0)


@pytest.fixture(scope="module")
def found(spark):
    return analytics.run_analytics(frames.extracts(spark))


def test_headlines(found):
    lines = [r.fact for r in insight.headline_facts(found, "Program", "FY2024").collect()]
    assert len(lines) == 8
    assert lines[0] == "Program FY2024 activity totals $3.2M across 11 approved loans and 4 lenders."
    assert lines[3] == "Cedar Trust is the largest lender by approved dollars at $1.2M (37.50% of total)."
    assert lines[6] == "Alpine / Lakes is the largest SBA district office view at $1.2M."
    assert lines[7].endswith("spanning 2 project states and territories.")


def test_cards_and_completion_line(found):
    cards = {r.label: r.value for r in insight.kpi_cards(found["kpi_summary"]).collect()}
    assert cards["Avg loan size"] == "$291K" and cards["Guaranty rate"] == "63.8%"
    line = insight.completion_line(found["kpi_summary"]).first().line
    assert line == "KPIs: $3.2M approved across 11 loans, guaranty rate 63.75%, top-10 share 100.00%"


def test_bars(found):
    bars = insight.ranked_bars(found).collect()
    assert [(b.position, b.label, b.note) for b in bars if b.chart == "states"] == [
        (1, "ME", "37.5% share, 3 loans"),
        (2, "WA", "33.8% share, 5 loans"),
        (3, "ID", "22.5% share, 2 loans"),
    ]
