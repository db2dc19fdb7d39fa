from __future__ import annotations

import frames
import pytest
from pyspark.sql import functions as F

from activity_mart.contracts import CHECK_DETAILS, QUALITY_REPORT
from activity_mart.operators import expectations
from activity_mart.operators.star import Star, build_star, fact_inner
from activity_mart.plans.staging import stage_county, stage_district, stage_lender
from activity_mart.sources.readers import state_regions


def built(spark, extracts):
    names = list(extracts)
    return build_star(extracts[names[0]], extracts[names[1]], state_regions(spark))


def report_of(spark, extracts):
    rows = expectations.quality_report(extracts, built(spark, extracts))
    assert rows.schema.simpleString() == QUALITY_REPORT.simpleString()
    return {r.check_name: (r.status, r.failed_count) for r in rows.collect()}


def test_all_checks_pass_on_clean_input(spark):
    found = report_of(spark, frames.extracts(spark))
    assert len(found) == 19 and set(found.values()) == {("pass", 0)}
    expected = {name for name in CHECK_DETAILS if name.startswith(("dim_", "fact_"))}
    assert expected < set(found)


def test_guaranty_above_approved_is_flagged_once(spark):
    rows = [("Cedar Trust", "Boise", "ID", 5, "1200000.00", "1200001.00"), *frames.LENDERS[1:]]
    found = report_of(spark, frames.extracts(spark, lender_rows=rows))
    assert found["sba_lender_activity_guaranty_not_above_approved"] == ("fail", 1)
    assert [name for name, (status, _) in found.items() if status == "fail"] == [
        "sba_lender_activity_guaranty_not_above_approved"
    ]


def test_every_kind_of_failure_is_counted(spark):
    counties = [
        *frames.COUNTIES,
        frames.COUNTIES[0],
        ("Stray Bank", "Reno", "NV", "ZZ", "NOWHERE", -1, "10.00", "5.00"),
        ("Harbor Union", "Portland", "ME", "ME", "YORK", 1, "10.00", None),
    ]
    found = report_of(spark, frames.extracts(spark, county_rows=counties))
    table = "sba_lender_county_activity"
    assert found[f"{table}_duplicate_rows"] == ("fail", 1)
    # The null guaranty also leaves the rate empty.
    assert found[f"{table}_missing_required_values"] == ("fail", 2)
    assert found[f"{table}_non_negative_amounts"] == ("fail", 1)
    assert found["fact_lender_key_not_null"] == ("fail", 1)
    assert found["dim_geography_valid_state_codes"] == ("fail", 1)
    assert found["fact_non_negative_amounts"] == ("fail", 1)


def test_copies_of_a_bad_row_all_count(spark):
    bad = ("Cedar Trust", "Boise", "ID", 1, "10.00", "11.00")
    found = {
        r.check_name: r.failed_count
        for r in expectations.source_checks("t", frames.lenders(spark, [bad, bad, bad])).collect()
    }
    assert found["t_guaranty_not_above_approved"] == 3 and found["t_duplicate_rows"] == 2


def test_an_empty_table_passes(spark):
    empty = frames.lenders(spark).where("false")
    assert {r.failed_count for r in expectations.source_checks("t", empty).collect()} == {0}


def test_null_state_is_not_accepted(spark):
    places = spark.createDataFrame([(1, None), (2, "TX"), (3, "XX")], "geography_key long, state string")
    row = expectations.accepted_states_check(places, ["TX"]).first()
    assert row.failed_count == 2


def test_gate_raises_with_the_failed_checks(spark):
    extracts = frames.extracts(spark)
    report = expectations.quality_report(extracts, built(spark, extracts))
    expectations.assert_quality(report)
    failed = report.withColumn("status", F.when(F.col("check_name") == "dim_lender_unique_key", "fail").otherwise("pass"))
    with pytest.raises(expectations.QualityGateError, match="dim_lender_unique_key"):
        expectations.assert_quality(failed)


def test_reconcile(spark):
    star = built(spark, frames.extracts(spark))
    staged = stage_county(frames.counties(spark))
    assert expectations.reconcile(star.fact, staged).first().status == "pass"
    stray = [*frames.COUNTIES, ("Stray Bank", "Reno", "NV", "WA", "KING", 1, "0.02", "0.01")]
    counties = frames.counties(spark, stray)
    inner = fact_inner(counties, star.dim_lender, star.dim_geography, star.dim_date)
    assert expectations.reconcile(inner, stage_county(counties)).first().status == "fail"
    assert expectations.reconcile(star.fact.where("false"), staged).first().status == "fail"


def test_expectations_and_their_rows(spark):
    extracts = frames.extracts(spark)
    star = built(spark, extracts)
    names = list(extracts)
    models = {
        "stg_lender_activity": stage_lender(extracts[names[0]]),
        "stg_lender_county_activity": stage_county(extracts[names[1]]),
        "stg_district_activity": stage_district(extracts[names[2]]),
        **Star(star.fact, star.dim_lender, star.dim_geography, star.dim_date).tables(),
    }
    models["fct_lending_activity"] = models.pop("fact_lending_activity")
    passed = expectations.check_expectations(models).collect()
    assert len(passed) == 27 and {r.status for r in passed} == {"pass"}

    models["dim_lender"] = star.dim_lender.where("lender_key = 1").unionByName(
        star.dim_lender.where("lender_key = 1")
    )
    found = {r.check_name: r.failed_count for r in expectations.check_expectations(models).collect()}
    assert found["unique_dim_lender_lender_key"] == 1
    assert found["relationships_fct_lending_activity_lender_key"] == 2
    broken = expectations.Expectation("unique", "dim_lender", "lender_key")
    assert expectations.failing_rows(models, broken).first().lender_key == 1


def test_failing_rows_are_returned(spark):
    fact = built(spark, frames.extracts(spark)).fact
    assert expectations.negative_amount_rows(fact).isEmpty()
    worse = fact.withColumn("guaranty_dollars", F.col("approved_dollars") + 1)
    assert expectations.guaranty_above_approved_rows(worse).count() == 4


def test_missing_cells(spark):
    row = expectations.missing_cells(frames.lenders(spark, [("A", "B", None, 0, "1", "1")])).first()
    assert (row.null_lender_state, row.null_avg_loan_size, row.null_cells) == (1, 1, 2)


def test_orphan_keys_count_rows(spark):
    rows = spark.createDataFrame([("a",), ("a",), ("b",), (None,), ("c",)], "name string")
    parent = spark.createDataFrame([("b",), ("b",)], "known string")
    found = expectations.orphan_keys(rows, "name", parent, "known")
    assert {(r.name, r["rows"]) for r in found.collect()} == {("a", 2), ("c", 1)}
    profile = spark.createDataFrame([("a", 5), ("a", 7), ("b", 1), (None, 3)], "name string, rows long")
    assert [tuple(r) for r in expectations.orphan_keys(profile, "name", parent, "known").collect()] == [("a", 12)]


def test_the_profile_stands_for_every_row(spark):
    counties = [*frames.COUNTIES, frames.COUNTIES[0], ("Stray Bank", "Reno", "NV", "ZZ", "NOWHERE", -1, "10.00", "15.00")]
    fact = built(spark, frames.extracts(spark, county_rows=counties)).fact
    profile = expectations.fact_profile(fact)
    assert profile.count() == 5 and profile.groupBy().sum("rows").first()[0] == 6
    rules = {r.check_name: r.failed_count for r in expectations.fact_rule_checks(profile).collect()}
    assert rules == {"fact_non_negative_amounts": 1, "fact_guaranty_not_above_approved": 1}
    empty = expectations.fact_rule_checks(expectations.fact_profile(fact.where("false"))).collect()
    assert {(r.status, r.failed_count) for r in empty} == {("pass", 0)}
