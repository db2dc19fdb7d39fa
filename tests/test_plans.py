"""Plan shapes that must hold at any size."""

from __future__ import annotations

import re
from decimal import Decimal

import pytest

import __spark_entry__ as contract
from activity_mart.contracts import COUNTY_EXTRACT, DISTRICT_EXTRACT, EXTRACTS
from activity_mart.operators import cleaning, expectations
from activity_mart.testbed import registry, tables

QUERIES = contract.queries()


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_and_no_python(name, spark, sf_dir):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "ArrowEval", "PandasUDF"):
        assert operator not in plan


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_windows_over_everything_see_bounded_rows(name, spark, sf_dir):
    plan = plan_of(QUERIES[name](spark, sf_dir)).splitlines()
    for at, line in enumerate(plan):
        if re.search(r"Window \[.*\], \[.* (ASC|DESC)", line) and not re.search(r"\], \[[^\]]*\], \[", line):
            below = "\n".join(plan[at:])
            assert "TakeOrderedAndProject" in below or "_part#" in line, line


def test_the_raw_scan_reads_only_what_the_lender_grain_needs(spark, sf_dir):
    plan = plan_of(tables.lender_view(spark, sf_dir))
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "lineitem" in line)
    columns = re.search(r"FileScan parquet \[([^\]]*)\]", scan).group(1)
    assert sorted(re.sub(r"#\d+L?", "", c) for c in columns.split(",")) == [
        "l_discount",
        "l_extendedprice",
        "l_suppkey",
    ]
    assert "orders" not in plan


def test_loans_are_summed_before_they_meet_the_supplier(spark, sf_dir):
    plan = plan_of(tables.county_view(spark, sf_dir))
    supplier_join = plan.index("s_suppkey")
    assert "partial_sum" in plan[supplier_join:]


def test_slicers_reach_the_dimension_scan(spark, sf_dir):
    plan = plan_of(QUERIES["measure_slice"](spark, sf_dir))
    assert "PushedFilters: [In(lender_state, [ASIA])" in plan or "EqualTo(lender_state,ASIA)" in plan


def partition_filters(plan: str) -> list[str]:
    return re.findall(r"PartitionFilters: \[([^\]]*)\]", plan)


@pytest.mark.parametrize("name", sorted(EXTRACTS))
def test_clean_rows_and_rejects_read_their_own_partitions(name, spark, sf_dir):
    rows, _ = tables.parsed(spark, sf_dir)[name]
    clean = partition_filters(plan_of(cleaning.clean(rows)))
    assert len(clean) == 1 and "row_status" in clean[0] and "clean" in clean[0]
    rejected = partition_filters(plan_of(cleaning.rejects(rows, EXTRACTS[name])))
    assert len(rejected) == 1 and "missing_required_value" in rejected[0] and "invalid_amount" in rejected[0]
    # Whole: nothing falls between the partitions.
    blank = rows.where("row_status = 'blank'").count()
    assert cleaning.valid_rows(rows).count() + cleaning.rejects(rows, EXTRACTS[name]).count() + blank == rows.count()


def test_the_log_does_not_read_the_delivery_again(spark, sf_dir):
    plan = plan_of(registry.QUERIES["cleaning_log"](spark, sf_dir))
    assert "FileScan" not in plan
    for name in ("dq_missing", "dq_row_rules"):
        assert "FileScan" not in plan_of(registry.QUERIES[name](spark, sf_dir))


def test_checks_of_the_fact_read_its_profile(spark, sf_dir):
    star = tables.star(spark, sf_dir)
    fact = star.fact.inputFiles()[0].rpartition("/fact_lending_activity")[2].split("/")[0]
    for report in (registry.check_models(spark, sf_dir), expectations.quality_report({}, star)):
        plan = plan_of(report)
        assert f"fact_lending_activity{fact}" not in plan and "fact-profile" in plan


def test_the_flawed_star_builds_no_office_extract(spark, sf_dir):
    kept = dict(tables._built)
    tables.forget()
    try:
        registry.QUERIES["dq_fact_keys"](spark, sf_dir).collect()
        built = {name for _, _, name in tables._built}
    finally:
        tables._built.update(kept)
    assert not [name for name in built if DISTRICT_EXTRACT.name in name] and f"flawed-{COUNTY_EXTRACT.name}" in built


def test_loans_travel_as_whole_cents(spark):
    rows = [(1, "9.99", "0.05"), (1, "0.01", None), (1, None, "0.05"), (2, None, None), (None, "-3.33", "0.50")]
    loans = spark.createDataFrame([(k, p and Decimal(p), d and Decimal(d)) for k, p, d in rows], "l_suppkey long, dollars decimal(18,2), discount decimal(4,2)")
    summed = tables._per_supplier(loans)
    assert {summed.schema[name].dataType.simpleString() for name in ("dollars", "guaranty")} == {"bigint"}
    found = {r.l_suppkey: (r.loans, r.dollars, r.guaranty) for r in summed.select("l_suppkey", "loans", tables._money("dollars"), tables._money("guaranty")).collect()}
    # Each guaranty is rounded to cents before it is summed: 9.4905 to 9.49, -1.665 to -1.67.
    assert found == {1: (3, Decimal("10.00"), Decimal("9.49")), 2: (1, None, None), None: (1, Decimal("-3.33"), Decimal("-1.67"))}
