"""Data-quality checks: the report, declarative expectations, and the gate.

The row rules of a table share one aggregate. A source table's duplicate check
groups whole rows; the other checks of that table ride on the same groups,
weighted by their number of copies, so each source is read and shuffled once. Where the
write of a table has taken its counts already, they are used instead.

All checks of the fact read its key profile: one row for each combination of keys, with
counts of rows and of broken rules. The fact is scanned once, however many checks there are,
and a lender that owns a third of it is a few rows when the profile meets the dimensions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from activity_mart.contracts import CHECK_DETAILS, QUALITY_REPORT, REGIONS, STATE_REGIONS
from activity_mart.operators.star import Star
from activity_mart.sources.store import stored


class QualityGateError(RuntimeError):
    """At least one quality check failed."""


def _report(one_row: DataFrame, checks: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Turn ``(column, check name, details)`` counts of a one-row frame into report rows."""
    rows = [
        F.struct(
            F.lit(name).alias("check_name"),
            F.when(F.col(column) == 0, "pass").otherwise("fail").alias("status"),
            F.col(column).cast("bigint").alias("failed_count"),
            F.lit(details).alias("details"),
        )
        for column, name, details in checks
    ]
    return one_row.select(F.inline(F.array(*rows))).to(QUALITY_REPORT)


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _holds(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def negative_source_amounts() -> Column:
    return _holds((F.col("approved_loans") < 0) | (F.col("approved_dollars") < 0))


def guaranty_above_approved(guaranty: str) -> Column:
    return _holds(F.col(guaranty) > F.col("approved_dollars"))


def negative_fact_amounts() -> Column:
    return _holds(
        (F.col("approved_loan_count") < 0) | (F.col("approved_dollars") < 0) | (F.col("guaranty_dollars") < 0)
    )


def null_cells(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a + b, [F.col(name).isNull().cast("bigint") for name in columns])


def row_counts(columns: Sequence[str]) -> list[Column]:
    """What a write of a cleaned table counts: nulls by column and in all, and broken amount rules."""
    return [
        *[F.count_if(F.col(name).isNull()).alias(f"null_{name}") for name in columns],
        F.coalesce(F.sum(null_cells(columns)), F.lit(0)).alias("null_cells"),
        F.count_if(negative_source_amounts()).alias("non_negative_amounts"),
        F.count_if(guaranty_above_approved("approved_sba_guaranty_dollars")).alias("guaranty_not_above_approved"),
    ]


SOURCE_RULES = ("missing_required_values", "duplicate_rows", "non_negative_amounts", "guaranty_not_above_approved")


def counted_checks(spark: SparkSession, table: str, counts: Mapping[str, int], rules: Sequence[str] = SOURCE_RULES) -> DataFrame:
    """The checks of one cleaned table from counts already taken; ``duplicate_rows`` is one of them."""
    taken = {**counts, "missing_required_values": counts["null_cells"]}
    one_row = spark.createDataFrame([tuple(taken[rule] for rule in rules)], ", ".join(f"{rule} long" for rule in rules))
    return _report(one_row, [(rule, f"{table}_{rule}", CHECK_DETAILS[rule]) for rule in rules])


def source_checks(table: str, rows: DataFrame) -> DataFrame:
    """The four checks of one cleaned table."""
    names = rows.columns
    copies = rows.groupBy(*names).agg(F.count("*").alias("_copies"))

    def weighted(per_row: Column) -> Column:
        return F.coalesce(F.sum(per_row * F.col("_copies")), F.lit(0))

    counts = copies.agg(
        weighted(null_cells(names)).alias("missing_required_values"),
        F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("duplicate_rows"),
        weighted(negative_source_amounts().cast("bigint")).alias("non_negative_amounts"),
        weighted(guaranty_above_approved("approved_sba_guaranty_dollars").cast("bigint")).alias(
            "guaranty_not_above_approved"
        ),
    )
    return _report(counts, [(rule, f"{table}_{rule}", CHECK_DETAILS[rule]) for rule in counts.columns])


def missing_cells(rows: DataFrame) -> DataFrame:
    """One row: nulls per column, and over all columns."""
    counts = [F.count_if(F.col(name).isNull()).alias(f"null_{name}") for name in rows.columns]
    total = F.coalesce(F.sum(null_cells(rows.columns)), F.lit(0)).alias("null_cells")
    return rows.agg(*counts, total)


def row_rules(table: str, rows: DataFrame) -> DataFrame:
    """The two amount rules of one cleaned table, in one aggregate."""
    counts = rows.agg(
        F.count_if(negative_source_amounts()).alias("non_negative_amounts"),
        F.count_if(guaranty_above_approved("approved_sba_guaranty_dollars")).alias(
            "guaranty_not_above_approved"
        ),
    )
    return _report(counts, [(rule, f"{table}_{rule}", CHECK_DETAILS[rule]) for rule in counts.columns])


def unique_key_check(name: str, dimension: DataFrame, key: str) -> DataFrame:
    repeats = dimension.groupBy(key).agg((F.count("*") - 1).alias("extra"))
    counts = repeats.agg(F.coalesce(F.sum("extra"), F.lit(0)).alias(name))
    return _report(counts, [(name, name, CHECK_DETAILS[name])])


def accepted_states_check(geographies: DataFrame, states: Sequence[str]) -> DataFrame:
    """Dimension rows whose state is not in the accepted codes; null is not accepted."""
    name = "dim_geography_valid_state_codes"
    unknown = F.coalesce(~F.col("state").isin(*states), F.lit(True))
    return _report(geographies.agg(F.count_if(unknown).alias(name)), [(name, name, CHECK_DETAILS[name])])


FACT_KEYS = ("lender_key", "geography_key", "date_key")


def fact_profile(fact: DataFrame) -> DataFrame:
    """One row for each combination of the fact's keys: its rows, and how many break each rule.

    At most as many rows as the fact; rows of one lender, place and period add up before the shuffle.
    """
    return fact.groupBy(*FACT_KEYS).agg(
        F.count("*").alias("rows"),
        F.count_if(F.col("approved_dollars").isNull()).alias("null_approved_dollars"),
        F.count_if(negative_fact_amounts()).alias("fact_non_negative_amounts"),
        F.count_if(guaranty_above_approved("guaranty_dollars")).alias("fact_guaranty_not_above_approved"),
    )


def _total(amount: Column) -> Column:
    return F.coalesce(F.sum(amount), F.lit(0))


def _rows_if(condition: Column) -> Column:
    return _total(F.when(condition, F.col("rows")))


def fact_key_checks(profile: DataFrame) -> DataFrame:
    """Fact rows without a lender or a place, from the fact's key profile."""
    names = ("fact_lender_key_not_null", "fact_geography_key_not_null")
    counts = profile.agg(
        _rows_if(F.col("lender_key").isNull()).alias(names[0]),
        _rows_if(F.col("geography_key").isNull()).alias(names[1]),
    )
    return _report(counts, [(name, name, CHECK_DETAILS[name]) for name in names])


def fact_rule_checks(profile: DataFrame) -> DataFrame:
    """Fact rows that break an amount rule, from the fact's key profile."""
    names = ("fact_non_negative_amounts", "fact_guaranty_not_above_approved")
    counts = profile.agg(*[_total(F.col(name)).alias(name) for name in names])
    return _report(counts, [(name, name, CHECK_DETAILS[name]) for name in names])


def quality_report(
    extracts: dict[str, DataFrame],
    star: Star,
    states: Sequence[str] = tuple(sorted(STATE_REGIONS)),
    counted: Mapping[str, Mapping[str, int]] | None = None,
) -> DataFrame:
    """Four checks per cleaned table and seven over the star schema.

    ``counted`` holds, by table, counts that its write has taken (:func:`row_counts`, and
    ``duplicate_rows``); other tables are read. The fact is read once, for its key profile.
    """
    counted = counted or {}
    profile = stored(fact_profile(star.fact), "fact-profile")
    parts = [
        counted_checks(rows.sparkSession, name, counted[name]) if name in counted else source_checks(name, rows)
        for name, rows in extracts.items()
    ]
    parts += [
        unique_key_check("dim_lender_unique_key", star.dim_lender, "lender_key"),
        unique_key_check("dim_geography_unique_key", star.dim_geography, "geography_key"),
        fact_key_checks(profile),
        accepted_states_check(star.dim_geography, states),
        fact_rule_checks(profile),
    ]
    return _union(parts)


def assert_quality(report: DataFrame) -> None:
    """Raise when a check failed; call it after every output is written."""
    failed = report.where(F.col("status") != "pass").select("check_name", "failed_count")
    # A report has one row per check, so the failures fit on the driver.
    found = [f"{row.check_name} ({row.failed_count})" for row in failed.collect()]
    if found:
        raise QualityGateError("failed data-quality checks: " + ", ".join(found))


def reconcile(fact: DataFrame, staged_counties: DataFrame, tolerance: str = "0.01") -> DataFrame:
    """One row comparing fact and staging dollars; a missing total fails as well."""
    totals = fact.agg(F.sum("approved_dollars").alias("fact_dollars")).select(
        "fact_dollars",
        staged_counties.agg(F.sum("approved_dollars")).scalar().alias("source_dollars"),
    )
    drift = F.abs(F.col("fact_dollars") - F.col("source_dollars"))
    within = F.coalesce(drift <= F.lit(tolerance).cast("decimal(18,2)"), F.lit(False))
    return totals.withColumn("status", F.when(within, "pass").otherwise("fail"))


def orphans(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Child rows whose value has no parent row; a null value refers to nothing."""
    keys = parent.select(F.col(field).alias(column))
    return child.where(F.col(column).isNotNull()).join(keys, column, "left_anti")


def orphan_keys(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Each value without a parent row, and how many child rows have it.

    Distinct values meet the parent, so that a value with a third of all rows is one row in the join.
    """
    rows = F.sum("rows") if "rows" in child.columns else F.count("*")
    values = child.where(F.col(column).isNotNull()).groupBy(column).agg(rows.alias("rows"))
    return orphans(values, column, parent, field)


# --- declarative expectations per model ---------------------------------------


@dataclass(frozen=True)
class Expectation:
    """``not_null``, ``unique``, ``accepted_values`` or ``relationships`` on one column."""

    kind: str
    model: str
    column: str
    values: tuple[str, ...] = ()
    parent: str = ""

    @property
    def name(self) -> str:
        return f"{self.kind}_{self.model}_{self.column}"


def _not_null(model: str, *columns: str) -> list[Expectation]:
    return [Expectation("not_null", model, column) for column in columns]


MODEL_EXPECTATIONS = [
    *_not_null(
        "stg_lender_activity", "lender_name", "approved_loan_count", "approved_dollars", "guaranty_dollars"
    ),
    *_not_null(
        "stg_lender_county_activity", "lender_name", "project_state", "project_county", "approved_dollars"
    ),
    *_not_null("stg_district_activity", "lender_name", "district_office_name"),
    *_not_null("dim_lender", "lender_key", "lender_name"),
    Expectation("unique", "dim_lender", "lender_key"),
    *_not_null("dim_geography", "geography_key", "state", "region"),
    Expectation("unique", "dim_geography", "geography_key"),
    Expectation("accepted_values", "dim_geography", "region", values=tuple(REGIONS)),
    *_not_null("dim_date", "date_key"),
    Expectation("unique", "dim_date", "date_key"),
    *_not_null(
        "fct_lending_activity", "lender_key", "geography_key", "date_key", "approved_dollars"
    ),
    Expectation("relationships", "fct_lending_activity", "lender_key", parent="dim_lender"),
    Expectation("relationships", "fct_lending_activity", "geography_key", parent="dim_geography"),
    Expectation("relationships", "fct_lending_activity", "date_key", parent="dim_date"),
]


FACT_MODEL = "fct_lending_activity"


def failing_rows(models: dict[str, DataFrame], expectation: Expectation) -> DataFrame:
    """The rows (for ``unique``: the repeated values) that break an expectation."""
    rows, column = models[expectation.model], F.col(expectation.column)
    if expectation.kind == "not_null":
        return rows.where(column.isNull())
    if expectation.kind == "accepted_values":
        return rows.where(~column.isin(*expectation.values))
    if expectation.kind == "unique":
        repeats = rows.where(column.isNotNull()).groupBy(expectation.column).agg(F.count("*").alias("rows"))
        return repeats.where(F.col("rows") > 1)
    if expectation.kind == "relationships":
        return orphans(rows, expectation.column, models[expectation.parent], expectation.column)
    raise ValueError(f"unknown expectation: {expectation.kind}")


def _failed_rows(expectation: Expectation, profiled: bool) -> Column:
    """Rows that break a row-wise expectation; of a profile, its rows count for as many as they stand for."""
    column = F.col(expectation.column)
    if expectation.kind == "accepted_values":
        failed = _holds(~column.isin(*expectation.values))
    elif profiled and expectation.column not in FACT_KEYS:
        return _total(F.col(f"null_{expectation.column}"))
    else:
        failed = column.isNull()
    return _rows_if(failed) if profiled else F.count_if(failed)


def check_expectations(
    models: dict[str, DataFrame], expectations: Sequence[Expectation] = MODEL_EXPECTATIONS
) -> DataFrame:
    """Report rows for all expectations; a model's row-wise ones share one aggregate.

    The fact is read once, for its key profile; its relationships are checked on distinct keys.
    """
    details = {
        "not_null": "Column must have a value.",
        "unique": "Column value must not repeat.",
        "accepted_values": "Column value must be in the accepted list.",
        "relationships": "Column value must exist in the parent model.",
    }
    read = dict(models)
    if any(e.model == FACT_MODEL for e in expectations):
        read[FACT_MODEL] = stored(fact_profile(models[FACT_MODEL]), "fact-profile")
    parts = []
    row_wise = [e for e in expectations if e.kind in ("not_null", "accepted_values")]
    for model in dict.fromkeys(e.model for e in row_wise):
        own = [e for e in row_wise if e.model == model]
        counts = read[model].agg(*[_failed_rows(e, model == FACT_MODEL).alias(e.name) for e in own])
        parts.append(_report(counts, [(e.name, e.name, details[e.kind]) for e in own]))
    for e in expectations:
        if e.kind == "relationships":
            found = orphan_keys(read[e.model], e.column, models[e.parent], e.column)
            parts.append(_report(found.agg(_total(F.col("rows")).alias(e.name)), [(e.name, e.name, details[e.kind])]))
        elif e.kind == "unique":
            counts = failing_rows(models, e).agg(F.count("*").alias(e.name))
            parts.append(_report(counts, [(e.name, e.name, details[e.kind])]))
    return _union(parts)


def negative_amount_rows(fact: DataFrame) -> DataFrame:
    return fact.where(negative_fact_amounts())


def guaranty_above_approved_rows(fact: DataFrame) -> DataFrame:
    return fact.where(guaranty_above_approved("guaranty_dollars"))
