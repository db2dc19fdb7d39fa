from __future__ import annotations

from decimal import Decimal

import frames
import pytest
from pyspark.sql import functions as F

from activity_mart.contracts import EXTRACTS, INVALID, LENDER_EXTRACT, MISSING, REJECTS
from activity_mart.operators import cleaning, expectations
from activity_mart.plans.refresh import parse
from activity_mart.sources.readers import normalize_columns
from activity_mart.testbed import tables

GOOD = ("Alpha Bank", "Austin", "TX", "4", "2000000", "1500000")


def outcome(spark, rows, **options):
    tagged = cleaning.tag(frames.raw(spark, rows), LENDER_EXTRACT, **options)
    clean = cleaning.clean(tagged).collect()
    rejected = cleaning.rejects(tagged, LENDER_EXTRACT).collect()
    return clean, rejected, cleaning.cleaning_log(tagged, LENDER_EXTRACT).first()


def test_valid_rows_pass_with_derived_columns(spark):
    clean, rejected, log = outcome(spark, [GOOD, ("Beta Bank", "Miami", "FL", "2", "500000", "375000")])
    assert len(clean) == 2 and not rejected
    assert clean[0].avg_loan_size == Decimal("500000.00")
    assert clean[0].guaranty_rate_pct == Decimal("75.00")
    assert (log.raw_rows, log.clean_rows, log.rows_removed, log.duplicate_rows) == (2, 2, 0, 0)


def test_missing_values_are_rejected_with_their_reason(spark):
    rows = [
        GOOD,
        (None, "Miami", "FL", "2", "500000", "375000"),
        ("Gamma Bank", "Reno", "NV", None, "100000", "80000"),
        ("Delta Bank", "Reno", "NV", None, "-5", "80000"),
    ]
    clean, rejected, log = outcome(spark, rows)
    assert len(clean) == 1
    assert {r.rejection_reason for r in rejected} == {MISSING} and len(rejected) == 3
    assert (log.rows_removed, log.missing_lender, log.missing_approved_loans) == (3, 1, 2)


def test_missing_counts_keep_only_non_zero_columns(spark):
    rows = [GOOD, (None, "Miami", "FL", "2", "500000", "n/a")]
    tagged = cleaning.tag(frames.raw(spark, rows), LENDER_EXTRACT)
    found = cleaning.missing_before(cleaning.cleaning_log(tagged, LENDER_EXTRACT), LENDER_EXTRACT).collect()
    assert {(r.column_name, r.missing) for r in found} == {("lender", 1), ("approved_sba_guaranty_dollars", 1)}


def test_zero_and_negative_amounts_are_rejected(spark):
    rows = [
        GOOD,
        ("Zero Bank", "Boise", "ID", "0", "100000", "80000"),
        ("Minus Bank", "Provo", "UT", "3", "-50000", "0"),
    ]
    clean, rejected, _ = outcome(spark, rows)
    assert [r.lender for r in clean] == ["Alpha Bank"]
    assert {r.rejection_reason for r in rejected} == {INVALID}


def test_negative_guaranty_is_kept(spark):
    clean, rejected, _ = outcome(spark, [("Alpha Bank", "Austin", "TX", "4", "100", "-50")])
    assert clean[0].guaranty_rate_pct == Decimal("-50.00") and not rejected


def test_blank_rows_leave_without_a_reject(spark):
    clean, rejected, log = outcome(spark, [GOOD, (None,) * 6])
    assert len(clean) == 1 and not rejected
    assert (log.rows_after_blank_drop, log.rows_removed, log.rows_rejected) == (1, 1, 0)


def test_white_space_text_passes_unless_told_otherwise(spark):
    rows = [("\t\xa0 ", "Austin", "TX", "4", "100", "50")]
    clean, _, _ = outcome(spark, rows)
    assert clean[0].lender == ""
    clean, rejected, _ = outcome(spark, rows, blank_is_missing=True)
    assert not clean and rejected[0].rejection_reason == MISSING


@pytest.mark.parametrize(
    ("text", "loans"),
    [(" 12 ", 12), ("1e3", 1000), ("2.5", 2), ("3.5", 4), ("1,000", None), ("inf", None), ("NaN", None), ("1.0d", None)],
)
def test_number_parsing(spark, text, loans):
    clean, rejected, _ = outcome(spark, [("A", "B", "C", text, "100", "50")])
    if loans is None:
        assert not clean and rejected[0].rejection_reason == MISSING
    else:
        assert clean[0].approved_loans == loans


def test_fractional_loans_round_to_zero_and_have_no_average(spark):
    clean, _, _ = outcome(spark, [("A", "B", "C", "0.4", "100", "50")])
    assert clean[0].approved_loans == 0 and clean[0].avg_loan_size is None


def test_money_rounds_half_to_even(spark):
    clean, _, _ = outcome(spark, [("A", "B", "C", "1", "2.665", "0.125"), ("A", "B", "C", "1", "2.675", "0.135")])
    assert [(r.approved_dollars, r.approved_sba_guaranty_dollars) for r in clean] == [
        (Decimal("2.66"), Decimal("0.12")),
        (Decimal("2.68"), Decimal("0.14")),
    ]


def test_an_amount_wider_than_its_column_is_rejected_with_its_text(spark):
    wide = [("A", "B", "C", "1", "2e16", "1"), ("A", "B", "C", "1e19", "5", "1"), ("A", "B", "C", "1", "5", "-1e17")]
    clean, rejected, log = outcome(spark, [*wide, ("A", "B", "C", "1", "9999999999999999.99", "1")])
    assert [r.approved_dollars for r in clean] == [Decimal("9999999999999999.99")]
    assert {r.rejection_reason for r in rejected} == {INVALID} and log.rows_rejected == 3
    assert sum(any(text in r.raw for text in ('"2e16"', '"1e19"', '"-1e17"')) for r in rejected) == 3


def test_an_absurd_rate_does_not_end_the_job(spark):
    clean, _, _ = outcome(spark, [("A", "B", "C", "1", "0.01", "9999999")])
    assert clean[0].approved_dollars == Decimal("0.01") and clean[0].guaranty_rate_pct is None


def test_quarantine_keeps_the_original_text(spark):
    tagged = cleaning.tag(frames.raw(spark, [("Alpha", "Austin", "TX", " n/a ", "1", "1")]), LENDER_EXTRACT)
    found = cleaning.quarantine({LENDER_EXTRACT: tagged})
    assert found.schema.simpleString() == REJECTS.simpleString()
    row = found.first()
    assert row.source_table == LENDER_EXTRACT.name and '"approved_loans":" n/a "' in row.raw
    assert row.approved_loans is None and row.approved_dollars == 1


def test_quarantine_of_clean_input_is_empty_and_typed(spark):
    found = cleaning.quarantine({LENDER_EXTRACT: cleaning.tag(frames.raw(spark, [GOOD]), LENDER_EXTRACT)})
    assert found.schema.simpleString() == REJECTS.simpleString() and found.isEmpty()


def test_unmapped_columns_survive_in_snake_case(spark):
    raw = frames.raw(spark, [(*GOOD, "x")], [*frames.RAW_HEADERS, "Extra (Note)"])
    assert "extra_note" in cleaning.clean(cleaning.tag(raw, LENDER_EXTRACT)).columns


def test_clashing_and_absent_columns_are_errors(spark):
    with pytest.raises(ValueError, match="share a name"):
        normalize_columns(frames.raw(spark, [("a", "b")], ["Lender", "lender "]), {})
    with pytest.raises(ValueError, match="missing from the extract"):
        cleaning.tag(frames.raw(spark, [("a",)], ["Lender"]), LENDER_EXTRACT)


def test_typed_sources_clean_like_text(spark):
    rows = [("A", "B", "C", 4.0, 200.0, float("nan")), ("A", "B", "C", 4.0, 200.0, 50.0)]
    schema = "`Lender` string, `Lender City` string, `Lender State` string, `Approved Loans` double, "
    schema += "`Approved Dollars` double, `Approved SBA Guaranty Dollars` double"
    tagged = cleaning.tag(spark.createDataFrame(rows, schema), LENDER_EXTRACT)
    assert cleaning.clean(tagged).count() == 1
    assert cleaning.rejects(tagged, LENDER_EXTRACT).first().rejection_reason == MISSING


def test_duplicates_count_copies_beyond_the_first(spark):
    frame = spark.createDataFrame([("a", 1), ("a", 1), ("a", 1), (None, 2), (None, 2)], "x string, y int")
    assert cleaning.surplus_rows(frame).first().duplicate_rows == 3


def test_driver_dirt_counts(spark):
    """Known counts of the driver tables with five kinds of dirt injected."""
    order = F.col("l_orderkey")
    rows = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet").select(
        F.when(order % 97 == 0, F.lit(None).cast("string"))
        .when(order % 89 == 0, "  Padded  ")
        .otherwise(F.col("l_returnflag"))
        .alias("Lender"),
        F.lit("c").alias("Lender City"),
        F.lit("s").alias("Lender State"),
        F.when(order % 101 == 0, "n/a")
        .when(order % 103 == 0, "-1")
        .when(order % 107 == 0, " 12 ")
        .otherwise(F.col("l_quantity").cast("string"))
        .alias("Approved Loans"),
        F.lit("1").alias("Approved Dollars"),
        F.lit("1").alias("Approved SBA Guaranty Dollars"),
    )
    tagged = cleaning.tag(rows, LENDER_EXTRACT)
    found = {r.rejection_reason: r["count"] for r in tagged.groupBy("rejection_reason").count().collect()}
    assert found == {None: 58250, INVALID: 581, MISSING: 1169}


def test_every_delivered_row_is_accounted_for(spark, sf_dir):
    log = cleaning.cleaning_log(
        cleaning.tag(tables.raw_delivery(spark, sf_dir), LENDER_EXTRACT), LENDER_EXTRACT
    ).first()
    blank = log.raw_rows - log.rows_after_blank_drop
    assert blank > 0 and log.rows_rejected > 0
    assert log.clean_rows + log.rows_rejected + blank == log.raw_rows
    assert log.rows_removed == log.rows_rejected + blank


def test_counts_taken_by_the_write_equal_counts_read_back(spark, sf_dir):
    for name, (rows, counts) in tables.parsed(spark, sf_dir).items():
        spec = EXTRACTS[name]
        log = cleaning.cleaning_log(rows, spec).first().asDict()
        assert log.pop("source_table") == name and log.pop("duplicate_rows") >= 0
        assert counts == log
        assert rows.columns == cleaning.tag(tables.deliveries(spark, sf_dir)[name], spec).columns
    for name, counts in tables.flawed_counts(spark, sf_dir).items():
        rows = tables.flawed_extracts(spark, sf_dir)[name]
        assert counts == {**expectations.missing_cells(rows).first().asDict(), **{r.check_name.removeprefix(f"{name}_"): r.failed_count for r in expectations.row_rules(name, rows).collect()}}


def test_counts_of_no_rows_are_zero(spark):
    nothing = frames.raw(spark, [GOOD]).where("Lender = 'nobody'")
    for raw in (nothing, frames.raw(spark, [])):
        rows, counts = parse(raw, LENDER_EXTRACT)
        assert rows.count() == 0 and set(counts.values()) == {0} and counts.keys() > {"raw_rows", "missing_lender"}
        log = cleaning.log_table(spark, {LENDER_EXTRACT: {**counts, "duplicate_rows": 0}}).first()
        assert (log.raw_rows, log.missing_before) == (0, {})


def test_duplicates_travel_as_digests(spark):
    rows = [(None, "a", 1), ("a", None, 1), (None, "a", 1), ("a", "", 1), ("", "a", 1), ("a", None, 1), ("a", None, None)]
    frame = spark.createDataFrame(rows, "x string, y string, n int")
    assert cleaning.surplus_rows(frame).first().duplicate_rows == 2
    assert cleaning.surplus_rows(frame, ["n"]).first().duplicate_rows == 5
    plan = cleaning.surplus_rows(frame)._jdf.queryExecution().executedPlan().toString()
    shuffled = [line for line in plan.splitlines() if "hashpartitioning" in line]
    assert shuffled and not any(f"{before}{name}#" in line for line in shuffled for name in "xyn" for before in "( ")
