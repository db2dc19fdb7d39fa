"""Cleaning with a quarantine.

``tag`` decides about every row in one narrow pass; clean rows, rejects and the
log are all read off its result. Written with ``STATUS`` as its partition column, that result
gives each of them its own files, and the counts of the log are taken by the write itself.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from activity_mart.contracts import (
    AMOUNTS,
    INVALID,
    MISSING,
    MONEY,
    PERCENT,
    RAW_NUMBER,
    REJECTS,
    ExtractSpec,
)
from activity_mart.functions.numeric import coerce_number, null_if_zero
from activity_mart.functions.text import strip_text
from activity_mart.sources.readers import normalize_columns

REASON = "rejection_reason"
ORIGINAL = "raw_record"
# What becomes of a row: CLEAN, BLANK or its rejection reason.
STATUS = "row_status"
CLEAN, BLANK = "clean", "blank"
_HELPERS = (REASON, ORIGINAL, STATUS)


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda left, right: left | right, conditions)


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda left, right: left & right, conditions)


# Decimal places and type that cleaning stores an amount with.
_STORED_AS = {
    "approved_loans": (0, "bigint"),
    "approved_dollars": (2, MONEY),
    "approved_sba_guaranty_dollars": (2, MONEY),
}


def _fitted(name: str) -> Column:
    """The amount as it is stored, half-even; null if it is too wide for its column."""
    digits, kind = _STORED_AS[name]
    return F.bround(name, digits).try_cast(kind)


def drop_blank_rows(raw: DataFrame) -> DataFrame:
    """Rows without a single value leave silently; they are not rejects."""
    return raw.na.drop("all")


def tag(raw: DataFrame, spec: ExtractSpec, blank_is_missing: bool = False) -> DataFrame:
    """Rename, strip and coerce, and give each row its rejection reason (null = clean).

    An amount too wide for its column is invalid, so that it is kept in the quarantine
    and not lost in a clean row. With ``blank_is_missing`` a required text of nothing but white space counts as
    missing; by default it passes as an empty string.
    """
    renamed = normalize_columns(raw, spec.columns)
    absent = [name for name in spec.required if name not in renamed.columns]
    if absent:
        raise ValueError(f"{spec.name}: columns missing from the extract: {', '.join(absent)}")

    def prepared(name: str) -> Column:
        if name in AMOUNTS:
            return coerce_number(F.col(name)).alias(name)
        if name in spec.required_text:
            return strip_text(F.col(name)).alias(name)
        return F.col(name)

    rows = renamed.select(*[prepared(name) for name in renamed.columns], F.struct(*renamed.columns).alias(ORIGINAL))
    # Stripping never turns text into null, so these tests look at the text as it came.
    absent_text = [F.col(f"{ORIGINAL}.{name}").isNull() for name in spec.required_text]
    if blank_is_missing:
        absent_text += [F.col(name) == "" for name in spec.required_text]
    # Clean first: a filter on that status is this one test, without the parses of the others.
    passes = all_of(
        [~condition for condition in absent_text]
        + [F.col("approved_loans") > 0, F.col("approved_dollars") > 0]
        + [_fitted(name).isNotNull() for name in AMOUNTS]
    )
    blank = all_of([F.col(f"{ORIGINAL}.{name}").isNull() for name in renamed.columns])
    missing = any_of(absent_text + [F.col(name).isNull() for name in AMOUNTS])
    status = F.when(passes, CLEAN).when(blank, BLANK).when(missing, MISSING).otherwise(INVALID)
    return rows.withColumn(STATUS, status).withColumn(REASON, F.when(F.col(STATUS).isin(MISSING, INVALID), F.col(STATUS)))


def round_amounts(rows: DataFrame) -> DataFrame:
    """Half-even: loan counts to whole numbers, money to cents. Amounts of clean rows fit."""
    return rows.withColumns({name: _fitted(name) for name in AMOUNTS})


def derive_ratios(rows: DataFrame) -> DataFrame:
    """Average loan size and guaranty rate per row; null where the divisor is zero."""
    dollars = F.col("approved_dollars")
    return rows.withColumns(
        {
            "avg_loan_size": F.bround(dollars / null_if_zero(F.col("approved_loans")), 2).try_cast(MONEY),
            "guaranty_rate_pct": F.bround(
                F.col("approved_sba_guaranty_dollars") * F.lit(100) / null_if_zero(dollars), 2
            ).try_cast(PERCENT),
        }
    )


def valid_rows(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col(STATUS) == CLEAN).drop(*_HELPERS)


def clean(tagged: DataFrame) -> DataFrame:
    return derive_ratios(round_amounts(valid_rows(tagged)))


def rejects(tagged: DataFrame, spec: ExtractSpec) -> DataFrame:
    """Rejected rows in the fixed envelope, with the original text kept as JSON."""
    return tagged.where(F.col(STATUS).isin(MISSING, INVALID)).select(
        F.lit(spec.name).alias("source_table"),
        F.col(STATUS).alias(REASON),
        F.col("lender"),
        F.col("approved_loans").cast(RAW_NUMBER),
        F.col("approved_dollars").cast(RAW_NUMBER),
        F.to_json(ORIGINAL, {"ignoreNullFields": "false"}).alias("raw"),
    )


def quarantine(tagged: dict[ExtractSpec, DataFrame]) -> DataFrame:
    """The rejects of all extracts in one frame, typed even when no row was rejected."""
    parts = [rejects(rows, spec) for spec, rows in tagged.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts).to(REJECTS)


def surplus_rows(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row: how many rows repeat an earlier one. Nulls compare equal.

    Rows travel as 128 bits of two digests, which also say which values are null, and not whole.
    """
    names = columns or df.columns
    values = [part for name in names for part in (F.col(name).isNull(), F.col(name))]
    digests = [F.xxhash64(F.lit(seed), *values).alias(f"_digest_{seed}") for seed in (1, 2)]
    copies = df.groupBy(*digests).agg(F.count("*").alias("copies"))
    return copies.agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).cast("bigint").alias("duplicate_rows"))


def log_counts(spec: ExtractSpec) -> list[Column]:
    """The log's counts over tagged rows, missing values counted before rejection."""
    kept = F.col(STATUS) != BLANK
    return [
        F.count("*").alias("raw_rows"),
        F.count_if(kept).alias("rows_after_blank_drop"),
        F.count_if(F.col(STATUS) == CLEAN).alias("clean_rows"),
        F.count_if(F.col(STATUS) != CLEAN).alias("rows_removed"),
        F.count_if(F.col(STATUS).isin(MISSING, INVALID)).alias("rows_rejected"),
        *[F.count_if(kept & F.col(c).isNull()).alias(f"missing_{c}") for c in spec.required],
    ]


def cleaning_log(tagged: DataFrame, spec: ExtractSpec) -> DataFrame:
    """One row of counts for an extract, from its tagged rows."""
    # The ratios follow from the amounts, so rows that agree before them agree after.
    duplicates = surplus_rows(round_amounts(valid_rows(tagged)))
    return tagged.agg(*log_counts(spec)).select(
        F.lit(spec.name).alias("source_table"), "*", duplicates.scalar().alias("duplicate_rows")
    )


LOG_COUNTS = ("raw_rows", "rows_after_blank_drop", "clean_rows", "rows_removed", "rows_rejected", "duplicate_rows")


def log_table(spark: SparkSession, counts: Mapping[ExtractSpec, Mapping[str, int]]) -> DataFrame:
    """The log from counts already taken: a row an extract, missing values by column, non-zero only."""
    rows = [
        (spec.name, *[taken[name] for name in LOG_COUNTS], {c: taken[f"missing_{c}"] for c in spec.required if taken[f"missing_{c}"]})
        for spec, taken in counts.items()
    ]
    columns = ", ".join(f"{name} long" for name in LOG_COUNTS)
    return spark.createDataFrame(rows, f"source_table string, {columns}, missing_before map<string, long>")


def missing_before(log: DataFrame, spec: ExtractSpec) -> DataFrame:
    """The log's missing counts as (source_table, column_name, missing), non-zero only."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(f"missing_{c}").alias("missing")) for c in spec.required]
    )
    return log.select("source_table", F.inline(pairs)).where("missing > 0")
