"""One refresh: extracts in, cleaned tables, star schema, quality and analytics out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from activity_mart.contracts import COUNTY_EXTRACT, EXTRACTS, LENDER_EXTRACT, ExtractSpec
from activity_mart.operators.cleaning import ORIGINAL, REASON, STATUS, clean, log_counts, log_table, quarantine, surplus_rows, tag
from activity_mart.operators.expectations import assert_quality, quality_report, row_counts
from activity_mart.operators.star import Star, build_star
from activity_mart.plans.analytics import run_analytics
from activity_mart.sources.readers import read_extracts, state_regions
from activity_mart.sources.sinks import register_views, write_table, write_tables
from activity_mart.sources.store import counted, run_folder, side_by_side, stored


@dataclass(frozen=True)
class Refresh:
    cleaned: dict[str, DataFrame]
    rejected: DataFrame
    log: DataFrame
    star: Star
    report: DataFrame
    analytics: dict[str, DataFrame]


def parse(raw: DataFrame, spec: ExtractSpec) -> tuple[DataFrame, dict[str, int]]:
    """The tagged extract as a table partitioned by row status, and its log counts, in one pass.

    Only rejects keep the record as it was delivered: nothing reads it of clean and blank rows.
    """
    tagged = tag(raw, spec)
    tagged = tagged.withColumn(ORIGINAL, F.when(F.col(REASON).isNotNull(), F.col(ORIGINAL)))
    return counted(tagged, log_counts(spec), lambda rows: stored(rows, f"tagged-{spec.name}", [STATUS]))


def refresh(
    spark: SparkSession,
    root: str,
    out: str,
    specs: dict[str, ExtractSpec] = EXTRACTS,
    fmt: str = "csv",
    gate: bool = True,
    out_fmt: str = "parquet",
    quoted_line_breaks: bool = False,
) -> Refresh:
    """Run every stage on the tables the stage before wrote; raise last if a check failed.

    The delivery is read once: its write by row status takes the log's counts, and clean rows and
    rejects then read only their own partitions. The write of the cleaned tables counts missing
    cells and broken rules; duplicates take one shuffle, for log and report alike.
    """
    raw = read_extracts(spark, specs, root, fmt, quoted_line_breaks)
    with run_folder(spark):
        parsed = side_by_side(spark, {name: lambda name=name, rows=rows: parse(rows, specs[name]) for name, rows in raw.items()})
        written = side_by_side(
            spark,
            {
                name: lambda name=name, tagged=tagged: _write_cleaned(clean(tagged), f"{out}/processed/{name}", out_fmt)
                for name, (tagged, _) in parsed.items()
            },
        )
        cleaned = {name: rows for name, (rows, _) in written.items()}
        rejected = write_table(
            quarantine({specs[name]: tagged for name, (tagged, _) in parsed.items()}), f"{out}/quality/rejected_records", out_fmt
        )
        duplicates = side_by_side(
            spark, {name: lambda rows=rows: surplus_rows(rows).first().duplicate_rows for name, rows in cleaned.items()}
        )
        logged = {specs[name]: {**counts, "duplicate_rows": duplicates[name]} for name, (_, counts) in parsed.items()}
        log = write_table(_flat(log_table(spark, logged), out_fmt), f"{out}/quality/cleaning_log", out_fmt)

        star = build_star(
            cleaned[LENDER_EXTRACT.name],
            cleaned[COUNTY_EXTRACT.name],
            state_regions(spark),
            save=lambda df, name, partition_by=None: write_table(df, f"{out}/warehouse/{name}", out_fmt, partition_by),
        )
        counts = {name: {**taken, "duplicate_rows": duplicates[name]} for name, (_, taken) in written.items()}
        report = write_table(
            quality_report(cleaned, star, counted=counts), f"{out}/quality/data_quality_report", out_fmt
        )
        register_views({**cleaned, **star.tables(), "rejected_records": rejected, "data_quality_report": report})
        analytics = write_tables(run_analytics(cleaned), f"{out}/analytics", out_fmt)
        if gate:
            assert_quality(report)
    return Refresh(cleaned, rejected, log, star, report, analytics)


def _write_cleaned(rows: DataFrame, path: str, fmt: str) -> tuple[DataFrame, dict[str, int]]:
    return counted(rows, row_counts(rows.columns), lambda counted_rows: write_table(counted_rows, path, fmt))


def _flat(log: DataFrame, fmt: str) -> DataFrame:
    """A map has no place in a CSV cell; there it is JSON."""
    return log.withColumn("missing_before", F.to_json("missing_before")) if fmt == "csv" else log
