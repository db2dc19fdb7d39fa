"""One callable per data product: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from activity_mart.contracts import (
    COUNTY_EXTRACT,
    DISTRICT_EXTRACT,
    EXTRACTS,
    FACT,
    INVALID,
    LENDER_EXTRACT,
    MISSING,
    MONEY,
    MONEY_TOTAL,
    PERCENT,
)
from activity_mart.functions import display, text
from activity_mart.functions.numeric import rounded_percent, rounded_ratio
from activity_mart.operators import cleaning, expectations, measures
from activity_mart.operators import star as star_schema
from activity_mart.plans import analytics, insight, pages, staging
from activity_mart.sources.readers import load_csv, normalize_columns, read_extracts, typed_import
from activity_mart.sources.sinks import write_table
from activity_mart.sources.store import new_path, side_by_side, stored
from activity_mart.testbed import tables

Query = Callable[[SparkSession, str], DataFrame]
_SLICE = {"lender_state": ["ASIA"], "region": ["EUROPE", "ASIA"]}


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


# --- ingest and cleaning -------------------------------------------------------


def ingest_extracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliver the three extracts as CSV, read them back by configuration, clean, and sum up."""
    root = new_path(spark, "delivery")
    for name, rows in tables.extracts(spark, sf_dir).items():
        spec = EXTRACTS[name]
        write_table(tables.text_delivery(rows, spec), f"{root}/{spec.section}", "csv")
    parts = []
    for name, raw in read_extracts(spark, EXTRACTS, root).items():
        rows = cleaning.clean(cleaning.tag(raw, EXTRACTS[name]))
        parts.append(
            rows.agg(
                F.count("*").alias("rows"),
                F.sum("approved_loans").alias("approved_loans"),
                F.sum("approved_dollars").cast(MONEY_TOTAL).alias("approved_dollars"),
                F.sum("approved_sba_guaranty_dollars").cast(MONEY_TOTAL).alias("approved_sba_guaranty_dollars"),
            ).select(F.lit(name).alias("source_table"), "*")
        )
    return _union(parts)


def csv_load_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    counties = tables.county_extract(spark, sf_dir)
    path = new_path(spark, "bulk")
    tables.null_token_rows(counties).write.csv(
        path,
        header=True,
        compression="gzip",
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )
    return load_csv(spark, path, counties.schema)


def typed_import_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A delivery in two column orders, one of them with a column that isn't asked for."""
    path = new_path(spark, "import")
    delivered = tables.fact_text(spark, sf_dir)
    late = F.col("date_key") >= "1996"
    turned = delivered.where(late).select(F.lit("x").alias("remark"), *reversed(delivered.columns))
    write_table(delivered.where(~late), f"{path}/early", "csv")
    write_table(turned, f"{path}/late", "csv")
    return typed_import(spark, f"{path}/*", FACT)


def _delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.raw_delivery(spark, sf_dir)


def _tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.tag(_delivery(spark, sf_dir), LENDER_EXTRACT)


def drop_blank_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = cleaning.drop_blank_rows(_delivery(spark, sf_dir))
    return normalize_columns(kept, LENDER_EXTRACT.columns)


def _rejected(reason: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = cleaning.rejects(_tagged(spark, sf_dir), LENDER_EXTRACT)
        return rows.where(F.col("rejection_reason") == reason).select(
            "rejection_reason", "lender", "approved_loans", "approved_dollars"
        )

    return query


def quarantine_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    deliveries = tables.deliveries(spark, sf_dir)
    return cleaning.quarantine({EXTRACTS[name]: cleaning.tag(rows, EXTRACTS[name]) for name, rows in deliveries.items()})


def cleaning_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log of all three deliveries: counts that their writes took, and the duplicates among clean rows."""
    parsed = tables.parsed(spark, sf_dir)
    found = {
        name: lambda rows=rows: cleaning.surplus_rows(cleaning.round_amounts(cleaning.valid_rows(rows))).first().duplicate_rows
        for name, (rows, _) in parsed.items()
    }
    duplicates = side_by_side(spark, found)
    log = cleaning.log_table(
        spark, {EXTRACTS[name]: {**counts, "duplicate_rows": duplicates[name]} for name, (_, counts) in parsed.items()}
    )
    entry = lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))
    missing = F.transform(F.array_sort(F.map_entries("missing_before")), entry)
    return log.withColumn("missing_before", F.array_join(missing, ", "))


def stg_county(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stage_county(tables.county_extract(spark, sf_dir)).drop("reporting_period")


# --- analytics ------------------------------------------------------------------


def _on_lenders(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(tables.lender_extract(spark, sf_dir))


def _on_counties(build: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(
        tables.county_extract(spark, sf_dir), tables.lender_extract(spark, sf_dir)
    )


def _on_districts(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(tables.district_extract(spark, sf_dir))


def _on_analytics(build: Callable[[dict[str, DataFrame]], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(analytics.run_analytics(tables.extracts(spark, sf_dir)))


def kpi_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.kpi_summary(
        tables.lender_extract(spark, sf_dir), tables.county_extract(spark, sf_dir)
    )


# --- star schema and measures ----------------------------------------------------


def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every month end in which orders were placed, as a reporting period."""
    orders = tables.source(spark, sf_dir, "orders")
    return star_schema.dim_date(orders.select(F.last_day("o_orderdate").alias("reporting_period")))


def dim_geography(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star_schema.dim_geography(
        tables.county_extract(spark, sf_dir), tables.regions(spark, sf_dir)
    )


def _flawed_counties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.flawed_extracts(spark, sf_dir, COUNTY_EXTRACT.name)[COUNTY_EXTRACT.name]


def fact_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = tables.flawed_star(spark, sf_dir)
    return star_schema.fact_left(_flawed_counties(spark, sf_dir), star.dim_lender, star.dim_geography)


def fact_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = tables.flawed_star(spark, sf_dir)
    return star_schema.fact_inner(
        _flawed_counties(spark, sf_dir), star.dim_lender, star.dim_geography, star.dim_date
    )


def reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = staging.stage_county(_flawed_counties(spark, sf_dir))
    result = expectations.reconcile(fact_inner(spark, sf_dir), source)
    return result.withColumns({c: F.col(c).cast(MONEY_TOTAL) for c in ("fact_dollars", "source_dollars")})


def orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All three relationships: a lender without its row, a state outside the lookup, a period without its date."""
    star = tables.flawed_star(spark, sf_dir)
    rows = staging.stage_county(_flawed_counties(spark, sf_dir))
    relations = {
        "lender": (rows, "lender_name", star.dim_lender, "lender_name"),
        "state": (rows, "project_state", tables.regions(spark, sf_dir), "state"),
        "period": (star.fact, "date_key", star.dim_date, "date_key"),
    }
    return _union(
        [
            expectations.orphan_keys(child, column, parent, field).select(
                F.lit(name).alias("relationship"), F.col(column).cast("string").alias("value"), "rows"
            )
            for name, (child, column, parent, field) in relations.items()
        ]
    )


def _on_star(build: Callable[[star_schema.Star], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(tables.star(spark, sf_dir))


def _on_flawed_star(build: Callable[[star_schema.Star], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(tables.flawed_star(spark, sf_dir))


# --- pages, flattened to one frame each --------------------------------------------


def _visual(name: str, rows: DataFrame, label: str, value: str) -> DataFrame:
    return rows.select(
        F.lit(name).alias("visual"), F.col(label).alias("label"), F.col(value).cast("double").alias("value")
    )


def _unpivot(name: str, row: DataFrame, labels: dict[str, str], kind: str) -> DataFrame:
    pairs = [
        F.struct(
            F.lit(name).alias("visual"), F.lit(label).alias("label"), F.col(column).cast(kind).alias("value")
        )
        for column, label in labels.items()
    ]
    return row.select(F.inline(F.array(*pairs)))


def page_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    page = pages.overview_page(tables.star(spark, sf_dir))
    labels = {
        measures.DOLLARS: "Total Approved Dollars",
        measures.LOANS: "Total Loan Count",
        "average_loan_size": "Average Loan Size",
        measures.GUARANTY: "Total Guaranty Dollars",
        "guaranty_rate": "Guaranty Rate",
        "active_lenders": "Active Lenders",
        "top_10_lender_share": "Top 10 Lender Share",
    }
    return _union(
        [
            _unpivot("cards", page["cards"], labels, "double"),
            _visual("top_lenders", page["top_lenders"], "lender_name", measures.DOLLARS),
            _visual("states", page["states"], "state", measures.DOLLARS),
        ]
    )


def page_geography(spark: SparkSession, sf_dir: str) -> DataFrame:
    page = pages.geography_page(tables.star(spark, sf_dir))
    columns = {
        "region": "string",
        "state": "string",
        "county": "string",
        measures.DOLLARS: MONEY_TOTAL.simpleString(),
        measures.LOANS: "bigint",
        "average_loan_size": "double",
    }

    def shaped(name: str) -> DataFrame:
        rows = page[name]
        values = [
            (F.col(c) if c in rows.columns else F.lit(None).cast(kind)).alias(c) for c, kind in columns.items()
        ]
        return rows.select(F.lit(name).alias("visual"), *values)

    return _union([shaped("states"), shaped("regions"), shaped("counties")])


def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return expectations.quality_report(
        tables.flawed_extracts(spark, sf_dir), tables.flawed_star(spark, sf_dir)
    )


def dq_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The page counts and lists both tables, so each is written once and read twice.
    written = side_by_side(
        spark,
        {
            "report": lambda: stored(quality_report(spark, sf_dir), "quality-report"),
            "rejected": lambda: stored(quarantine_union(spark, sf_dir), "rejected"),
        },
    )
    page = pages.quality_page(tables.flawed_star(spark, sf_dir), **written)
    labels = {
        "fact_rows": "Fact Rows",
        "failed_checks": "Failed Data Quality Checks",
        "rejected_records": "Rejected Record Count",
        "reporting_period": "Reporting Period",
    }
    rejected = page["rejected"].groupBy("source_table", "rejection_reason").agg(F.count("*").alias("rows"))
    return _union(
        [
            _unpivot("cards", page["cards"], labels, "string"),
            page["report"].select(
                F.lit("report").alias("visual"),
                F.col("check_name").alias("label"),
                F.concat_ws(" ", "status", "failed_count").alias("value"),
            ),
            rejected.select(
                F.lit("rejected").alias("visual"),
                F.concat_ws(" ", "source_table", "rejection_reason").alias("label"),
                F.col("rows").cast("string").alias("value"),
            ),
        ]
    )


# --- data quality --------------------------------------------------------------------


def _per_flawed_extract(build: Callable[[str, DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: _union(
        [build(name, rows) for name, rows in tables.flawed_extracts(spark, sf_dir).items()]
    )


def _duplicates(name: str, rows: DataFrame) -> DataFrame:
    return expectations.source_checks(name, rows).where(F.col("check_name") == f"{name}_duplicate_rows")


def dq_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nulls by column of all three tables, as their writes counted them."""
    rows = [
        (name, column.removeprefix("null_"), n)
        for name, counts in tables.flawed_counts(spark, sf_dir).items()
        for column, n in counts.items()
        if column.startswith("null_")
    ]
    return spark.createDataFrame(rows, "source_table string, column_name string, missing long")


def dq_row_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = ("non_negative_amounts", "guaranty_not_above_approved")
    return _union(
        [expectations.counted_checks(spark, name, counts, rules) for name, counts in tables.flawed_counts(spark, sf_dir).items()]
    )


def _unique_keys(star: star_schema.Star) -> DataFrame:
    """A lender dimension in which every fourth key comes twice, and the geography as it is."""
    lenders = star.dim_lender.unionByName(star.dim_lender.where("lender_key % 4 = 0"))
    return _union(
        [
            expectations.unique_key_check("dim_lender_unique_key", lenders, "lender_key"),
            expectations.unique_key_check("dim_geography_unique_key", star.dim_geography, "geography_key"),
        ]
    )


def _fact_keys(star: star_schema.Star) -> DataFrame:
    """A fact that lacks every third place as well."""
    place = F.when(F.col("geography_key") % 3 != 0, F.col("geography_key"))
    return expectations.fact_key_checks(expectations.fact_profile(star.fact.withColumn("geography_key", place)))


# Four of five of the driver's states.
ACCEPTED_STATES = [f"NATION_{i}" for i in range(25) if i % 5]


def check_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tables.flawed_extracts(spark, sf_dir)
    star = tables.flawed_star(spark, sf_dir)
    models = {
        "stg_lender_activity": staging.stage_lender(rows[LENDER_EXTRACT.name]),
        "stg_lender_county_activity": staging.stage_county(rows[COUNTY_EXTRACT.name]),
        "stg_district_activity": staging.stage_district(rows[DISTRICT_EXTRACT.name]),
        "dim_lender": star.dim_lender,
        "dim_geography": star.dim_geography,
        "dim_date": star.dim_date,
        "fct_lending_activity": star.fact,
    }
    return expectations.check_expectations(models)


def failing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that break a rule, and the one row of the reconciliation, with the dollars that drifted."""
    fact = tables.flawed_star(spark, sf_dir).fact
    drift = (F.col("fact_dollars") - F.col("source_dollars")).cast(MONEY)
    absent = {c: F.lit(None).cast(FACT[c].dataType) for c in FACT.names if c != "approved_dollars"}
    found = {
        "non_negative_amounts": expectations.negative_amount_rows(fact),
        "guaranty_not_above_approved": expectations.guaranty_above_approved_rows(fact),
        "reconciles_to_source": reconcile(spark, sf_dir).where("status <> 'pass'").withColumns({**absent, "approved_dollars": drift}),
    }
    return _union(
        [
            rows.select(
                F.lit(rule).alias("rule"),
                "lender_key",
                "geography_key",
                "approved_loan_count",
                "approved_dollars",
                "guaranty_dollars",
            )
            for rule, rows in found.items()
        ]
    )


# --- display and rounding ---------------------------------------------------------------


def rounding(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = tables.source(spark, sf_dir, "orders")
    price = F.col("o_totalprice").cast(MONEY)
    grouped = orders.groupBy("o_custkey").agg(
        F.sum(price).alias("paid"), F.max(price).cast(MONEY_TOTAL).alias("largest"), F.count("*").alias("orders")
    )
    paid, largest = F.col("paid"), F.col("largest")
    rest = (paid - largest * 2).cast(MONEY_TOTAL)
    return grouped.select(
        "o_custkey",
        rounded_ratio(paid, F.col("orders"), 2, MONEY).alias("avg_price"),
        rounded_percent(largest, paid, PERCENT).alias("largest_pct"),
        rounded_percent(rest, largest, PERCENT).alias("rest_pct"),
    )


def money_short(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("o_totalprice").cast(MONEY)
    amounts = tables.source(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.col("o_custkey").alias("small"),
        price.alias("thousands"),
        (price * 100).alias("millions"),
        (price * -100000).alias("billions"),
    )
    return amounts.withColumns(
        {name: display.money_short(F.col(name)) for name in amounts.columns if name != "o_orderkey"}
    )


def _description() -> Column:
    return F.concat("p_name", F.lit("/"), "p_type", F.lit(" o'"), "p_brand")


def title_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.source(spark, sf_dir, "part").select(
        "p_partkey", text.title_case(_description()).alias("title")
    )


def ellipsis(spark: SparkSession, sf_dir: str) -> DataFrame:
    limits = {"short": 12, "medium": 20, "long": insight.LABEL_LIMIT}
    return tables.source(spark, sf_dir, "part").select(
        "p_partkey", *[text.ellipsis(_description(), limit).alias(name) for name, limit in limits.items()]
    )


def display_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    balance = F.col("c_acctbal").cast(MONEY)
    return tables.source(spark, sf_dir, "customer").select(
        "c_custkey",
        display.thousands(balance).alias("thousands"),
        display.percent_one(balance).alias("percent_one"),
        display.percent_two(balance).alias("percent_two"),
        display.currency(balance).alias("currency"),
        display.fraction_percent(balance / 10000).alias("fraction_percent"),
    )


QUERIES: dict[str, Query] = {
    "ingest_extracts": ingest_extracts,
    "csv_load_nulls": csv_load_nulls,
    "typed_import": typed_import_query,
    "drop_blank_rows": drop_blank_rows,
    "strip_text": lambda s, d: _tagged(s, d).select("source_line", "lender"),
    "coerce_numeric": lambda s, d: _tagged(s, d).select(
        "source_line", "approved_loans", "approved_dollars", "approved_sba_guaranty_dollars"
    ),
    "reject_missing": _rejected(MISSING),
    "reject_invalid_amount": _rejected(INVALID),
    "quarantine_union": quarantine_union,
    "clean_rows": lambda s, d: cleaning.valid_rows(_tagged(s, d)),
    "round_amounts": lambda s, d: cleaning.round_amounts(cleaning.valid_rows(_tagged(s, d))),
    "derive_row_ratios": lambda s, d: cleaning.clean(_tagged(s, d)),
    "cleaning_log": cleaning_log,
    "stg_lender": _on_lenders(staging.stage_lender),
    "stg_county": stg_county,
    "stg_district": _on_districts(staging.stage_district),
    "kpi_summary": kpi_summary,
    "top10_share": _on_lenders(analytics.top_share),
    "top_lenders": _on_lenders(analytics.top_lenders),
    "state_activity": _on_counties(analytics.state_activity),
    "county_concentration": _on_counties(analytics.county_concentration),
    "geographic_reach": _on_counties(lambda counties, lenders: analytics.geographic_reach(lenders, counties)),
    "office_activity": _on_districts(analytics.office_activity),
    "widest_reach": _on_counties(
        lambda counties, lenders: analytics.widest_reach(analytics.geographic_reach(lenders, counties))
    ),
    "concentration_curve": _on_lenders(analytics.concentration_curve),
    "lender_metrics": _on_lenders(lambda rows: analytics.lender_metrics(staging.stage_lender(rows))),
    "state_metrics": _on_counties(lambda rows, _: analytics.state_metrics(staging.stage_county(rows))),
    "executive_kpis": _on_star(lambda star: analytics.executive_kpis(star.fact)),
    "headline_facts": _on_analytics(lambda found: insight.headline_facts(found, "Lending", "FY2024")),
    "completion_line": lambda s, d: insight.completion_line(kpi_summary(s, d)),
    "kpi_cards": lambda s, d: insight.kpi_cards(kpi_summary(s, d)),
    "ranked_bars": _on_analytics(insight.ranked_bars),
    "dim_lender": _on_lenders(star_schema.dim_lender),
    "dim_geography": dim_geography,
    "dim_date": dim_date,
    "fact_left": fact_left,
    "fact_inner": fact_inner,
    "reconcile": reconcile,
    "orphans": orphans,
    "m_base": _on_star(lambda star: measures.base_measures(star, ["region", "state"])),
    "m_ratios": _on_star(
        lambda star: measures.ratio_measures(measures.base_measures(star, ["lender_state"]))
    ),
    "m_lender_share": _on_star(lambda star: measures.lender_share(star, ["region", "lender_name"], _SLICE)),
    "m_active_lenders": _on_flawed_star(lambda star: measures.active_lenders_by(star, ["region", "lender_state"])),
    "m_active_lenders_by_name": _on_flawed_star(lambda star: measures.active_lenders_by(star, ["lender_name"])),
    "m_top10_dollars": _on_star(lambda star: measures.top_lender_dollars(star, ["region"])),
    "m_top10_share": _on_star(lambda star: measures.top_lender_share(star, ["region"])),
    "lender_reach": _on_flawed_star(measures.lender_reach),
    "m_failed_checks": lambda s, d: measures.failed_checks(quality_report(s, d)),
    "m_rejected": lambda s, d: measures.rejected_count(quarantine_union(s, d)),
    "measure_slice": _on_star(
        lambda star: measures.ratio_measures(measures.base_measures(star, ["lender_name"], _SLICE))
    ),
    "page_overview": page_overview,
    "page_lender": _on_star(pages.lender_page),
    "page_geography": page_geography,
    "region_rollup": _on_star(pages.region_rollup),
    "dq_page": dq_page,
    "dq_missing": dq_missing,
    "dq_duplicates": _per_flawed_extract(_duplicates),
    "dq_row_rules": dq_row_rules,
    "dq_unique_keys": _on_flawed_star(_unique_keys),
    "dq_fact_keys": _on_flawed_star(_fact_keys),
    "dq_accepted_states": _on_flawed_star(
        lambda star: expectations.accepted_states_check(star.dim_geography, ACCEPTED_STATES)
    ),
    "dq_fact_rules": _on_flawed_star(
        lambda star: expectations.fact_rule_checks(expectations.fact_profile(star.fact))
    ),
    "quality_report": quality_report,
    "expectations": check_models,
    "failing_rows": failing_rows,
    "rounding": rounding,
    "money_short": money_short,
    "title_case": title_case,
    "ellipsis": ellipsis,
    "display_formats": display_formats,
}
