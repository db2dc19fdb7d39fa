"""Lending extracts and marts derived from the driver tables.

One lineitem is one loan: the supplier is the lender, the customer's nation and
market segment are the project state and county, the order priority is the office.
Lineitems are summed by supplier key before they meet the supplier table, so a
supplier with a large part of all loans never becomes a hot join key.

Extracts and marts are tables: each is written once per application and source
folder and shared by the queries that need it.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from activity_mart.contracts import (
    COUNTY_EXTRACT,
    DISTRICT_EXTRACT,
    EXTRACTS,
    GEOGRAPHY_ID,
    LENDER_EXTRACT,
    LENDER_ID,
    MONEY,
    ExtractSpec,
)
from activity_mart.operators.cleaning import derive_ratios
from activity_mart.operators.expectations import row_counts
from activity_mart.operators.star import Star, build_star
from activity_mart.plans.refresh import parse
from activity_mart.sources.store import counted, side_by_side, stored

_built: dict[tuple[str, str, str], object] = {}
_locks: dict[tuple[str, str, str], threading.Lock] = {}
_guard = threading.Lock()


def _once(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], object]):
    key = (spark.conf.get("spark.app.id", ""), sf_dir, name)
    with _guard:
        lock = _locks.setdefault(key, threading.Lock())
    with lock:
        if key not in _built:
            _built[key] = build()
        return _built[key]


def forget() -> None:
    """Build every table anew from here on."""
    with _guard:
        _built.clear()


def source(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def price() -> Column:
    return F.col("l_extendedprice").cast(MONEY)


def guaranteed() -> Column:
    return price() * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))


def _loans(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Price and discount of each loan, as narrow as they are read: joins shuffle every loan."""
    return source(spark, sf_dir, "lineitem").select(
        "l_suppkey", *columns, price().alias("dollars"), F.col("l_discount").cast("decimal(4,2)").alias("discount")
    )


def _cents(amount: Column) -> Column:
    """Money as whole cents: a sum that its column can hold fits a long, and takes half the bytes."""
    return (amount * 100).cast("bigint")


def _money(cents: str) -> Column:
    """Sums of cents as money again; one too wide for the column is an error, as the cast of a decimal sum is."""
    return (F.col(cents).cast("decimal(20,0)") / F.lit(100).cast("decimal(3,0)")).cast(MONEY).alias(cents)


def _per_supplier(loans: DataFrame, *by: str) -> DataFrame:
    guaranty = (F.col("dollars") * (F.lit(1) - F.col("discount"))).cast(MONEY)
    return loans.groupBy("l_suppkey", *by).agg(
        F.count("*").alias("loans"), F.sum(_cents(F.col("dollars"))).alias("dollars"), F.sum(_cents(guaranty)).alias("guaranty")
    )


def with_lender(rows: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attach lender, city and state by supplier key.

    Table by table, so that each join decides on real file sizes and not on the
    estimate of another join.
    """
    suppliers = source(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    nations = source(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    return (
        rows.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(source(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .withColumnsRenamed({"s_name": "lender", "n_name": "lender_city", "r_name": "lender_state"})
    )


def _extract(per_supplier: DataFrame, spark: SparkSession, sf_dir: str, by: list[str]) -> DataFrame:
    named = with_lender(per_supplier, spark, sf_dir)
    summed = named.groupBy(*LENDER_ID, *by).agg(*[F.sum(name).alias(name) for name in ("loans", "dollars", "guaranty")])
    rows = summed.select(
        *LENDER_ID,
        *by,
        F.col("loans").cast("bigint").alias("approved_loans"),
        _money("dollars").alias("approved_dollars"),
        _money("guaranty").alias("approved_sba_guaranty_dollars"),
    )
    return derive_ratios(rows)


def lender_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Needs no orders: the lender grain comes from lineitem and supplier alone."""
    return _extract(_per_supplier(_loans(spark, sf_dir)), spark, sf_dir, [])


def county_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = source(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    orders = (
        source(spark, sf_dir, "orders")
        .select("o_orderkey", "o_custkey")
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .select("o_orderkey", "c_nationkey", F.col("c_mktsegment").alias("project_county"))
    )
    loans = _loans(spark, sf_dir, "l_orderkey").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    states = source(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("project_state")
    )
    grouped = _per_supplier(loans, "c_nationkey", "project_county").join(states, "c_nationkey")
    return _extract(grouped, spark, sf_dir, GEOGRAPHY_ID)


def district_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = source(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    loans = _loans(spark, sf_dir, "l_orderkey").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    grouped = _per_supplier(loans, "o_orderpriority").select(
        "*",
        F.substring_index("o_orderpriority", "-", 1).alias("do_code"),
        F.expr("substr(o_orderpriority, instr(o_orderpriority, '-') + 1)").alias("sba_do_name"),
    )
    return _extract(grouped, spark, sf_dir, ["do_code", "sba_do_name"])


_VIEWS = {
    LENDER_EXTRACT.name: lender_view,
    COUNTY_EXTRACT.name: county_view,
    DISTRICT_EXTRACT.name: district_view,
}


def extract(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return _once(spark, sf_dir, name, lambda: stored(_VIEWS[name](spark, sf_dir), name))


def lender_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(spark, sf_dir, LENDER_EXTRACT.name)


def county_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(spark, sf_dir, COUNTY_EXTRACT.name)


def district_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(spark, sf_dir, DISTRICT_EXTRACT.name)


def extracts(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return side_by_side(
        spark, {name: lambda name=name: extract(spark, sf_dir, name) for name in _VIEWS}
    )


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State to region lookup; one state is left out so that it falls to the default."""
    region = source(spark, sf_dir, "region")
    return (
        source(spark, sf_dir, "nation")
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .where(F.col("n_name") != "NATION_7")
        .select(F.col("n_name").alias("state"), F.col("r_name").alias("region"))
    )


def star(spark: SparkSession, sf_dir: str) -> Star:
    return _once(
        spark,
        sf_dir,
        "star",
        lambda: build_star(
            lender_extract(spark, sf_dir), county_extract(spark, sf_dir), regions(spark, sf_dir)
        ),
    )


# --- flawed copies: the same tables with rows that fail the checks --------------


def flawed(rows: DataFrame) -> DataFrame:
    """Break rules on some rows, chosen by loan count; every row is kept.

    The guaranty is dropped or raised above the approved amount, the loan count
    turns negative, and some rows appear twice.
    """
    n = F.col("approved_loans")
    copies = F.when(n % 13 == 4, 2).otherwise(1)
    broken = {
        "approved_sba_guaranty_dollars": F.when(n % 7 == 2, F.lit(None).cast(MONEY))
        .when(n % 5 == 1, F.col("approved_dollars") + F.lit(1).cast(MONEY))
        .otherwise(F.col("approved_sba_guaranty_dollars"))
        .cast(MONEY),
        "approved_loans": F.when(n % 11 == 3, -n).otherwise(n),
    }
    repeated = rows.select("*", F.explode(F.sequence(F.lit(1), copies)).alias("_copy")).drop("_copy")
    return repeated.withColumns(broken)


def _flawed(spark: SparkSession, sf_dir: str, name: str) -> tuple[DataFrame, dict[str, int]]:
    def build() -> tuple[DataFrame, dict[str, int]]:
        rows = flawed(extract(spark, sf_dir, name))
        if name == LENDER_EXTRACT.name:
            renamed = F.when(F.col("approved_dollars") * 100 % 7 == 0, F.concat("lender", F.lit(" (former)")))
            rows = rows.withColumn("lender", F.coalesce(renamed, "lender"))
        return counted(rows, row_counts(rows.columns), lambda kept: stored(kept, f"flawed-{name}"))

    return _once(spark, sf_dir, f"flawed-{name}", build)


def _all_flawed(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, tuple[DataFrame, dict[str, int]]]:
    return side_by_side(spark, {name: lambda name=name: _flawed(spark, sf_dir, name) for name in names or _VIEWS})


def flawed_extracts(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    """Flawed extracts, all or those named; every seventh lender also carries another name in the lender one."""
    return {name: rows for name, (rows, _) in _all_flawed(spark, sf_dir, *names).items()}


def flawed_counts(spark: SparkSession, sf_dir: str) -> dict[str, dict[str, int]]:
    """What the writes of the flawed extracts counted."""
    return {name: counts for name, (_, counts) in _all_flawed(spark, sf_dir).items()}


def flawed_star(spark: SparkSession, sf_dir: str) -> Star:
    """A star whose fact has unmatched lenders and broken amounts."""

    def build() -> Star:
        # The star has no offices, so their extract is not built for it.
        tables = flawed_extracts(spark, sf_dir, LENDER_EXTRACT.name, COUNTY_EXTRACT.name)
        return build_star(
            tables[LENDER_EXTRACT.name], tables[COUNTY_EXTRACT.name], regions(spark, sf_dir)
        )

    return _once(spark, sf_dir, "flawed-star", build)


def raw_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dirty lender delivery as files; a source the cleaning queries share."""
    return _once(
        spark, sf_dir, "raw-delivery", lambda: stored(delivery_view(spark, sf_dir), "raw-delivery")
    )


def delivery_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dirty lender delivery as text, one row per lineitem, with delivery headers.

    Text goes missing or comes padded, numbers are junk, negative, padded or
    fractional, some rows come twice, and blank rows are mixed in.
    """
    order = F.col("l_orderkey")
    copies = F.when(order % 113 == 0, 2).otherwise(1)
    emitted = F.concat(
        F.array_repeat(F.lit(True), copies),
        F.when(order % 79 == 0, F.array(F.lit(False))).otherwise(F.array().cast("array<boolean>")),
    )
    name = (
        F.when(order % 97 == 0, F.lit(None).cast("string"))
        .when(order % 89 == 0, "  Padded  ")
        .when(order % 83 == 0, F.concat(F.lit("\t"), F.col("lender"), F.lit(" ")))
        .otherwise(F.col("lender"))
    )
    count = (
        F.when(order % 101 == 0, "n/a")
        .when(order % 103 == 0, "-1")
        .when(order % 107 == 0, " 12 ")
        .when(order % 109 == 0, "0.4")
        .otherwise(F.col("l_quantity").cast("decimal(18,1)").cast("string"))
    )
    taxed = price() * (F.lit(1) + F.col("l_tax").cast("decimal(4,2)"))
    values = {
        "Lender": name,
        "Lender City": F.col("lender_city"),
        "Lender State": F.col("lender_state"),
        "Approved Loans": count,
        "Approved Dollars": taxed.cast("decimal(22,4)").cast("string"),
        "Approved SBA Guaranty Dollars": guaranteed().cast("decimal(22,4)").cast("string"),
        "Source Line": F.concat_ws("-", F.col("l_orderkey"), F.col("l_linenumber")),
    }
    return (
        with_lender(source(spark, sf_dir, "lineitem"), spark, sf_dir)
        .select("*", F.explode(emitted).alias("_filled"))
        .select(*[F.when(F.col("_filled"), value).alias(header) for header, value in values.items()])
    )


def text_delivery(rows: DataFrame, spec: ExtractSpec) -> DataFrame:
    """An extract as it would be delivered: text only, with the delivery's headers."""
    return rows.select(*[F.col(name).cast("string").alias(header) for header, name in spec.columns.items()])


def dirty_delivery(rows: DataFrame, spec: ExtractSpec) -> DataFrame:
    """A text delivery whose loan counts are missing, junk or negative on some rows."""
    n = F.col("approved_loans")
    loans = (
        F.when(n % 17 == 3, F.lit(None).cast("string"))
        .when(n % 19 == 4, "n/a")
        .when(n % 23 == 5, "-1")
        .otherwise(n.cast("string"))
    )
    return text_delivery(rows.withColumn("approved_loans", loans), spec)


def deliveries(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The dirty deliveries of all three extracts."""
    dirty = {
        spec.name: dirty_delivery(extract(spark, sf_dir, spec.name), spec) for spec in (COUNTY_EXTRACT, DISTRICT_EXTRACT)
    }
    return {LENDER_EXTRACT.name: raw_delivery(spark, sf_dir), **dirty}


def parsed(spark: SparkSession, sf_dir: str) -> dict[str, tuple[DataFrame, dict[str, int]]]:
    """The deliveries as tables by row status, each with the counts that its write took."""

    def build() -> dict[str, tuple[DataFrame, dict[str, int]]]:
        raw = deliveries(spark, sf_dir)
        return side_by_side(spark, {name: lambda name=name, rows=rows: parse(rows, EXTRACTS[name]) for name, rows in raw.items()})

    return _once(spark, sf_dir, "parsed", build)


def null_token_rows(rows: DataFrame) -> DataFrame:
    """Cleaned rows as text, with null tokens and padding for the bulk loader to resolve."""
    n = F.col("approved_loans")
    marked = {
        "lender_city": F.when(n % 7 == 2, "NULL").when(n % 5 == 1, "null").when(n % 3 == 0, "").otherwise(
            F.concat(F.lit("  "), "lender_city", F.lit("  "))
        ),
        "avg_loan_size": F.when(n % 11 == 3, "NULL").otherwise(F.col("avg_loan_size").cast("string")),
    }
    return rows.withColumns(marked).select(
        *[F.col(name).cast("string").alias(name) for name in rows.columns]
    )


def fact_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineitems laid out like a fact file, as text, with values that do not convert."""
    order, day = F.col("l_orderkey"), F.col("l_shipdate")
    return source(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("lender_key"),
        F.when(order % 97 == 0, "none").otherwise(F.col("l_partkey").cast("string")).alias("geography_key"),
        F.date_format(day, "yyyyMMdd").alias("date_key"),
        F.when(order % 89 == 0, "n/a").otherwise(F.date_format(day, "yyyy-MM-dd")).alias("reporting_period"),
        F.when(order % 101 == 0, "many")
        .otherwise(F.col("l_quantity").cast("bigint").cast("string"))
        .alias("approved_loan_count"),
        F.when(order % 103 == 0, "1,000").otherwise(price().cast("string")).alias("approved_dollars"),
        guaranteed().cast(MONEY).cast("string").alias("guaranty_dollars"),
    )
