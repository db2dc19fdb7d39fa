from __future__ import annotations

import datetime

import frames
import pytest
from pyspark.sql import functions as F

from activity_mart.contracts import DIM_DATE, DIM_GEOGRAPHY, DIM_LENDER, FACT, STATE_REGIONS
from activity_mart.operators import measures
from activity_mart.operators import star as star_schema
from activity_mart.operators.keys import DuplicateKeyError, dense_key, require_unique
from activity_mart.plans.staging import stage_county, stage_district
from activity_mart.sources.readers import state_regions
from activity_mart.sources.store import stored


@pytest.fixture(scope="module")
def star(spark):
    return star_schema.build_star(frames.lenders(spark), frames.counties(spark), state_regions(spark))


def test_schemas(star):
    assert star.fact.schema == FACT
    assert star.dim_lender.schema == DIM_LENDER
    assert star.dim_geography.schema == DIM_GEOGRAPHY
    assert star.dim_date.schema == DIM_DATE


def test_keys_are_dense_and_in_natural_order(star):
    assert [(r.lender_key, r.lender_name) for r in star.dim_lender.orderBy("lender_key").collect()] == [
        (1, "Cedar Trust"),
        (2, "Harbor Union"),
        (3, "Quiet Savings"),
        (4, "Ridge Mutual"),
    ]
    places = star.dim_geography.orderBy("geography_key").collect()
    assert [(r.geography_key, r.state) for r in places] == [(1, "ID"), (2, "ME"), (3, "WA")]


def test_regions(star):
    assert {r.state: r.region for r in star.dim_geography.collect()} == {"ID": "West", "ME": "Northeast", "WA": "West"}
    assert len(STATE_REGIONS) == 56


def test_unlisted_state_is_unknown(spark):
    rows = [("A", "B", "TX", "ZZ", "X", 1, "1", "1")]
    found = star_schema.dim_geography(frames.counties(spark, rows), state_regions(spark)).first()
    assert found.region == "Unknown"


def test_lookup_that_would_multiply_rows_is_refused(spark):
    twice = state_regions(spark).union(state_regions(spark))
    with pytest.raises(DuplicateKeyError, match="region lookup"):
        star_schema.dim_geography(frames.counties(spark), twice)


def test_fact_matches_its_source(spark, star):
    assert star.fact.count() == 4
    assert star.fact.where("lender_key IS NULL OR geography_key IS NULL").isEmpty()
    totals = star.fact.agg(F.sum("approved_dollars"), F.sum("guaranty_dollars"), F.sum("approved_loan_count")).first()
    assert [str(v) for v in totals] == ["3000000.00", "2040000.00", "10"]


def test_unmatched_lender_is_null_on_the_left_and_gone_inside(spark, star):
    rows = [*frames.COUNTIES, ("Stray Bank", "Reno", "NV", "WA", "KING", 1, "10", "5")]
    counties = frames.counties(spark, rows)
    left = star_schema.fact_left(counties, star.dim_lender, star.dim_geography)
    inner = star_schema.fact_inner(counties, star.dim_lender, star.dim_geography, star.dim_date)
    assert left.schema == inner.schema == FACT
    assert left.count() == 5 and left.where("lender_key IS NULL").count() == 1
    assert inner.count() == 4
    other = star.dim_date.withColumn("reporting_period", F.lit("2023-09-30").cast("date"))
    assert star_schema.fact_inner(counties, star.dim_lender, star.dim_geography, other).isEmpty()


def test_fact_refuses_a_dimension_with_repeated_keys(spark, star):
    doubled = star.dim_lender.union(star.dim_lender)
    with pytest.raises(DuplicateKeyError, match="dim_lender"):
        star_schema.fact_left(frames.counties(spark), doubled, star.dim_geography)


def test_period_row(star):
    row = star.dim_date.first()
    assert tuple(row) == (20240930, datetime.date(2024, 9, 30), 2024, "Q4", 9, "FY2024 Year End")


def test_several_periods_join_on_their_own_date(spark, star):
    first = frames.counties(spark).withColumn("reporting_period", F.lit("2024-09-30").cast("date"))
    second = frames.counties(spark).withColumn("reporting_period", F.lit("2025-03-31").cast("date"))
    both = first.unionByName(second)
    built = star_schema.build_star(frames.lenders(spark), both, state_regions(spark))
    labels = {r.date_key: (r.quarter, r.period_label) for r in built.dim_date.collect()}
    assert labels == {20240930: ("Q4", "FY2024 Year End"), 20250331: ("Q2", "FY2025 Q2")}
    inner = star_schema.fact_inner(both, built.dim_lender, built.dim_geography, built.dim_date)
    assert inner.count() == built.fact.count() == 8
    assert {r.date_key for r in inner.collect()} == {20240930, 20250331}


def test_periods_have_few_files_and_are_pruned(spark):
    # Forty tasks, three periods, one of them with most rows.
    rows = frames.counties(spark).crossJoin(spark.range(2000).repartition(40)).withColumn(
        "reporting_period", F.expr("CASE WHEN id % 10 = 1 THEN DATE'2023-09-30' WHEN id % 10 = 2 THEN DATE'2022-09-30' ELSE DATE'2024-09-30' END")
    ).drop("id")
    built = star_schema.build_star(frames.lenders(spark), rows, state_regions(spark))
    per_period = built.fact.withColumn("file", F.input_file_name()).groupBy("date_key").agg(F.count("*").alias("n"), F.count_distinct("file").alias("files"))
    assert {r.date_key: (r.n, r.files) for r in per_period.collect()} == {
        20240930: (6400, 1), 20230930: (800, 1), 20220930: (800, 1)
    }
    sliced = measures.base_measures(built, ["state"], {"year": [2023]})
    plan = sliced._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date_key" in plan and "dynamicpruning" in plan
    assert sum(r.total_loan_count for r in sliced.collect()) == 200 * sum(r[5] for r in frames.COUNTIES)


def test_a_hot_period_is_split_by_size(spark):
    names = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k"}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        # A small period that does not share its shuffle partition with the hot one.
        place = "pmod(hash(CAST(id AS INT)), 8)"
        apart = f"{place} <> (SELECT pmod(hash(20240930), 8))"
        small = spark.range(20230101, 20230130).where(apart).first().id
        rows = spark.range(0, 200_000, numPartitions=20).select(
            F.xxhash64("id").alias("lender_key"), F.when(F.col("id") % 50 == 0, small).otherwise(20240930).cast("int").alias("date_key")
        )
        files = stored(star_schema.by_period(rows), "periods", ["date_key"])
        per_period = {r.date_key: r.files for r in files.withColumn("file", F.input_file_name()).groupBy("date_key").agg(F.count_distinct("file").alias("files")).collect()}
    finally:
        for name in names:
            spark.conf.unset(name)
    assert per_period[20240930] > 4 and per_period[small] == 1
    assert files.count() == 200_000


def test_dense_key_over_many_partitions(spark):
    members = spark.range(5000).select(F.format_string("m%05d", (F.col("id") * 7919) % 5000).alias("name"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        keyed = dense_key(members, ["name"], "k")
        assert keyed.agg(F.count_distinct("k"), F.min("k"), F.max("k")).first() == (5000, 1, 5000)
        assert keyed.where(F.col("k") != F.substring("name", 2, 5).cast("int") + 1).isEmpty()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_dense_key_of_nothing(spark):
    assert dense_key(spark.createDataFrame([], "name string"), ["name"], "k").isEmpty()


def test_require_unique(spark):
    frame = spark.createDataFrame([("a", 1), ("a", 2)], "x string, y int")
    require_unique(frame, ["x", "y"], "pairs")
    with pytest.raises(DuplicateKeyError):
        require_unique(frame, ["x"], "names")


def test_staging_types(spark):
    staged = stage_district(frames.offices(spark)).orderBy("do_code").first()
    assert staged.do_code == "0101" and staged.district_office_name == "ALPINE / LAKES"
    assert stage_county(frames.counties(spark)).first().reporting_period == datetime.date(2024, 9, 30)
