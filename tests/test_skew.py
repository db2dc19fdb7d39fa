"""One supplier, one order and one customer own a third of everything; results stay whole."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F
from test_oracle import _rows

import __spark_entry__ as contract
from activity_mart.operators.spread import PLACE, hot_keys, lookup_join, numbered
from activity_mart.testbed import tables

QUERIES, ORACLES = contract.queries(), contract.oracle_sql()
NAMES = ["kpi_summary", "geographic_reach", "state_activity", "office_activity", "m_top10_share", "dq_duplicates"]


@pytest.fixture(scope="module")
def skewed(tmp_path_factory, sf_dir):
    folder = tmp_path_factory.mktemp("skewed")
    connection = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        rows = f"SELECT * FROM '{file}'"
        if file.stem == "lineitem":
            hot = "l_linenumber <= 2"
            rows = (
                f"SELECT * REPLACE (CASE WHEN {hot} THEN 0 ELSE l_suppkey END AS l_suppkey, "
                f"CASE WHEN {hot} THEN 0 ELSE l_orderkey END AS l_orderkey) FROM '{file}'"
            )
        if file.stem == "orders":
            hot = "CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE o_custkey END"
            rows = f"SELECT * REPLACE ({hot} AS o_custkey) FROM '{file}'"
        connection.sql(f"COPY ({rows}) TO '{folder / file.name}' (FORMAT parquet, ROW_GROUP_SIZE 2048)")
        connection.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM '{folder / file.name}'")
    return str(folder), connection


@pytest.fixture
def splitting(spark):
    """Sort-merge joins only, with every larger partition treated as skewed."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
        # Several map tasks, so that the hot partition has parts to split into.
        "spark.sql.files.maxPartitionBytes": "32k",
        "spark.sql.files.openCostInBytes": "0",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name in settings:
        spark.conf.unset(name)


@pytest.mark.parametrize("name", NAMES)
def test_hot_keys(name, spark, skewed, splitting):
    folder, connection = skewed
    found = QUERIES[name](spark, folder)
    expected = connection.sql(ORACLES[name])
    assert _rows(found.columns, found.collect()) == _rows(expected.columns, expected.fetchall())


def test_the_hot_order_is_split(spark, skewed, splitting):
    folder, _ = skewed
    rows = tables.county_view(spark, folder)
    rows.collect()
    assert "skew=true" in rows._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def not_adaptive(spark):
    """Sort-merge joins, and nothing that splits a hot partition at run time."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "false",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@pytest.mark.parametrize("name", ["fact_left", "fact_inner", "clean_rows", "orphans"])
def test_hot_keys_without_adaptive_execution(name, spark, skewed, not_adaptive):
    folder, connection = skewed
    found = QUERIES[name](spark, folder)
    expected = connection.sql(ORACLES[name])
    assert _rows(found.columns, found.collect()) == _rows(expected.columns, expected.fetchall())


# Half of the rows hold one key, a tenth hold none, and the rest are spread over 400.
HOT = "CASE WHEN id % 10 < 5 THEN 7 WHEN id % 10 = 9 THEN NULL ELSE id % 400 END"


@pytest.mark.parametrize("how", ["left", "inner"])
def test_a_lookup_spreads_hot_and_missing_keys(how, spark, not_adaptive):
    rows = spark.range(20_000).selectExpr(f"{HOT} AS k", "id % 3 AS v")
    lookup = spark.range(0, 390).selectExpr("id AS k", "id * 2 AS found")
    joined = lookup_join(numbered(rows), lookup, ["k"], how, parts=16)
    plain = rows.join(lookup, "k", how)
    assert sorted(map(str, joined.drop(PLACE).collect())) == sorted(map(str, plain.collect()))
    # The join's own partitions: eight tasks, and no one has much more than its share.
    sizes = [r.n for r in joined.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert max(sizes) < 0.35 * sum(sizes)
    unsalted = [r.n for r in plain.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert max(unsalted) > 0.45 * sum(unsalted)


def test_hot_keys_are_few_and_get_salts_by_share(spark):
    rows = spark.range(20_000).selectExpr(f"{HOT} AS k")
    assert [tuple(r) for r in hot_keys(rows, ["k"], 16).collect()] == [(7, 9)]
    assert hot_keys(rows.limit(0), ["k"], 16).isEmpty()
    with pytest.raises(ValueError, match="column names in use"):
        lookup_join(numbered(rows), rows.withColumn("_salt", F.lit(1)), ["k"])
    with pytest.raises(ValueError, match="left or inner"):
        lookup_join(numbered(rows), rows, ["k"], "full")
