"""Small hand-made frames shared by the tests."""

from __future__ import annotations

from activity_mart.contracts import (
    COUNTY_EXTRACT,
    DISTRICT_EXTRACT,
    LENDER_EXTRACT,
    cleaned_schema,
)
from activity_mart.operators.cleaning import derive_ratios

RAW_HEADERS = list(LENDER_EXTRACT.columns)


def raw(spark, rows, headers=RAW_HEADERS):
    schema = ", ".join(f"`{name}` string" for name in headers)
    return spark.createDataFrame(rows, schema)


def _cleaned(spark, spec, rows):
    fields = cleaned_schema(spec).fields[:-2]
    text = ", ".join(f"{f.name} string" for f in fields)
    frame = spark.createDataFrame([tuple(None if v is None else str(v) for v in row) for row in rows], text)
    return derive_ratios(frame.select(*[frame[f.name].cast(f.dataType).alias(f.name) for f in fields]))


# Two lenders tie at the top, one has no county row, two share a place, one lends in two states.
LENDERS = [
    ("Cedar Trust", "Boise", "ID", 5, "1200000.00", "960000.00"),
    ("Harbor Union", "Portland", "ME", 3, "1200000.00", "600000.00"),
    ("Quiet Savings", "Salem", "OR", 1, "200000.00", "0.00"),
    ("Ridge Mutual", "Portland", "OR", 2, "600000.00", "480000.00"),
]
COUNTIES = [
    ("Cedar Trust", "Boise", "ID", "ID", "ADA", 2, "720000.00", "576000.00"),
    ("Cedar Trust", "Boise", "ID", "WA", "KING", 3, "480000.00", "384000.00"),
    ("Harbor Union", "Portland", "ME", "ME", "YORK", 3, "1200000.00", "600000.00"),
    ("Ridge Mutual", "Portland", "OR", "WA", "KING", 2, "600000.00", "480000.00"),
]
# Two offices tie.
OFFICES = [
    ("Cedar Trust", "Boise", "ID", "0101", "ALPINE / LAKES", 5, "1200000.00", "960000.00"),
    ("Harbor Union", "Portland", "ME", "0202", "COAST", 3, "1200000.00", "600000.00"),
]


def lenders(spark, rows=LENDERS):
    return _cleaned(spark, LENDER_EXTRACT, rows)


def counties(spark, rows=COUNTIES):
    return _cleaned(spark, COUNTY_EXTRACT, rows)


def offices(spark, rows=OFFICES):
    return _cleaned(spark, DISTRICT_EXTRACT, rows)


def extracts(spark, lender_rows=LENDERS, county_rows=COUNTIES, office_rows=OFFICES):
    return {
        LENDER_EXTRACT.name: lenders(spark, lender_rows),
        COUNTY_EXTRACT.name: counties(spark, county_rows),
        DISTRICT_EXTRACT.name: offices(spark, office_rows),
    }
