"""Formats against Python's own formatting of the same numbers."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from activity_mart.functions import display, text


def python_money_short(value: float) -> str:
    size = abs(value)
    for limit, letter, digits in ((1e9, "B", 1), (1e6, "M", 1), (1e3, "K", 0)):
        if size >= limit:
            return f"${value / limit:.{digits}f}{letter}"
    return f"${value:,.0f}"


def test_one_decimal_rounds_by_the_exact_value(spark):
    rng = random.Random(7)
    values = [n / 100 for n in range(-3000, 3000, 5)]
    values += [n / 20 for n in range(1, 2001, 2)]
    values += [rng.uniform(-1e6, 1e6) for _ in range(500)] + [0.04999999999999999, 0.05, 0.25, 0.75, 0.0]
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    for row in frame.select("v", display.one_decimal(F.col("v")).alias("shown")).collect():
        assert row.shown == f"{row.v:.1f}", row.v


def test_money_short_scales(spark):
    known = {7_060_000_000: "$7.1B", 1_000_000_000: "$1.0B", 64_300_000: "$64.3M", 12_000: "$12K", 1: "$1"}
    values = [float(v) for v in known] + [-2_500_000.0, 999.5, 1000.0, 999_999.0, 1_350_000.0, 1_450_000.0, 0.0]
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    shown = {r.v: r.s for r in frame.select("v", display.money_short(F.col("v")).alias("s")).collect()}
    for value, expected in known.items():
        assert shown[float(value)] == expected
    for value, found in shown.items():
        assert found == python_money_short(value), value


def test_title_case_capitalises_after_any_non_letter(spark):
    values = ["DALLAS / FT WORTH DISTRICT OFFICE", "ft-worth o'NEIL", "3rd éCOLE", "", "a1b"]
    frame = spark.createDataFrame([(v,) for v in values], "v string")
    for row in frame.select("v", text.title_case(F.col("v")).alias("t")).collect():
        assert row.t == row.v.title()


def test_ellipsis_trims_before_the_dots(spark):
    def python(value, limit):
        return value if len(value) <= limit else value[: limit - 3].rstrip() + "..."

    values = ["short", "x" * 34, "x" * 35, "ends in space  here and more", "Live Oak Banking Company of the South"]
    frame = spark.createDataFrame([(v,) for v in values], "v string")
    for limit in (10, 12, 17, 34):
        for row in frame.select("v", text.ellipsis(F.col("v"), limit).alias("e")).collect():
            assert row.e == python(row.v, limit)


def test_currency_and_percent_formats(spark):
    frame = spark.createDataFrame([("-1234.50", "0.12345"), ("0.40", "-0.5"), ("1234567.49", "1")], "a string, f string")
    rows = frame.select(
        display.currency(F.col("a").cast("decimal(18,2)")).alias("a"),
        display.fraction_percent(F.col("f").cast("decimal(18,6)")).alias("f"),
    ).collect()
    assert [tuple(r) for r in rows] == [("($1,235)", "12.35%"), ("$0", "-50.00%"), ("$1,234,567", "100.00%")]


def test_strip_text_removes_every_kind_of_blank(spark):
    values = ["\t  a b \x1c", "   ", None, "x", "　y "]
    frame = spark.createDataFrame([(v,) for v in values], "v string")
    found = [r.s for r in frame.select(text.strip_text(F.col("v")).alias("s")).collect()]
    assert found == [v.strip() if v is not None else None for v in values]


def test_snake_case():
    cases = {"": "", "__": "", "a": "a", "A--b": "a_b", "\tRow 2\n": "row_2", "é9 Ü": "9", "x/(y)%": "x_y"}
    assert {name: text.snake_case(name) for name in cases} == cases
