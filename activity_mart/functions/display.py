"""Presentation formats for money, counts and percentages."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def _sign(value: Column) -> Column:
    return F.when(value < 0, "-").otherwise("")


def _tenths(size: Column) -> Column:
    """A non-negative double as text with one decimal, rounded by its exact binary value.

    A double printed as 10.85 is really a little below or above the tie. Where ten
    times the value looks like a tie, the error of that product (8 + 2 times the
    value, computed without loss) tells which side the value is on.
    """
    product = size * 10.0
    error = (size * 8.0 - product) + size * 2.0
    tie = (product % 1.0 == 0.5).cast("double")
    rounded = F.rint(product + tie * F.signum(error) * 0.25)
    return (rounded.cast("decimal(20,0)") * F.lit(Decimal("0.1"))).cast("string")


def one_decimal(value: Column) -> Column:
    """A double with one decimal, rounded by its exact binary value."""
    return F.concat(_sign(value), _tenths(F.abs(value)))


def thousands(value: Column) -> Column:
    """A whole number with separators; a fraction is rounded half to even."""
    return F.format_number(F.rint(value.cast("double")).cast("bigint"), 0)


def money_short(value: Column) -> Column:
    """``$31.1B``, ``$2.5M``, ``$443K``, ``$950``: scale chosen by absolute value."""
    amount = value.cast("double")
    size = F.abs(amount)
    scaled = size / F.when(size >= 1e9, 1e9).when(size >= 1e6, 1e6).when(size >= 1e3, 1e3).otherwise(1.0)
    digits = F.when(size >= 1e6, _tenths(scaled)).when(
        size >= 1e3, F.rint(scaled).cast("bigint").cast("string")
    )
    letter = F.when(size >= 1e9, "B").when(size >= 1e6, "M").when(size >= 1e3, "K").otherwise("")
    return F.concat(F.lit("$"), _sign(amount), F.coalesce(digits, thousands(size)), letter)


def percent_one(value: Column) -> Column:
    return F.concat(one_decimal(value.cast("double")), F.lit("%"))


def percent_two(value: Column) -> Column:
    """A percentage already held at two decimals."""
    return F.concat(value.cast("decimal(28,2)").cast("string"), F.lit("%"))


def currency(value: Column) -> Column:
    """Whole dollars with separators; negatives in parentheses."""
    amount = F.round(value.cast("decimal(38,10)"), 0).cast("decimal(28,0)")
    shown = F.concat(F.lit("$"), F.format_number(F.abs(amount), 0))
    return F.when(amount < 0, F.concat(F.lit("("), shown, F.lit(")"))).otherwise(shown)


def fraction_percent(value: Column) -> Column:
    """A fraction shown as ``0.00%``."""
    amount = F.round(value.cast("decimal(38,12)") * 100, 2).cast("decimal(28,2)")
    return F.concat(amount.cast("string"), F.lit("%"))
