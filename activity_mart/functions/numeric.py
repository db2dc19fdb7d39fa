"""Exact decimal arithmetic for amounts and ratios.

Money never passes through a double on its way to a rounded result: dividing
doubles and rounding to cents disagrees with exact arithmetic on roughly one
ratio in a hundred.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from activity_mart.contracts import RAW_NUMBER


def coerce_number(text: Column) -> Column:
    """Text to a wide decimal; anything unreadable, NaN or infinite becomes null."""
    return text.try_cast(RAW_NUMBER)


def null_if_zero(value: Column) -> Column:
    return F.when(value != 0, value)


def rounded_ratio(numerator: Column, denominator: Column, digits: int, kind: T.DecimalType) -> Column:
    """``numerator / denominator`` rounded half away from zero, null on a zero denominator.

    Integer division of the scaled amounts keeps the rounding exact however
    large the totals grow; a plain decimal division would round twice. A result
    too large for ``kind`` is null.
    """
    base = F.abs(null_if_zero(denominator))
    doubled = F.abs(numerator) * F.lit(2 * 10**digits) + base
    units = F.call_function("div", doubled, base * F.lit(2))
    sign = F.when((numerator < 0) != (denominator < 0), -1).otherwise(1)
    unit = F.lit(Decimal(1).scaleb(-digits))
    return ((units * sign).cast("decimal(20,0)") * unit).try_cast(kind)


def rounded_percent(part: Column, whole: Column, kind: T.DecimalType) -> Column:
    return rounded_ratio(part * F.lit(100), whole, 2, kind)


def plain_ratio(numerator: Column, denominator: Column) -> Column:
    """Unrounded quotient as a double, null when the denominator is zero."""
    return numerator.cast("double") / null_if_zero(denominator).cast("double")
