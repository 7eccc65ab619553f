"""Exact rounding.

Averages and rates are kept in whole units of their last decimal place (an average with one
decimal is a count of tenths), because a double would round some halves the wrong way. Whole
numbers also stay in fixed-width aggregation buffers, so grouping is a hash aggregate.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def div_half_away(num: Column, den: Column) -> Column:
    """num / den as a whole number, halves rounded away from zero; NULL when den is 0.

    Half of den is added on the side of num's sign, and `div` cuts towards zero.
    """
    size = F.abs(den)
    rounded = num * 2 + F.when(num < 0, -size).otherwise(size)
    return F.call_function("div", rounded, F.nullif(den * 2, F.lit(0).cast("bigint")))


def from_units(units: Column, scale: int) -> Column:
    """Whole units of 10**-scale as a decimal(18, scale)."""
    unit = F.lit(Decimal(1).scaleb(-scale))
    return (units.cast("decimal(18,0)") * unit).cast(f"decimal(18,{scale})")


def to_units(value: Column, scale: int) -> Column:
    """The reverse of from_units, exact for any decimal with at most that scale."""
    return (value * (10**scale)).cast("bigint")


def cents(text: Column) -> Column:
    """An amount of cents written as text, in currency with two decimals."""
    return from_units(text.try_cast("int").cast("bigint"), 2)
