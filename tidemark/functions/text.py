"""Numbers as people read them in the reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def grouped(number: Column) -> Column:
    """A whole number with thousands separated; a fraction is rounded, halves to even."""
    return F.format_number(number, 0)


def signed_percent(rate: Column) -> Column:
    """A decimal fraction as a percentage with its sign and one decimal."""
    percent = F.round(rate * 100, 1).cast("decimal(18,1)")
    sign = F.when(percent < 0, "-").otherwise("+")
    return F.concat(sign, F.abs(percent).cast("string"), F.lit("%"))
