"""Generated rows: calendars and hour spines. Executors unfold them, the driver does not."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The calendar's first and last day.
CALENDAR_START = date(2026, 8, 26)
CALENDAR_END = date(2030, 1, 1)


def days_between(spark: SparkSession, start: date, end: date) -> DataFrame:
    """Every day from start to end, both included."""
    days = F.sequence(F.lit(start), F.lit(end), F.expr("interval 1 day"))
    return spark.range(1).select(F.explode(days).alias("date_day"))


def hours_between(first: DataFrame, last: datetime | Column, name: str) -> DataFrame:
    """Every hour from the single value in `first` to the hour of `last`.

    No rows when `first` is empty or NULL, or when `last` lies before it.
    """
    end = F.date_trunc("hour", last if isinstance(last, Column) else F.lit(last).cast("timestamp"))
    bounds = first.toDF("lo").select("lo", end.alias("hi")).filter("lo <= hi")
    return bounds.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 hour"))).alias(name))


def days_of(first: DataFrame, last: datetime | Column, name: str) -> DataFrame:
    """Every day from the single value in `first` to the day of `last`; else as `hours_between`."""
    end = F.to_date(last if isinstance(last, Column) else F.lit(last).cast("timestamp"))
    bounds = first.toDF("lo").select("lo", end.alias("hi")).filter("lo <= hi")
    return bounds.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias(name))


def dim_date(
    spark: SparkSession, start: date = CALENDAR_START, end: date = CALENDAR_END
) -> DataFrame:
    """The calendar: one row per day with its ISO attributes."""
    return calendar_of(days_between(spark, start, end))


def calendar_of(days: DataFrame) -> DataFrame:
    """Attributes of each `date_day`. ISO weeks, Monday is 1."""
    iso_day = F.extract(F.lit("dayofweek_iso"), "date_day").cast("int")
    return days.select(
        "date_day",
        iso_day.alias("day_of_week"),
        F.date_format("date_day", "EEEE").alias("day_name"),
        iso_day.isin(6, 7).alias("is_weekend"),
        F.weekofyear("date_day").alias("week_of_year"),
        F.month("date_day").alias("month_number"),
        F.date_format("date_day", "MMMM").alias("month_name"),
        F.quarter("date_day").alias("quarter"),
        F.year("date_day").alias("year"),
    )
