"""Bring the written facts up to date by rebuilding only the days that changed.

A full build reads all history on every run. Here the cost follows the days that are rebuilt,
plus the week before them: the last dense day before them holds one row for every entity known by
then, with its record so far. After an outage the rebuilt days begin where the dense fact ends.
"""

from __future__ import annotations

from collections.abc import Collection
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.daily import daily_rollup, stretches, trends
from tidemark.operators.ledger import hour_counts
from tidemark.operators.observations import fact_native, normalize_observations
from tidemark.sources.sinks import write_days
from tidemark.sources.versions import Store

FACT, TRENDS = "fct_player_counts", "fct_player_trends_daily"
HOURS = "hour_counts"


def counts_of_days(fact: DataFrame, days: Collection[date] | None = None) -> DataFrame:
    """(date_day, logical_hour, snapshot_rows) of a written fact; of some of its days only those
    folders are read."""
    if days is not None:
        fact = fact.filter(F.col("date_day").isin(*days) if days else F.lit(False))
    counted = hour_counts(fact)
    return counted.select(F.to_date("logical_hour").alias("date_day"), *counted.columns)


def refresh_hour_counts(store: Store, days: Collection[date]) -> DataFrame:
    """Bring the kept counts per hour up to date after a load that touched `days`; returns them.

    Reads those days of the fact and the counts, a row per hour, and publishes a new version, so
    the cost of the hour ledger follows the load and not the history.
    """
    held = store.read(HOURS)
    fresh = counts_of_days(store.read(FACT), days)
    other = held.filter(~F.col("date_day").isin(*days)) if days else held
    build = store.build()
    counts = build.write(HOURS, other.unionByName(fresh).coalesce(1))
    build.publish()
    return counts


def refresh(
    spark: SparkSession, player_counts: DataFrame, root: str, since: date, days: int = 7
) -> None:
    """Rebuild both facts under `root` from `since` on, and the counts per hour where the store
    keeps them; `since` is the earliest day that new rows touch. `player_counts` has its `dt`
    partition column, so earlier days are not read.

    Whole days without rows before `since` are filled in as well: the dense fact is rebuilt from
    the day after its last one, however long ago that is. Raises if the dense fact is empty while
    the hourly fact has days before `since`, as nothing says what was known by then.
    """
    store = Store(spark, root)
    fact_path, trend_path = store.path(FACT), store.path(TRENDS)
    fact_schema = spark.read.parquet(fact_path).schema
    trend_schema = spark.read.parquet(trend_path).schema
    recent = player_counts.filter(F.col("dt") >= F.lit(since))
    fresh = fact_native(normalize_observations(recent, carry=()))
    write_days(fresh, fact_path)

    fact = spark.read.schema(fact_schema).parquet(fact_path)
    dense = spark.read.schema(trend_schema).parquet(trend_path)
    reached = dense.agg(F.max("date_day")).first()[0]
    if reached is None and not fact.filter(F.col("date_day") < F.lit(since)).isEmpty():
        raise ValueError(f"{TRENDS} is empty but {FACT} has days before {since}")
    start = since if reached is None else min(since, reached + timedelta(days=1))
    changed = fact.filter(F.col("date_day") >= F.lit(start))
    first_kept = F.lit(start - timedelta(days=days))
    before = (
        dense.filter(F.col("date_day").between(first_kept, F.lit(start - timedelta(days=1))))
        .select(
            "app_id",
            "date_day",
            "avg_player_count",
            "peak_player_count",
            "observed_hours",
            F.col("peak_player_count_record").alias("known_record"),
            F.col("last_record_day").alias("known_record_day"),
        )
    )
    known = before.unionByName(daily_rollup(changed), allowMissingColumns=True)
    last_day = fact.agg(F.max("date_day"))
    rebuilt = trends(stretches(known, last_day), days).filter(F.col("date_day") >= F.lit(start))
    # The days written are not among the days read, and a dynamic overwrite replaces files only
    # when the whole job has succeeded.
    write_days(rebuilt, trend_path)
    if HOURS in store.current()[1]:
        touched = fresh.select("date_day").distinct().collect()  # a value per calendar day
        refresh_hour_counts(store, [r.date_day for r in touched])
