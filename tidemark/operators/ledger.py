"""Run records, and the ledger that gives every hour a status."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.sources.spines import days_of, hours_between


def _length(ids: str) -> Column:
    """Length of a list; NULL for a NULL list whatever the session's legacy settings."""
    return F.when(F.col(ids).isNotNull(), F.size(ids))


def normalize_runs(runs: DataFrame) -> DataFrame:
    """Truncate the hour and derive what the record does not store.

    A run that recorded nothing about who was missing has a NULL list, and both derived counts
    are then NULL.
    """
    return runs.withColumn("unobservable_count", _length("unobservable_app_ids")).withColumns(
        {
            "logical_hour": F.date_trunc("hour", "logical_hour"),
            "failed_count": F.col("tracked_count")
            - F.col("observed_count")
            - F.col("unobservable_count"),
        }
    )


def normalize_catalog_runs(runs: DataFrame) -> DataFrame:
    """Add the sizes of the two id lists, NULL where the list is."""
    return runs.withColumns(
        {
            "skipped_chart_count": _length("skipped_chart_app_ids"),
            "no_metadata_count": _length("no_metadata_app_ids"),
        }
    )


def latest_run_per_hour(runs: DataFrame) -> DataFrame:
    """The last recorded run of each hour; run_id decides between equal clocks."""
    newest = F.max_by(F.struct("*"), F.struct("recorded_at", "run_id")).alias("run")
    return runs.groupBy("logical_hour").agg(newest).select("run.*")


def hour_status() -> Column:
    """First match wins, and a NULL anywhere in the third test falls through to ran_short."""
    complete = (
        (F.col("failed_count") == 0)
        & (F.col("loaded_count") == F.col("observed_count"))
        & (F.col("observed_count") > 0)
    )
    return (
        F.when(F.col("run_id").isNull() & F.col("snapshot_rows").isNotNull(), "unaudited")
        .when(F.col("run_id").isNull(), "unrecorded")
        .when(complete, "complete")
        .otherwise("ran_short")
    )


def hour_counts(observations: DataFrame) -> DataFrame:
    """(logical_hour, snapshot_rows) of deduplicated observations: all the ledger needs of them.

    Counts of whole hours merge by replacement, so a kept table of them follows the hours that a
    load touched and never reads the others again.
    """
    return observations.groupBy("logical_hour").agg(F.count(F.lit(1)).alias("snapshot_rows"))


def hour_ledger(runs: DataFrame, observations: DataFrame, as_of: datetime | Column) -> DataFrame:
    """The ledger of hours, from `normalize_runs` and deduplicated observations."""
    return ledger_of_counts(runs, hour_counts(observations), as_of)


def ledger_of_counts(
    runs: DataFrame, counted: DataFrame, as_of: datetime | Column
) -> DataFrame:
    """One row per hour from the first observation to `as_of`, each with a status.

    `runs` comes from `normalize_runs` and `counted` from `hour_counts`, so there is at most one
    row per hour of each. Runs dated before the first observation fall outside. The high-water
    mark is the latest complete hour; with none it is NULL on every row.
    """
    spine = hours_between(counted.agg(F.min("logical_hour")), as_of, "logical_hour")
    classified = (
        spine.join(counted, "logical_hour", "left")
        .join(latest_run_per_hour(runs), "logical_hour", "left")
        .withColumns(
            {"has_observations": F.col("snapshot_rows").isNotNull(), "status": hour_status()}
        )
    )
    mark = classified.filter(F.col("status") == "complete").agg(F.max("logical_hour"))
    return classified.select(
        "logical_hour",
        "status",
        "has_observations",
        (F.col("logical_hour") == mark.scalar()).alias("is_high_water_mark"),
        "tracked_count",
        "observed_count",
        "unobservable_count",
        "failed_count",
        "loaded_count",
        "snapshot_rows",
        "latency_p50_ms",
        "latency_max_ms",
        "run_id",
        "recorded_at",
    )


def missing_hours(ledger: DataFrame) -> DataFrame:
    """Hours for which nothing was observed, with the reason on record."""
    return ledger.filter(~F.col("has_observations")).select(
        "logical_hour", "status", "has_observations"
    )


def high_water_mark(ledger: DataFrame) -> DataFrame:
    """The latest complete hour, as one row, or none."""
    return ledger.filter("is_high_water_mark").select("logical_hour")


def catalog_days(runs: DataFrame, as_of: datetime | Column) -> DataFrame:
    """One row per day from the first catalog run to `as_of`, with the day's last record.

    Columns `date_day`, `is_recorded`, `run_id`, `recorded_at`, `app_list_count`, `chart_count`,
    `newly_tracked_count` and `attempts`. A day on which no run left a record is there with
    `is_recorded` false: nothing else would notice it. `runs` has the columns of the raw table.
    """
    kept = F.struct("run_id", "recorded_at", "app_list_count", "chart_count", "newly_tracked_count")
    by_day = runs.groupBy(F.to_date("logical_date").alias("date_day")).agg(
        F.max_by(kept, F.struct("recorded_at", "run_id")).alias("run"),
        F.count(F.lit(1)).alias("attempts"),
    )
    spine = days_of(by_day.agg(F.min("date_day")), as_of, "date_day")
    return spine.join(by_day, "date_day", "left").select(
        "date_day",
        F.col("run").isNotNull().alias("is_recorded"),
        "run.*",
        F.coalesce("attempts", F.lit(0)).alias("attempts"),
    )
