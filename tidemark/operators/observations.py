"""The native fact: one value per entity and hour, gaps absent."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LINEAGE = ("s3_key", "loaded_at", "observed_at")


def normalize_observations(raw: DataFrame, carry: Sequence[str] = LINEAGE) -> DataFrame:
    """Truncate to the hour and keep the earliest observation of each entity-hour.

    `raw` is unique on (app_id, logical_hour), which the loader guarantees. Taking the minimum
    is an aggregate, not a ranked window, so copies are folded before the shuffle and one hot
    entity does not fill a task. With `carry=()` every buffer is fixed-width and the plan is a
    hash aggregate; carrying text columns along costs a sort.
    """
    hour = F.date_trunc("hour", "logical_hour").alias("logical_hour")
    grouped = raw.groupBy("app_id", hour)
    if not carry:
        return grouped.agg(F.min_by("player_count", "logical_hour").alias("player_count"))
    kept = ["player_count", *carry]
    first = F.min_by(F.struct(*kept), "logical_hour").alias("first")
    return grouped.agg(first).select("app_id", "logical_hour", *[f"first.{c}" for c in kept])


def fact_native(observations: DataFrame) -> DataFrame:
    """The hourly fact: day and hour of day derived, lineage dropped."""
    return observations.select(
        "app_id",
        F.to_date("logical_hour").alias("date_day"),
        "logical_hour",
        F.hour("logical_hour").alias("hour_of_day"),
        "player_count",
    )


def latest_per_entity(fact: DataFrame) -> DataFrame:
    """Each entity's own latest hour and the value in it."""
    return fact.groupBy("app_id").agg(
        F.max("logical_hour").alias("logical_hour"),
        F.max_by("player_count", "logical_hour").alias("player_count"),
    )


def within_staleness(
    rows: DataFrame, hours: int = 2, latency: str | None = "latency_ms"
) -> DataFrame:
    """Drop an observation whose call began more than `hours` after its logical time.

    `observed_at` is the clock after the call, so the latency is taken off first. Exactly
    `hours` late is kept. A row without `observed_at` cannot be shown to be late and is kept.
    """
    begun = F.unix_micros("observed_at")
    if latency:
        begun = begun - F.coalesce(F.col(latency), F.lit(0)).cast("bigint") * 1000
    late_by = begun - F.unix_micros("logical_date")
    return rows.filter(F.coalesce(late_by <= hours * 3_600_000_000, F.lit(True)))


def classify_responses(responses: DataFrame) -> DataFrame:
    """Give every answered call a status: observed, or unobservable when the source refused it.

    A response that was not refused but has no count is an error, never a zero.
    """
    refused = F.col("http_status") == 404
    count = F.coalesce(
        F.col("player_count"),
        F.when(
            ~refused,
            F.raise_error(F.concat(F.lit("no player_count for "), F.col("app_id"))).cast("int"),
        ),
    )
    status = F.when(refused, "unobservable").otherwise("observed")
    return responses.withColumns({"status": status, "player_count": count}).drop("http_status")
