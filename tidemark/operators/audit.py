"""Bundling a run's rows into documents, opening documents again, and the records of both runs."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators.merge import first_per_key
from tidemark.sources.landing import player_counts_key

# Counters a rerun finds already spent: their first recorded value is the true one.
TRANSITION_COUNTS = ("newly_tracked_count", "reactivated_count", "deactivated_count")


def bundle(rows: DataFrame, tracked: DataFrame, max_rows: int = 50_000) -> DataFrame:
    """One nested document per run: `tracked` is (logical_date, tracked_count), `rows` its answers.

    An entity is asked once per run, so each (logical_date, app_id) is kept once. A run with more
    than `max_rows` answers, counted and not as reported, becomes several documents, divided by a
    hash of the entity, so that no task ever holds a list that grows with the universe. A run
    without answers still has a document, with empty lists; answers of a run that is not in
    `tracked` raise, as they would be lost.
    """
    asked_once = first_per_key(rows, ["logical_date", "app_id"], "observed_at")
    answers = asked_once.groupBy("logical_date").agg(F.count(F.lit(1)).alias("answers"))
    sized = answers.join(
        tracked.select("logical_date", F.lit(True).alias("known")), "logical_date", "left"
    )
    unknown = F.concat(F.lit("answers of an untracked run: "), F.col("logical_date").cast("string"))
    parts = F.when(F.col("known"), F.ceil(F.col("answers") / max_rows)).otherwise(
        F.raise_error(unknown).cast("long")
    )
    placed = asked_once.join(sized, "logical_date").withColumn(
        "part", F.pmod(F.xxhash64("app_id"), parts).cast("int")
    )
    seen = F.col("status") == "observed"

    def members(schema, when: Column) -> Column:
        row = F.struct(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
        return F.array_sort(F.collect_list(F.when(when, row)))

    documents = placed.groupBy("logical_date", "part").agg(
        members(schemas.OBSERVED, seen).alias("observed"),
        members(schemas.UNOBSERVABLE, ~seen).alias("unobservable"),
    )
    return tracked.join(documents, "logical_date", "left").select(
        "logical_date",
        F.coalesce("part", F.lit(0)).alias("part"),
        F.col("tracked_count").cast("int").alias("tracked_count"),
        F.coalesce("observed", F.array().cast(schemas.BUNDLE["observed"].dataType)).alias(
            "observed"
        ),
        F.coalesce("unobservable", F.array().cast(schemas.BUNDLE["unobservable"].dataType)).alias(
            "unobservable"
        ),
    )


def document_key(bundles: DataFrame) -> Column:
    """Where a document is, as far as the frame knows it."""
    return F.col("s3_key") if "s3_key" in bundles.columns else player_counts_key(
        F.col("logical_date")
    )


def bundle_rows(bundles: DataFrame) -> DataFrame:
    """The observed rows of bundles, as rows of the hourly raw table plus their position.

    Bundles that were read from the landing zone hand on the path of their document; bundles that
    have not landed get the key of their interval. A row without a count stops the load: it must
    never pass as zero or vanish.
    """
    observed = bundles.select(
        document_key(bundles).alias("s3_key"),
        F.posexplode("observed").alias("position", "row"),
    )
    count = F.coalesce(
        F.col("row.player_count"),
        F.raise_error(F.concat(F.lit("no player_count in "), "s3_key")).cast("int"),
    )
    return observed.select(
        F.col("row.app_id").alias("app_id"),
        count.alias("player_count"),
        F.col("row.logical_date").alias("logical_hour"),
        F.col("row.observed_at").alias("observed_at"),
        "s3_key",
        "position",
        F.col("row.latency_ms").alias("latency_ms"),
    )


def unobservable_rows(bundles: DataFrame) -> DataFrame:
    """The entities each run could not observe, one row each."""
    return bundles.select(
        "logical_date", F.explode("unobservable.app_id").alias("app_id")
    )


def document_summary(bundles: DataFrame) -> DataFrame:
    """What the documents of a run say together, without opening them into rows.

    A run that says nothing about unobservable entities has a NULL list, not an empty one.
    """
    ids = F.transform("unobservable", lambda row: row["app_id"])
    return bundles.groupBy("logical_date").agg(
        F.max("tracked_count").alias("tracked_count"),
        F.sum(F.size("observed")).cast("int").alias("observed_count"),
        F.when(F.count("unobservable") > 0, F.array_sort(F.flatten(F.collect_list(ids)))).alias(
            "unobservable_app_ids"
        ),
        F.min(document_key(bundles)).alias("s3_key"),
    )


def run_measures(bundles: DataFrame) -> DataFrame:
    """Counts and latencies per run, over all of its documents.

    The median is exact, halves rounded to even, over observed rows only. Its state is one
    counter per distinct millisecond value, so it merges before the shuffle.
    """
    opened = bundles.select(
        "logical_date",
        "tracked_count",
        F.size("observed").alias("observed"),
        F.when(F.col("unobservable").isNotNull(), F.size("unobservable")).alias("unobservable"),
        F.posexplode_outer("observed.latency_ms").alias("position", "latency_ms"),
    )
    once = F.coalesce(F.col("position"), F.lit(0)) == 0
    return opened.groupBy("logical_date").agg(
        F.max("tracked_count").alias("tracked_count"),
        F.sum(F.when(once, F.col("observed"))).cast("int").alias("observed_count"),
        F.sum(F.when(once, F.col("unobservable"))).cast("int").alias("unobservable_count"),
        F.bround(F.median("latency_ms"), 0).cast("int").alias("latency_p50_ms"),
        F.max("latency_ms").alias("latency_max_ms"),
    )


def audit_snapshot_runs(
    runs: DataFrame, bundles: DataFrame, player_counts: DataFrame, as_of: datetime
) -> DataFrame:
    """One row of `schemas.SNAPSHOT_RUNS` per run in `runs` (run_id, logical_hour), whatever
    became of the run.

    `loaded_count` is counted from the table at the run's exact time, not taken from the load.
    A run without a document keeps its identity and that count, and NULL for the rest. Who was
    unobservable is a list in the table's row, NULL where the documents do not say and empty where
    there was nobody; `unobservable_rows` has the same ids as rows. The key is that of the run's
    document, the first by name if there are several.
    """
    loaded = (
        player_counts.join(runs.select("logical_hour").distinct(), "logical_hour", "left_semi")
        .groupBy("logical_hour")
        .agg(F.count(F.lit(1)).cast("int").alias("loaded_count"))
    )
    measured = run_measures(bundles).select(
        F.col("logical_date").alias("logical_hour"), "latency_p50_ms", "latency_max_ms"
    )
    said = document_summary(bundles).withColumnRenamed("logical_date", "logical_hour")
    return (
        runs.select("run_id", "logical_hour")
        .join(said, "logical_hour", "left")
        .join(measured, "logical_hour", "left")
        .join(loaded, "logical_hour", "left")
        .select(
            "run_id",
            "logical_hour",
            "tracked_count",
            "observed_count",
            "unobservable_app_ids",
            F.coalesce("loaded_count", F.lit(0)).alias("loaded_count"),
            "latency_p50_ms",
            "latency_max_ms",
            "s3_key",
            F.lit(as_of).cast("timestamp").alias("recorded_at"),
        )
    )


def details_latency(details: DataFrame) -> DataFrame:
    """Latencies of a catalog run's storefront answers, per run: what the hourly record has, and
    the catalog's record lacks.

    Columns `logical_date`, `answers`, `latency_p50_ms` (exact, halves rounded to even) and
    `latency_max_ms`, both NULL where no answer says. The median's state is one counter per
    distinct millisecond value, so it merges before the shuffle.
    """
    return details.groupBy("logical_date").agg(
        F.count(F.lit(1)).alias("answers"),
        F.bround(F.median("latency_ms"), 0).cast("int").alias("latency_p50_ms"),
        F.max("latency_ms").alias("latency_max_ms"),
    )


def audit_catalog_run(
    runs: DataFrame,
    universe: DataFrame | None,
    metadata: DataFrame | None,
    as_of: datetime,
) -> DataFrame:
    """The record of a catalog run. `runs` is one row: run_id, logical_date and the two keys.

    `universe` and `metadata` are the one-row audits of the two steps; a step that did not run
    is None and leaves its columns NULL. Write it with `upsert(..., first_non_null=
    TRANSITION_COUNTS)`, since a rerun finds the transitions already made.
    """
    held = runs
    for name, audit in (("universe", universe), ("metadata", metadata)):
        if audit is not None:
            held = held.withColumn(name, audit.select(F.struct("*")).scalar())

    def of(step: str, audit: DataFrame | None, column: str) -> Column:
        dtype = schemas.CATALOG_RUNS[column].dataType
        value = F.lit(None) if audit is None else F.col(f"{step}.{column}")
        return value.cast(dtype).alias(column)

    return held.select(
        "run_id",
        "logical_date",
        of("universe", universe, "app_list_count"),
        of("universe", universe, "chart_count"),
        of("universe", universe, "skipped_chart_app_ids"),
        of("universe", universe, "newly_tracked_count"),
        of("universe", universe, "reactivated_count"),
        of("metadata", metadata, "deactivated_count"),
        of("metadata", metadata, "no_metadata_app_ids"),
        of("metadata", metadata, "metadata_upserted_count"),
        "app_list_key",
        "most_played_key",
        F.lit(as_of).cast("timestamp").alias("recorded_at"),
    )
