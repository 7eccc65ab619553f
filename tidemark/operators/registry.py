"""The registry of entities: who is admitted, who is active, and the dimension built on it."""

from __future__ import annotations

from datetime import datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators.merge import absent_rows, flag_changes, set_flag, upsert


class Admission(NamedTuple):
    """The candidates, each with a verdict, and the two halves of them."""

    judged: DataFrame

    @property
    def admitted(self) -> DataFrame:
        return self.judged.filter("is_admitted").select("app_id", "name", "source")

    @property
    def refused(self) -> DataFrame:
        return self.judged.filter(~F.col("is_admitted")).select("app_id")


class Step(NamedTuple):
    """A state after a step, and the step's one-row audit."""

    state: DataFrame
    audit: DataFrame


class MetadataStep(NamedTuple):
    metadata: DataFrame
    registry: DataFrame
    audit: DataFrame


def normalize_registry(registry: DataFrame) -> DataFrame:
    return registry.select(
        "app_id",
        F.col("name").alias("app_name"),
        F.col("source").alias("tracked_source"),
        "tracked_from",
        "is_active",
    )


def active_ids(registry: DataFrame) -> DataFrame:
    """Ids to observe, in order. An empty registry is an error, not an empty run.

    The test looks for one row, so it reads no more than it must.
    """
    active = registry.filter("is_active").select("app_id")
    if active.isEmpty():
        raise RuntimeError("no active entity is registered: refresh the catalog first")
    return active.orderBy("app_id")


def admit(seed: DataFrame, chart: DataFrame, app_list: DataFrame) -> Admission:
    """Who may be tracked: every seed id, and every chart id that the app list knows.

    A seed id keeps source `seed` even if it also charts, and a placeholder name if the list
    lacks it. Repeated list entries resolve to the last one; `app_list` is (app_id, name,
    position). The list is cut to the candidates before anything is grouped.
    """
    chosen = seed.select("app_id").distinct().withColumn("source", F.lit("seed"))
    charted = (
        chart.select("app_id")
        .distinct()
        .join(seed.select("app_id"), "app_id", "left_anti")
        .withColumn("source", F.lit("chart"))
    )
    candidates = chosen.unionByName(charted)
    names = (
        app_list.join(candidates.select("app_id"), "app_id", "left_semi")
        .groupBy("app_id")
        .agg(F.max_by(F.struct("name"), "position").alias("listed"))
    )
    listed = F.col("listed").isNotNull()
    name = F.when(listed, F.col("listed.name")).otherwise(schemas.UNLISTED_NAME)
    judged = candidates.join(names, "app_id", "left").select(
        "app_id",
        name.alias("name"),
        "source",
        (listed | (F.col("source") == "seed")).alias("is_admitted"),
    )
    return Admission(judged)


def _sorted_ids(ids: DataFrame, name: str) -> Column:
    """Ids as one sorted list. Only for subsets of a chart, whose length the source fixes."""
    return ids.agg(F.array_sort(F.collect_list("app_id"))).scalar().alias(name)


def _count(rows: DataFrame, name: str, what: Column | None = None) -> Column:
    what = F.count(F.lit(1)) if what is None else what
    return rows.agg(what.cast("int")).scalar().alias(name)


def registry_step(
    registry: DataFrame,
    admission: Admission,
    chart: DataFrame,
    app_list: DataFrame,
    as_of: datetime,
) -> Step:
    """Add admitted entities that are new and reactivate inactive ones that chart.

    Nobody is removed, and an entity already known keeps its name and source.
    """
    arrivals = absent_rows(admission.admitted, registry, ["app_id"], ["source"]).withColumns(
        {"tracked_from": F.lit(as_of).cast("timestamp"), "is_active": F.lit(True)}
    )
    grown = registry.unionByName(arrivals.select(*registry.columns))
    # One pass over the candidates, who are as few as the chart and the seed.
    known = registry.select("app_id", F.lit(True).alias("known"))
    admitted = F.col("is_admitted")
    verdicts = admission.judged.join(known, "app_id", "left").agg(
        F.array_sort(F.collect_list(F.when(~admitted, F.col("app_id")))).alias("refused"),
        F.count_if(admitted & F.col("known").isNull()).cast("int").alias("new"),
    )
    audit = verdicts.select(
        _count(app_list, "app_list_count", F.count_distinct("app_id")),
        _count(chart, "chart_count"),
        F.col("refused").alias("skipped_chart_app_ids"),
        F.col("new").alias("newly_tracked_count"),
        _count(flag_changes(registry, chart, True), "reactivated_count"),
    )
    return Step(set_flag(grown, chart, True), audit)


def metadata_step(
    metadata: DataFrame,
    registry: DataFrame,
    details: DataFrame,
    chart: DataFrame,
    as_of: datetime,
) -> MetadataStep:
    """Store what the details calls brought; `details` is (app_id, success, data).

    A failed entity is deactivated only if it is also off the chart; one still charting stays
    active and is listed. `first_loaded_at` survives an update. Of several answers for an id one
    is stored, the first by its text, and an id with an answer has not failed.
    """
    now = F.lit(as_of).cast("timestamp")
    answered = (
        details.filter("success")
        .groupBy("app_id")
        .agg(F.min_by("data", F.col("data").cast("string")).alias("data"))
        .select("app_id", "data", now.alias("first_loaded_at"), now.alias("updated_at"))
    )
    outcome = details.groupBy("app_id").agg(F.bool_or("success").alias("success"))
    failed = outcome.filter(~F.col("success")).select("app_id")
    charting = failed.join(chart.select("app_id"), "app_id", "left_semi")
    gone = failed.join(chart.select("app_id"), "app_id", "left_anti")
    audit = metadata.sparkSession.range(1).select(
        _count(answered, "metadata_upserted_count"),
        _sorted_ids(charting, "no_metadata_app_ids"),
        _count(flag_changes(registry, gone, False), "deactivated_count"),
    )
    return MetadataStep(
        upsert(metadata, answered, ["app_id"], keep=["first_loaded_at"]),
        set_flag(registry, gone, False),
        audit,
    )


def evidence_runs(runs: DataFrame, n: int) -> DataFrame:
    """The last n runs that say something about who is unobservable.

    A run that recorded no list, or that observed nothing, is no evidence. Records are counted,
    not hours: two runs in one hour are two. Equal hours are ordered by recording, then run.
    """
    return (
        runs.filter(F.col("unobservable_count").isNotNull() & (F.col("observed_count") > 0))
        .orderBy(F.desc("logical_hour"), F.desc("recorded_at"), F.desc("run_id"))
        .limit(n)
    )


def listed_ids(runs: DataFrame) -> DataFrame:
    """(run_id, app_id) rows from runs that hold the ids as a list."""
    return runs.select("run_id", F.explode("unobservable_app_ids").alias("app_id"))


def always_unobservable(
    runs: DataFrame, unobservable: DataFrame, n: int = schemas.KNOWN_UNOBSERVABLE_HOURS
) -> DataFrame:
    """Entities listed in every one of the last n evidence runs.

    With fewer than n such runs there is nobody. An id repeated within a run counts each time.
    """
    recent = evidence_runs(runs, n).select("run_id")
    return (
        unobservable.join(recent, "run_id")
        .groupBy("app_id")
        .agg(F.count(F.lit(1)).alias("listings"))
        .filter(F.col("listings") == n)
        .select("app_id")
    )


def dim_entity(
    registry: DataFrame,
    metadata: DataFrame,
    runs: DataFrame,
    unobservable: DataFrame,
    n: int = schemas.KNOWN_UNOBSERVABLE_HOURS,
) -> DataFrame:
    """One row per entity ever tracked, with its current metadata and the unobservable flag.

    `registry`, `metadata` and `runs` are normalized; `unobservable` is (run_id, app_id). The
    metadata name wins over the registry name, which is the fallback.
    """
    flagged = always_unobservable(runs, unobservable, n).withColumn("listed", F.lit(True))
    described = metadata.withColumnRenamed("app_name", "described_name")
    return (
        registry.join(described, "app_id", "left")
        .join(flagged, "app_id", "left")
        .select(
            "app_id",
            F.coalesce("described_name", "app_name").alias("app_name"),
            "app_type",
            "app_description",
            "release_date",
            "genre_names",
            "required_age",
            "is_free",
            "is_windows",
            "is_mac",
            "is_linux",
            "metacritic_score",
            "achievement_count",
            "recommendation_count",
            "price_initial_usd",
            "price_final_usd",
            "tracked_source",
            "tracked_from",
            "is_active",
            F.col("listed").isNotNull().alias("is_unobservable"),
        )
    )
