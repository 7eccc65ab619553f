"""Checks kept by day against checks of whole tables."""

from __future__ import annotations

from dataclasses import replace
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tests.support import day, plan_of, rows
from tests.test_model import CALENDAR, LAST, START, raw  # noqa: F401
from tidemark.operators import checks as ck
from tidemark.plans import check_states, model
from tidemark.sources.sinks import write_days
from tidemark.sources.versions import Store

DAYS = [(START + timedelta(days=d)).date() for d in range(20)]


@pytest.fixture(scope="module")
def built(spark, raw, tmp_path_factory):  # noqa: F811
    return model.build(spark, raw, LAST, str(tmp_path_factory.mktemp("model")), CALENDAR)


def broken(spark, built, folder, days):
    """The model with facts in which some days have violations of every kind, kept by day."""
    on = F.col("date_day").isin(*days)
    odd = on & (F.col("app_id") == 3)
    fact = built.fct_player_counts
    hours = fact.withColumn(
        "player_count", F.when(odd, -F.col("player_count") - 1).otherwise(F.col("player_count"))
    ).withColumn("app_id", F.when(on & (F.col("app_id") == 4), None).otherwise(
        F.when(on & (F.col("app_id") == 5), 77).otherwise(F.col("app_id"))))
    hours = hours.unionByName(fact.filter(on & (F.col("app_id") == 1)))
    trends = built.fct_player_trends_daily
    trends = trends.withColumn("observed_hours", F.when(odd, 25).otherwise(F.col("observed_hours")))
    trends = trends.withColumn("days_since_peak", F.when(odd, -1).otherwise(F.col("days_since_peak")))
    trends = trends.unionByName(trends.filter(on & (F.col("app_id") == 2)))
    frames = {}
    for name, frame in (("fct_player_counts", hours), ("fct_player_trends_daily", trends)):
        write_days(frame, f"{folder}/{name}", whole=True)
        frames[name] = spark.read.schema(frame.schema).parquet(f"{folder}/{name}").select(
            *frame.columns)
    daily = frames["fct_player_trends_daily"].select(*built.fct_player_counts_daily.columns)
    return replace(built, fct_player_counts_daily=daily, **frames)


def counts(frame):
    return {r["check"]: r["violations"] for r in frame.collect()}


def test_states_equal_whole_checks_after_a_refresh(spark, raw, built, tmp_path):  # noqa: F811
    store = Store(spark, str(tmp_path))
    before = broken(spark, built, f"{tmp_path}/one", DAYS[14:16])
    first = counts(check_states.incremental_checks(before, raw, LAST, store))
    assert first == counts(ck.summarize(model.model_checks(before, raw, LAST)))
    failed = {name for name, n in first.items() if n}
    assert {"fct_player_counts.grain", "fct_player_counts.non_negative",
            "fct_player_counts.app_id.not_null", "fct_player_counts.app_id.known",
            "fct_player_trends_daily.contract", "fct_player_trends_daily.grain",
            "fct_player_counts_daily.contract", "fct_player_counts_daily.grain"} <= failed
    # One of the days is mended, another breaks: only these two are read again.
    after = broken(spark, built, f"{tmp_path}/two", [DAYS[15], DAYS[17]])
    got = counts(check_states.incremental_checks(after, raw, LAST, store, [DAYS[14], DAYS[17]]))
    assert got == counts(ck.summarize(model.model_checks(after, raw, LAST)))
    assert got["fct_player_counts.grain"] != 0


def test_only_the_days_of_a_refresh_are_read(spark, raw, built):  # noqa: F811
    of_facts, others = check_states.split(model.model_checks(built, raw, LAST))
    assert {c.name.split(".")[0] for c in of_facts} == set(check_states.FACTS)
    assert not {c.name for c in of_facts} & {c.name for c in others}
    plan = plan_of(check_states.day_states(of_facts, [DAYS[2]]))
    scans = [x for x in plan.split("\n") if "FileScan" in x and "fct_" in x]
    assert scans and all("date_day#" in x.split("PartitionFilters: ")[1][:200] for x in scans)
    assert all(f"{DAYS[2]}" in x or "20" in x.split("PartitionFilters: ")[1][:300] for x in scans)


def test_a_reference_whose_parent_came_later_is_no_violation(spark, raw, built, tmp_path):  # noqa: F811
    store = Store(spark, str(tmp_path))
    less = replace(built, dim_game=built.dim_game.filter("app_id <> 5"))
    of_facts, _ = check_states.split(model.model_checks(less, raw, LAST))
    lacking = counts(check_states.summarize_states(
        of_facts, check_states.refresh_states(store, of_facts)))
    assert lacking["fct_player_counts.app_id.known"] > 0
    of_facts, _ = check_states.split(model.model_checks(built, raw, LAST))
    states = check_states.refresh_states(store, of_facts, [DAYS[-1]])
    assert states.filter("reference = '5'").count() > 0
    assert counts(check_states.summarize_states(of_facts, states))[
        "fct_player_counts.app_id.known"] == 0


def test_no_days_and_rows_without_a_day(spark, raw, built):  # noqa: F811
    of_facts, _ = check_states.split(model.model_checks(built, raw, LAST))
    assert check_states.day_states(of_facts, []).collect() == []
    lost = built.fct_player_counts.withColumn(
        "date_day", F.when(F.col("app_id") != 6, F.col("date_day")))
    worse = replace(built, fct_player_counts=lost)
    of_facts, _ = check_states.split(model.model_checks(worse, raw, LAST))
    found = check_states.day_states(of_facts, [day("2026-09-03")])
    assert ("fct_player_counts.date_day.not_null",) in rows(found.filter("date_day is null"), "check")
