"""Statuses of hours."""

from __future__ import annotations

from tests.support import at, rows
from tidemark.operators import checks
from tidemark.operators.ledger import (
    high_water_mark,
    hour_ledger,
    missing_hours,
    normalize_catalog_runs,
    normalize_runs,
)
from tidemark.operators.reports import status_grid

RUNS = (
    "run_id string, logical_hour timestamp, tracked_count int, observed_count int, "
    "unobservable_app_ids array<bigint>, loaded_count int, latency_p50_ms int, "
    "latency_max_ms int, s3_key string, recorded_at timestamp"
)


def run(run_id, hour, tracked, observed, ids, loaded, recorded="2026-09-02T00:00:00"):
    return (
        run_id, at(hour), tracked, observed, ids, loaded, None, None, None, at(recorded),
    )


def observed(spark, *hours, n=1):
    return spark.createDataFrame(
        [(i, at(h), 1) for h in hours for i in range(n)],
        "app_id bigint, logical_hour timestamp, player_count int",
    )


def ledger(spark, runs, observations, as_of):
    return hour_ledger(normalize_runs(spark.createDataFrame(runs, RUNS)), observations, at(as_of))


def test_statuses(spark):
    runs = [
        run("complete", "2026-09-01T02:00:00", 106, 105, [7], 105),
        run("killed load", "2026-09-01T03:00:00", 106, 105, [7], 0),
        run("nothing recorded", "2026-09-01T04:07:00", None, None, None, 0),
        run("null list", "2026-09-01T05:00:00", 105, 105, None, 105),
        run("before the spine", "2026-08-31T05:00:00", 1, 1, [], 1),
    ]
    seen = observed(spark, "2026-09-01T00:00:00", "2026-09-01T02:00:00", "2026-09-01T05:00:00")
    got = ledger(spark, runs, seen, "2026-09-01T05:30:00")
    assert rows(got, "logical_hour", "status", "has_observations", "failed_count") == [
        (at("2026-09-01T00:00:00"), "unaudited", True, None),
        (at("2026-09-01T01:00:00"), "unrecorded", False, None),
        (at("2026-09-01T02:00:00"), "complete", True, 0),
        (at("2026-09-01T03:00:00"), "ran_short", False, 0),
        (at("2026-09-01T04:00:00"), "ran_short", False, None),
        (at("2026-09-01T05:00:00"), "ran_short", True, None),
    ]
    assert rows(high_water_mark(got)) == [(at("2026-09-01T02:00:00"),)]
    assert [r[1] for r in rows(missing_hours(got))] == ["unrecorded", "ran_short", "ran_short"]
    assert checks.ledger_not_dense(got).count() == 0
    assert checks.breaches(got, checks.LEDGER_CONTRACT).count() == 0


def test_later_record_of_the_hour_wins(spark):
    runs = [
        run("a", "2026-09-01T00:00:00", 2, 2, [], 2, "2026-09-01T00:10:00"),
        run("b", "2026-09-01T00:05:00", 2, 1, [], 1, "2026-09-01T00:20:00"),
    ]
    got = ledger(spark, runs, observed(spark, "2026-09-01T00:00:00"), "2026-09-01T00:00:00")
    assert rows(got, "run_id", "status") == [("b", "ran_short")]


def test_without_a_complete_hour_the_mark_is_null_everywhere(spark):
    got = ledger(spark, [], observed(spark, "2026-09-01T00:00:00"), "2026-09-01T02:00:00")
    assert rows(got, "is_high_water_mark") == [(None,)] * 3
    assert checks.ledger_not_dense(got).count() == 1


def test_nothing_observed_is_an_empty_ledger(spark):
    runs = [run("a", "2026-09-01T00:00:00", 2, 2, [], 2)]
    assert ledger(spark, runs, observed(spark), "2026-09-01T02:00:00").count() == 0


def test_null_list_is_not_an_empty_list(spark):
    runs = [
        run("a", "2026-09-01T00:59:00", 5, 3, [1, 2], 3),
        run("b", "2026-09-01T00:00:00", 5, 3, [], 3),
        run("c", "2026-09-01T00:00:00", 5, 3, None, 3),
    ]
    got = normalize_runs(spark.createDataFrame(runs, RUNS))
    assert rows(got, "run_id", "logical_hour", "unobservable_count", "failed_count") == [
        ("a", at("2026-09-01T00:00:00"), 2, 0),
        ("b", at("2026-09-01T00:00:00"), 0, 2),
        ("c", at("2026-09-01T00:00:00"), None, None),
    ]
    lists = spark.createDataFrame(
        [("a", [1], None), ("b", [], [1, 2])],
        "run_id string, skipped_chart_app_ids array<bigint>, no_metadata_app_ids array<bigint>",
    )
    assert rows(
        normalize_catalog_runs(lists), "run_id", "skipped_chart_count", "no_metadata_count"
    ) == [("a", 1, None), ("b", 0, 2)]


def test_grid_has_a_column_per_hour(spark):
    seen = observed(spark, "2026-09-01T01:00:00")
    got = status_grid(ledger(spark, [], seen, "2026-09-02T00:00:00")).orderBy("day")
    first, second = got.collect()
    assert (first["h00"], first["h01"], first["h23"]) == (None, "unaudited", "unrecorded")
    assert (second["h00"], second["h01"]) == ("unrecorded", None)
