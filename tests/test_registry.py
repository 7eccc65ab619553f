"""Admission, registry and metadata steps, and the dimension."""

from __future__ import annotations

import json

import pytest

from tests.support import at, rows
from tidemark import schemas
from tidemark.operators import audit, merge, registry
from tidemark.operators.checks import unflagged_unobservable
from tidemark.operators.ledger import normalize_runs
from tidemark.operators.metadata import extract_metadata, unwrap_details
from tidemark.sources.tables import seed_frame

NOW, LATER = at("2026-09-10T00:00:00"), at("2026-09-11T00:00:00")


def ids(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "app_id bigint")


def listed(spark, *items):
    return spark.createDataFrame(
        [(i, name, n) for n, (i, name) in enumerate(items)],
        "app_id bigint, name string, position int",
    )


def members(spark, *items):
    return spark.createDataFrame(
        [(i, f"e{i}", "chart", NOW, active) for i, active in items], schemas.TRACKED_UNIVERSE
    )


def test_seed_bypasses_the_list_and_keeps_its_source(spark):
    got = registry.admit(
        ids(spark, 1, 2), ids(spark, 2, 3, 4), listed(spark, (2, "two"), (3, "3"), (3, "three"))
    )
    assert rows(got.admitted, "app_id", "name", "source") == [
        (1, "(not in app list)", "seed"),
        (2, "two", "seed"),
        (3, "three", "chart"),
    ]
    assert rows(got.refused) == [(4,)]


def test_the_curated_ids(spark):
    assert seed_frame(spark).distinct().count() == 13


def test_registry_step_adds_reactivates_and_never_removes(spark):
    held = members(spark, (1, False), (2, False), (3, True))
    chart, app_list = ids(spark, 1, 4, 9), listed(spark, (1, "x"), (4, "four"))
    admission = registry.admit(ids(spark), chart, app_list)
    step = registry.registry_step(held, admission, chart, app_list, LATER)
    assert rows(step.state, "app_id", "name", "is_active", "tracked_from") == [
        (1, "e1", True, NOW),
        (2, "e2", False, NOW),
        (3, "e3", True, NOW),
        (4, "four", True, LATER),
    ]
    assert rows(step.audit) == [(2, 3, [9], 1, 1)]
    again = registry.registry_step(step.state, admission, chart, app_list, LATER)
    assert rows(again.state) == rows(step.state)
    assert rows(again.audit, "newly_tracked_count", "reactivated_count") == [(0, 0)]


def envelope(app_id, data, success=True):
    return (app_id, json.dumps({str(app_id): {"success": success, "data": data}}))


def details(spark, *items):
    return unwrap_details(spark.createDataFrame(list(items), "app_id bigint, envelope string"))


def test_failed_envelopes_are_counted_as_failed(spark):
    got = details(
        spark,
        envelope(1, {"name": "one"}),
        (2, json.dumps({"2": {"success": False}})),
        (3, json.dumps({"4": {"success": True, "data": {"name": "other"}}})),
        (5, "{}"),
    )
    assert rows(got, "app_id", "success") == [(1, True), (2, False), (3, False), (5, False)]
    assert got.filter("data is not null").count() == 1


def test_chart_outranks_missing_metadata(spark):
    fresh = details(spark, envelope(1, {"name": "new"}), envelope(2, None, False), (3, "{}"))
    nothing = spark.createDataFrame([], schemas.APP_METADATA)
    held = members(spark, (1, True), (2, True), (3, True))
    step = registry.metadata_step(nothing, held, fresh, ids(spark, 2), NOW)
    assert rows(step.registry, "app_id", "is_active") == [(1, True), (2, True), (3, False)]
    assert rows(step.audit) == [(1, [2], 1)]

    newer = details(spark, envelope(1, {"name": "newer"}))
    moved = registry.metadata_step(step.metadata, step.registry, newer, ids(spark), LATER)
    assert rows(moved.metadata, "app_id", "first_loaded_at", "updated_at") == [(1, NOW, LATER)]
    assert rows(extract_metadata(moved.metadata), "app_name") == [("newer",)]


def test_catalog_rerun_keeps_its_first_transition_counts(spark):
    run = spark.createDataFrame(
        [("r1", NOW, "a", "b")],
        "run_id string, logical_date timestamp, app_list_key string, most_played_key string",
    )
    universe = (
        "app_list_count int, chart_count int, skipped_chart_app_ids array<bigint>, "
        "newly_tracked_count int, reactivated_count int"
    )
    first = audit.audit_catalog_run(
        run, spark.createDataFrame([(9, 100, [7], 32, 0)], universe), None, NOW
    )
    rerun = audit.audit_catalog_run(
        run, spark.createDataFrame([(9, 101, [], 0, 0)], universe), None, LATER
    )
    assert first.schema.fieldNames() == schemas.CATALOG_RUNS.fieldNames()
    empty = spark.createDataFrame([], schemas.CATALOG_RUNS)
    held = merge.upsert(empty, first, ["run_id"], first_non_null=audit.TRANSITION_COUNTS)
    held = merge.upsert(held, rerun, ["run_id"], first_non_null=audit.TRANSITION_COUNTS)
    assert rows(
        held, "newly_tracked_count", "deactivated_count", "chart_count", "skipped_chart_app_ids",
        "recorded_at",
    ) == [(32, None, 101, [], LATER)]


def test_empty_registry_raises(spark):
    with pytest.raises(RuntimeError, match="no active entity"):
        registry.active_ids(members(spark, (1, False)))
    assert [r[0] for r in registry.active_ids(members(spark, (2, True), (1, True))).collect()] == [
        1, 2,
    ]


RUNS = (
    "run_id string, logical_hour timestamp, tracked_count int, observed_count int, "
    "unobservable_app_ids array<bigint>, recorded_at timestamp"
)


def evidence(spark, lists, observed=None):
    """One run per hour, oldest first."""
    hours = [at(f"2026-09-{1 + n // 24:02d}T{n % 24:02d}:00:00") for n in range(len(lists))]
    seen = observed or [5] * len(lists)
    return normalize_runs(
        spark.createDataFrame(
            [
                (f"r{n:02d}", h, 9, seen[n], found, h)
                for n, (h, found) in enumerate(zip(hours, lists, strict=True))
            ],
            RUNS,
        )
    )


def flagged(spark, runs):
    return rows(registry.always_unobservable(runs, registry.listed_ids(runs)))


def test_flag_needs_every_one_of_the_last_evidence_runs(spark):
    assert flagged(spark, evidence(spark, [[7]] * 24)) == [(7,)]
    assert flagged(spark, evidence(spark, [[7]] * 23)) == []
    assert flagged(spark, evidence(spark, [[7]] * 23 + [[]])) == []
    assert flagged(spark, evidence(spark, [[]] + [[7, 8]] * 24)) == [(7,), (8,)]


def test_a_run_that_observed_nothing_is_no_evidence(spark):
    lists = [[7]] * 12 + [[]] + [None] + [[7]] * 12
    assert flagged(spark, evidence(spark, lists, [5] * 12 + [0, 5] + [5] * 12)) == [(7,)]


def test_dimension_prefers_the_metadata_name(spark):
    meta = extract_metadata(details(spark, envelope(1, {"name": "real"})).filter("success"))
    runs = evidence(spark, [[2]] * 24)
    held = registry.normalize_registry(members(spark, (1, True), (2, False)))
    dim = registry.dim_entity(held, meta, runs, registry.listed_ids(runs))
    assert rows(dim, "app_id", "app_name", "is_active", "is_unobservable") == [
        (1, "real", True, False),
        (2, "e2", False, True),
    ]
    later = evidence(spark, [[2]] * 24 + [[2, 1, 5]])
    assert rows(unflagged_unobservable(later, registry.listed_ids(later), dim)) == [(1,), (5,)]
