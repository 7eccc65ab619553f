"""Ranks and reports."""

from __future__ import annotations

import random
from datetime import timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.support import at, plan_of, rows
from tidemark.operators import checks, registry, reports
from tidemark.operators.daily import dense_daily, trends
from tidemark.operators.observations import fact_native
from tidemark.operators.ranking import dense_ranks, pieces, with_dense_ranks

DIM = (
    "app_id bigint, app_name string, release_date date, genre_names array<string>, "
    "is_free boolean, price_final_usd decimal(18,2), tracked_source string, is_active boolean"
)


def world(spark, values, active=lambda i: True):
    """Entities with one value per hour from noon on; returns dim, fact, trends."""
    start = at("2026-09-01T12:00:00")
    fact = fact_native(
        spark.createDataFrame(
            [
                (i, start + timedelta(hours=h), v)
                for i, series in values.items()
                for h, v in enumerate(series)
                if v is not None
            ],
            "app_id bigint, logical_hour timestamp, player_count bigint",
        )
    )
    dim = spark.createDataFrame(
        [(i, f"e{i}", None, None, None, None, "chart", active(i)) for i in values], DIM
    )
    return dim, fact, trends(dense_daily(fact))


def test_ties_share_a_rank(spark):
    board = reports.leaderboard(*world(spark, {1: [9], 2: [9], 3: [4]}))
    assert rows(board, "app_id", "current_rank") == [(1, 1), (2, 1), (3, 2)]
    assert checks.ranks_with_holes(board).count() == 0
    assert checks.breaches(board, checks.BOARD_CONTRACT).count() == 0


def test_inactive_entity_is_not_ranked(spark):
    board = reports.leaderboard(*world(spark, {1: [99], 2: [5], 3: [4]}, lambda i: i != 1))
    assert rows(board, "app_id", "current_rank") == [(2, 1), (3, 2)]


def test_current_is_each_entitys_own_hour(spark):
    board = reports.leaderboard(*world(spark, {1: [5, 7], 2: [9, None]}))
    assert rows(board, "app_id", "current_player_count", "current_hour") == [
        (1, 7, at("2026-09-01T13:00:00")),
        (2, 9, at("2026-09-01T12:00:00")),
    ]
    summary = reports.board_summary(board)
    assert rows(summary) == [(2, 7, at("2026-09-01T13:00:00"), 1)]


def test_entity_without_observation_is_not_on_the_board(spark):
    dim, fact, trended = world(spark, {1: [5], 2: [None]})
    assert rows(reports.leaderboard(dim, fact, trended), "app_id") == [(1,)]


def test_summary_of_an_empty_board(spark):
    board = reports.leaderboard(*world(spark, {1: [5]}, lambda i: False))
    assert rows(reports.board_summary(board)) == [(0, None, None, 0)]


def test_ranks_use_no_single_ordered_task(spark):
    df = spark.range(100).selectExpr("id % 7 as v")
    plan = plan_of(dense_ranks(df, "v", "r"))
    # The one window runs over the pieces' counts; values are sorted within their pieces only.
    window = [line for line in plan.split("\n") if "Window [" in line]
    assert window and all("piece" in line and "row_number" not in line for line in window)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(-(10**12), 10**12)), min_size=1, max_size=60))
def test_dense_rank_equals_brute_force(spark, values):
    values = values + random.Random(1).choices(values, k=10)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v bigint")
    order = sorted({v for v in values if v is not None}, reverse=True)
    want = sorted(
        ((i, None if v is None else order.index(v) + 1) for i, v in enumerate(values)), key=repr
    )
    assert rows(with_dense_ranks(df, {"v": "r"}), "i", "r") == want


def test_movers_leave_out_the_day_in_progress(spark):
    days = {i: [10 * i] + [None] * 23 + [10 * i + i * i] + [None] * 23 + [1] for i in range(1, 9)}
    dim, _, trended = world(spark, days)
    got = reports.top_movers(trended, dim, k=2).collect()
    assert [r["app_id"] for r in got] == [8, 7, 2, 1]
    assert [str(r["change_rate"]) for r in got] == ["0.8000", "0.7000", "0.2000", "0.1000"]


def test_panels_keep_ties_and_drop_the_last_day(spark):
    dim, fact, trended = world(spark, {1: [9] * 30, 2: [9] * 30, 3: [1] * 30})
    board = reports.leaderboard(dim, fact, trended)
    got = reports.top_panels(trended, board, k=1)
    assert rows(got, "app_id", "observed_hours") == [(1, 12), (2, 12)]
    long = reports.to_long(
        got, ["app_id"], {"avg_player_count": "mean", "avg_player_count_7d": "week"}
    )
    assert rows(long.select("app_id", "series")) == [
        (1, "mean"), (1, "week"), (2, "mean"), (2, "week"),
    ]


def test_profile_uses_only_full_days(spark):
    start_at_noon = [None] * 12
    dim, fact, trended = world(spark, {1: start_at_noon + [5] * 24 + [100] * 3})
    got = reports.hour_of_day_profile(fact, trended)
    assert rows(got) == sorted(((h, 5.0) for h in range(24)), key=repr)


def test_a_narrow_range_is_ranked_in_pieces(spark):
    """A million values within a thousandth of their size."""
    n = 1_000_000
    df = spark.range(0, n, 1, 8).selectExpr("1000000000 + id as v")
    got = dense_ranks(df, "v", "r")
    wrong = got.filter(f"r <> 1000000000 + {n} - v").count()
    assert (got.count(), wrong) == (n, 0)


def test_crowded_values_share_no_task(spark):
    """A million values in one sliver of a wide range: no task has three times the median."""
    n = 1_000_000
    crowd = spark.range(0, n, 1, 8).selectExpr("0.5 + id / 1e15 as v")
    df = crowd.unionByName(spark.range(0, 1000).selectExpr("id * 1e12 as v"))
    sizes = pieces(df, "v").groupBy((F.col("place") / 2**33).cast("bigint")).count()
    sizes = sorted(r["count"] for r in sizes.collect())
    assert len(sizes) >= 8 and sizes[-1] <= 3 * sizes[len(sizes) // 2]
    assert dense_ranks(df, "v", "r").agg({"r": "max"}).first()[0] == df.distinct().count()


def test_an_unknown_status_stops_the_grid(spark):
    hour = at("2026-09-10T13:00:00")
    ledger = spark.createDataFrame(
        [(hour, "odd", "r", 1, 1)],
        "logical_hour timestamp, status string, run_id string, observed_count int, tracked_count int",
    )
    with pytest.raises(Exception, match="unknown status odd"):
        reports.status_grid(ledger).collect()


def test_an_empty_registry_raises(spark):
    empty = spark.createDataFrame([], "app_id bigint, is_active boolean")
    with pytest.raises(Exception):
        registry.active_ids(empty)
