"""Hourly, daily and trend facts on small cases with known answers."""

from __future__ import annotations

from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.support import at, day, plan_of, rows
from tidemark.operators.daily import daily_rollup, dense_daily, fill_gaps, stretches, trends
from tidemark.operators.observations import (
    classify_responses,
    fact_native,
    latest_per_entity,
    normalize_observations,
    within_staleness,
)
from tidemark.plans.queries import QUERIES

FACT = "app_id bigint, date_day date, player_count int"


def raw(spark, *items):
    return spark.createDataFrame(
        [(i, v, at(t), f"k{n}", None, None) for n, (i, t, v) in enumerate(items)],
        "app_id bigint, player_count int, logical_hour timestamp, s3_key string, "
        "loaded_at timestamp, observed_at timestamp",
    )


def fact(spark, *items):
    return spark.createDataFrame([(i, day(d), v) for i, d, v in items], FACT)


def test_earliest_observation_of_the_hour_wins(spark):
    obs = raw(spark, (1, "2026-09-01T10:07:00", 9), (1, "2026-09-01T10:00:00", 5))
    want = [(1, at("2026-09-01T10:00:00"), 5, "k1")]
    assert rows(
        normalize_observations(obs), "app_id", "logical_hour", "player_count", "s3_key"
    ) == want
    assert rows(normalize_observations(obs, carry=())) == [want[0][:3]]


def test_lone_late_observation_moves_to_its_hour(spark):
    obs = raw(spark, (1, "2026-09-01T10:07:00", 9))
    assert rows(normalize_observations(obs, carry=())) == [(1, at("2026-09-01T10:00:00"), 9)]


def test_lean_normalization_is_a_hash_aggregate(spark):
    plan = plan_of(normalize_observations(raw(spark, (1, "2026-09-01T10:07:00", 9)), carry=()))
    assert "SortAggregate" not in plan and "HashAggregate" in plan


def test_fact_drops_lineage(spark):
    got = fact_native(normalize_observations(raw(spark, (1, "2026-09-01T23:59:00", 9))))
    assert rows(got) == [(1, day("2026-09-01"), at("2026-09-01T23:00:00"), 23, 9)]


def test_latest_is_per_entity(spark):
    obs = raw(
        spark,
        (1, "2026-09-01T10:00:00", 5),
        (1, "2026-09-01T12:00:00", 6),
        (2, "2026-09-01T09:00:00", 7),
    )
    assert rows(latest_per_entity(fact_native(obs))) == [
        (1, at("2026-09-01T12:00:00"), 6),
        (2, at("2026-09-01T09:00:00"), 7),
    ]


def test_mean_rounds_half_away_from_zero(spark):
    up = fact(spark, *[(1, "2026-09-01", v) for v in (1, 1, 1, 2)])
    down = fact(spark, *[(1, "2026-09-01", -v) for v in (1, 1, 1, 2)])
    assert rows(daily_rollup(up), "avg_player_count") == [(Decimal("1.3"),)]
    assert rows(daily_rollup(down), "avg_player_count") == [(Decimal("-1.3"),)]


def test_dense_grid_runs_to_the_global_last_day(spark):
    got = dense_daily(fact(spark, (1, "2026-09-01", 5), (1, "2026-09-03", 7), (2, "2026-09-04", 9)))
    assert rows(got.filter("app_id = 1"), "date_day", "peak_player_count", "observed_hours") == [
        (day("2026-09-01"), 5, 1),
        (day("2026-09-02"), None, 0),
        (day("2026-09-03"), 7, 1),
        (day("2026-09-04"), None, 0),
    ]
    assert rows(got.filter("app_id = 2"), "date_day") == [(day("2026-09-04"),)]


def test_dense_grid_of_nothing_is_empty(spark):
    assert dense_daily(fact(spark)).count() == 0


def test_dense_grid_needs_no_join(spark):
    plan = plan_of(dense_daily(fact(spark, (1, "2026-09-01", 5))))
    assert "Join" not in plan


def test_gap_hides_the_change_on_both_sides(spark):
    got = trends(dense_daily(fact(spark, (1, "2026-09-01", 100), (1, "2026-09-03", 110))))
    assert rows(
        got,
        "date_day",
        "avg_player_count_prev_day",
        "avg_player_count_change",
        "avg_player_count_7d",
        "observed_days_7d",
    ) == [
        (day("2026-09-01"), None, None, Decimal("100.0"), 1),
        (day("2026-09-02"), Decimal("100.0"), None, Decimal("100.0"), 1),
        (day("2026-09-03"), None, None, Decimal("105.0"), 2),
    ]


def test_tie_moves_the_record_to_the_later_day(spark):
    peaks = (10, 30, 30, 20)
    days = [f"2026-09-0{i}" for i in range(1, 5)]
    got = trends(dense_daily(fact(spark, *[(1, d, p) for d, p in zip(days, peaks, strict=True)])))
    assert rows(got, "date_day", "last_record_day", "days_since_peak") == [
        (day("2026-09-01"), day("2026-09-01"), 0),
        (day("2026-09-02"), day("2026-09-02"), 0),
        (day("2026-09-03"), day("2026-09-03"), 0),
        (day("2026-09-04"), day("2026-09-03"), 1),
    ]


def test_rate_from_zero_is_null(spark):
    got = trends(dense_daily(fact(spark, (1, "2026-09-01", 0), (1, "2026-09-02", 8))))
    last = got.filter(F.col("date_day") == day("2026-09-02"))
    assert rows(last, "avg_player_count_change", "avg_player_count_change_rate") == [
        (Decimal("8.0"), None)
    ]


def test_frame_forgets_after_seven_days(spark):
    got = trends(dense_daily(fact(spark, (1, "2026-09-01", 70), (2, "2026-09-09", 1))))
    mine = got.filter("app_id = 1 and date_day >= '2026-09-07'")
    assert rows(mine, "date_day", "avg_player_count_7d", "observed_days_7d") == [
        (day("2026-09-07"), Decimal("70.0"), 1),
        (day("2026-09-08"), None, 0),
        (day("2026-09-09"), None, 0),
    ]


def test_trends_shuffle_once_and_sort_once(spark, tmp_path):
    path = str(tmp_path / "daily")
    dense_daily(fact(spark, (1, "2026-09-01", 0), (1, "2026-09-02", 8))).write.parquet(path)
    plan = plan_of(trends(spark.read.parquet(path)))
    assert plan.count("Exchange") == 1 and plan.count("Sort [") == 1


@pytest.mark.parametrize(("late", "kept"), [("12:00:00", 1), ("12:00:01", 0)])
def test_two_hours_is_the_limit(spark, late, kept):
    row = (1, at("2026-09-01T10:00:00"), at(f"2026-09-01T{late}"), 0)
    df = spark.createDataFrame(
        [row], "app_id bigint, logical_date timestamp, observed_at timestamp, latency_ms int"
    )
    assert within_staleness(df).count() == kept


def test_latency_does_not_make_an_observation_late(spark):
    df = spark.createDataFrame(
        [
            (1, at("2026-09-01T10:00:00"), at("2026-09-01T12:00:03"), 3000),
            (2, at("2026-09-01T10:00:00"), None, None),
        ],
        "app_id bigint, logical_date timestamp, observed_at timestamp, latency_ms int",
    )
    assert within_staleness(df).count() == 2


def test_missing_count_is_an_error_and_not_zero(spark):
    schema = "app_id bigint, http_status int, player_count int"
    refused = spark.createDataFrame([(1, 404, None), (2, 200, 5)], schema)
    assert rows(classify_responses(refused), "app_id", "status", "player_count") == [
        (1, "unobservable", None),
        (2, "observed", 5),
    ]
    malformed = spark.createDataFrame([(1, 200, None)], schema)
    with pytest.raises(Exception, match="no player_count"):
        classify_responses(malformed).collect()


def gappy(spark):
    """Entities with rows on some days of forty: close together, far apart, equal and zero."""
    import random

    draw = random.Random(5)
    days = [str(date(2026, 9, 1) + timedelta(days=n)) for n in range(40)]
    made = [
        (i, d, draw.choice((0, 3, -4, draw.randrange(100))))
        for i in range(1, 7)
        for d in draw.sample(days, 40 // i)
        for _ in range(draw.randrange(1, 3))
    ]
    return fact(spark, *made)


@pytest.mark.parametrize("days", [1, 3, 7])
def test_trends_of_stretches_are_those_of_the_grid(spark, days):
    f = gappy(spark)
    grid, folded = trends(dense_daily(f), days), trends(dense_daily(f, folded=True), days)
    assert folded.dtypes == grid.dtypes
    assert rows(folded) == rows(grid) and grid.count() > 200


def test_stretches_carry_what_is_known(spark):
    rollup = daily_rollup(gappy(spark)).withColumns(
        {
            "known_record": F.when(F.dayofmonth("date_day") % 5 == 0, 60),
            "known_record_day": F.when(F.dayofmonth("date_day") % 5 == 0, F.lit(day("2026-08-20"))),
        }
    )
    unseen = F.when(F.dayofmonth("date_day") % 4 != 1, F.col("avg_player_count"))
    rollup = rollup.withColumn("avg_player_count", unseen)
    last = spark.createDataFrame([(day("2026-10-30"),)], "d date")
    grid, folded = trends(fill_gaps(rollup, last)), trends(stretches(rollup, last))
    assert rows(folded) == rows(grid)


def test_windows_run_over_rows_and_not_over_the_grid(spark, sf_dir):
    plan = plan_of(QUERIES["dense_orders_by_day"](spark, sf_dir))
    assert plan.index("Generate") < plan.index("Window")
