"""The whole model on one small history: every check, the views, and the refresh."""

from __future__ import annotations

import json
from datetime import timedelta

import pytest

from tests.support import at, day, plan_of, rows
from tidemark import schemas
from tidemark.operators import checks as ck
from tidemark.plans.model import Raw, build, model_checks
from tidemark.plans.refresh import refresh
from tidemark.sources.versions import Store

START = at("2026-09-01T06:00:00")
HOURS = 24 * 20
LAST = START + timedelta(hours=HOURS - 1)
CALENDAR = (day("2026-08-26"), day("2027-01-01"))


def observed(i, h):
    """Entity 9 is never seen; the others start later, pause, and skip hours."""
    return i != 9 and h >= 30 * i and h % (i + 5) != 0 and not 200 <= h < 200 + 26 * (i % 4)


def counts(hours):
    return [
        (i, (h * 37 + i * 11) % 50 + i, START + timedelta(hours=h, minutes=m), None, "k", LAST)
        for h in hours
        for i in range(1, 7)
        for m in ((0, 7) if h % 10 == 0 else (0,))
        if observed(i, h)
    ]


def with_dt(df):
    return df.selectExpr("*", "date(logical_hour) as dt")


@pytest.fixture(scope="module")
def raw(spark):
    audited = range(100, HOURS)
    runs = [
        (
            f"r{h}", START + timedelta(hours=h), 7, sum(observed(i, h) for i in range(1, 7)),
            [9] + [i for i in range(1, 7) if not observed(i, h)],
            sum(observed(i, h) for i in range(1, 7)), 300, 900, "k",
            START + timedelta(hours=h, minutes=2),
        )
        for h in audited
    ]
    described = [
        (i, json.dumps({"steam_appid": i, "name": f"n{i}", "type": "game"}), LAST, LAST)
        for i in range(1, 6)
    ]
    text = "app_id bigint, data string, first_loaded_at timestamp, updated_at timestamp"
    return Raw(
        player_counts=with_dt(
            spark.createDataFrame(counts(range(HOURS)), schemas.PLAYER_COUNTS)
        ).cache(),
        tracked_universe=spark.createDataFrame(
            [(i, f"e{i}", "seed", START, i != 2) for i in (1, 2, 3, 4, 5, 6, 9)],
            schemas.TRACKED_UNIVERSE,
        ),
        app_metadata=spark.createDataFrame(described, text).selectExpr(
            "app_id", "parse_json(data) as data", "first_loaded_at", "updated_at"
        ),
        snapshot_runs=spark.createDataFrame(runs, schemas.SNAPSHOT_RUNS),
        catalog_runs=spark.createDataFrame(
            [("c1", LAST, 9, 1, [], 0, 0, 0, [], 5, "a", "b", LAST)], schemas.CATALOG_RUNS
        ),
    )


@pytest.fixture(scope="module")
def built(spark, raw, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("model"))
    return build(spark, raw, LAST, root, CALENDAR)


def test_every_check_passes(built, raw):
    found = model_checks(built, raw, LAST)
    assert len(found) == 43 + 4
    failed = ck.summarize(found).filter("violations > 0").collect()
    assert failed == []


def test_old_loads_are_reported(built, raw):
    found = model_checks(built, raw, LAST + timedelta(hours=27))
    late = ck.summarize([c for c in found if c.name.endswith(".fresh")])
    assert rows(late, "check", "severity", "violations") == [
        ("app_metadata.fresh", "warn", 1),
        ("catalog_runs.fresh", "warn", 1),
        ("player_counts.fresh", "warn", 1),
        ("snapshot_runs.fresh", "warn", 1),
    ]


def test_written_and_lazy_models_agree(spark, built, raw):
    lazy = build(spark, raw, LAST, None, CALENDAR)
    for name in ("fct_player_counts_daily", "fct_player_trends_daily", "game_leaderboard"):
        assert rows(getattr(lazy, name)) == rows(getattr(built, name)), name


def test_views_answer_the_published_queries(spark, built):
    built.register()
    missing = spark.sql(
        "select logical_hour, status from fct_snapshot_hours where not has_observations"
    )
    marks = spark.sql("select logical_hour from fct_snapshot_hours where is_high_water_mark")
    flagged = spark.sql("select app_id from dim_game where is_unobservable")
    assert missing.filter("status not in ('unrecorded', 'ran_short')").count() == 0
    assert marks.count() == 1
    assert rows(flagged) == [(9,)]
    board = spark.sql("select app_name from game_leaderboard order by current_rank limit 15")
    assert board.count() == 5


@pytest.mark.parametrize("split", [24 * 3, 24 * 9 + 5, 24 * 19])
def test_refresh_equals_a_full_build(spark, raw, tmp_path, split):
    root = str(tmp_path / "facts")
    early = Raw(
        raw.player_counts.filter(raw.player_counts.logical_hour < START + timedelta(hours=split)),
        raw.tracked_universe, raw.app_metadata, raw.snapshot_runs, raw.catalog_runs,
    )
    build(spark, early, LAST, root, CALENDAR)
    refresh(spark, raw.player_counts, root, (START + timedelta(hours=split)).date())
    full = build(spark, raw, LAST, str(tmp_path / "full"), CALENDAR)
    for name in ("fct_player_counts", "fct_player_trends_daily"):
        whole = getattr(full, name)
        held = Store(spark, root).read(name, whole.schema).select(*whole.columns)
        assert rows(held) == rows(whole), name


@pytest.mark.parametrize("gap", [1, 3, 9])
def test_refresh_after_an_outage_of_whole_days(spark, raw, tmp_path, gap):
    """Days without any row, and an entity that never returns, are in the refreshed facts."""
    root = str(tmp_path / "facts")
    hour = raw.player_counts.logical_hour
    back = START + timedelta(days=3 + gap)
    before = raw.player_counts.filter(hour < START + timedelta(days=3))
    gone = before.select("app_id").distinct().orderBy("app_id").first()[0]
    after = raw.player_counts.filter((hour >= back) & (raw.player_counts.app_id != gone))
    others = (raw.tracked_universe, raw.app_metadata, raw.snapshot_runs, raw.catalog_runs)
    build(spark, Raw(before, *others), LAST, root, CALENDAR)
    landed = before.unionByName(after)
    refresh(spark, landed, root, back.date())
    full = build(spark, Raw(landed, *others), LAST, str(tmp_path / "full"), CALENDAR)
    for name in ("fct_player_counts", "fct_player_trends_daily"):
        whole = getattr(full, name)
        held = Store(spark, root).read(name, whole.schema).select(*whole.columns)
        assert rows(held) == rows(whole), name


def test_plans_have_no_nested_loops(spark, raw):
    lazy = build(spark, raw, LAST, None, CALENDAR)
    for name in ("fct_player_trends_daily", "fct_snapshot_hours", "game_leaderboard", "dim_game"):
        plan = plan_of(getattr(lazy, name))
        assert "NestedLoop" not in plan and "CartesianProduct" not in plan, name
