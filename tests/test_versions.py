"""Versions switched at once, counts kept per hour, and a board that reads its own days."""

from __future__ import annotations

from datetime import timedelta

import pytest

from tests.support import plan_of, rows
from tests.test_model import CALENDAR, HOURS, LAST, START, counts, raw, with_dt  # noqa: F401
from tidemark import schemas
from tidemark.operators import reports
from tidemark.operators.ledger import hour_ledger, ledger_of_counts, normalize_runs
from tidemark.operators.observations import fact_native, normalize_observations
from tidemark.plans import model, refresh
from tidemark.sources.sinks import write_days
from tidemark.sources.versions import Store


def table(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "v bigint")


def test_a_build_is_seen_whole_or_not_at_all(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    build = store.build()
    build.write("a", table(spark, 1))
    build.write("b", table(spark, 1))
    assert store.current() == (0, {})
    build.publish()
    second = store.build()
    second.write("a", table(spark, 2))
    assert rows(store.read("a")) == [(1,)]  # died here
    third = store.build()
    third.write("a", table(spark, 3))
    assert third.publish() == 2
    assert (rows(store.read("a")), rows(store.read("b"))) == ([(3,)], [(1,)])


def test_old_versions_are_deleted_only_where_no_kept_build_names_them(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    first = None
    for n in range(4):
        build = store.build()
        if n == 0:
            build.write("kept", table(spark, 7))
        build.write("a", table(spark, n))
        first = first or build.tables["a"]
        build.publish()
    assert first in store.expire(2)
    assert rows(store.read("a")) == [(3,)] and rows(store.read("kept")) == [(7,)]
    assert store.expire(2) == []


def test_a_build_that_dies_leaves_the_old_state(spark, raw, tmp_path, monkeypatch):  # noqa: F811
    root = str(tmp_path)
    early = raw.player_counts.filter(raw.player_counts.logical_hour < START + timedelta(days=9))
    others = (raw.tracked_universe, raw.app_metadata, raw.snapshot_runs, raw.catalog_runs)
    model.build(spark, model.Raw(early, *others), LAST, root, CALENDAR)
    store = Store(spark, root)
    names = sorted(store.current()[1])
    before = {n: rows(store.read(n)) for n in names}
    assert names == ["dim_game", "fct_player_counts", "fct_player_trends_daily",
                     "game_leaderboard", "hour_counts"]

    def dies(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(model, "leaderboard", dies)
        with pytest.raises(RuntimeError):
            model.build(spark, raw, LAST, root, CALENDAR)
    assert {n: rows(store.read(n)) for n in names} == before
    built = model.build(spark, raw, LAST, root, CALENDAR)
    assert rows(store.read("fct_player_counts", built.fct_player_counts.schema).select(
        *built.fct_player_counts.columns)) == rows(built.fct_player_counts)
    assert rows(store.read("fct_player_counts")) != before["fct_player_counts"]


def facts(spark, hours):
    observed = with_dt(spark.createDataFrame(counts(hours), schemas.PLAYER_COUNTS))
    return fact_native(normalize_observations(observed, carry=()))


def test_hour_counts_follow_the_days_of_a_load(spark, raw, tmp_path):  # noqa: F811
    root, store = str(tmp_path), Store(spark, str(tmp_path))
    held_back = range(24 * 4 + 3, 24 * 4 + 9)
    first = [h for h in range(24 * 12) if h not in held_back]
    write_days(facts(spark, first), f"{root}/{refresh.FACT}")
    build = store.build()
    build.write(refresh.HOURS, refresh.counts_of_days(store.read(refresh.FACT)))
    build.publish()
    runs = normalize_runs(raw.snapshot_runs)
    for hours in (range(24 * 12, 24 * 13), held_back):  # the next day, then a late load
        touched = {(START + timedelta(hours=h)).date() for h in hours}
        known = [h for h in range(HOURS) if (START + timedelta(hours=h)).date() in touched]
        loaded = [h for h in known if h < 24 * 13]
        write_days(facts(spark, loaded), f"{root}/{refresh.FACT}")
        counted = refresh.refresh_hour_counts(store, sorted(touched))
    whole = facts(spark, range(24 * 13))
    got = ledger_of_counts(runs, counted, LAST)
    assert rows(got) == rows(hour_ledger(runs, whole, LAST))


def test_a_load_reads_the_folders_of_its_days(spark, tmp_path):
    path = str(tmp_path / "fact")
    write_days(facts(spark, range(24 * 6)), path)
    fact = spark.read.parquet(path)
    one = (START + timedelta(days=2)).date()
    assert "PartitionFilters: [isnotnull(date_day" in plan_of(refresh.counts_of_days(fact, [one]))
    assert {f.split("date_day=")[1][:10] for f in fact.filter(fact.date_day == one).inputFiles()} \
        >= {str(one)}
    assert refresh.counts_of_days(fact, []).collect() == []


def test_refresh_keeps_the_hour_counts(spark, raw, tmp_path):  # noqa: F811
    root = str(tmp_path)
    cut = START + timedelta(days=8)
    early = raw.player_counts.filter(raw.player_counts.logical_hour < cut)
    others = (raw.tracked_universe, raw.app_metadata, raw.snapshot_runs, raw.catalog_runs)
    model.build(spark, model.Raw(early, *others), LAST, root, CALENDAR)
    refresh.refresh(spark, raw.player_counts, root, cut.date())
    full = model.build(spark, raw, LAST, str(tmp_path / "full"), CALENDAR)
    held = Store(spark, root).read(refresh.HOURS)
    want = Store(spark, str(tmp_path / "full")).read(refresh.HOURS)
    assert rows(held.select("logical_hour", "snapshot_rows")) == rows(
        want.select("logical_hour", "snapshot_rows"))
    assert full.fct_snapshot_hours.count() > 0


def test_the_board_reads_only_current_days(spark, raw, tmp_path):  # noqa: F811
    built = model.build(spark, raw, LAST, str(tmp_path), CALENDAR)
    trends, fact = built.fct_player_trends_daily, built.fct_player_counts
    current = fact.groupBy("app_id").agg({"date_day": "max"}).toDF("app_id", "date_day")
    pruned = reports.on_days_of(trends, current)
    plan = plan_of(pruned)
    assert "dynamicpruning" in plan and "BroadcastHashJoin" in plan
    days = {r.date_day for r in current.collect()}
    assert {r.date_day for r in pruned.select("date_day").distinct().collect()} == days
    plain = reports.leaderboard(built.dim_game, fact, trends)
    assert rows(plain) == rows(built.game_leaderboard)


def test_the_frontier_reads_the_last_day(spark, tmp_path):
    path = str(tmp_path / "fact")
    write_days(facts(spark, range(24 * 6)), path)
    held = spark.read.parquet(path)
    hours = spark.createDataFrame([(START, True)], "logical_hour timestamp, has_observations boolean")
    got = reports.freshness(held, hours, by_day=True)
    scans = [x for x in plan_of(got).split("\n") if "FileScan" in x and "logical_hour" in x]
    assert any("PartitionFilters: [isnotnull(date_day" in x and "ubquery" in x for x in scans)
    assert rows(got) == rows(reports.freshness(held, hours))
