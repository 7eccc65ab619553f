"""Key-aware loads, and that a rerun changes nothing."""

from __future__ import annotations

import pytest

from tests.support import at, plan_of, rows
from tidemark.operators import merge
from tidemark.sources import sinks, tables

SCHEMA = "id bigint, a string, b bigint"


def frame(spark, *items):
    return spark.createDataFrame(list(items), SCHEMA)


def test_absent_rows_keeps_the_first_of_each_new_key(spark):
    target = frame(spark, (1, "old", 1))
    incoming = frame(spark, (1, "x", 2), (2, "second", 9), (2, "first", 3))
    assert rows(merge.absent_rows(incoming, target, ["id"], ["b"])) == [(2, "first", 3)]


def test_upsert_rules_per_column(spark):
    target = frame(spark, (1, "old", 32), (2, "old", None), (3, "alone", 5))
    incoming = frame(spark, (1, "new", 0), (2, "new", 7), (4, "born", 1))
    replaced = merge.upsert(target, incoming, ["id"])
    assert rows(replaced) == [(1, "new", 0), (2, "new", 7), (3, "alone", 5), (4, "born", 1)]
    kept = merge.upsert(target, incoming, ["id"], keep=["a"], first_non_null=["b"])
    assert rows(kept) == [(1, "old", 32), (2, "old", 7), (3, "alone", 5), (4, "born", 1)]


def test_upsert_can_write_null_over_a_value(spark):
    got = merge.upsert(frame(spark, (1, "old", 1)), frame(spark, (1, None, None)), ["id"])
    assert rows(got) == [(1, None, None)]


@pytest.mark.parametrize("rules", [{}, {"keep": ["a"], "first_non_null": ["b"]}])
def test_upsert_twice_is_upsert_once(spark, rules):
    target = frame(spark, (1, "old", None), (3, "alone", 5))
    incoming = frame(spark, (1, "new", 0), (4, "born", 1))
    once = merge.upsert(target, incoming, ["id"], **rules)
    assert rows(merge.upsert(once, incoming, ["id"], **rules)) == rows(once)


def test_newest_attempt_wins(spark):
    got = merge.newest_per_key(frame(spark, (1, "x", 1), (1, "y", 2)), ["id"], "b")
    assert rows(got) == [(1, "y", 2)]


def test_upsert_into_buckets_reads_each_side_once(spark, tmp_path):
    """The target lies arranged by its key: it is scanned once and not shuffled."""
    target = spark.range(5000).selectExpr("id", "'old' a", "id b")
    held = sinks.write_buckets(target, str(tmp_path / "target"), ["id"], 8)
    incoming = str(tmp_path / "incoming")
    spark.range(4990, 5010).selectExpr("id", "'new' a", "-id b").write.parquet(incoming)
    state = merge.upsert(held, spark.read.parquet(incoming), ["id"])
    plan = plan_of(state)
    assert plan.count("FileScan") == 2 and plan.count("Bucketed: true") == 1
    assert plan.count("Exchange") == 1 and "FullOuter" in plan
    assert state.where("a = 'old'").count() == 4990
    assert rows(state.where("id >= 4999"))[0] == (4999, "new", -4999)
    assert state.where("a = 'new'").count() == 20


def test_buckets_are_read_from_their_files_alone(spark, tmp_path):
    path = str(tmp_path / "held")
    held = sinks.write_buckets(frame(spark, (1, "x", 2), (2, None, None)), path, ["id"], 4)
    spark.sql(f"DROP TABLE {sinks.scratch_name(path)}")
    again = sinks.read_buckets(spark, path, held.schema, ["id"], 4)
    assert rows(again) == [(1, "x", 2), (2, None, None)]


def test_upsert_keeps_rows_without_a_key(spark):
    target = frame(spark, (None, "old", 1), (1, "old", 1))
    incoming = frame(spark, (None, "new", 2), (1, "new", 2))
    got = rows(merge.upsert(target, incoming, ["id"]))
    assert sorted(got, key=repr) == [(1, "new", 2), (None, "new", 2), (None, "old", 1)]


def test_flags(spark):
    target = spark.createDataFrame(
        [(1, False), (2, True), (3, False)], "app_id bigint, is_active boolean"
    )
    ids = spark.createDataFrame([(1,), (1,), (2,), (9,)], "app_id bigint")
    assert rows(merge.flag_changes(target, ids, True), "app_id") == [(1,)]
    assert rows(merge.set_flag(target, ids, True)) == [(1, True), (2, True), (3, False)]


def counts(spark, n, hour="2026-09-10T13:00:00", value=5):
    return spark.createDataFrame(
        [(i, value, at(hour), None, "key", at("2026-09-10T13:02:00")) for i in range(n)],
        "app_id bigint, player_count int, logical_hour timestamp, observed_at timestamp, "
        "s3_key string, loaded_at timestamp",
    )


def test_reload_of_an_hour_inserts_nothing(spark, tmp_path):
    tables.create_raw_tables(spark, str(tmp_path))
    tables.create_raw_tables(spark, str(tmp_path))
    path = f"{tmp_path}/player_counts"
    assert sinks.insert_player_counts(counts(spark, 0), path) == 0
    assert sinks.insert_player_counts(counts(spark, 60), path) == 60
    assert sinks.insert_player_counts(counts(spark, 105, value=6), path) == 45
    assert sinks.insert_player_counts(counts(spark, 105, value=7), path) == 0
    held = tables.read_player_counts(spark, path)
    assert held.count() == 105 and held.filter("player_count = 5").count() == 60


def test_only_touched_days_are_read_back(spark, tmp_path):
    tables.create_raw_tables(spark, str(tmp_path))
    path = f"{tmp_path}/player_counts"
    sinks.insert_player_counts(counts(spark, 3, "2026-09-10T13:00:00"), path)
    sinks.insert_player_counts(counts(spark, 3, "2026-09-11T13:00:00"), path)
    plan = plan_of(tables.read_player_counts(spark, path).filter("dt = '2026-09-11'"))
    assert "PartitionFilters: [isnotnull(dt" in plan


def test_days_written_again_replace_only_themselves(spark, tmp_path):
    path = str(tmp_path / "days")
    schema = "date_day date, v int"
    both = spark.createDataFrame([("2026-09-01", 1), ("2026-09-02", 2)], "d string, v int")
    both = both.selectExpr("cast(d as date) as date_day", "v")
    sinks.write_days(both, path)
    sinks.write_days(both.filter("v = 2").selectExpr("date_day", "v * 10 as v"), path)
    held = spark.read.schema(schema).parquet(path)
    assert rows(held, "v") == [(1,), (20,)]
    sinks.write_days(both.filter("v = 2"), path, whole=True)
    assert rows(spark.read.schema(schema).parquet(path), "v") == [(2,)]
