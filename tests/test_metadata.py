"""Typed columns out of documents."""

from __future__ import annotations

import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.support import day, plan_of, rows
from tidemark.operators.metadata import extract_metadata
from tidemark.plans import driver_tables as given
from tidemark.plans import queries


def extract(spark, **data):
    df = spark.createDataFrame([(1, json.dumps(data))], "app_id bigint, data string")
    return extract_metadata(df).first()


@pytest.mark.parametrize(
    ("age", "want"), [(0, 0), ("17", 17), ("17+", None), (None, None), ("99999999999", None)]
)
def test_required_age(spark, age, want):
    assert extract(spark, required_age=age)["required_age"] == want


@pytest.mark.parametrize(
    ("release", "want"),
    [
        ({"coming_soon": False, "date": "Aug 6, 2026"}, day("2026-08-06")),
        ({"coming_soon": False, "date": "Aug 16, 2026"}, day("2026-08-16")),
        ({"coming_soon": False, "date": "Q4 2026"}, None),
        ({"coming_soon": False, "date": "Feb 31, 2026"}, None),
        ({"coming_soon": True, "date": "Aug 6, 2026"}, None),
        ({"date": "Aug 6, 2026"}, None),
    ],
)
def test_release_date(spark, release, want):
    assert extract(spark, release_date=release)["release_date"] == want


@pytest.mark.parametrize(
    ("data", "want"),
    [
        ({}, None),
        ({"genres": []}, None),
        ({"genres": [{"id": "2", "description": "B"}, {"id": 1, "description": "A"}]}, ["B", "A"]),
        ({"genres": [{"id": "2"}]}, [None]),
    ],
)
def test_genres_keep_their_order(spark, data, want):
    assert extract(spark, **data)["genre_names"] == want


def test_absent_fields(spark):
    got = extract(spark)
    assert got["achievement_count"] == 0
    assert got["metacritic_score"] is None and got["is_free"] is None
    assert got["price_final_usd"] is None and got["price_currency"] is None


def test_present_fields(spark):
    got = extract(
        spark,
        steam_appid=1,
        name="n",
        type="game",
        short_description="d",
        is_free=False,
        platforms={"windows": True, "mac": False},
        metacritic={"score": 90},
        achievements={"total": 12},
        recommendations={"total": 34},
        price_overview={"currency": "USD", "initial": 5999, "final": 4999},
    )
    assert (got["steam_appid"], got["app_name"], got["app_type"]) == (1, "n", "game")
    assert (got["is_windows"], got["is_mac"], got["is_linux"]) == (True, False, None)
    assert (got["metacritic_score"], got["achievement_count"]) == (90, 12)
    assert (got["price_initial_usd"], got["price_final_usd"]) == (
        Decimal("59.99"), Decimal("49.99"),
    )


def test_documents_of_one_small_file_are_built_by_many_tasks(spark, sf_dir):
    assert given.table(spark, sf_dir, "part").rdd.getNumPartitions() == 1
    built = given.details_raw(spark, sf_dir).groupBy(F.spark_partition_id()).count()
    assert built.count() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_documents_of_the_checked_model_are_read_by_many_tasks(spark, sf_dir):
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    stored = given.raw_tables(spark, sf_dir).app_metadata
    typed = extract_metadata(stored)
    for frame in (stored, typed):
        assert frame.groupBy(F.spark_partition_id()).count().count() == partitions


def test_documents_of_the_checked_model_are_opened_once(spark, sf_dir, monkeypatch):
    calls, build = [], given.details_raw

    def counted(*args):
        calls.append(args)
        return build(*args)

    lazy = given.raw_tables(spark, sf_dir).app_metadata
    monkeypatch.setattr(given, "details_raw", counted)
    built, raw, _ = queries.checked_model(spark, sf_dir)
    assert len(calls) == 1
    assert "from_json" in plan_of(lazy)
    for frame in (raw.app_metadata, built.stg_app_metadata):
        assert "from_json" not in plan_of(frame)
    text = ("app_id", "cast(data as string)", "first_loaded_at", "updated_at")
    assert rows(raw.app_metadata.selectExpr(*text)) == rows(lazy.selectExpr(*text))
    assert rows(built.stg_app_metadata) == rows(extract_metadata(lazy))
