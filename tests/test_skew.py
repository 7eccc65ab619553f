"""One key holds a third of all rows: results stay whole, and the folding happens map-side."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.support import plan_of, rows
from tidemark.operators import checks, merge
from tidemark.operators.daily import dense_daily
from tidemark.operators.observations import fact_native, latest_per_entity, normalize_observations
from tidemark.operators.ranking import with_dense_ranks

N = 300_000


@pytest.fixture(scope="module")
def hot(spark):
    """Entity 0 has every third row, all of them within two hours."""
    crowded = F.col("id") % 3 == 0
    seconds = F.when(crowded, F.col("id") % 7200).otherwise(F.col("id") * 7 % 864_000)
    return spark.range(0, N, 1, 8).select(
        F.when(crowded, 0).otherwise(F.col("id") % 997 + 1).alias("app_id"),
        (F.col("id") % 1000).cast("int").alias("player_count"),
        F.timestamp_seconds(F.lit(1_700_000_000) + seconds).alias("logical_hour"),
        F.col("id"),
    )


def test_hot_entity_is_folded_before_the_shuffle(hot):
    fact = normalize_observations(hot, carry=())
    plan = plan_of(fact)
    assert plan.index("partial_min_by") > plan.index("Exchange")
    earliest = hot.filter("app_id = 0").groupBy(F.date_trunc("hour", "logical_hour")).agg(
        F.min("logical_hour")
    )
    assert fact.filter("app_id = 0").count() == earliest.count() == 3


def test_hot_entity_keeps_every_day_and_its_latest(hot):
    fact = fact_native(normalize_observations(hot, carry=()))
    daily = dense_daily(fact)
    assert daily.filter("app_id = 0").count() == 11
    assert daily.agg(F.sum("observed_hours")).first()[0] == fact.count()
    newest = hot.filter("app_id = 0").agg(F.max(F.date_trunc("hour", "logical_hour"))).first()[0]
    assert rows(latest_per_entity(fact).filter("app_id = 0"), "logical_hour") == [(newest,)]


def test_hot_value_keeps_every_row(hot):
    tied = hot.withColumn("v", F.when(F.col("app_id") == 0, 7).otherwise(F.col("id") % 5000))
    ranked = with_dense_ranks(tied, {"v": "r"})
    assert ranked.count() == N
    counts = ranked.groupBy("v").agg(F.count_distinct("r").alias("n"), F.first("r").alias("r"))
    assert counts.filter("n <> 1").count() == 0
    assert counts.filter("r <> 5000 - v").count() == 0


def test_hot_reference_is_reported_row_by_row(hot):
    parents = hot.filter("app_id > 0").select("app_id").distinct()
    assert checks.orphans(hot, "app_id", parents, "app_id").count() == N // 3


def test_hot_key_is_inserted_once(hot):
    target = hot.filter("app_id = 5").select("app_id", "id").limit(1)
    fresh = merge.absent_rows(hot.select("app_id", "id"), target, ["app_id"], ["id"])
    assert rows(fresh.filter("app_id = 0")) == [(0, 0)]
    assert fresh.count() == 997
