"""Rows that sources should not deliver but do."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators import audit, metadata, registry
from tidemark.operators.ranking import dense_ranks

NOW = datetime(2024, 1, 1)


def test_nan_and_infinite_values_rank_as_the_window_ranks_them(spark):
    values = [float("nan"), float("inf"), float("-inf"), 0.0, -1.5, 1e300, None, 2.0, float("nan")]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = {str(r.v): r.place for r in dense_ranks(df, "v", "place").collect()}
    df.createOrReplaceTempView("ranked_values")
    want = spark.sql(
        "select distinct v, dense_rank() over (order by v desc) as place "
        "from ranked_values where v is not null"
    ).collect()
    assert got == {str(r.v): r.place for r in want}


def test_several_answers_for_an_id_store_one(spark):
    answers = spark.sql(
        """select * from values (1L, true, parse_json('{"name": "b"}')),
        (1L, true, parse_json('{"name": "a"}')), (1L, false, null), (2L, false, null),
        (2L, false, null) as t(app_id, success, data)"""
    )
    held = spark.sql(
        """select 2L as app_id, true as is_active, timestamp '2023-01-01' as added_at,
        timestamp '2023-01-01' as updated_at"""
    )
    nothing = answers.limit(0).select(
        "app_id", "data", F.lit(NOW).alias("first_loaded_at"), F.lit(NOW).alias("updated_at")
    )
    chart = spark.createDataFrame([], "app_id long")
    step = registry.metadata_step(nothing, held, answers, chart, NOW)
    stored = step.metadata.select("app_id", F.col("data").cast("string").alias("data")).collect()
    assert [tuple(r) for r in stored] == [(1, '{"name":"a"}')]
    assert step.registry.filter("is_active").isEmpty()


def test_a_document_that_cannot_be_parsed_stops_the_step(spark):
    cut_off = spark.createDataFrame([(1, '{"1": {"success": true, "data": {"na')],
                                    "app_id long, envelope string")
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        metadata.unwrap_details(cut_off).collect()


def bundled(spark, tracked, **options):
    rows = spark.createDataFrame(
        [(NOW, n, "observed", n, 10, NOW) for n in range(12)],
        "logical_date timestamp, app_id long, status string, player_count int, latency_ms int, "
        "observed_at timestamp",
    )
    for field in (*audit.schemas.OBSERVED.fields, *audit.schemas.UNOBSERVABLE.fields):
        if field.name not in rows.columns:
            rows = rows.withColumn(field.name, F.lit(None).cast(field.dataType))
    runs = spark.createDataFrame(tracked, "logical_date timestamp, tracked_count int")
    return audit.bundle(rows, runs, **options)


def test_a_run_over_several_documents_is_one_summary(spark):
    documents = bundled(spark, [(NOW, 1)], max_rows=5).cache()
    assert documents.count() > 1
    summary = audit.document_summary(documents).collect()
    assert [(r.tracked_count, r.observed_count, r.unobservable_app_ids) for r in summary] == [
        (1, 12, [])
    ]


def test_answers_of_an_unknown_run_raise(spark):
    with pytest.raises(Exception, match="untracked run"):
        bundled(spark, [(datetime(2024, 1, 2), 3)]).collect()
