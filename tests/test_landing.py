"""Documents: schemas, bundles, audits, and the round trip through files."""

from __future__ import annotations

import json

import pytest

from tests.support import at, rows
from tidemark import schemas
from tidemark.operators import audit, merge
from tidemark.operators.ledger import normalize_runs
from tidemark.sources import landing, sinks, tables

HOUR = "2026-09-10T13:00:00+00:00"


def land(root, kind, day, name, document):
    folder = root / kind / f"dt={day}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(json.dumps(document))


def seen(app_id, count, latency=100, **more):
    return {
        "app_id": app_id, "player_count": count, "api_result": 1, "logical_date": HOUR,
        "observed_at": "2026-09-10T13:00:01.250000+00:00", "latency_ms": latency,
        "status": "observed", **more,
    }


def test_old_documents_read_with_nulls(spark, tmp_path):
    earlier = HOUR.replace("T13", "T12")
    old = {"logical_date": earlier, "observed": [{"app_id": 1, "player_count": 5}]}
    new = {"logical_date": HOUR, "tracked_count": 1, "observed": [seen(2, 6)], "unobservable": []}
    land(tmp_path, landing.PLAYER_COUNTS, "2026-09-10", "12-snapshot.json", old)
    land(tmp_path, landing.PLAYER_COUNTS, "2026-09-10", "13-snapshot.json", new)
    got = landing.read_bundles(spark, str(tmp_path)).orderBy("s3_key").collect()
    assert [r["unobservable"] for r in got] == [None, []]
    assert got[0]["observed"][0]["observed_at"] is None
    assert got[1]["observed"][0]["observed_at"] == at("2026-09-10T13:00:01.250000")
    assert got[1]["s3_key"] == "raw/player-counts/dt=2026-09-10/13-snapshot.json"
    summary = audit.document_summary(landing.read_bundles(spark, str(tmp_path)))
    assert rows(summary, "observed_count", "unobservable_app_ids") == [(1, None), (1, [])]


def test_day_filter_prunes_folders(spark, tmp_path):
    for day in ("2026-09-10", "2026-09-11"):
        land(tmp_path, landing.PLAYER_COUNTS, day, "00-snapshot.json", {"observed": []})
    one = landing.read_bundles(spark, str(tmp_path)).filter("dt = '2026-09-11'")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert one.count() == 1 and "PartitionFilters: [isnotnull(dt" in plan


def test_pages_of_the_app_list_and_the_chart(spark, tmp_path):
    def page(*apps):
        return {"app_count": 2, "apps": [{"appid": i, "name": n} for i, n in apps]}

    land(tmp_path, landing.APP_LIST, "2026-09-10", "app-list-1.json", page((1, "a"), (2, "b")))
    land(tmp_path, landing.APP_LIST, "2026-09-10", "app-list-2.json", page((3, "c")))
    land(
        tmp_path, landing.MOST_PLAYED, "2026-09-10", "most-played.json",
        {"most_played": [{"appid": 3, "rank": 1}, {"appid": 1, "rank": 2}]},
    )
    assert rows(landing.read_app_list(spark, str(tmp_path)), "app_id", "name") == [
        (1, "a"), (2, "b"), (3, "c"),
    ]
    assert rows(landing.read_chart(spark, str(tmp_path)), "position", "app_id") == [(0, 3), (1, 1)]


def test_details_are_opened_from_files(spark, tmp_path):
    from tidemark.operators.metadata import extract_metadata, unwrap_details

    document = {
        "app_id": 7, "logical_date": HOUR, "latency_ms": 3,
        "envelope": {"7": {"success": True, "data": {"name": "seven", "required_age": 0}}},
    }
    land(tmp_path, landing.APP_DETAILS, "2026-09-10", "7.json", document)
    opened = unwrap_details(landing.read_details(spark, str(tmp_path)))
    assert rows(extract_metadata(opened), "app_id", "app_name", "required_age") == [(7, "seven", 0)]


def test_row_without_a_count_stops_the_load(spark, tmp_path):
    land(
        tmp_path, landing.PLAYER_COUNTS, "2026-09-10", "13-snapshot.json",
        {"logical_date": HOUR, "observed": [{"app_id": 1}]},
    )
    with pytest.raises(Exception, match="no player_count"):
        audit.bundle_rows(landing.read_bundles(spark, str(tmp_path))).collect()


ANSWERS = (
    "logical_date timestamp, app_id bigint, player_count int, api_result int, "
    "observed_at timestamp, latency_ms int, status string"
)


def answers(spark, n, refused=0, latencies=None):
    t = at("2026-09-10T13:00:00")
    clock = at("2026-09-10T13:00:01.123456")
    found = [
        (t, i, i, 1, clock, latencies[i] if latencies else 10 * i, "observed") for i in range(n)
    ] + [(t, 1000 + i, None, None, t, 99_999, "unobservable") for i in range(refused)]
    return spark.createDataFrame(found, ANSWERS)


def tracked(spark, n):
    return spark.createDataFrame(
        [(at("2026-09-10T13:00:00"), n)], "logical_date timestamp, tracked_count int"
    )


@pytest.mark.parametrize(("max_rows", "parts"), [(50_000, 1), (10, 11)])
def test_bundle_splits_by_size_and_measures_the_same(spark, max_rows, parts):
    documents = audit.bundle(answers(spark, 105, 1), tracked(spark, 106), max_rows)
    assert documents.count() <= parts and (documents.count() > 1) == (parts > 1)
    assert rows(audit.run_measures(documents)) == [
        (at("2026-09-10T13:00:00"), 106, 105, 1, 520, 1040)
    ]
    assert audit.bundle_rows(documents).select("app_id").distinct().count() == 105
    assert rows(audit.unobservable_rows(documents), "app_id") == [(1000,)]


def test_run_without_answers_still_lands(spark):
    documents = audit.bundle(answers(spark, 0), tracked(spark, 146))
    assert rows(documents, "tracked_count", "observed", "unobservable") == [(146, [], [])]
    assert rows(audit.run_measures(documents)) == [
        (at("2026-09-10T13:00:00"), 146, 0, 0, None, None)
    ]


@pytest.mark.parametrize(("latencies", "median"), [([2, 3], 2), ([3, 4], 4), ([1, 2, 9], 2)])
def test_median_rounds_halves_to_even(spark, latencies, median):
    documents = audit.bundle(answers(spark, len(latencies), 0, latencies), tracked(spark, 9))
    assert rows(audit.run_measures(documents), "latency_p50_ms", "latency_max_ms") == [
        (median, max(latencies))
    ]


def test_killed_load_is_finished_by_running_it_again(spark, tmp_path):
    """A run whose load died, then its load run again, and once more."""
    tables.create_raw_tables(spark, str(tmp_path / "tables"))
    path = str(tmp_path / "tables" / "player_counts")
    documents = audit.bundle(answers(spark, 105, 1), tracked(spark, 106))
    dated = documents.selectExpr("*", "date(logical_date) as dt", "hour(logical_date) as hour")
    landing.write_documents(dated, str(tmp_path), landing.PLAYER_COUNTS, ["dt", "hour"])
    landing.write_documents(dated, str(tmp_path), landing.PLAYER_COUNTS, ["dt", "hour"])
    bundles = landing.read_bundles(spark, str(tmp_path))
    assert bundles.count() == 1
    columns = ("logical_date", "tracked_count", "observed", "unobservable")
    assert rows(bundles, *columns) == rows(documents, *columns)

    runs = spark.createDataFrame(
        [("r1", at("2026-09-10T13:00:00")), ("r2", at("2026-09-10T14:00:00"))],
        "run_id string, logical_hour timestamp",
    )

    def record(clock):
        held = tables.read_player_counts(spark, path)
        return audit.audit_snapshot_runs(runs, bundles, held, at(clock))

    def load():
        loaded = audit.bundle_rows(bundles).selectExpr(
            "*", "timestamp'2026-09-10 13:02:00' as loaded_at"
        )
        return sinks.insert_player_counts(loaded, path, ["s3_key", "position"])

    columns = ("run_id", "tracked_count", "observed_count", "unobservable_app_ids", "loaded_count")
    before = record("2026-09-10T13:01:00")
    assert before.schema.names == schemas.SNAPSHOT_RUNS.names
    gone = rows(audit.unobservable_rows(bundles), "app_id")[0][0]
    assert rows(before, *columns) == [("r1", 106, 105, [gone], 0), ("r2", None, None, None, 0)]
    assert rows(before, "s3_key")[0] == rows(bundles, "s3_key")[0]
    assert [load(), load()] == [105, 0]
    after = record("2026-09-10T13:05:00")
    created = spark.read.schema(schemas.SNAPSHOT_RUNS).parquet(
        str(tmp_path / "tables" / "snapshot_runs")
    )
    held = merge.upsert(merge.upsert(created, before, ["run_id"]), after, ["run_id"])
    assert rows(held, *columns) == [("r1", 106, 105, [gone], 105), ("r2", None, None, None, 0)]
    assert rows(normalize_runs(held), "run_id", "failed_count") == [("r1", 0), ("r2", None)]


def test_a_large_day_lands_from_many_tasks(spark, tmp_path):
    """Whatever the caller names: the day's documents are counted, and small days stay whole."""
    days = spark.range(100_000).selectExpr(
        "if(id < 99990, date'2026-09-10', date'2026-09-11') dt", "id app_id", "'x' envelope"
    )
    landing.write_documents(days, str(tmp_path), landing.APP_DETAILS, ["dt"])
    files = {d: len(list((tmp_path / landing.APP_DETAILS / f"dt={d}").glob("part-*.json")))
             for d in ("2026-09-10", "2026-09-11")}
    assert files["2026-09-10"] >= 8 and files["2026-09-11"] == 1
    held = spark.read.json(f"{tmp_path}/{landing.APP_DETAILS}")
    assert held.agg({"app_id": "sum"}).first()[0] == sum(range(100_000))


def test_documents_that_cannot_be_hashed_and_days_without_name(spark, tmp_path):
    rows_ = spark.createDataFrame([(None, {"a": 1}), (None, {"a": 2})], "dt date, m map<string,int>")
    landing.write_documents(rows_, str(tmp_path), landing.APP_DETAILS, ["dt"])
    assert spark.read.json(f"{tmp_path}/{landing.APP_DETAILS}").count() == 2
    landing.write_documents(rows_.limit(0), str(tmp_path / "e"), landing.APP_DETAILS, ["dt"])
