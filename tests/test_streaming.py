"""Streams against their batch twins."""

from __future__ import annotations

import json
from datetime import timedelta

from tests.support import at, rows
from tidemark.operators.audit import bundle_rows
from tidemark.operators.observations import latest_per_entity, normalize_observations
from tidemark.sources import landing, tables
from tidemark.streaming import observations as streaming

START = at("2026-09-10T00:00:00")


def land(root, hours, minute=0, value=0):
    """One document per hour, each with a late row; in the order given."""
    for n in hours:
        run = START + timedelta(hours=n, minutes=minute)
        folder = root / landing.PLAYER_COUNTS / f"dt={run:%Y-%m-%d}"
        folder.mkdir(parents=True, exist_ok=True)

        def row(app_id, delay, run=run, n=n):
            return {
                "app_id": app_id, "player_count": 100 * n + app_id + value,
                "logical_date": run.isoformat() + "+00:00",
                "observed_at": (run + timedelta(minutes=delay)).isoformat() + "+00:00",
                "latency_ms": 5, "status": "observed",
            }

        document = {
            "logical_date": run.isoformat() + "+00:00",
            "tracked_count": 3,
            "observed": [row(1, 1), row(2, 119), row(3, 181)],
            "unobservable": [],
        }
        (folder / f"{run:%H%M}-snapshot.json").write_text(json.dumps(document))


def load(spark, root, max_files=None):
    rows_ = streaming.observation_stream(streaming.bundle_stream(spark, str(root), max_files))
    table = f"{root}/tables/player_counts"
    tables.create_raw_tables(spark, f"{root}/tables")
    streaming.run_to_end(
        streaming.load_player_counts(rows_, table, f"{root}/checkpoint", lambda: START)
    )
    return tables.read_player_counts(spark, table)


def test_stream_loads_what_a_batch_would_in_any_order(spark, tmp_path):
    forward, backward = tmp_path / "f", tmp_path / "b"
    land(forward, range(4))
    land(forward, range(4), minute=7, value=50)
    land(backward, reversed(range(4)), minute=7, value=50)
    land(backward, reversed(range(4)))
    facts = [
        rows(normalize_observations(load(spark, root, max_files), carry=()))
        for root, max_files in ((forward, None), (backward, 1))
    ]
    want = [(i, START + timedelta(hours=n), 100 * n + i) for i in (1, 2) for n in range(4)]
    assert facts == [sorted(want, key=repr)] * 2


def test_restart_continues_after_the_checkpoint(spark, tmp_path):
    land(tmp_path, range(2))
    assert load(spark, tmp_path).count() == 4
    assert load(spark, tmp_path).count() == 4
    land(tmp_path, [2])
    assert load(spark, tmp_path).count() == 6


def test_replay_without_its_checkpoint_inserts_nothing(spark, tmp_path):
    land(tmp_path, range(2))
    load(spark, tmp_path)
    rows_ = streaming.observation_stream(streaming.bundle_stream(spark, str(tmp_path)))
    table = f"{tmp_path}/tables/player_counts"
    streaming.run_to_end(
        streaming.load_player_counts(rows_, table, f"{tmp_path}/other", lambda: START)
    )
    assert tables.read_player_counts(spark, table).count() == 4


def test_append_mode_agrees_up_to_the_watermark(spark, tmp_path):
    land(tmp_path, range(6))
    stream = streaming.observation_stream(streaming.bundle_stream(spark, str(tmp_path)))
    first = streaming.first_in_hour(stream)
    streaming.run_to_end(
        streaming.append_files(first, f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    )
    got = spark.read.schema(first.schema).parquet(f"{tmp_path}/out")
    # The newest row is at 05:00, so hours that ended by 03:00 are final.
    want = [(i, START + timedelta(hours=n), 100 * n + i) for i in (1, 2) for n in range(3)]
    assert rows(got) == sorted(want, key=repr)


def test_latest_in_stream_equals_batch(spark, tmp_path):
    land(tmp_path, range(3))
    stream = streaming.observation_stream(streaming.bundle_stream(spark, str(tmp_path), 1))
    changes = streaming.latest_in_stream(stream)
    streaming.run_to_end(
        streaming.write_changes(changes, f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    )
    got = streaming.read_changes(spark, f"{tmp_path}/out", "app_id")
    batch = bundle_rows(landing.read_bundles(spark, str(tmp_path))).filter("app_id < 3")
    assert rows(got, "app_id", "logical_hour", "player_count") == rows(latest_per_entity(batch))


def test_repeated_delivery_is_dropped(spark, tmp_path):
    land(tmp_path, range(2))
    folder = tmp_path / landing.PLAYER_COUNTS / "dt=2026-09-10"
    (folder / "again-snapshot.json").write_text((folder / "0000-snapshot.json").read_text())
    stream = streaming.observation_stream(streaming.bundle_stream(spark, str(tmp_path)))
    once = streaming.first_delivery(stream)
    streaming.run_to_end(
        streaming.append_files(once, f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    )
    assert spark.read.parquet(f"{tmp_path}/out").count() == 4


def observed(spark, path, *batches):
    """A stream of rows (app_id, minute, value), one file per batch and in that order."""
    for batch in batches:
        made = [(a, START + timedelta(minutes=m), v) for a, m, v in batch]
        frame = spark.createDataFrame(made, "app_id bigint, logical_hour timestamp, player_count int")
        frame.coalesce(1).write.mode("append").parquet(path)
    reader = spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", 1)
    return reader.parquet(path)


def corrected(spark, tmp_path, *batches):
    stream = streaming.corrected_hours(observed(spark, f"{tmp_path}/in", *batches))
    streaming.run_to_end(
        streaming.write_changes(stream, f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    )
    return spark.read.parquet(f"{tmp_path}/out")


def test_a_closed_hour_is_corrected_by_an_earlier_row(spark, tmp_path):
    changes = corrected(
        spark, tmp_path,
        [(1, 20, 5), (2, 30, 8)],
        [(1, 70, 6)],  # the first hour is over,
        [(2, 75, 1)],  # and known to be over from the next load on
        [(1, 10, 4), (2, 40, 9)],  # late: the one is earlier, the other is not
        [(1, 100, 7)],
    )
    first = changes.filter("logical_hour = timestamp'2026-09-10 00:00:00'")
    assert rows(first, "app_id", "player_count", "corrects") == [
        (1, 4, True), (1, 5, False), (2, 8, False),
    ]
    held = streaming.read_changes(spark, f"{tmp_path}/out", "app_id", "logical_hour")
    assert rows(held.filter("hour(logical_hour) = 0"), "app_id", "player_count") == [(1, 4), (2, 8)]


def test_any_order_up_to_two_hours_late_equals_a_batch(spark, tmp_path):
    import random

    draw = random.Random(3)
    made = [(draw.randrange(4), m, draw.randrange(100)) for m in range(0, 600, 3)]
    arrivals = sorted(made, key=lambda r: r[1] + draw.randrange(119))
    batches = [arrivals[k : k + 25] for k in range(0, len(arrivals), 25)]
    corrected(spark, tmp_path, *batches)
    held = streaming.read_changes(spark, f"{tmp_path}/out", "app_id", "logical_hour")
    first = {}
    for a, m, v in made:
        first[a, m // 60] = min(first.get((a, m // 60), (m, v)), (m, v))
    newest = max(m for _, m, _ in made)
    want = sorted(
        ((a, START + timedelta(hours=h), v) for (a, h), (_, v) in first.items()
         if (h + 1) * 60 <= newest),
        key=repr,
    )
    assert rows(held, "app_id", "logical_hour", "player_count") == want


def test_a_late_row_of_a_passed_hour_needs_no_later_load(spark, tmp_path):
    changes = corrected(spark, tmp_path, [(1, 200, 5)], [(2, 100, 3)])
    assert rows(changes, "app_id", "logical_hour", "player_count", "corrects") == [
        (2, START + timedelta(hours=1), 3, False)
    ]


def test_missing_ids_and_counts_are_kept(spark, tmp_path):
    big = 2**53 + 1  # no double holds it
    corrected(
        spark, tmp_path,
        [(None, 20, 5), (0, 30, 4), (big, 10, None)],
        [(None, 10, 6), (big, 10, 7), (1, 130, 1)],
        [(None, 5, None), (1, 140, 2)],
    )
    changes = spark.read.parquet(f"{tmp_path}/out")
    assert rows(changes, "app_id", "player_count", "corrects") == [
        (0, 4, False), (big, 7, False), (None, None, False),
    ]


def test_state_is_called_per_share_and_hour_and_not_per_entity(spark, tmp_path):
    load = [(i, 20 + i % 90, i) for i in range(2_000)]
    stream = streaming.corrected_hours(observed(spark, f"{tmp_path}/in", load))
    query = streaming.write_changes(stream, f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    streaming.run_to_end(query)
    kept = max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress)
    assert 0 < kept < 2_000
    held = streaming.read_changes(spark, f"{tmp_path}/out", "app_id", "logical_hour")
    assert held.count() == sum(i % 90 < 40 for i in range(2_000))
