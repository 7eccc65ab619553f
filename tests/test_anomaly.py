"""Row counts against the rhythm of the week, and the watches on runs."""

from __future__ import annotations

import statistics
from datetime import timedelta

import pytest

from tests.support import at, day, rows
from tidemark.operators import anomaly, checks
from tidemark.operators.ledger import catalog_days
from tidemark import schemas

START = at("2026-03-02T00:00:00")  # a Monday
WEEKS = 9


def series():
    """Busy days, quiet nights, quieter weekends; some hours lost, some far too full."""
    out = {}
    for h in range(24 * 7 * WEEKS):
        base = 200 if 8 <= h % 24 < 20 else 20
        if h // 24 % 7 >= 5:
            base //= 2
        out[h] = base + (h * 7919) % 5
    for h in (24 * 7 * 5 + 30, 24 * 7 * 8 + 50):
        out[h] = 2
    for h in (24 * 7 * 6 + 11,):
        out[h] = 900
    for h in (24 * 7 * 4 + 12, 24 * 7 * 7 + 100):
        del out[h]
    return out


def frame(spark, counts):
    made = [(START + timedelta(hours=h), n) for h, n in counts.items()]
    return spark.createDataFrame(made, "logical_hour timestamp, snapshot_rows bigint")


def plain(counts, last, weeks=8, least=3, width=3.0, share=0.1):
    out = []
    for h in range(min(counts), last + 1):
        past = [counts.get(x, 0) for x in range(h - 168, min(counts) - 1, -168)][:weeks]
        if len(past) < least:
            continue
        middle = statistics.median(past)
        spread = statistics.median(abs(x - middle) for x in past)
        allowed = max(spread * (width * anomaly.SIGMA), middle * share, 1.0)
        n = counts.get(h, 0)
        if n < middle - allowed or n > middle + allowed:
            out.append((h, n, len(past), middle, spread, "drop" if n < middle else "spike"))
    return out


def test_drops_and_spikes(spark):
    counts, last = series(), 24 * 7 * WEEKS - 1
    found = anomaly.row_count_anomalies(frame(spark, counts), START + timedelta(hours=last))
    got = [
        (int((r.logical_hour - START).total_seconds() // 3600), *r[1:])
        for r in found.orderBy("logical_hour").collect()
    ]
    assert got == plain(counts, last)
    hours = {g[0]: g[-1] for g in got}
    assert hours[24 * 7 * 5 + 30] == "drop" and hours[24 * 7 * 6 + 11] == "spike"
    assert hours[24 * 7 * 7 + 100] == "drop"  # a lost hour counts as none
    # A lost hour among the weeks before does not make a usual week look bad.
    assert 24 * 7 * 5 + 12 not in hours


def test_an_outlier_is_reported_while_later_hours_lack(spark):
    counts = {h: 50 for h in range(24 * 28)}
    found = anomaly.row_count_anomalies(frame(spark, counts), START + timedelta(hours=24 * 28 + 5))
    assert [r.kind for r in found.collect()] == ["drop"] * 6


def test_short_history_is_not_judged(spark):
    counts = {h: 50 if h < 24 * 20 else 0 for h in range(24 * 21)}
    last = START + timedelta(hours=24 * 21 - 1)
    assert anomaly.row_count_anomalies(frame(spark, counts), last).collect() == []
    assert anomaly.row_count_anomalies(frame(spark, {}), last).collect() == []


@pytest.mark.parametrize("values, want", [
    ([], None), ([4], 4.0), ([1, 3], 2.0), ([9, 1, 5], 5.0), ([2, 2, 3, 10], 2.5),
])
def test_median(spark, values, want):
    got = spark.createDataFrame([(values,)], "v array<bigint>").select(
        anomaly.median_of("v").alias("m"))
    assert got.first().m == want


def run(run_id, when, recorded, listed=5):
    return (run_id, at(when), listed, 1, [], 0, 0, 0, [], 5, "a", "b", at(recorded))


def test_a_day_without_a_run_is_a_row(spark):
    runs = spark.createDataFrame(
        [
            run("a", "2026-05-01T04:00:00", "2026-05-01T04:05:00"),
            run("b", "2026-05-01T04:00:00", "2026-05-01T09:00:00", 6),
            run("c", "2026-05-04T04:00:00", "2026-05-04T04:05:00"),
        ],
        schemas.CATALOG_RUNS,
    )
    days = catalog_days(runs, at("2026-05-05T12:00:00"))
    assert rows(days, "date_day", "is_recorded", "run_id", "app_list_count", "attempts") == [
        (day("2026-05-01"), True, "b", 6, 2),
        (day("2026-05-02"), False, None, None, 0),
        (day("2026-05-03"), False, None, None, 0),
        (day("2026-05-04"), True, "c", 5, 1),
        (day("2026-05-05"), False, None, None, 0),
    ]
    missing = checks.unrecorded_days(days)
    assert rows(missing) == [(day("2026-05-02"),), (day("2026-05-03"),), (day("2026-05-05"),)]
    assert catalog_days(runs.limit(0), at("2026-05-05T12:00:00")).collect() == []


def test_recent_hours_that_ran_short(spark):
    hours = [(at(f"2026-05-01T{h:02d}:00:00"), s, 1, 2) for h, s in
             enumerate(["ran_short", "complete", "ran_short", "unrecorded", "ran_short"])]
    ledger = spark.createDataFrame(
        hours, "logical_hour timestamp, status string, failed_count int, loaded_count int")
    got = checks.recently_short(ledger, at("2026-05-01T03:30:00"), 3)
    assert rows(got, "logical_hour") == [(at("2026-05-01T02:00:00"),)]
