"""The same answers in plain SQL, for an independent engine to compute.

Common table expressions are composed by name: `compose("SELECT ...", "trend")` puts in front
whatever `trend` needs. Averages and rates are whole tenths and ten-thousandths until the end.
"""

from __future__ import annotations

# name -> (names it reads, body)
PARTS: dict[str, tuple[tuple[str, ...], str]] = {}


def part(name: str, needs: tuple[str, ...], body: str) -> None:
    PARTS[name] = (needs, body)


def compose(select: str, *needs: str) -> str:
    """The query with what it reads in front. It may begin with `, name AS (...)` of its own."""
    done: list[str] = []

    def visit(name: str) -> None:
        if name not in done:
            for other in PARTS[name][0]:
                visit(other)
            done.append(name)

    for name in needs:
        visit(name)
    if not done:
        return select
    return "WITH " + ",\n".join(f"{n} AS ({PARTS[n][1]})" for n in done) + "\n" + select


def staged(name: str, source: str, entity: str = "user_id", where: str = "true") -> None:
    """Parts `<name>_staged`, `<name>_fact`: earliest observation per entity and hour."""
    part(
        f"{name}_staged",
        (),
        f"""
        SELECT app_id, date_trunc('hour', ts) AS logical_hour, player_count FROM (
          SELECT {entity} AS app_id, ts, CAST(round(value * 100) AS BIGINT) AS player_count,
                 row_number() OVER (
                   PARTITION BY {entity}, date_trunc('hour', ts) ORDER BY ts) AS rn
          FROM {source} WHERE {where}
        ) WHERE rn = 1""",
    )
    part(
        f"{name}_fact",
        (f"{name}_staged",),
        f"""
        SELECT app_id, CAST(logical_hour AS DATE) AS date_day, logical_hour,
               extract(hour FROM logical_hour) AS hour_of_day, player_count
        FROM {name}_staged""",
    )


def dense(name: str) -> None:
    """Parts `<name>_rollup`, `<name>_dense` over `<name>_fact`."""
    part(
        f"{name}_rollup",
        (f"{name}_fact",),
        f"""
        SELECT app_id, date_day, count(*) AS n, max(player_count) AS peak,
               CAST((20 * sum(player_count) + count(*)) // (2 * count(*)) AS BIGINT) AS tenths
        FROM {name}_fact GROUP BY app_id, date_day""",
    )
    part(
        f"{name}_dense",
        (f"{name}_rollup",),
        f"""
        SELECT f.app_id, d.date_day, r.tenths, r.peak, coalesce(r.n, 0) AS n
        FROM (SELECT app_id, min(date_day) AS first_day FROM {name}_rollup GROUP BY app_id) f
        JOIN (SELECT CAST(unnest(generate_series(
                (SELECT min(date_day) FROM {name}_rollup),
                (SELECT max(date_day) FROM {name}_rollup), INTERVAL 1 DAY)) AS DATE) AS date_day) d
          ON d.date_day >= f.first_day
        LEFT JOIN {name}_rollup r ON r.app_id = f.app_id AND r.date_day = d.date_day""",
    )


staged("obs", "events")
dense("obs")
staged("kind", "events", entity="event_type")
dense("kind")
staged("side", "events", where="event_type NOT IN ('purchase', 'error')")

def trended(source: str, prefix: str = "") -> None:
    """Part `<prefix>trend` over `<source>_dense`, and what it needs."""
    part(f"{prefix}windowed", (f"{source}_dense",), WINDOWED.format(dense=f"{source}_dense"))
    part(f"{prefix}anchored", (f"{prefix}windowed",), ANCHORED.format(rows=f"{prefix}windowed"))
    part(f"{prefix}trend", (f"{prefix}anchored",), TREND.format(rows=f"{prefix}anchored"))


WINDOWED = """
    SELECT *,
      lag(tenths) OVER w AS prev,
      sum(tenths) OVER week AS s7,
      count(tenths) OVER week AS n7,
      max(peak) OVER so_far AS record
    FROM {dense}
    WINDOW w AS (PARTITION BY app_id ORDER BY date_day),
      week AS (PARTITION BY app_id ORDER BY date_day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW),
      so_far AS (PARTITION BY app_id ORDER BY date_day ROWS UNBOUNDED PRECEDING)"""
ANCHORED = """
    SELECT *, max(date_day) FILTER (WHERE coalesce(peak = record, false)) OVER (
      PARTITION BY app_id ORDER BY date_day ROWS UNBOUNDED PRECEDING) AS last_record_day
    FROM {rows}"""
TREND = """
    SELECT app_id, date_day,
      CAST(tenths AS DOUBLE) / 10 AS avg_player_count,
      peak AS peak_player_count,
      CAST(n AS BIGINT) AS observed_hours,
      CAST(prev AS DOUBLE) / 10 AS avg_player_count_prev_day,
      CAST(tenths - prev AS DOUBLE) / 10 AS avg_player_count_change,
      CAST(CASE WHEN tenths < prev THEN -1 ELSE 1 END
        * ((20000 * abs(tenths - prev) + prev) // (2 * nullif(prev, 0))) AS DOUBLE) / 10000
        AS avg_player_count_change_rate,
      CAST((2 * s7 + n7) // (2 * nullif(n7, 0)) AS DOUBLE) / 10 AS avg_player_count_7d,
      CAST(n7 AS BIGINT) AS observed_days_7d,
      record AS peak_player_count_record,
      CAST(date_day - last_record_day AS BIGINT) AS days_since_peak,
      last_record_day
    FROM {rows}"""
trended("obs")

# The events with an outage after the middle of their days: what comes later is some days later.
OUTAGES = (3, 40)
for gap in OUTAGES:
    staged(
        f"gap{gap}",
        f"""(SELECT * REPLACE (CASE WHEN CAST(ts AS DATE) >= back THEN ts + INTERVAL {gap} DAY
          ELSE ts END AS ts) FROM events, (SELECT CAST(min(ts) AS DATE)
          + CAST((CAST(max(ts) AS DATE) - CAST(min(ts) AS DATE)) // 2 AS INTEGER) AS back FROM events))""",
    )
    dense(f"gap{gap}")
    trended(f"gap{gap}", f"gap{gap}_")
part(
    "latest",
    ("obs_fact",),
    """
    SELECT app_id, logical_hour, date_day, player_count FROM (
      SELECT *, row_number() OVER (PARTITION BY app_id ORDER BY logical_hour DESC) AS rn
      FROM obs_fact) WHERE rn = 1""",
)
part(
    "registry",
    (),
    """
    SELECT c_custkey AS app_id, c_name AS name,
      CASE WHEN c_nationkey = 0 THEN 'seed' ELSE 'chart' END AS source,
      c_mktsegment <> 'HOUSEHOLD' AS is_active
    FROM customer""",
)
part(
    "meta",
    (),
    """
    SELECT p_partkey AS app_id,
      CASE WHEN p_partkey % 500 = 7 THEN p_partkey + 1 ELSE p_partkey END AS steam_appid,
      p_name AS app_name,
      CASE WHEN p_partkey % 50 = 3 THEN 'dlc' ELSE 'game' END AS app_type,
      p_type AS app_description,
      CASE WHEN p_partkey % 11 <> 0 AND p_partkey % 13 <> 0 AND p_partkey % 5 <= 2
        THEN CAST(DATE '2015-01-01' + CAST(p_partkey % 4000 AS INTEGER) AS DATE) END
        AS release_date,
      CASE WHEN p_partkey % 6 > 1 THEN replace(p_name, ' ', '|') END AS genre_names,
      CASE p_partkey % 4 WHEN 0 THEN 0 WHEN 1 THEN 17 END AS required_age,
      p_partkey % 2 = 0 AS is_free,
      true AS is_windows,
      p_partkey % 3 = 0 AS is_mac,
      p_partkey % 5 = 0 AS is_linux,
      CASE WHEN p_partkey % 3 <> 0 THEN p_size * 2 END AS metacritic_score,
      CASE WHEN p_partkey % 4 <> 1 THEN p_size ELSE 0 END AS achievement_count,
      CASE WHEN p_partkey % 7 <> 2 THEN p_partkey * 3 END AS recommendation_count,
      CASE WHEN p_partkey % 2 = 1 THEN 'USD' END AS price_currency,
      CASE WHEN p_partkey % 2 = 1
        THEN CAST(round(p_retailprice * 100) AS BIGINT) END AS initial_cents,
      CASE WHEN p_partkey % 2 = 1
        THEN CAST(round(p_retailprice * 100) AS BIGINT) - p_partkey % 100 END AS final_cents
    FROM part WHERE p_brand <> 'Brand#9'""",
)
part(
    "day_flagged",
    ("obs_dense",),
    """
    SELECT app_id FROM obs_dense
    WHERE n = 0 AND date_day IN (
      SELECT date_day FROM obs_dense GROUP BY date_day HAVING count(*) FILTER (WHERE n > 0) > 0
      ORDER BY date_day DESC LIMIT 2)
    GROUP BY app_id HAVING count(*) = 2""",
)
part(
    "board",
    ("latest", "trend", "registry", "meta"),
    """
    SELECT r.app_id, coalesce(m.app_name, r.name) AS app_name,
      CAST(dense_rank() OVER (ORDER BY l.player_count DESC) AS BIGINT) AS current_rank,
      l.player_count AS current_player_count,
      l.logical_hour AS current_hour,
      t.avg_player_count AS avg_player_count_current_day,
      t.peak_player_count AS peak_player_count_current_day,
      t.observed_hours AS observed_hours_current_day,
      CAST(dense_rank() OVER (ORDER BY t.avg_player_count_7d DESC) AS BIGINT) AS rank_7d,
      t.avg_player_count_7d, t.observed_days_7d, t.peak_player_count_record,
      t.last_record_day, t.days_since_peak,
      m.release_date, m.genre_names, m.is_free, m.final_cents, r.source AS tracked_source
    FROM registry r
    JOIN latest l ON l.app_id = r.app_id
    JOIN trend t ON t.app_id = r.app_id AND t.date_day = l.date_day
    LEFT JOIN meta m ON m.app_id = r.app_id
    WHERE r.is_active""",
)
part(
    "runs",
    (),
    """
    SELECT h AS logical_hour, a.attempt, bought, failed,
      'run-' || strftime(h, '%Y%m%d%H') || '-' || a.attempt AS run_id,
      h + INTERVAL 10 MINUTE * (a.attempt + 1) AS recorded_at,
      bought + failed AS tracked_count,
      CASE WHEN a.attempt = 1 THEN bought ELSE 0 END AS observed_count,
      CASE WHEN a.attempt = 1 THEN bought ELSE 0 END AS loaded_count,
      0 AS unobservable_count,
      bought * 10 + 5 AS latency_p50_ms, bought * 20 + 5 AS latency_max_ms
    FROM (
      SELECT date_trunc('hour', ts) AS h,
        count(*) FILTER (WHERE event_type = 'purchase') AS bought,
        count(*) FILTER (WHERE event_type = 'error') AS failed
      FROM events WHERE event_type IN ('purchase', 'error') GROUP BY 1
    ) CROSS JOIN (VALUES (0), (1)) a(attempt)
    WHERE bought > 0""",
)
part(
    "judged",
    ("runs", "side_staged"),
    """
    SELECT s.logical_hour, c.snapshot_rows, c.snapshot_rows IS NOT NULL AS has_observations,
      d.run_id, d.recorded_at, d.tracked_count, d.observed_count, d.unobservable_count,
      d.tracked_count - d.observed_count - d.unobservable_count AS failed_count, d.loaded_count,
      d.latency_p50_ms, d.latency_max_ms,
      CASE
        WHEN d.run_id IS NULL AND c.snapshot_rows IS NOT NULL THEN 'unaudited'
        WHEN d.run_id IS NULL THEN 'unrecorded'
        WHEN d.tracked_count - d.observed_count - d.unobservable_count = 0
          AND d.loaded_count = d.observed_count AND d.observed_count > 0 THEN 'complete'
        ELSE 'ran_short' END AS status
    FROM (SELECT unnest(generate_series((SELECT min(logical_hour) FROM side_staged),
            (SELECT date_trunc('hour', max(ts)) + INTERVAL 24 HOUR FROM events),
            INTERVAL 1 HOUR)) AS logical_hour) s
    LEFT JOIN (SELECT logical_hour, count(*) AS snapshot_rows FROM side_staged GROUP BY 1) c
      ON c.logical_hour = s.logical_hour
    LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (
            PARTITION BY logical_hour ORDER BY recorded_at DESC) AS rn FROM runs)
          WHERE rn = 1) d
      ON d.logical_hour = s.logical_hour""",
)
part(
    "ledger",
    ("judged",),
    """
    SELECT *, logical_hour = max(logical_hour) FILTER (WHERE status = 'complete') OVER ()
      AS is_high_water_mark
    FROM judged""",
)
part(
    "listing",
    (),
    """
    SELECT CAST(event_id AS VARCHAR) AS run_id, event_id, ts, event_id % 11 + 5 AS tracked_count,
      event_id % 7 AS observed_count,
      CASE WHEN event_type = 'error' THEN NULL
           WHEN event_id % 3 = 0 THEN CAST([] AS BIGINT[])
           ELSE generate_series(user_id % 4, user_id % 4 + event_id % 5) END AS ids
    FROM events""",
)
part(
    "late",
    (),
    """
    SELECT * FROM events
    WHERE (event_id % 181) * 60000 - event_id * 37 % 900000 <= 2 * 3600 * 1000""",
)
# Registry steps: who is listed, who charts, who is seeded.
part(
    "app_list",
    (),
    """
    SELECT c_custkey AS app_id, CASE WHEN c_nationkey = 12 THEN 'renamed ' || c_name
      ELSE c_name END AS name
    FROM customer WHERE c_nationkey <> 2""",
)
part(
    "chart",
    (),
    """
    SELECT o_custkey AS app_id
    FROM orders GROUP BY o_custkey ORDER BY sum(CAST(round(o_totalprice * 100) AS BIGINT)) DESC, o_custkey
    LIMIT 100""",
)
part("seed", (), "SELECT unnest([-2, -1, 0, 5, 9, 10, 18, 20, 50, 80, 90, 100, 110]) AS app_id")
part(
    "judged_ids",
    ("seed", "chart", "app_list"),
    """
    SELECT c.app_id, c.source, l.name FROM (
      SELECT app_id, 'seed' AS source FROM seed
      UNION ALL
      SELECT app_id, 'chart' FROM chart WHERE app_id NOT IN (SELECT app_id FROM seed)
    ) c LEFT JOIN app_list l ON l.app_id = c.app_id""",
)
part(
    "admitted",
    ("judged_ids",),
    """
    SELECT app_id, coalesce(name, '(not in app list)') AS name, source FROM judged_ids
    WHERE name IS NOT NULL OR source = 'seed'""",
)
part(
    "known",
    (),
    """
    SELECT c_custkey AS app_id, c_name AS name, 'chart' AS source,
      c_mktsegment <> 'BUILDING' AND c_acctbal >= 0 AS is_active
    FROM customer""",
)
part(
    "part_chart",
    (),
    """
    SELECT l_partkey AS app_id FROM lineitem GROUP BY l_partkey
    ORDER BY sum(CAST(l_quantity AS BIGINT)) DESC, l_partkey LIMIT 100""",
)
