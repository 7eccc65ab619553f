"""Every check of the model in plain SQL, over relations given by name.

The relations are `fact`, `daily`, `trends`, `hours`, `board`, `dim`, `dates`, `runs`, `catalog`,
`meta` and `absent` (unobservable ids of the latest evidence run); `checks_sql` puts the common
table expressions that define them in front.
"""

from __future__ import annotations


def _unique(relation: str, *key: str) -> str:
    present = " AND ".join(f"{c} IS NOT NULL" for c in key)
    return (
        f"SELECT count(*) FROM (SELECT 1 FROM {relation} WHERE {present} "
        f"GROUP BY {', '.join(key)} HAVING count(*) > 1)"
    )


def _null(relation: str, column: str) -> str:
    return f"SELECT count(*) FROM {relation} WHERE {column} IS NULL"


def _unknown(relation: str, column: str, parent: str) -> str:
    return (
        f"SELECT count(*) FROM {relation} c WHERE c.{column} IS NOT NULL "
        f"AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{column} = c.{column})"
    )


def _rows(relation: str, *rules: str) -> str:
    return f"SELECT count(*) FROM {relation} WHERE " + " OR ".join(f"({r})" for r in rules)


def _old(newest: str, hours: int) -> str:
    return (
        f"SELECT CAST(newest IS NULL OR newest < (SELECT moment FROM as_of) - INTERVAL {hours} HOUR "
        f"AS BIGINT) FROM (SELECT {newest})"
    )


def _holes(column: str) -> str:
    return (
        f"(SELECT coalesce(CAST(max({column}) <> count(DISTINCT {column}) AS BIGINT), 0) FROM board)"
    )


STATUSES = "'complete', 'ran_short', 'unrecorded', 'unaudited'"

SQL: dict[str, str] = {}
for _name, _relation, _column in (
    ("dim_game", "dim", "app_id"),
    ("dim_date", "dates", "date_day"),
    ("fct_snapshot_hours", "hours", "logical_hour"),
    ("game_leaderboard", "board", "app_id"),
    ("stg_snapshot_runs", "runs", "run_id"),
    ("stg_catalog_runs", "catalog", "run_id"),
):
    SQL[f"{_name}.{_column}.unique"] = _unique(_relation, _column)
    SQL[f"{_name}.{_column}.not_null"] = _null(_relation, _column)
for _name, _relation in (
    ("fct_player_counts", "fact"),
    ("fct_player_counts_daily", "daily"),
    ("fct_player_trends_daily", "trends"),
):
    for _column, _parent in (("app_id", "dim"), ("date_day", "dates")):
        SQL[f"{_name}.{_column}.not_null"] = _null(_relation, _column)
        SQL[f"{_name}.{_column}.known"] = _unknown(_relation, _column, _parent)
SQL |= {
    "game_leaderboard.app_id.known": _unknown("board", "app_id", "dim"),
    "fct_player_counts.logical_hour.not_null": _null("fact", "logical_hour"),
    "fct_snapshot_hours.status.not_null": _null("hours", "status"),
    "stg_app_metadata.steam_appid.not_null": _null("meta", "steam_appid"),
    "fct_snapshot_hours.status.accepted": _rows("hours", f"status NOT IN ({STATUSES})"),
    "stg_app_metadata.app_type.accepted": _rows("meta", "app_type NOT IN ('game')"),
    "stg_app_metadata.price_currency.accepted": _rows("meta", "price_currency NOT IN ('USD')"),
    "fct_player_counts.grain": _unique("fact", "app_id", "logical_hour"),
    "fct_player_counts_daily.grain": _unique("daily", "app_id", "date_day"),
    "fct_player_trends_daily.grain": _unique("trends", "app_id", "date_day"),
    "fct_player_counts.non_negative": _rows("fact", "player_count < 0"),
    "fct_player_counts_daily.contract": _rows(
        "daily", "observed_hours NOT BETWEEN 0 AND 24",
        "(avg_player_count IS NULL) <> (observed_hours = 0)",
        "(peak_player_count IS NULL) <> (observed_hours = 0)",
        "peak_player_count < avg_player_count",
    ),
    # Tenths are compared as whole numbers.
    "fct_player_trends_daily.contract": _rows(
        "trends",
        """round(10 * avg_player_count_change) IS DISTINCT FROM
          round(10 * avg_player_count) - round(10 * avg_player_count_prev_day)""",
        """(avg_player_count_change_rate IS NULL) <> (avg_player_count IS NULL
          OR avg_player_count_prev_day IS NULL OR avg_player_count_prev_day = 0)""",
        "observed_days_7d NOT BETWEEN 0 AND 7",
        "(avg_player_count_7d IS NULL) <> (observed_days_7d = 0)",
        "peak_player_count > peak_player_count_record",
        "last_record_day > date_day",
        "days_since_peak < 0",
    ),
    "fct_snapshot_hours.contract": _rows(
        "hours", f"status NOT IN ({STATUSES})",
        "status = 'complete' AND NOT has_observations",
        "status = 'unrecorded' AND has_observations",
        "status = 'unaudited' AND run_id IS NOT NULL",
        "status <> 'complete' AND is_high_water_mark",
    ),
    "game_leaderboard.contract": _rows(
        "board", "current_player_count > peak_player_count_current_day",
        "peak_player_count_current_day > peak_player_count_record",
        "observed_hours_current_day NOT BETWEEN 1 AND 24",
    ),
    "stg_app_metadata.same_id": _rows("meta", "app_id <> steam_appid"),
    "fct_snapshot_hours.dense": """SELECT CAST(
        epoch(max(logical_hour) - min(logical_hour)) / 3600 + 1 IS DISTINCT FROM count(*)
        OR count(*) FILTER (WHERE is_high_water_mark) <> 1 AS BIGINT) FROM hours""",
    "game_leaderboard.ranks": f"SELECT {_holes('current_rank')} + {_holes('rank_7d')}",
    "dim_game.knows_every_unobservable": """SELECT count(*) FROM absent a
        WHERE NOT EXISTS (SELECT 1 FROM dim d WHERE d.app_id = a.app_id AND d.is_unobservable)""",
    "player_counts.fresh": _old("max(loaded_at) AS newest FROM loads", 2),
    "snapshot_runs.fresh": _old("max(recorded_at) AS newest FROM runs", 2),
    "app_metadata.fresh": _old("max(updated_at) AS newest FROM stored", 26),
    "catalog_runs.fresh": _old("max(recorded_at) AS newest FROM catalog", 26),
}


def checks_sql() -> str:
    """(check, severity, violations) of all checks, over relations of the names above."""
    lines = []
    for name, sql in SQL.items():
        warns = name.endswith(".fresh") or name.endswith("unobservable")
        severity = "warn" if warns else "error"
        lines.append(
            f"SELECT '{name}' AS \"check\", '{severity}' AS severity, "
            f"CAST(({sql}) AS BIGINT) AS violations"
        )
    return "\nUNION ALL ".join(lines)
