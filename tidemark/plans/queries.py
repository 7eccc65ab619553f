"""Registered queries over the given tables, each beside the SQL that must agree with it."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import replace
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.functions.documents import text_at, value_at
from tidemark.functions.text import grouped, signed_percent
from tidemark.operators import anomaly, audit, checks, ledger, merge, registry, reports
from tidemark.operators.daily import daily_rollup, dense_daily, trends
from tidemark.operators.metadata import extract_metadata, unwrap_details
from tidemark.operators.observations import (
    classify_responses,
    fact_native,
    latest_per_entity,
    normalize_observations,
    within_staleness,
)
from tidemark.operators.ranking import top_k, with_dense_ranks
from tidemark.plans import check_states, model
from tidemark.plans import driver_tables as given
from tidemark.plans.check_oracle import checks_sql
from tidemark.plans.oracle import OUTAGES, compose
from tidemark.plans.refresh import (
    FACT,
    HOURS,
    TRENDS,
    counts_of_days,
    refresh,
    refresh_hour_counts,
)
from tidemark.session import prepare, scratch_dir, together
from tidemark.sources import landing, spines, tables
from tidemark.sources.sinks import (
    insert_player_counts,
    settled,
    write_buckets,
    write_days,
    write_version,
)
from tidemark.sources.versions import Store
from tidemark.streaming import observations as streaming

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def flat(df: DataFrame, gaps: Sequence[str] = ()) -> DataFrame:
    """Plain columns that two engines hand over alike: bigint, double, boolean and text.

    Columns in `gaps` may be NULL: numbers among them become doubles and flags become text.
    """

    def plain(field: T.StructField):
        column, dtype = F.col(f"`{field.name}`"), field.dataType
        if isinstance(dtype, T.DateType):
            column = F.date_format(column, "yyyy-MM-dd")
        elif isinstance(dtype, T.TimestampType):
            column = column.cast("string")  # to the microsecond
        elif isinstance(dtype, T.DecimalType):
            column = column.cast("double")
        elif isinstance(dtype, T.ArrayType):
            column = F.array_join(column.cast("array<string>"), "|")
        elif field.name in gaps:
            column = column.cast("string" if isinstance(dtype, T.BooleanType) else "double")
        elif isinstance(dtype, (T.IntegerType, T.ShortType)):
            column = column.cast("bigint")
        return column.alias(field.name)

    return df.select(*[plain(f) for f in df.schema.fields])


def query(
    name: str, sql: str, gaps: Sequence[str] = (), flags: Sequence[str] = ()
) -> Callable[[Query], Query]:
    """Register a query with its SQL. `gaps` are nullable numbers, `flags` nullable booleans."""
    casts = [f'CAST("{c}" AS DOUBLE) AS "{c}"' for c in gaps]
    casts += [f'CAST("{c}" AS VARCHAR) AS "{c}"' for c in flags]

    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return flat(build(prepare(spark), sf_dir), [*gaps, *flags])

        QUERIES[name] = run
        ORACLE[name] = f"SELECT * REPLACE ({', '.join(casts)}) FROM (\n{sql}\n)" if casts else sql
        return build

    return register


# ---- native fact, daily fact, trends ----


@query(
    "obs_hourly_dedup",
    compose(
        """SELECT app_id, CAST(logical_hour AS VARCHAR) AS logical_hour, player_count,
          'raw/player-counts/dt=' || strftime(logical_hour, '%Y-%m-%d') || '/'
            || strftime(logical_hour, '%H') || '-snapshot.json' AS s3_key
        FROM obs_staged""",
        "obs_staged",
    ),
)
def obs_hourly_dedup(spark, sf):
    return normalize_observations(given.observations(spark, sf), carry=["s3_key"])


@query(
    "fact_native",
    compose(
        """SELECT app_id, CAST(date_day AS VARCHAR) AS date_day,
          CAST(logical_hour AS VARCHAR) AS logical_hour, hour_of_day, player_count
        FROM obs_fact""",
        "obs_fact",
    ),
)
def fact_native_query(spark, sf):
    return given.fact(spark, sf)


@query(
    "daily_rollup",
    compose(
        """SELECT app_id, CAST(date_day AS VARCHAR) AS date_day,
          CAST(tenths AS DOUBLE) / 10 AS avg_player_count, peak AS peak_player_count,
          n AS observed_hours
        FROM obs_rollup""",
        "obs_rollup",
    ),
)
def daily_rollup_query(spark, sf):
    return daily_rollup(given.fact(spark, sf))


@query(
    "daily_dense",
    compose(
        """SELECT app_id, CAST(date_day AS VARCHAR) AS date_day,
          CAST(tenths AS DOUBLE) / 10 AS avg_player_count, peak AS peak_player_count,
          n AS observed_hours
        FROM obs_dense""",
        "obs_dense",
    ),
    gaps=["peak_player_count"],
)
def daily_dense(spark, sf):
    return given.daily(spark, sf)


TREND_COLUMNS = """app_id, CAST(date_day AS VARCHAR) AS date_day, avg_player_count,
  peak_player_count, observed_hours, avg_player_count_prev_day, avg_player_count_change,
  avg_player_count_change_rate, avg_player_count_7d, observed_days_7d,
  peak_player_count_record, days_since_peak,
  CAST(last_record_day AS VARCHAR) AS last_record_day"""


@query(
    "trends_full",
    compose(f"SELECT {TREND_COLUMNS} FROM trend", "trend"),
    gaps=["peak_player_count"],
)
def trends_full(spark, sf):
    return given.trend(spark, sf)


@query(
    "refresh_after_outage",
    compose(
        " UNION ALL ".join(
            f"SELECT {gap} AS gap, {TREND_COLUMNS} FROM gap{gap}_trend" for gap in OUTAGES
        ),
        *[f"gap{gap}_trend" for gap in OUTAGES],
    ),
    gaps=["peak_player_count"],
)
def refresh_after_outage(spark, sf):
    """Facts written up to the middle day, then an outage of whole days, then a refresh. What was
    observed after the middle is moved behind the outage."""
    first, last = given.event_days(spark, sf)
    back = first + (last - first) // 2
    refreshed = []
    for gap in OUTAGES:
        hour, root = F.col("logical_hour"), scratch_dir(spark, f"outage-{gap}")
        later = hour + F.expr(f"interval {gap} days")
        landed = given.observations(spark, sf).withColumn(
            "logical_hour", F.when(F.to_date(hour) >= F.lit(back), later).otherwise(hour)
        ).withColumn("dt", F.to_date("logical_hour"))
        early = landed.filter(F.col("dt") < F.lit(back))
        fact = fact_native(normalize_observations(early, carry=()))
        trend = trends(dense_daily(fact, folded=True))
        write_days(fact, f"{root}/{FACT}")
        write_days(trend, f"{root}/{TRENDS}")
        refresh(spark, landed, root, back + timedelta(days=gap))
        held = spark.read.schema(trend.schema).parquet(f"{root}/{TRENDS}")
        refreshed.append(held.select(F.lit(gap).alias("gap"), *trend.columns))
    return reduce(DataFrame.unionAll, refreshed)


@query(
    "trend_lag_change",
    compose(
        """SELECT app_id, CAST(date_day AS VARCHAR) AS date_day, avg_player_count_prev_day,
          avg_player_count_change, avg_player_count_change_rate FROM trend""",
        "trend",
    ),
)
def trend_lag_change(spark, sf):
    return given.trend(spark, sf).select(
        "app_id", "date_day", "avg_player_count_prev_day", "avg_player_count_change",
        "avg_player_count_change_rate",
    )


@query(
    "trend_7d",
    compose(
        """SELECT app_id, CAST(date_day AS VARCHAR) AS date_day, avg_player_count_7d,
          observed_days_7d FROM trend""",
        "trend",
    ),
)
def trend_7d(spark, sf):
    return given.trend(spark, sf).select(
        "app_id", "date_day", "avg_player_count_7d", "observed_days_7d"
    )


@query(
    "trend_record",
    compose(
        """SELECT app_id, CAST(date_day AS VARCHAR) AS date_day, peak_player_count_record,
          days_since_peak, CAST(last_record_day AS VARCHAR) AS last_record_day FROM trend""",
        "trend",
    ),
)
def trend_record(spark, sf):
    return given.trend(spark, sf).select(
        "app_id", "date_day", "peak_player_count_record", "days_since_peak", "last_record_day"
    )


def order_days(spark, sf):
    """Orders as an hourly fact: customers over the whole calendar, with long gaps."""
    orders = given.table(spark, sf, "orders").select(
        F.col("o_custkey").alias("app_id"),
        F.round("o_totalprice").cast("bigint").alias("player_count"),
        (F.col("o_orderdate") + F.make_dt_interval(hours=(F.col("o_orderkey") % 24).cast("int")))
        .alias("logical_hour"),
        "o_orderkey",
    )
    first = orders.groupBy("app_id", "logical_hour").agg(
        F.min("player_count").alias("player_count")
    )
    return fact_native(first)


@query(
    "dense_orders_by_day",
    """
    WITH f AS (
      SELECT o_custkey AS app_id, o_orderdate + INTERVAL 1 HOUR * (o_orderkey % 24) AS h,
        min(CAST(round(o_totalprice) AS BIGINT)) AS v
      FROM orders GROUP BY 1, 2),
    r AS (
      SELECT app_id, CAST(h AS DATE) AS d, max(v) AS peak, count(*) AS n FROM f GROUP BY 1, 2),
    g AS (
      SELECT app_id, CAST(unnest(generate_series(min(d), (SELECT max(d) FROM r),
        INTERVAL 1 DAY)) AS DATE) AS d FROM r GROUP BY app_id),
    w AS (
      SELECT g.app_id, g.d, r.peak, coalesce(r.n, 0) AS n,
        max(r.peak) OVER (PARTITION BY g.app_id ORDER BY g.d ROWS UNBOUNDED PRECEDING) AS record,
        count(r.peak) OVER (PARTITION BY g.app_id ORDER BY g.d
          ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS n7
      FROM g LEFT JOIN r ON r.app_id = g.app_id AND r.d = g.d)
    SELECT CAST(d AS VARCHAR) AS date_day, count(*) AS entities,
      count(*) FILTER (WHERE n = 0) AS gaps, CAST(sum(n) AS BIGINT) AS hours,
      CAST(sum(record) AS BIGINT) AS records, CAST(sum(n7) AS BIGINT) AS support
    FROM w GROUP BY d""",
)
def dense_orders_by_day(spark, sf):
    """Trends over the grid of all customers and days, years long and mostly gaps, per day."""
    trended = trends(dense_daily(order_days(spark, sf), folded=True))
    return trended.groupBy("date_day").agg(
        F.count(F.lit(1)).alias("entities"),
        F.count_if(F.col("observed_hours") == 0).alias("gaps"),
        F.sum("observed_hours").alias("hours"),
        F.sum("peak_player_count_record").alias("records"),
        F.sum("observed_days_7d").alias("support"),
    )


@query(
    "latest_per_entity",
    compose(
        """SELECT app_id, CAST(logical_hour AS VARCHAR) AS logical_hour, player_count
        FROM latest""",
        "latest",
    ),
)
def latest_per_entity_query(spark, sf):
    return latest_per_entity(given.fact(spark, sf))


@query(
    "late_guard",
    compose("SELECT event_id, user_id AS app_id FROM late", "late"),
)
def late_guard(spark, sf):
    rows = given.observations(spark, sf).withColumn("logical_date", F.col("logical_hour"))
    return within_staleness(rows).select("event_id", "app_id")


@query(
    "response_status",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN 'unobservable' ELSE 'observed' END
      AS status, CASE WHEN event_type <> 'error' THEN CAST(round(value * 100) AS BIGINT) END
      AS player_count FROM events""",
    gaps=["player_count"],
)
def response_status(spark, sf):
    refused = F.col("event_type") == "error"
    responses = given.observations(spark, sf).select(
        "event_id",
        F.col("app_id"),
        F.when(refused, 404).otherwise(200).alias("http_status"),
        F.when(~refused, F.col("player_count").cast("int")).alias("player_count"),
    )
    return classify_responses(responses).select("event_id", "status", "player_count")


# ---- calendar and ranks ----


@query(
    "dim_date",
    """SELECT CAST(d AS VARCHAR) AS date_day, CAST(isodow(d) AS BIGINT) AS day_of_week,
      dayname(d) AS day_name, isodow(d) IN (6, 7) AS is_weekend,
      CAST(weekofyear(d) AS BIGINT) AS week_of_year, CAST(month(d) AS BIGINT) AS month_number,
      monthname(d) AS month_name, CAST(quarter(d) AS BIGINT) AS quarter,
      CAST(year(d) AS BIGINT) AS year, orders
    FROM (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS orders FROM orders GROUP BY 1)""",
)
def dim_date(spark, sf):
    """The calendar joined to the days that orders fall on, with the orders of each."""
    days = given.table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("date_day"))
    per_day = days.groupBy("date_day").agg(F.count(F.lit(1)).alias("orders"))
    first, last = per_day.agg(F.min("date_day"), F.max("date_day")).first()
    nowhere = date(1970, 1, 1)
    calendar = spines.dim_date(spark, first or nowhere, last or nowhere)
    return calendar.join(per_day, "date_day")


@query(
    "dense_rank_orders",
    """SELECT o_orderkey, o_totalprice,
      CAST(dense_rank() OVER (ORDER BY o_totalprice DESC) AS BIGINT) AS price_rank FROM orders""",
)
def dense_rank_orders(spark, sf):
    orders = given.table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return with_dense_ranks(orders, {"o_totalprice": "price_rank"})


@query(
    "dense_rank_ties",
    """SELECT l_orderkey, l_linenumber, l_quantity,
      CAST(dense_rank() OVER (ORDER BY l_quantity DESC) AS BIGINT) AS quantity_rank
    FROM lineitem""",
)
def dense_rank_ties(spark, sf):
    lines = given.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return with_dense_ranks(lines, {"l_quantity": "quantity_rank"})


# ---- hour ledger ----

LEDGER_COLUMNS = """CAST(logical_hour AS VARCHAR) AS logical_hour, status, has_observations,
  is_high_water_mark, CAST(tracked_count AS BIGINT) AS tracked_count,
  CAST(observed_count AS BIGINT) AS observed_count,
  CAST(unobservable_count AS BIGINT) AS unobservable_count,
  CAST(failed_count AS BIGINT) AS failed_count, CAST(loaded_count AS BIGINT) AS loaded_count,
  CAST(snapshot_rows AS BIGINT) AS snapshot_rows,
  CAST(latency_p50_ms AS BIGINT) AS latency_p50_ms,
  CAST(latency_max_ms AS BIGINT) AS latency_max_ms, run_id,
  CAST(recorded_at AS VARCHAR) AS recorded_at"""


@query(
    "hour_ledger",
    compose(f"SELECT {LEDGER_COLUMNS} FROM ledger", "ledger"),
    gaps=[
        "tracked_count", "observed_count", "unobservable_count", "failed_count", "loaded_count",
        "snapshot_rows", "latency_p50_ms", "latency_max_ms",
    ],
    flags=["is_high_water_mark"],
)
def hour_ledger(spark, sf):
    return given.ledger(spark, sf)


LEDGER_GAPS = (
    "tracked_count", "observed_count", "unobservable_count", "failed_count", "loaded_count",
    "snapshot_rows", "latency_p50_ms", "latency_max_ms",
)


@query(
    "ledger_incremental",
    compose(f"SELECT {LEDGER_COLUMNS} FROM ledger", "ledger"),
    gaps=LEDGER_GAPS,
    flags=["is_high_water_mark"],
)
def ledger_incremental(spark, sf):
    """The ledger over counts that were kept up to date by loads: history up to the middle day but
    for one hour, then all later days, then the late hour, whose load reads its own day only."""
    root = scratch_dir(spark, "hours")
    store = Store(spark, root)
    fact = settled(fact_native(given.side_observations(spark, sf)), "side")
    first, last = given.event_days(spark, sf)
    middle, late = first + (last - first) // 2, first + (last - first) // 4
    day = F.col("date_day")
    held_back = (day == F.lit(late)) & (F.col("hour_of_day") == 5)
    write_days(fact.filter((day < F.lit(middle)) & ~held_back), f"{root}/{FACT}")
    build = store.build()
    build.write(HOURS, counts_of_days(store.read(FACT)))
    build.publish()
    later = [middle + timedelta(days=d) for d in range((last - middle).days + 1)]
    for days in (later, [late]):
        write_days(fact.filter(day.isin(*days)), f"{root}/{FACT}")
        counted = refresh_hour_counts(store, days)
    runs = ledger.normalize_runs(given.runs_raw(spark, sf))
    return ledger.ledger_of_counts(runs, counted, given.day_after(spark, sf))


@query(
    "missing_hours",
    compose(
        """SELECT CAST(logical_hour AS VARCHAR) AS logical_hour, status, has_observations
        FROM ledger WHERE NOT has_observations""",
        "ledger",
    ),
)
def missing_hours(spark, sf):
    return ledger.missing_hours(given.ledger(spark, sf))


@query(
    "high_water_mark",
    compose(
        """SELECT CAST(logical_hour AS VARCHAR) AS logical_hour FROM ledger
        WHERE is_high_water_mark""",
        "ledger",
    ),
)
def high_water_mark(spark, sf):
    return ledger.high_water_mark(given.ledger(spark, sf))


@query(
    "status_histogram",
    compose("SELECT status, count(*) AS n FROM ledger GROUP BY status", "ledger"),
)
def status_histogram(spark, sf):
    return reports.status_histogram(given.ledger(spark, sf))


@query(
    "status_cells",
    compose(
        """SELECT CAST(CAST(logical_hour AS DATE) AS VARCHAR) AS day,
          extract(hour FROM logical_hour) AS hour, status,
          CASE WHEN run_id IS NULL THEN status
            ELSE format('{}: {} of {} observed', status, observed_count, tracked_count) END
            AS hover
        FROM ledger""",
        "ledger",
    ),
)
def status_cells(spark, sf):
    return reports.status_cells(given.ledger(spark, sf))


@query(
    "status_grid",
    compose(
        "SELECT CAST(CAST(logical_hour AS DATE) AS VARCHAR) AS day, "
        + ", ".join(
            f"max(status) FILTER (WHERE extract(hour FROM logical_hour) = {h}) AS h{h:02d}"
            for h in range(24)
        )
        + " FROM ledger GROUP BY 1",
        "ledger",
    ),
)
def status_grid(spark, sf):
    return reports.status_grid(given.ledger(spark, sf))


@query(
    "observed_per_hour",
    compose(
        """SELECT CAST(logical_hour AS VARCHAR) AS logical_hour, snapshot_rows FROM ledger""",
        "ledger",
    ),
    gaps=["snapshot_rows"],
)
def observed_per_hour(spark, sf):
    return reports.observed_per_hour(given.ledger(spark, sf))


@query(
    "latency_per_hour",
    compose(
        """SELECT CAST(logical_hour AS VARCHAR) AS logical_hour, latency_p50_ms, latency_max_ms
        FROM ledger""",
        "ledger",
    ),
    gaps=["latency_p50_ms", "latency_max_ms"],
)
def latency_per_hour(spark, sf):
    return reports.latency_per_hour(given.ledger(spark, sf))


@query(
    "ledger_summary",
    compose(
        """SELECT
          count(*) FILTER (WHERE status = 'complete') AS complete_hours,
          count(*) FILTER (WHERE status = 'ran_short') AS ran_short_hours,
          count(*) FILTER (WHERE status = 'unrecorded') AS unrecorded_hours,
          count(*) FILTER (WHERE status = 'unaudited') AS unaudited_hours,
          CAST(max(logical_hour) FILTER (WHERE is_high_water_mark) AS VARCHAR) AS high_water_mark,
          (SELECT count(*) FROM day_flagged WHERE app_id IN (SELECT c_custkey FROM customer))
            AS unobservable_entities
        FROM ledger""",
        "ledger",
        "day_flagged",
    ),
)
def ledger_summary(spark, sf):
    return reports.ledger_summary(given.ledger(spark, sf), given.entity_dim(spark, sf))


@query(
    "ledger_density_check",
    compose(
        """SELECT * FROM (
          SELECT count(*) AS actual_rows,
            CAST(epoch(max(logical_hour) - min(logical_hour)) / 3600 + 1 AS BIGINT)
              AS expected_rows,
            count(*) FILTER (WHERE is_high_water_mark) AS flagged_rows
          FROM ledger WHERE extract(hour FROM logical_hour) <> 5)
        WHERE actual_rows <> expected_rows OR flagged_rows <> 1""",
        "ledger",
    ),
)
def ledger_density_check(spark, sf):
    """A ledger with one hour of the day taken out must be reported."""
    return checks.ledger_not_dense(given.ledger(spark, sf).filter(F.hour("logical_hour") != 5))


@query(
    "run_counts",
    compose(
        """SELECT run_id, tracked_count, observed_count, len(ids) AS unobservable_count,
          tracked_count - observed_count - len(ids) AS failed_count
        FROM listing""",
        "listing",
    ),
    gaps=["unobservable_count", "failed_count"],
)
def run_counts(spark, sf):
    runs = ledger.normalize_runs(given.listing_runs(spark, sf))
    return runs.select(
        "run_id", "tracked_count", "observed_count", "unobservable_count", "failed_count"
    )


@query(
    "catalog_run_counts",
    compose(
        """SELECT run_id, len(ids) AS skipped_chart_count,
          len(CASE WHEN event_id % 2 = 0 THEN ids END) AS no_metadata_count FROM listing""",
        "listing",
    ),
    gaps=["skipped_chart_count", "no_metadata_count"],
)
def catalog_run_counts(spark, sf):
    ids = F.col("unobservable_app_ids")
    runs = given.listing_runs(spark, sf).select(
        "run_id",
        ids.alias("skipped_chart_app_ids"),
        F.when(F.col("run_id").cast("bigint") % 2 == 0, ids).alias("no_metadata_app_ids"),
    )
    return ledger.normalize_catalog_runs(runs).select(
        "run_id", "skipped_chart_count", "no_metadata_count"
    )


# ---- reports ----

BOARD_COLUMNS = """app_id, app_name, current_rank, current_player_count,
  CAST(current_hour AS VARCHAR) AS current_hour, avg_player_count_current_day,
  peak_player_count_current_day, observed_hours_current_day, rank_7d, avg_player_count_7d,
  observed_days_7d, peak_player_count_record, CAST(last_record_day AS VARCHAR) AS last_record_day,
  days_since_peak, CAST(release_date AS VARCHAR) AS release_date, genre_names, is_free,
  CAST(final_cents AS DOUBLE) / 100 AS price_final_usd, tracked_source"""


def board(spark: SparkSession, sf: str, trended: DataFrame | None = None) -> DataFrame:
    return reports.leaderboard(
        given.board_dim(spark, sf),
        given.fact(spark, sf),
        given.trend(spark, sf) if trended is None else trended,
        lambda current: settled(current, "board"),
    )


def trend_table(spark: SparkSession, sf: str) -> DataFrame:
    """The trends as a written table, for reports that read them more than once."""
    return settled(given.trend(spark, sf), "trends")


@query("leaderboard", compose(f"SELECT {BOARD_COLUMNS} FROM board", "board"), flags=["is_free"])
def leaderboard(spark, sf):
    return board(spark, sf)


@query(
    "leaderboard_by_day", compose(f"SELECT {BOARD_COLUMNS} FROM board", "board"), flags=["is_free"]
)
def leaderboard_by_day(spark, sf):
    """The board on trends kept in folders by day, of which it reads the current ones."""
    root, trended = scratch_dir(spark, "by-day"), given.trend(spark, sf)
    write_days(trended, f"{root}/{TRENDS}")
    held = spark.read.schema(trended.schema).parquet(f"{root}/{TRENDS}")
    return reports.leaderboard(
        given.board_dim(spark, sf),
        given.fact(spark, sf),
        held,
        lambda current: settled(current, "board"),
        by_day=True,
    )


@query(
    "board_table",
    compose(
        """SELECT current_rank AS "Rank", app_name AS "Game",
          current_player_count AS "Players now",
          CAST((CAST(round(avg_player_count_7d * 10) AS BIGINT) + 5) // 10 AS BIGINT)
            AS "7-day avg",
          rank_7d AS "7-day rank", peak_player_count_record AS "Record peak",
          days_since_peak AS "Days since peak",
          strftime(current_hour, '%Y-%m-%d %H:00') AS "Latest hour (UTC)"
        FROM board""",
        "board",
    ),
)
def board_table(spark, sf):
    return reports.board_table(board(spark, sf))


@query(
    "board_top",
    compose(
        """SELECT app_name, current_player_count FROM board
        ORDER BY current_rank, app_id LIMIT 15""",
        "board",
    ),
)
def board_top(spark, sf):
    return reports.board_top(board(spark, sf))


@query(
    "board_summary",
    compose(
        """SELECT count(*) AS ranked,
          CAST(sum(current_player_count) FILTER (
            WHERE current_hour = (SELECT max(current_hour) FROM board)) AS BIGINT)
            AS players_at_latest_hour,
          CAST(max(current_hour) AS VARCHAR) AS latest_hour,
          count(*) FILTER (WHERE current_hour < (SELECT max(current_hour) FROM board))
            AS behind_latest_hour
        FROM board""",
        "board",
    ),
    gaps=["players_at_latest_hour"],
)
def board_summary(spark, sf):
    return reports.board_summary(board(spark, sf))


@query(
    "top_movers",
    compose(
        """, moved AS (
          SELECT t.app_id, coalesce(m.app_name, r.name) AS app_name,
            t.avg_player_count_change_rate AS change_rate
          FROM trend t JOIN registry r ON r.app_id = t.app_id
          LEFT JOIN meta m ON m.app_id = r.app_id
          WHERE t.avg_player_count_change_rate IS NOT NULL AND t.date_day = (
            SELECT max(date_day) FROM trend
            WHERE date_day < (SELECT max(date_day) FROM trend)))
        SELECT * FROM (SELECT * FROM moved ORDER BY change_rate DESC, app_id LIMIT 6)
        UNION ALL
        SELECT * FROM (SELECT * FROM moved ORDER BY change_rate, app_id LIMIT 6)""",
        "trend",
        "registry",
        "meta",
    ),
)
def top_movers(spark, sf):
    return reports.top_movers(trend_table(spark, sf), given.board_dim(spark, sf))


@query(
    "movers_labels",
    compose(
        """, moved AS (
          SELECT t.app_id, CAST(round(t.avg_player_count_change_rate * 10000) AS BIGINT) AS rate
          FROM trend t WHERE t.avg_player_count_change_rate IS NOT NULL)
        SELECT app_id, count(*) AS days, min(
          CASE WHEN rate <= -5 THEN '-' ELSE '+' END || ((abs(rate) + 5) // 10) // 10 || '.'
            || ((abs(rate) + 5) // 10) % 10 || '%') AS labels
        FROM moved GROUP BY app_id""",
        "trend",
    ),
)
def movers_labels(spark, sf):
    """Every change as its label; per entity their number and the first in text order."""
    rate = "avg_player_count_change_rate"
    moved = given.trend(spark, sf).filter(F.col(rate).isNotNull())
    labelled = moved.select("app_id", signed_percent(F.col(rate)).alias("label"))
    return labelled.groupBy("app_id").agg(
        F.count(F.lit(1)).alias("days"), F.min("label").alias("labels")
    )


PANELS = """SELECT b.rank_7d, b.app_id, b.app_name, CAST(t.date_day AS VARCHAR) AS date_day,
  {columns}
  FROM trend t JOIN board b ON b.app_id = t.app_id
  WHERE b.rank_7d <= 6 AND t.date_day < (SELECT max(date_day) FROM trend)"""


def panels(spark: SparkSession, sf: str) -> DataFrame:
    trended = trend_table(spark, sf)
    return reports.top_panels(trended, board(spark, sf, trended))


@query(
    "top_panels",
    compose(
        PANELS.format(columns="t.avg_player_count, t.avg_player_count_7d, t.observed_hours"),
        "board",
    ),
)
def top_panels(spark, sf):
    return panels(spark, sf)


@query(
    "panels_long",
    compose(
        PANELS.format(
            columns="t.observed_hours, 'Daily average' AS series, t.avg_player_count AS value"
        )
        + " UNION ALL "
        + PANELS.format(
            columns="t.observed_hours, '7-day average' AS series, t.avg_player_count_7d AS value"
        ),
        "board",
    ),
)
def panels_long(spark, sf):
    names = {"avg_player_count": "Daily average", "avg_player_count_7d": "7-day average"}
    ids = ["rank_7d", "app_id", "app_name", "date_day", "observed_hours"]
    return reports.to_long(panels(spark, sf), ids, names)


@query(
    "hour_profile",
    compose(
        """SELECT hour_of_day, avg(players) AS players FROM (
          SELECT logical_hour, hour_of_day, CAST(sum(player_count) AS BIGINT) AS players
          FROM kind_fact WHERE date_day IN (
            SELECT date_day FROM kind_dense GROUP BY date_day HAVING max(n) = 24
            ORDER BY date_day DESC LIMIT 7)
          GROUP BY logical_hour, hour_of_day)
        GROUP BY hour_of_day""",
        "kind_dense",
    ),
)
def hour_profile(spark, sf):
    return reports.hour_of_day_profile(
        given.fact(spark, sf, "event_type"), given.daily(spark, sf, "event_type")
    )


@query(
    "hour_profile_labels",
    compose(
        """SELECT hour_of_day, format('{:,}', CAST(round_even(avg(players), 0) AS BIGINT)) AS players
        FROM (
          SELECT logical_hour, hour_of_day, CAST(sum(player_count) AS BIGINT) AS players
          FROM kind_fact GROUP BY logical_hour, hour_of_day)
        GROUP BY hour_of_day""",
        "kind_fact",
    ),
)
def hour_profile_labels(spark, sf):
    """Mean totals by hour of day over all days, as labels."""
    totals = given.fact(spark, sf, "event_type").groupBy("logical_hour", "hour_of_day").agg(
        F.sum("player_count").alias("players")
    )
    return totals.groupBy("hour_of_day").agg(grouped(F.avg("players")).alias("players"))


@query(
    "freshness_frontier",
    compose(
        """SELECT
          CAST((SELECT max(logical_hour) FROM ledger WHERE has_observations) AS VARCHAR)
            AS observed_through,
          CAST((SELECT max(logical_hour) FROM obs_fact) AS VARCHAR) AS built_through""",
        "ledger",
        "obs_fact",
    ),
)
def freshness_frontier(spark, sf):
    return reports.freshness(given.fact(spark, sf), given.ledger(spark, sf))


@query("freshness_by_day", ORACLE["freshness_frontier"])
def freshness_by_day(spark, sf):
    """The frontier of a fact kept in folders by day."""
    root, fact = scratch_dir(spark, "frontier"), given.fact(spark, sf)
    write_days(fact, f"{root}/{FACT}")
    held = spark.read.schema(fact.schema).parquet(f"{root}/{FACT}")
    return reports.freshness(held, given.ledger(spark, sf), by_day=True)


@query(
    "adhoc_sql",
    compose(
        """SELECT date_day, entities, peak FROM (
          SELECT CAST(date_day AS VARCHAR) AS date_day, count(*) AS entities, max(peak) AS peak
          FROM obs_dense GROUP BY 1)""",
        "obs_dense",
    ),
)
def adhoc_sql(spark, sf):
    return tables.query(
        spark,
        """SELECT date_day, count(*) AS entities, max(peak_player_count) AS peak
        FROM {daily} GROUP BY date_day""",
        daily=given.daily(spark, sf),
    )


# ---- registry, metadata ----


@query(
    "all_of_last_n",
    compose(
        """SELECT app_id, count(*) AS listings FROM (
          SELECT unnest(ids) AS app_id FROM (
            SELECT ids FROM listing WHERE ids IS NOT NULL AND observed_count > 0
            ORDER BY ts DESC, run_id DESC LIMIT 24))
        GROUP BY app_id""",
        "listing",
    ),
)
def all_of_last_n(spark, sf):
    """The evidence behind the flag: in how many of the last 24 evidence runs each id is listed."""
    runs = ledger.normalize_runs(given.listing_runs(spark, sf))
    recent = registry.listed_ids(registry.evidence_runs(runs, schemas.KNOWN_UNOBSERVABLE_HOURS))
    return recent.groupBy("app_id").agg(F.count(F.lit(1)).alias("listings"))


@query("always_unobservable", compose("SELECT app_id FROM day_flagged", "day_flagged"))
def always_unobservable(spark, sf):
    runs, absent = given.day_evidence(given.daily(spark, sf))
    return registry.always_unobservable(runs, absent, 2)


@query(
    "entity_dim_flag",
    compose(
        """SELECT r.app_id, coalesce(m.app_name, r.name) AS app_name, m.app_type,
          m.app_description, CAST(m.release_date AS VARCHAR) AS release_date, m.genre_names,
          CAST(m.required_age AS BIGINT) AS required_age, m.is_free, m.is_windows, m.is_mac,
          m.is_linux, CAST(m.metacritic_score AS BIGINT) AS metacritic_score,
          CAST(m.achievement_count AS BIGINT) AS achievement_count,
          CAST(m.recommendation_count AS BIGINT) AS recommendation_count,
          CAST(m.initial_cents AS DOUBLE) / 100 AS price_initial_usd,
          CAST(m.final_cents AS DOUBLE) / 100 AS price_final_usd,
          r.source AS tracked_source, '2024-01-01 00:00:00' AS tracked_from, r.is_active,
          r.app_id IN (SELECT app_id FROM day_flagged) AS is_unobservable
        FROM registry r LEFT JOIN meta m ON m.app_id = r.app_id""",
        "registry",
        "meta",
        "day_flagged",
    ),
    gaps=["required_age", "metacritic_score", "recommendation_count", "achievement_count"],
    flags=["is_free", "is_windows", "is_mac", "is_linux"],
)
def entity_dim_flag(spark, sf):
    return given.entity_dim(spark, sf)


@query(
    "unobservable_canary",
    compose(
        """SELECT app_id FROM obs_dense
        WHERE n = 0 AND date_day = (SELECT max(date_day) FROM obs_dense WHERE n > 0)
          AND app_id NOT IN (SELECT f.app_id FROM day_flagged f
                             JOIN customer c ON c.c_custkey = f.app_id)""",
        "obs_dense",
        "day_flagged",
    ),
)
def unobservable_canary(spark, sf):
    runs, absent = given.day_evidence(given.daily(spark, sf))
    return checks.unflagged_unobservable(runs, absent, given.entity_dim(spark, sf))


@query(
    "metadata_extract",
    compose(
        """SELECT app_id, steam_appid, app_name, app_type, app_description,
          CAST(release_date AS VARCHAR) AS release_date, genre_names,
          CAST(required_age AS BIGINT) AS required_age, is_free, is_windows, is_mac, is_linux,
          CAST(metacritic_score AS BIGINT) AS metacritic_score,
          CAST(achievement_count AS BIGINT) AS achievement_count,
          CAST(recommendation_count AS BIGINT) AS recommendation_count, price_currency,
          CAST(initial_cents AS DOUBLE) / 100 AS price_initial_usd,
          CAST(final_cents AS DOUBLE) / 100 AS price_final_usd
        FROM meta""",
        "meta",
    ),
    gaps=["required_age", "metacritic_score", "recommendation_count"],
)
def metadata_extract(spark, sf):
    return given.metadata(spark, sf)


@query(
    "json_props",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
      CAST(json_extract_string(props, '$.missing.deeper') AS VARCHAR) AS missing FROM events""",
)
def json_props(spark, sf):
    doc = given.table(spark, sf, "events").select("event_id", F.parse_json("props").alias("doc"))
    return doc.select(
        "event_id",
        value_at("doc", "$.k", "int").alias("k"),
        text_at("doc", "$.missing.deeper").alias("missing"),
    )


def seed(spark: SparkSession) -> DataFrame:
    return tables.seed_frame(spark, (-2, -1, 0, 5, 9, 10, 18, 20, 50, 80, 90, 100, 110))


def app_list(spark: SparkSession, sf: str) -> DataFrame:
    """Customers of all nations but one as the app list; another nation's are listed twice, and
    the later name stands."""
    listed = given.table(spark, sf, "customer").filter("c_nationkey <> 2")
    key = F.col("c_custkey").alias("app_id")
    once = listed.select(key, F.col("c_name").alias("name"), F.lit(0).alias("position"))
    renamed = F.concat(F.lit("renamed "), "c_name").alias("name")
    again = listed.filter("c_nationkey = 12").select(key, renamed, F.lit(1).alias("position"))
    return once.unionByName(again)


def chart(spark: SparkSession, sf: str) -> DataFrame:
    """The hundred best customers."""
    totals = (
        given.table(spark, sf, "orders")
        .groupBy(F.col("o_custkey").alias("app_id"))
        .agg(F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("total"))
    )
    return top_k(totals, 100, F.desc("total"), F.asc("app_id")).select("app_id")


@query(
    "chart_per_year",
    """SELECT year, o_custkey, total_cents, place FROM (
      SELECT *, row_number() OVER (PARTITION BY year ORDER BY total_cents DESC, o_custkey) AS place
      FROM (SELECT CAST(year(o_orderdate) AS BIGINT) AS year, o_custkey,
              CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS total_cents
            FROM orders GROUP BY 1, 2)) WHERE place <= 100""",
)
def chart_per_year(spark, sf):
    """The top hundred of every year; the rank limit is applied before the shuffle too."""
    totals = (
        given.table(spark, sf, "orders")
        .groupBy(F.year("o_orderdate").alias("year"), "o_custkey")
        .agg(F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("total_cents"))
    )
    best = Window.partitionBy("year").orderBy(F.desc("total_cents"), F.asc("o_custkey"))
    return totals.withColumn("place", F.row_number().over(best)).filter("place <= 100")


@query("admit", compose("SELECT app_id, name, source FROM admitted", "admitted"))
def admit(spark, sf):
    return registry.admit(seed(spark), chart(spark, sf), app_list(spark, sf)).admitted


@query(
    "admit_refused",
    compose(
        "SELECT app_id FROM judged_ids WHERE name IS NULL AND source <> 'seed'", "judged_ids"
    ),
)
def admit_refused(spark, sf):
    return registry.admit(seed(spark), chart(spark, sf), app_list(spark, sf)).refused


def known(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as the registry so far; those with debts and one segment are inactive."""
    return given.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("app_id"),
        F.col("c_name").alias("name"),
        F.lit("chart").alias("source"),
        F.lit(datetime(2024, 1, 1)).cast("timestamp").alias("tracked_from"),
        F.expr("c_mktsegment <> 'BUILDING' AND c_acctbal >= 0").alias("is_active"),
    )


def stepped(spark: SparkSession, sf: str) -> registry.Step:
    charted, listed = chart(spark, sf), app_list(spark, sf)
    admission = registry.admit(seed(spark), charted, listed)
    return registry.registry_step(known(spark, sf), admission, charted, listed, given.AS_OF)


@query(
    "registry_step",
    compose(
        """SELECT app_id, name, source,
          is_active OR app_id IN (SELECT app_id FROM chart) AS is_active,
          '2024-01-01 00:00:00' AS tracked_from FROM known
        UNION ALL
        SELECT app_id, name, source, true, '2024-01-30 23:00:00' FROM admitted
        WHERE app_id NOT IN (SELECT app_id FROM known)""",
        "known",
        "admitted",
    ),
)
def registry_step(spark, sf):
    return stepped(spark, sf).state


@query(
    "registry_audit",
    compose(
        """SELECT (SELECT count(DISTINCT app_id) FROM app_list) AS app_list_count,
          (SELECT count(*) FROM chart) AS chart_count,
          (SELECT coalesce(string_agg(CAST(app_id AS VARCHAR), '|' ORDER BY app_id), '')
           FROM judged_ids WHERE name IS NULL AND source <> 'seed') AS skipped_chart_app_ids,
          (SELECT count(*) FROM admitted WHERE app_id NOT IN (SELECT app_id FROM known))
            AS newly_tracked_count,
          (SELECT count(*) FROM known WHERE NOT is_active AND app_id IN (SELECT app_id FROM chart))
            AS reactivated_count""",
        "known",
        "admitted",
    ),
)
def registry_audit(spark, sf):
    return stepped(spark, sf).audit


@query(
    "active_ids",
    compose("SELECT app_id FROM known WHERE is_active", "known"),
)
def active_ids(spark, sf):
    return registry.active_ids(known(spark, sf))


def part_chart(spark: SparkSession, sf: str) -> DataFrame:
    totals = (
        given.table(spark, sf, "lineitem")
        .groupBy(F.col("l_partkey").alias("app_id"))
        .agg(F.sum(F.col("l_quantity").cast("bigint")).alias("total"))
    )
    return top_k(totals, 100, F.desc("total"), F.asc("app_id")).select("app_id")


def described(
    spark: SparkSession, sf: str, details: DataFrame | None = None
) -> registry.MetadataStep:
    """Parts: the smaller ones have older metadata, one brand has no details any more."""
    parts = given.table(spark, sf, "part").withColumnRenamed("p_partkey", "app_id")
    earlier = F.lit(datetime(2024, 1, 1)).cast("timestamp")
    stored = parts.filter("p_size <= 25").select(
        "app_id",
        F.parse_json(F.lit('{"name":"old"}')).alias("data"),
        earlier.alias("first_loaded_at"),
        earlier.alias("updated_at"),
    )
    members = parts.select(
        "app_id",
        F.col("p_name").alias("name"),
        F.lit("chart").alias("source"),
        earlier.alias("tracked_from"),
        (F.col("p_type") != "PROMO").alias("is_active"),
    )
    if details is None:
        details = unwrap_details(given.details_raw(spark, sf))
    return registry.metadata_step(stored, members, details, part_chart(spark, sf), given.AS_OF)


@query(
    "metadata_step",
    """SELECT p_partkey AS app_id,
      CASE WHEN p_brand <> 'Brand#9' THEN p_name ELSE 'old' END AS name,
      CASE WHEN p_size <= 25 THEN '2024-01-01 00:00:00' ELSE '2024-01-30 23:00:00' END
        AS first_loaded_at,
      CASE WHEN p_brand <> 'Brand#9' THEN '2024-01-30 23:00:00' ELSE '2024-01-01 00:00:00' END
        AS updated_at
    FROM part WHERE p_size <= 25 OR p_brand <> 'Brand#9'""",
)
def metadata_step(spark, sf):
    state = described(spark, sf).metadata
    return state.select(
        "app_id", text_at("data", "$.name").alias("name"), "first_loaded_at", "updated_at"
    )


@query(
    "metadata_step_registry",
    compose(
        """SELECT p_partkey AS app_id, p_type <> 'PROMO' AND NOT (
            p_brand = 'Brand#9' AND p_partkey NOT IN (SELECT app_id FROM part_chart)) AS is_active
        FROM part""",
        "part_chart",
    ),
)
def metadata_step_registry(spark, sf):
    return described(spark, sf).registry.select("app_id", "is_active")


@query(
    "catalog_audit",
    compose(
        """SELECT 'scheduled-1' AS run_id, '2024-01-30 23:00:00' AS logical_date,
          (SELECT count(DISTINCT app_id) FROM app_list) AS app_list_count,
          (SELECT count(*) FROM chart) AS chart_count,
          (SELECT count(*) FROM admitted WHERE app_id NOT IN (SELECT app_id FROM known))
            AS newly_tracked_count,
          (SELECT count(*) FROM part WHERE p_brand <> 'Brand#9') AS metadata_upserted_count,
          (SELECT coalesce(string_agg(CAST(app_id AS VARCHAR), '|' ORDER BY app_id), '')
           FROM part_chart JOIN part ON p_partkey = app_id WHERE p_brand = 'Brand#9') AS no_metadata_app_ids,
          (SELECT count(*) FROM part WHERE p_brand = 'Brand#9' AND p_type <> 'PROMO'
             AND p_partkey NOT IN (SELECT app_id FROM part_chart)) AS deactivated_count""",
        "known",
        "admitted",
        "part_chart",
    ),
)
def catalog_audit(spark, sf):
    return catalog_record(spark, sf).select(
        "run_id", "logical_date", "app_list_count", "chart_count", "newly_tracked_count",
        "metadata_upserted_count", "no_metadata_app_ids", "deactivated_count",
    )


def catalog_record(
    spark: SparkSession, sf: str, details: DataFrame | None = None
) -> DataFrame:
    """The audit record of one catalog run over the given tables; it reads the details thrice."""
    if details is None:
        details = given.landed_details(spark, sf)
    run = spark.range(1).select(
        F.lit("scheduled-1").alias("run_id"),
        F.lit(given.AS_OF).cast("timestamp").alias("logical_date"),
        landing.app_list_key(F.lit(given.AS_OF)).alias("app_list_key"),
        landing.most_played_key(F.lit(given.AS_OF)).alias("most_played_key"),
    )
    return audit.audit_catalog_run(
        run, stepped(spark, sf).audit, described(spark, sf, details).audit, given.AS_OF
    )


# ---- key-aware loads, on orders ----


def order_sides(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Orders up to 1998 as the target, those from 1997 on as the incoming side with new values."""
    orders = given.table(spark, sf, "orders").select(
        "o_orderkey",
        F.col("o_orderstatus").alias("status"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_custkey")).alias("counter"),
        "o_orderdate",
    )
    incoming = orders.filter("o_orderdate >= '1997-01-01'").select(
        "o_orderkey",
        F.lit("new").alias("status"),
        (F.col("cents") + 1).alias("cents"),
        F.lit(-1).cast("bigint").alias("counter"),
    )
    target = orders.filter("o_orderdate < '1999-01-01'").drop("o_orderdate")
    return target, incoming


ORDER_TARGET = """target AS (
  SELECT o_orderkey, o_orderstatus AS status, CAST(round(o_totalprice * 100) AS BIGINT) AS cents,
    CASE WHEN o_orderpriority = '1-URGENT' THEN o_custkey END AS counter
  FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01')"""


@query(
    "insert_if_absent",
    f"""WITH {ORDER_TARGET}
    SELECT * FROM target
    UNION ALL
    SELECT o_orderkey, 'first', CAST(round(o_totalprice * 100) AS BIGINT) + 1, -1
    FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND NOT o_orderdate < TIMESTAMP '1999-01-01'""",
    gaps=["counter"],
)
def insert_if_absent(spark, sf):
    """Every incoming key comes twice; the first of the two is the one inserted."""
    target, incoming = order_sides(spark, sf)
    twice = incoming.withColumn("attempt", F.explode(F.array(F.lit(2), F.lit(1)))).withColumn(
        "status", F.when(F.col("attempt") == 1, "first").otherwise("second")
    )
    fresh = merge.absent_rows(twice, target, ["o_orderkey"], ["attempt"])
    return target.unionByName(fresh.drop("attempt"))


@query(
    "upsert_replace",
    f"""WITH {ORDER_TARGET}
    SELECT o_orderkey,
      CASE WHEN o_orderdate >= TIMESTAMP '1997-01-01' THEN 'new' ELSE o_orderstatus END AS status,
      CAST(round(o_totalprice * 100) AS BIGINT)
        + CASE WHEN o_orderdate >= TIMESTAMP '1997-01-01' THEN 1 ELSE 0 END AS cents,
      CASE WHEN o_orderdate >= TIMESTAMP '1997-01-01' THEN -1
        WHEN o_orderpriority = '1-URGENT' THEN o_custkey END AS counter
    FROM orders""",
    gaps=["counter"],
)
def upsert_replace(spark, sf):
    target, incoming = order_sides(spark, sf)
    attempts = incoming.withColumn("attempt", F.explode(F.array(F.lit(1), F.lit(2)))).withColumn(
        "cents", F.when(F.col("attempt") == 2, F.col("cents")).otherwise(0)
    )
    newest = merge.newest_per_key(attempts, ["o_orderkey"], "attempt")
    return merge.upsert(target, newest, ["o_orderkey"])


@query(
    "upsert_in_buckets",
    f"SELECT * FROM ({ORACLE['upsert_replace']})",
    gaps=["counter"],
)
def upsert_in_buckets(spark, sf):
    """The upsert of two loads, one after the other, into a target laid out by its key."""
    target, incoming = order_sides(spark, sf)
    key, root = ["o_orderkey"], scratch_dir(spark, "buckets")
    held = write_buckets(target, f"{root}/orders-0", key, 8)
    for number, share in enumerate((0, 1), 1):
        load = incoming.filter(F.col("o_orderkey") % 2 == share)
        held = write_buckets(merge.upsert(held, load, key), f"{root}/orders-{number}", key, 8)
    return held


@query(
    "upsert_first_non_null",
    """SELECT o_orderkey,
      CASE WHEN o_orderdate < TIMESTAMP '1999-01-01' THEN o_orderstatus ELSE 'new' END AS status,
      CAST(round(o_totalprice * 100) AS BIGINT)
        + CASE WHEN o_orderdate >= TIMESTAMP '1997-01-01' THEN 1 ELSE 0 END AS cents,
      CASE WHEN o_orderdate < TIMESTAMP '1999-01-01' AND o_orderpriority = '1-URGENT' THEN o_custkey
        WHEN o_orderdate >= TIMESTAMP '1997-01-01' THEN -1 END AS counter
    FROM orders""",
    gaps=["counter"],
)
def upsert_first_non_null(spark, sf):
    target, incoming = order_sides(spark, sf)
    return merge.upsert(
        target, incoming, ["o_orderkey"], keep=["status"], first_non_null=["counter"]
    )


@query(
    "set_flag",
    """SELECT c_custkey AS app_id,
      c_mktsegment <> 'HOUSEHOLD' AND c_custkey NOT IN (
        SELECT o_custkey FROM orders WHERE o_orderstatus = 'F') AS is_active FROM customer""",
)
def set_flag(spark, sf):
    finished = given.table(spark, sf, "orders").filter("o_orderstatus = 'F'")
    ids = finished.select(F.col("o_custkey").alias("app_id"))
    members = given.registry_raw(spark, sf).select("app_id", "is_active")
    return merge.set_flag(members, ids, False)


@query(
    "flag_changes",
    """SELECT c_custkey AS app_id FROM customer
    WHERE c_mktsegment <> 'HOUSEHOLD' AND c_custkey IN (
      SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')""",
)
def flag_changes(spark, sf):
    finished = given.table(spark, sf, "orders").filter("o_orderstatus = 'F'")
    ids = finished.select(F.col("o_custkey").alias("app_id"))
    return merge.flag_changes(given.registry_raw(spark, sf), ids, False).select("app_id")


# ---- landing documents, audits, streams ----


def hourly_answers(spark: SparkSession, sf: str) -> DataFrame:
    """Every event as one answer of the run of its hour; errors are the unobservable ones."""
    seen = F.col("event_type") != "error"
    return given.observations(spark, sf).select(
        F.date_trunc("hour", "logical_hour").alias("logical_date"),
        F.col("event_id").alias("app_id"),
        F.when(seen, F.col("player_count")).alias("player_count"),
        F.when(seen, F.lit(1)).alias("api_result"),
        "observed_at",
        "latency_ms",
        F.when(seen, "observed").otherwise("unobservable").alias("status"),
    )


def hourly_bundles(spark: SparkSession, sf: str, max_rows: int = 50_000) -> DataFrame:
    answers = hourly_answers(spark, sf)
    tracked = answers.groupBy("logical_date").agg((F.count(F.lit(1)) + 2).alias("tracked_count"))
    return audit.bundle(answers, tracked, max_rows)


def land(bundles: DataFrame, root: str) -> None:
    """Land bundles by day and hour, so that landing an hour again replaces that hour only."""
    dated = bundles.withColumns({"dt": F.to_date("logical_date"), "hour": F.hour("logical_date")})
    landing.write_documents(dated, root, landing.PLAYER_COUNTS, ["dt", "hour"], ["part"])


@query(
    "latency_stats",
    """SELECT CAST(date_trunc('hour', ts) AS VARCHAR) AS logical_date,
      count(*) + 2 AS tracked_count,
      count(*) FILTER (WHERE event_type <> 'error') AS observed_count,
      count(*) FILTER (WHERE event_type = 'error') AS unobservable_count,
      CAST(round_even(median(event_id * 37 % 900000) FILTER (WHERE event_type <> 'error'), 0)
        AS BIGINT) AS latency_p50_ms,
      max(event_id * 37 % 900000) FILTER (WHERE event_type <> 'error') AS latency_max_ms
    FROM events GROUP BY 1""",
    gaps=["latency_p50_ms", "latency_max_ms"],
)
def latency_stats(spark, sf):
    """Measures of runs whose answers are spread over several documents."""
    return audit.run_measures(hourly_bundles(spark, sf, max_rows=5))


@query(
    "document_summary",
    """SELECT CAST(date_trunc('hour', ts) AS VARCHAR) AS logical_date,
      count(*) + 2 AS tracked_count,
      count(*) FILTER (WHERE event_type <> 'error') AS observed_count,
      coalesce(string_agg(CAST(event_id AS VARCHAR), '|' ORDER BY event_id)
        FILTER (WHERE event_type = 'error'), '') AS unobservable_app_ids
    FROM events GROUP BY 1""",
)
def document_summary(spark, sf):
    """What documents say together; a run is spread over several."""
    return audit.document_summary(hourly_bundles(spark, sf, max_rows=5)).drop("s3_key")


@query(
    "bundle_roundtrip",
    """SELECT event_id AS app_id, CAST(round(value * 100) AS BIGINT) AS player_count,
      CAST(date_trunc('hour', ts) AS VARCHAR) AS logical_hour, event_id * 37 % 900000 AS latency_ms,
      'raw/player-counts/dt=' || strftime(ts, '%Y-%m-%d') || '/hour=' || extract(hour FROM ts)
        AS folder
    FROM events WHERE event_type <> 'error'""",
)
def bundle_roundtrip(spark, sf):
    """Answers bundled, landed as JSON, read back and opened."""
    root = scratch_dir(spark, "roundtrip")
    land(hourly_bundles(spark, sf), root)
    rows = audit.bundle_rows(landing.read_bundles(spark, root))
    folder = F.regexp_extract("s3_key", "^(.*)/part-[^/]*[.]json$", 1).alias("folder")
    return rows.select("app_id", "player_count", "logical_hour", "latency_ms", folder)


def quarter_bundles(spark: SparkSession, sf: str, observed_at: str) -> DataFrame:
    """Observations as the answers of one run every quarter of an hour."""
    answers = given.observations(spark, sf).select(
        F.window("logical_hour", "15 minutes")["start"].alias("logical_date"),
        "app_id",
        "player_count",
        F.lit(1).alias("api_result"),
        F.col(observed_at).alias("observed_at"),
        "latency_ms",
        F.lit("observed").alias("status"),
    )
    tracked = answers.groupBy("logical_date").agg(F.count(F.lit(1)).alias("tracked_count"))
    return audit.bundle(answers, tracked)


@query(
    "rebuild_from_landing",
    compose(
        """SELECT app_id, CAST(date_day AS VARCHAR) AS date_day,
          CAST(logical_hour AS VARCHAR) AS logical_hour, hour_of_day, player_count
        FROM obs_fact""",
        "obs_fact",
    ),
)
def rebuild_from_landing(spark, sf):
    """The raw table rebuilt from all documents, loaded twice, then the fact on top of it."""
    root = scratch_dir(spark, "rebuild")
    land(quarter_bundles(spark, sf, "logical_hour"), root)
    tables.create_raw_tables(spark, f"{root}/tables")
    path = f"{root}/tables/player_counts"
    rows = (
        audit.bundle_rows(landing.read_bundles(spark, root))
        .withColumn("loaded_at", F.lit(given.AS_OF).cast("timestamp"))
    )
    insert_player_counts(rows, path, ["s3_key", "position"])
    insert_player_counts(rows, path, ["s3_key", "position"])
    held = tables.read_player_counts(spark, path)
    return fact_native(normalize_observations(held, carry=()))


@query(
    "snapshot_audit",
    """SELECT 'run-' || strftime(h, '%Y%m%d%H') AS run_id, CAST(h AS VARCHAR) AS logical_hour,
      CASE WHEN landed THEN tracked END AS tracked_count,
      CASE WHEN landed THEN seen END AS observed_count,
      CASE WHEN landed THEN coalesce(refused, '') END AS unobservable_app_ids,
      CASE WHEN landed AND extract(hour FROM h) < 18 THEN seen ELSE 0 END AS loaded_count,
      CASE WHEN landed THEN 'raw/player-counts/dt=' || strftime(h, '%Y-%m-%d') || '/'
        || strftime(h, '%H') || '-snapshot.json' END AS s3_key
    FROM (
      SELECT date_trunc('hour', ts) AS h, extract(hour FROM date_trunc('hour', ts)) <> 7 AS landed,
        count(*) + 2 AS tracked, count(*) FILTER (WHERE event_type <> 'error') AS seen,
        string_agg(CAST(event_id AS VARCHAR), '|' ORDER BY event_id)
          FILTER (WHERE event_type = 'error') AS refused
      FROM events GROUP BY 1, 2)""",
    gaps=["tracked_count", "observed_count"],
)
def snapshot_audit(spark, sf):
    """Every hour has a run; hour 7 never landed, and the evenings were never loaded."""
    bundles = hourly_bundles(spark, sf).filter(F.hour("logical_date") != 7)
    held = audit.bundle_rows(bundles).filter(F.hour("logical_hour") < 18)
    hours = given.observations(spark, sf).select(
        F.date_trunc("hour", "logical_hour").alias("logical_hour")
    )
    runs = hours.distinct().withColumn(
        "run_id", F.concat(F.lit("run-"), F.date_format("logical_hour", "yyyyMMddHH"))
    )
    return audit.audit_snapshot_runs(runs, bundles, held, given.AS_OF).drop(
        "recorded_at", "latency_p50_ms", "latency_max_ms"
    )


@query(
    "hourly_run_end_to_end",
    """SELECT CAST(h AS VARCHAR) AS logical_hour,
      CASE WHEN seen > 0 AND n IS NULL THEN 'unaudited' WHEN n IS NULL THEN 'unrecorded'
        WHEN extract(hour FROM h) % 3 > 0 AND seen > 0 THEN 'complete' ELSE 'ran_short' END
        AS status,
      n + CASE WHEN extract(hour FROM h) % 3 = 0 THEN 2 ELSE 0 END AS tracked_count,
      seen AS observed_count, n - seen AS unobservable_count,
      seen AS loaded_count, nullif(seen, 0) AS snapshot_rows
    FROM (SELECT unnest(generate_series(
        (SELECT date_trunc('hour', min(ts)) FROM events WHERE event_type <> 'error'),
        (SELECT date_trunc('hour', max(ts)) + INTERVAL 24 HOUR FROM events),
        INTERVAL 1 HOUR)) AS h)
    LEFT JOIN (SELECT date_trunc('hour', ts) AS h, count(*) AS n,
        count(*) FILTER (WHERE event_type <> 'error') AS seen FROM events GROUP BY 1) USING (h)""",
    gaps=["tracked_count", "observed_count", "unobservable_count", "loaded_count", "snapshot_rows"],
)
def hourly_run_end_to_end(spark, sf):
    """Answers landed, loaded into the created tables and audited, all of it twice, and the ledger
    on those tables. Every third hour of the day two entities gave no answer at all."""
    root = scratch_dir(spark, "hourly")
    answers = hourly_answers(spark, sf)
    silent = F.when(F.hour("logical_date") % 3 == 0, 2).otherwise(0)
    tracked = answers.groupBy("logical_date").agg(F.count(F.lit(1)).alias("n")).select(
        "logical_date", (F.col("n") + silent).alias("tracked_count")
    )
    land(audit.bundle(answers, tracked), root)
    tables.create_raw_tables(spark, f"{root}/tables")
    counts, runs_path = f"{root}/tables/player_counts", f"{root}/tables/snapshot_runs"
    runs = tracked.select(
        F.date_format("logical_date", "yyyyMMddHH").alias("run_id"),
        F.col("logical_date").alias("logical_hour"),
    )
    for attempt in ("first", "second"):
        bundles = landing.read_bundles(spark, root)
        rows = audit.bundle_rows(bundles).withColumn(
            "loaded_at", F.lit(given.AS_OF).cast("timestamp")
        )
        insert_player_counts(rows, counts, ["s3_key", "position"])
        held = tables.read_player_counts(spark, counts)
        record = audit.audit_snapshot_runs(runs, bundles, held, given.AS_OF)
        table = spark.read.schema(schemas.SNAPSHOT_RUNS).parquet(runs_path)
        state = merge.upsert(table, record, ["run_id"])
        runs_path = write_version(state, f"{root}/runs", attempt)
    recorded = ledger.normalize_runs(spark.read.schema(schemas.SNAPSHOT_RUNS).parquet(runs_path))
    observed = normalize_observations(held, carry=())
    return ledger.hour_ledger(recorded, observed, given.day_after(spark, sf)).select(
        "logical_hour", "status", "tracked_count", "observed_count", "unobservable_count",
        "loaded_count", "snapshot_rows",
    )


@query(
    "admit_from_landing",
    compose("SELECT app_id, name, source FROM admitted", "admitted"),
)
def admit_from_landing(spark, sf):
    """The app list landed in pages and the chart as one document, read back and judged."""
    root, day = scratch_dir(spark, "catalog"), F.lit(given.AS_OF.date()).alias("dt")
    stamped = [F.lit(given.AS_OF).cast("timestamp").alias(c) for c in ("logical_date", "fetched_at")]
    listed = app_list(spark, sf).withColumn("page", (F.col("app_id") / 500).cast("int"))
    entry = F.struct("position", F.col("app_id").alias("appid"), "name")
    pages = listed.groupBy("page").agg(F.array_sort(F.collect_list(entry)).alias("apps"))
    landing.write_documents(
        pages.select(day, "page", *stamped, "apps"), root, landing.APP_LIST, ["dt"], ["page"]
    )
    places = chart(spark, sf).agg(
        F.collect_list(F.struct(F.col("app_id").alias("appid"))).alias("most_played")
    )
    landing.write_documents(places.select(day, *stamped, "*"), root, landing.MOST_PLAYED, ["dt"])
    names, charted = landing.read_app_list(spark, root), landing.read_chart(spark, root)
    return registry.admit(seed(spark), charted, names).admitted


@query(
    "catalog_latency",
    """SELECT CAST(d AS VARCHAR) AS logical_date, count(*) AS answers,
      CAST(round_even(median(ms), 0) AS BIGINT) AS latency_p50_ms, max(ms) AS latency_max_ms
    FROM (SELECT o_orderdate AS d,
        CASE WHEN o_orderstatus <> 'F' THEN o_orderkey * 37 % 900000 END AS ms FROM orders)
    GROUP BY d""",
    gaps=["latency_p50_ms", "latency_max_ms"],
)
def catalog_latency(spark, sf):
    """Orders as the answers of their day's catalog run; finished ones say no latency."""
    answers = given.table(spark, sf, "orders").select(
        F.col("o_orderdate").alias("logical_date"),
        F.when(
            F.col("o_orderstatus") != "F", (F.col("o_orderkey") * 37 % 900_000).cast("int")
        ).alias("latency_ms"),
    )
    return audit.details_latency(answers)


@query(
    "details_from_landing",
    compose(
        """SELECT app_id, steam_appid, app_name, app_type, genre_names IS NULL AS no_genres
        FROM meta""",
        "meta",
    ),
)
def details_from_landing(spark, sf):
    """Storefront answers landed one document each, read back and opened."""
    root = scratch_dir(spark, "details")
    documents = given.details_raw(spark, sf).select(
        F.lit(given.AS_OF.date()).alias("dt"),
        "app_id",
        F.lit(given.AS_OF).cast("timestamp").alias("logical_date"),
        "envelope",
    )
    landing.write_documents(documents, root, landing.APP_DETAILS, ["dt"], ["app_id"])
    opened = unwrap_details(landing.read_details(spark, root)).filter("success")
    return extract_metadata(opened).select(
        "app_id", "steam_appid", "app_name", "app_type",
        F.col("genre_names").isNull().alias("no_genres"),
    )


@query(
    "model_views",
    compose(
        """SELECT CAST(date_day AS VARCHAR) AS date_day, count(*) AS n,
          count(DISTINCT app_id) AS entities
        FROM obs_fact JOIN registry USING (app_id) GROUP BY 1""",
        "obs_fact",
        "registry",
    ),
)
def model_views(spark, sf):
    """The model as views under their names, asked by plain SQL."""
    model.build(spark, given.raw_tables(spark, sf), given.AS_OF).register()
    return spark.sql(
        """SELECT date_day, count(*) AS n, count(DISTINCT app_id) AS entities
        FROM fct_player_counts JOIN dim_game USING (app_id) GROUP BY date_day"""
    )


@query(
    "metadata_versions",
    """SELECT p_partkey AS app_id,
      CASE WHEN p_brand <> 'Brand#9' THEN '2024-01-30 23:00:00' ELSE '2024-01-01 00:00:00' END
        AS updated_at
    FROM part WHERE p_size <= 25 OR p_brand <> 'Brand#9'""",
)
def metadata_versions(spark, sf):
    """The stepped metadata written as a new version and read back from it."""
    root = scratch_dir(spark, "versions")
    path = write_version(described(spark, sf).metadata, root, "2024-01-30")
    return spark.read.schema(schemas.APP_METADATA).parquet(path).select("app_id", "updated_at")


def event_stream(spark: SparkSession, sf: str) -> DataFrame:
    events = spark.readStream.schema(given.SCHEMAS["events"]).parquet(f"{sf}/events.parquet*")
    return given.to_observations(events.withColumn("ts", F.col("ts").cast("timestamp")))


@query(
    "stream_hourly_dedup",
    compose(
        """SELECT app_id, CAST(logical_hour AS VARCHAR) AS logical_hour, player_count
        FROM obs_staged
        WHERE logical_hour + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 2 HOUR""",
        "obs_staged",
    ),
)
def stream_hourly_dedup(spark, sf):
    """The streamed fact: every hour the watermark has closed."""
    root = scratch_dir(spark, "hours")
    stream = streaming.first_in_hour(event_stream(spark, sf))
    streaming.run_to_end(streaming.append_files(stream, f"{root}/out", f"{root}/checkpoint"))
    return spark.read.schema(stream.schema).parquet(f"{root}/out")


@query(
    "stream_latest",
    compose(
        """SELECT app_id, player_count FROM (
          SELECT user_id AS app_id, CAST(round(value * 100) AS BIGINT) AS player_count,
            row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rn FROM events)
        WHERE rn = 1""",
    ),
)
def stream_latest(spark, sf):
    root = scratch_dir(spark, "latest")
    stream = streaming.latest_in_stream(event_stream(spark, sf))
    streaming.run_to_end(streaming.write_changes(stream, f"{root}/out", f"{root}/checkpoint"))
    return streaming.read_changes(spark, f"{root}/out", "app_id").select("app_id", "player_count")


@query(
    "stream_corrected",
    compose(
        """SELECT app_id, CAST(logical_hour AS VARCHAR) AS logical_hour, player_count
        FROM obs_staged
        WHERE logical_hour + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events)""",
        "obs_staged",
    ),
)
def stream_corrected(spark, sf):
    """Observations that arrive up to two hours late, in eight loads: every hour that the stream
    has passed, as last corrected."""
    root, slices = scratch_dir(spark, "corrected"), 8
    events = given.table(spark, sf, "events")
    delay = F.make_dt_interval(mins=(F.col("event_id") * 53 % 119).cast("int"))
    arrived = events.withColumn("arrived", F.unix_micros(F.col("ts") + delay))
    span = arrived.agg(F.min("arrived").alias("low"), F.max("arrived").alias("high")).first()
    width = ((span.high or 0) - (span.low or 0)) // slices + 1
    part = F.floor((F.col("arrived") - F.lit(span.low or 0)) / F.lit(width))
    arrived = arrived.withColumn("part", part)
    arrived.drop("arrived").write.partitionBy("part").parquet(f"{root}/arrived")
    schema = given.SCHEMAS["events"].replace("timestamp_ntz", "timestamp")
    arrived = spark.read.schema(f"{schema}, part bigint").parquet(f"{root}/arrived")
    for k in range(slices):  # one load after the other; the stream goes on from its checkpoint
        load = arrived.filter(F.col("part") == k).drop("part")
        load.write.mode("append").parquet(f"{root}/landed")
        landed = spark.readStream.schema(schema).parquet(f"{root}/landed")
        stream = streaming.corrected_hours(given.to_observations(landed))
        streaming.run_to_end(streaming.write_changes(stream, f"{root}/out", f"{root}/checkpoint"))
    held = streaming.read_changes(spark, f"{root}/out", "app_id", "logical_hour")
    return held.select("app_id", "logical_hour", "player_count")


@query(
    "stream_load",
    """SELECT app_id, CAST(date_trunc('hour', quarter) AS VARCHAR) AS logical_hour, player_count
    FROM (
      SELECT *, row_number() OVER (
        PARTITION BY app_id, date_trunc('hour', quarter) ORDER BY quarter) AS in_hour
      FROM (
        SELECT user_id AS app_id, time_bucket(INTERVAL 15 MINUTE, ts) AS quarter,
          CAST(round(value * 100) AS BIGINT) AS player_count,
          ts + INTERVAL 1 MINUTE * (event_id % 181) AS observed_at,
          event_id * 37 % 900000 AS latency_ms,
          row_number() OVER (PARTITION BY user_id, time_bucket(INTERVAL 15 MINUTE, ts)
            ORDER BY ts + INTERVAL 1 MINUTE * (event_id % 181)) AS asked
        FROM events)
      WHERE asked = 1
        AND observed_at - INTERVAL 1 MILLISECOND * latency_ms <= quarter + INTERVAL 2 HOUR)
    WHERE in_hour = 1""",
)
def stream_load(spark, sf):
    """Documents landed, streamed into the raw table with late rows refused, then normalized."""
    root = scratch_dir(spark, "load")
    land(quarter_bundles(spark, sf, "observed_at"), root)
    tables.create_raw_tables(spark, f"{root}/tables")
    path = f"{root}/tables/player_counts"
    rows = streaming.observation_stream(streaming.bundle_stream(spark, root))
    loading = streaming.load_player_counts(
        rows, path, f"{root}/checkpoint", lambda: given.AS_OF
    )
    streaming.run_to_end(loading)
    return normalize_observations(tables.read_player_counts(spark, path), carry=())


# ---- checks ----


def tally_query(name: str, contract: dict, frame: Query, sql_rules: dict[str, str], source: str,
                *needs: str) -> None:
    """Register the count of every rule's violations, in one pass over the table."""
    counts = " UNION ALL ".join(
        f"SELECT '{rule}' AS \"check\", count(*) FILTER (WHERE {sql}) AS violations FROM {source}"
        for rule, sql in sql_rules.items()
    )
    query(name, compose(counts, *needs))(
        lambda spark, sf: checks.tally(frame(spark, sf), contract)
    )


tally_query(
    "checks_daily_contract",
    checks.DAILY_CONTRACT,
    lambda spark, sf: given.daily(spark, sf).withColumns(
        {
            "observed_hours": F.col("observed_hours") * 13,
            "avg_player_count": F.when(F.col("app_id") % 3 != 0, F.col("avg_player_count")),
        }
    ),
    {
        "hours_out_of_range": "n * 13 > 24",
        "mean_and_hours_disagree": "n > 0 AND app_id % 3 = 0",
        "peak_and_hours_disagree": "(n > 0) <> (peak IS NOT NULL)",
        "peak_below_mean": "peak * 10 < tenths",
    },
    "obs_dense",
    "obs_dense",
)

tally_query(
    "checks_trends_contract",
    checks.TRENDS_CONTRACT,
    lambda spark, sf: given.trend(spark, sf).withColumns(
        {
            "avg_player_count_change": F.when(
                F.col("app_id") % 3 == 0, F.col("avg_player_count_change")
            ),
            "avg_player_count_change_rate": F.when(
                F.col("app_id") % 5 != 0, F.col("avg_player_count_change_rate")
            ),
        }
    ),
    {
        "change_is_not_the_difference": "app_id % 3 <> 0 AND avg_player_count_change IS NOT NULL",
        "rate_and_basis_disagree": "app_id % 5 = 0 AND avg_player_count_change_rate IS NOT NULL",
        "support_out_of_range": "observed_days_7d > 7",
        "mean_and_support_disagree": "observed_days_7d > 0 AND avg_player_count_7d IS NULL",
        "peak_above_record": "peak_player_count > peak_player_count_record",
        "record_in_the_future": "last_record_day > date_day",
        "negative_days_since_peak": "days_since_peak < 0",
    },
    "trend",
    "trend",
)

tally_query(
    "checks_ledger_contract",
    checks.LEDGER_CONTRACT,
    lambda spark, sf: given.ledger(spark, sf).withColumn(
        "status", F.when(F.hour("logical_hour") < 12, F.col("status")).otherwise("complete")
    ),
    {
        "unknown_status": "false",
        "complete_without_rows": """NOT has_observations
          AND (status = 'complete' OR extract(hour FROM logical_hour) >= 12)""",
        "unrecorded_with_rows": "status = 'unrecorded' AND has_observations",
        "unaudited_with_run": "status = 'unaudited' AND run_id IS NOT NULL",
        "high_water_not_complete": "status <> 'complete' AND is_high_water_mark",
    },
    "ledger",
    "ledger",
)

tally_query(
    "checks_board_contract",
    checks.BOARD_CONTRACT,
    lambda spark, sf: board(spark, sf).withColumn(
        "current_player_count", F.col("current_player_count") * 2
    ),
    {
        "current_above_day_peak": "current_player_count * 2 > peak_player_count_current_day",
        "day_peak_above_record": "peak_player_count_current_day > peak_player_count_record",
        "hours_out_of_range": "observed_hours_current_day NOT BETWEEN 1 AND 24",
    },
    "board",
    "board",
)


@query(
    "checks_grain",
    """SELECT user_id AS app_id, CAST(date_trunc('hour', ts) AS VARCHAR) AS logical_hour,
      count(*) AS n FROM events GROUP BY 1, 2 HAVING count(*) > 1""",
)
def checks_grain(spark, sf):
    """Hours that several observations share, before they are normalized."""
    hours = given.observations(spark, sf).withColumn(
        "logical_hour", F.date_trunc("hour", "logical_hour")
    )
    return checks.duplicates(hours, "app_id", "logical_hour")


@query(
    "checks_unique",
    """SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) > 1""",
)
def checks_unique(spark, sf):
    return checks.duplicates(given.table(spark, sf, "orders"), "o_custkey")


@query(
    "checks_not_null",
    compose("SELECT app_id, app_name FROM meta WHERE genre_names IS NULL", "meta"),
)
def checks_not_null(spark, sf):
    return given.metadata(spark, sf).filter(checks.is_null("genre_names")).select("app_id", "app_name")


@query(
    "checks_accepted",
    compose("SELECT app_id, app_type FROM meta WHERE app_type NOT IN ('game')", "meta"),
)
def checks_accepted(spark, sf):
    found = given.metadata(spark, sf).filter(checks.is_unaccepted("app_type", ["game"]))
    return found.select("app_id", "app_type")


@query(
    "checks_same_id",
    compose("SELECT app_id, steam_appid FROM meta WHERE app_id <> steam_appid", "meta"),
)
def checks_same_id(spark, sf):
    found = checks.breaches(given.metadata(spark, sf), checks.SAME_ID)
    return found.select("app_id", "steam_appid")


@query(
    "checks_relationships",
    """SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
    WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size < 40)""",
)
def checks_relationships(spark, sf):
    parts = given.table(spark, sf, "part").filter("p_size < 40")
    found = checks.orphans(given.table(spark, sf, "lineitem"), "l_partkey", parts, "p_partkey")
    return found.select("l_orderkey", "l_linenumber", "l_partkey")


@query(
    "checks_non_negative",
    """SELECT c_custkey AS app_id, CAST(round(c_acctbal * 100) AS BIGINT) AS player_count
    FROM customer WHERE round(c_acctbal * 100) < 0""",
)
def checks_non_negative(spark, sf):
    balances = given.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("app_id"),
        F.round(F.col("c_acctbal") * 100).cast("bigint").alias("player_count"),
    )
    return checks.breaches(balances, checks.NON_NEGATIVE)


@query(
    "checks_ranks",
    compose(
        """SELECT * FROM (
          SELECT 'current_rank' AS rank_column, max(current_rank) AS max_rank,
            count(DISTINCT current_rank) AS distinct_ranks FROM board WHERE current_rank <> 2
          UNION ALL
          SELECT 'rank_7d', max(rank_7d), count(DISTINCT rank_7d) FROM board
          WHERE current_rank <> 2)
        WHERE max_rank <> distinct_ranks""",
        "board",
    ),
)
def checks_ranks(spark, sf):
    """A board without its second rank has holes."""
    return checks.ranks_with_holes(board(spark, sf).filter("current_rank <> 2"))


@query(
    "checks_freshness",
    """SELECT CAST(max(ts) AS VARCHAR) AS newest FROM events
    HAVING max(ts) < TIMESTAMP '2024-02-02 00:00:00' - INTERVAL 26 HOUR""",
)
def checks_freshness(spark, sf):
    return checks.stale(given.table(spark, sf, "events"), "ts", datetime(2024, 2, 2), 26)


ANOMALIES = f"""WITH hours AS (
    SELECT date_trunc('hour', ts) AS h, count(DISTINCT user_id) AS n,
      CAST(epoch(date_trunc('hour', ts)) // 3600 AS BIGINT) AS k
    FROM events GROUP BY 1, 3),
  counted AS (
    SELECT h, n * CASE WHEN k % 89 = 7 THEN 4 ELSE 1 END AS n FROM hours WHERE k % 97 <> 13),
  dense AS (
    SELECT s.h, coalesce(n, 0) AS n FROM (
      SELECT unnest(generate_series((SELECT min(h) FROM counted),
        (SELECT date_trunc('hour', max(ts)) FROM events), INTERVAL 1 HOUR)) AS h) s
    LEFT JOIN counted USING (h)),
  past AS (
    SELECT h, n, coalesce(list(n) OVER (PARTITION BY isodow(h), extract(hour FROM h) ORDER BY h
      ROWS BETWEEN 8 PRECEDING AND 1 PRECEDING), []) AS w FROM dense),
  middle AS (SELECT *, CAST(list_aggregate(w, 'median') AS DOUBLE) AS m FROM past),
  spread AS (
    SELECT *, CAST(list_aggregate(list_transform(w, lambda x: abs(x - m)), 'median') AS DOUBLE) AS d
    FROM middle WHERE len(w) >= 3),
  judged AS (
    SELECT *, greatest(d * {3.0 * anomaly.SIGMA!r}::DOUBLE, m * 0.1::DOUBLE, 1.0::DOUBLE) AS allowed
    FROM spread)
  SELECT CAST(h AS VARCHAR) AS logical_hour, n AS snapshot_rows, CAST(len(w) AS BIGINT) AS weeks_seen,
    m AS expected, d AS spread, CASE WHEN n < m THEN 'drop' ELSE 'spike' END AS kind
  FROM judged WHERE n < m - allowed OR n > m + allowed"""


@query("checks_row_anomaly", ANOMALIES)
def checks_row_anomaly(spark, sf):
    """Hours whose rows are far from those of the same hour in the weeks before. Of the given
    observations every 97th hour is lost and every 89th comes fourfold."""
    rows = normalize_observations(given.observations(spark, sf), carry=())
    hour = F.floor(F.unix_timestamp("logical_hour") / 3600)
    copies = F.when(hour % 89 == 7, F.sequence(F.lit(0), F.lit(3))).otherwise(F.array(F.lit(0)))
    seeded = rows.filter(hour % 97 != 13).withColumn("copy", F.explode(copies))
    last = given.table(spark, sf, "events").agg(F.max("ts")).scalar()
    return anomaly.row_count_anomalies(ledger.hour_counts(seeded), last)


@query(
    "checks_recently_short",
    compose(
        """SELECT CAST(logical_hour AS VARCHAR) AS logical_hour, status,
          CAST(failed_count AS BIGINT) AS failed_count, CAST(loaded_count AS BIGINT) AS loaded_count
        FROM ledger WHERE status = 'ran_short'
          AND logical_hour > (SELECT max(ts) FROM events) - INTERVAL 48 HOUR
          AND logical_hour <= (SELECT max(ts) FROM events)""",
        "ledger",
    ),
)
def checks_recently_short(spark, sf):
    last = given.table(spark, sf, "events").agg(F.max("ts")).scalar()
    return checks.recently_short(given.ledger(spark, sf), last, 48)


def refresh_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Urgent open orders as records of catalog runs: days with several, and days without any."""
    urgent = given.table(spark, sf, "orders").filter(
        "o_orderpriority = '1-URGENT' AND o_orderstatus = 'P'"
    )
    return urgent.select(
        F.col("o_orderkey").cast("string").alias("run_id"),
        F.col("o_orderdate").alias("logical_date"),
        (F.col("o_orderdate") + F.expr("interval 1 minute") * (F.col("o_custkey") % 600)).alias(
            "recorded_at"
        ),
        F.col("o_custkey").cast("int").alias("app_list_count"),
        F.lit(100).alias("chart_count"),
        (F.col("o_orderkey") % 7).cast("int").alias("newly_tracked_count"),
    )


REFRESHED = """refreshed AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS run_id, CAST(o_orderdate AS DATE) AS d,
    o_orderdate + INTERVAL 1 MINUTE * (o_custkey % 600) AS recorded_at,
    o_custkey AS app_list_count, o_orderkey % 7 AS newly_tracked_count
  FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'P'),
recorded AS (
  SELECT *, count(*) OVER (PARTITION BY d) AS attempts, row_number() OVER (
    PARTITION BY d ORDER BY recorded_at DESC, run_id DESC) AS rn FROM refreshed),
days AS (
  SELECT CAST(unnest(generate_series((SELECT min(d) FROM refreshed),
    (SELECT CAST(max(o_orderdate) AS DATE) FROM orders), INTERVAL 1 DAY)) AS DATE) AS d)"""


@query(
    "catalog_days",
    f"""WITH {REFRESHED}
    SELECT CAST(days.d AS VARCHAR) AS date_day, run_id IS NOT NULL AS is_recorded, run_id,
      CAST(recorded_at AS VARCHAR) AS recorded_at, app_list_count,
      CASE WHEN run_id IS NOT NULL THEN 100 END AS chart_count, newly_tracked_count,
      coalesce(attempts, 0) AS attempts
    FROM days LEFT JOIN recorded ON recorded.d = days.d AND rn = 1""",
    gaps=["app_list_count", "chart_count", "newly_tracked_count"],
)
def catalog_days(spark, sf):
    """Every day up to the last order with the last catalog record of the day, if there is one."""
    last = given.table(spark, sf, "orders").agg(F.max("o_orderdate")).scalar()
    return ledger.catalog_days(refresh_runs(spark, sf), last)


@query(
    "checks_unrecorded_days",
    f"""WITH {REFRESHED}
    SELECT CAST(d AS VARCHAR) AS date_day FROM days WHERE d NOT IN (SELECT d FROM refreshed)""",
)
def checks_unrecorded_days(spark, sf):
    last = given.table(spark, sf, "orders").agg(F.max("o_orderdate")).scalar()
    return checks.unrecorded_days(ledger.catalog_days(refresh_runs(spark, sf), last))


# The relations of the model in SQL: what the given tables are to it, and how hours are judged.
MODEL = """,
  as_of AS (SELECT CAST(max(ts) AS DATE) + INTERVAL 23 HOUR AS moment FROM events),
  given_as_of AS (SELECT TIMESTAMP '2024-01-30 23:00:00' AS moment),
  fact AS (SELECT * FROM obs_fact),
  daily AS (
    SELECT app_id, date_day, CAST(tenths AS DOUBLE) / 10 AS avg_player_count,
      peak AS peak_player_count, n AS observed_hours FROM obs_dense),
  trends AS (SELECT * FROM trend),
  dim AS (SELECT app_id, false AS is_unobservable FROM registry),
  dates AS (
    SELECT CAST(unnest(generate_series((SELECT min(CAST(ts AS DATE)) FROM events),
      (SELECT max(CAST(ts AS DATE)) FROM events), INTERVAL 1 DAY)) AS DATE) AS date_day),
  catalog AS (SELECT 'scheduled-1' AS run_id, moment AS recorded_at FROM given_as_of),
  loads AS (SELECT moment AS loaded_at FROM given_as_of, events),
  stored AS (SELECT moment AS updated_at FROM given_as_of, meta),
  absent AS (SELECT CAST(NULL AS BIGINT) AS app_id FROM events WHERE false),
  timed AS (
    SELECT s.logical_hour, c.n IS NOT NULL AS has_observations, d.run_id,
      CASE
        WHEN d.run_id IS NULL AND c.n IS NOT NULL THEN 'unaudited'
        WHEN d.run_id IS NULL THEN 'unrecorded'
        WHEN d.tracked_count - d.observed_count - d.unobservable_count = 0
          AND d.loaded_count = d.observed_count AND d.observed_count > 0 THEN 'complete'
        ELSE 'ran_short' END AS status
    FROM (SELECT unnest(generate_series((SELECT min(logical_hour) FROM fact),
        (SELECT moment FROM as_of), INTERVAL 1 HOUR)) AS logical_hour) s
    LEFT JOIN (SELECT logical_hour, count(*) AS n FROM fact GROUP BY 1) c USING (logical_hour)
    LEFT JOIN (SELECT * FROM runs QUALIFY row_number() OVER (
        PARTITION BY logical_hour ORDER BY recorded_at DESC) = 1) d USING (logical_hour)),
  hours AS (
    SELECT *, logical_hour = max(logical_hour) FILTER (WHERE status = 'complete') OVER ()
      AS is_high_water_mark FROM timed)
"""
MODEL_NEEDS = ("meta", "registry", "obs_dense", "runs", "trend", "board")

# The same with something wrong in every table. Tenths of the entities are told apart by id.
BROKEN = """
  broken_fact AS (
    SELECT CASE app_id % 10 WHEN 2 THEN NULL WHEN 6 THEN -app_id ELSE app_id END AS app_id,
      CASE app_id % 10 WHEN 5 THEN NULL WHEN 7 THEN date_day + 4000 ELSE date_day END AS date_day,
      CASE WHEN app_id % 10 <> 4 THEN logical_hour END AS logical_hour,
      CASE WHEN app_id % 10 = 3 THEN -1 - player_count ELSE player_count END AS player_count
    FROM fact UNION ALL
    SELECT app_id, date_day, logical_hour, player_count FROM fact WHERE app_id % 10 = 1),
  broken_trends AS (
    SELECT * REPLACE (
      CASE app_id % 10 WHEN 2 THEN NULL WHEN 6 THEN -app_id ELSE app_id END AS app_id,
      CASE app_id % 10 WHEN 5 THEN NULL WHEN 7 THEN date_day + 4000 ELSE date_day END AS date_day,
      CASE WHEN app_id % 10 = 3 THEN 25 ELSE observed_hours END AS observed_hours,
      CASE WHEN app_id % 10 = 8 THEN -1 ELSE days_since_peak END AS days_since_peak)
    FROM trends UNION ALL SELECT * FROM trends WHERE app_id % 10 = 1),
  broken_daily AS (
    SELECT app_id, date_day, avg_player_count, peak_player_count, observed_hours
    FROM broken_trends),
  broken_hours AS (
    SELECT * REPLACE (
      CASE extract(hour FROM logical_hour) WHEN 1 THEN 'odd' WHEN 2 THEN NULL ELSE status END
        AS status,
      CASE WHEN extract(hour FROM logical_hour) <> 3 THEN logical_hour END AS logical_hour)
    FROM hours UNION ALL SELECT * FROM hours WHERE extract(hour FROM logical_hour) = 4),
  broken_board AS (
    SELECT * REPLACE (
      CASE app_id % 10 WHEN 2 THEN NULL WHEN 6 THEN -app_id ELSE app_id END AS app_id,
      2 * current_player_count AS current_player_count, 2 * current_rank AS current_rank)
    FROM board UNION ALL SELECT * FROM board WHERE app_id % 10 = 1),
  broken_dim AS (
    SELECT * REPLACE (CASE WHEN app_id % 10 <> 9 THEN app_id END AS app_id)
    FROM dim UNION ALL SELECT * FROM dim WHERE app_id % 10 = 1),
  broken_dates AS (
    SELECT CASE WHEN extract(day FROM date_day) <> 9 THEN date_day END AS date_day
    FROM dates UNION ALL SELECT date_day FROM dates WHERE extract(day FROM date_day) = 8),
  broken_runs AS (
    SELECT CASE WHEN extract(hour FROM logical_hour) <> 5 THEN run_id END AS run_id,
      recorded_at FROM runs
    UNION ALL SELECT run_id, recorded_at FROM runs WHERE extract(hour FROM logical_hour) = 6),
  broken_catalog AS (
    SELECT run_id, recorded_at FROM catalog UNION ALL SELECT run_id, recorded_at FROM catalog
    UNION ALL SELECT NULL, recorded_at FROM catalog),
  broken_meta AS (
    SELECT app_id, app_type, CASE WHEN app_id % 10 <> 2 THEN steam_appid END AS steam_appid,
      CASE WHEN app_id % 10 = 3 THEN 'EUR' ELSE price_currency END AS price_currency FROM meta)
"""


@query("model_checks", compose(MODEL + checks_sql(), *MODEL_NEEDS))
def model_checks_query(spark, sf):
    """The whole model built from the given tables, written, and every check on it."""
    built, raw, as_of = checked_model(spark, sf)
    return checks.summarize(model.model_checks(built, raw, as_of))


def checked_model(spark: SparkSession, sf: str) -> tuple[model.Model, model.Raw, datetime]:
    """The model of the given tables with the record of a catalog run, at the last day's end."""
    # The model, its checks and the catalog run all read the documents.
    calendar, details = together(
        lambda: given.event_days(spark, sf), lambda: given.landed_details(spark, sf)
    )
    raw = given.raw_tables(spark, sf, details)
    root, as_of = scratch_dir(spark, "model"), last_hour(calendar[1])
    built, catalog = together(
        lambda: model.build(spark, raw, as_of, root, calendar),
        lambda: settled(catalog_record(spark, sf, details), "catalog"),
    )
    built = replace(built, stg_catalog_runs=ledger.normalize_catalog_runs(catalog))
    return built, replace(raw, catalog_runs=catalog), as_of


def last_hour(day: date) -> datetime:
    return datetime(day.year, day.month, day.day, 23)


def broken_model(built: model.Model) -> model.Model:
    """A model with violations of every kind, for checks that must count them."""
    tenth, hour = F.col("app_id") % 10, F.hour("logical_hour")

    def mended(column: str, *cases: tuple) -> dict:
        out = F.col(column)
        for when, value in cases:
            out = F.when(when, value).otherwise(out)
        return {column: out}

    ids = mended("app_id", (tenth == 2, F.lit(None)), (tenth == 6, -F.col("app_id")))
    days = mended("date_day", (tenth == 5, F.lit(None)), (tenth == 7, F.date_add("date_day", 4000)))
    fact, trended = built.fct_player_counts, built.fct_player_trends_daily
    hours, dim, dates = built.fct_snapshot_hours, built.dim_game, built.dim_date
    board, runs, catalog = built.game_leaderboard, built.stg_snapshot_runs, built.stg_catalog_runs
    broken_fact = fact.withColumns(
        ids
        | days
        | mended("logical_hour", (tenth == 4, F.lit(None)))
        | mended("player_count", (tenth == 3, -1 - F.col("player_count")))
    ).unionByName(fact.filter(tenth == 1))
    broken_trends = trended.withColumns(
        ids
        | days
        | mended("observed_hours", (tenth == 3, F.lit(25)))
        | mended("days_since_peak", (tenth == 8, F.lit(-1)))
    ).unionByName(trended.filter(tenth == 1))
    return replace(
        built,
        fct_player_counts=broken_fact,
        fct_player_trends_daily=broken_trends,
        fct_player_counts_daily=broken_trends.select(*built.fct_player_counts_daily.columns),
        fct_snapshot_hours=hours.withColumns(
            mended("status", (hour == 1, F.lit("odd")), (hour == 2, F.lit(None)))
            | mended("logical_hour", (hour == 3, F.lit(None)))
        ).unionByName(hours.filter(hour == 4)),
        game_leaderboard=board.withColumns(
            ids
            | {c: F.col(c) * 2 for c in ("current_player_count", "current_rank")}
        ).unionByName(board.filter(tenth == 1)),
        dim_game=dim.withColumns(mended("app_id", (tenth == 9, F.lit(None)))).unionByName(
            dim.filter(tenth == 1)
        ),
        dim_date=dates.withColumns(
            mended("date_day", (F.dayofmonth("date_day") == 9, F.lit(None)))
        ).unionByName(dates.filter(F.dayofmonth("date_day") == 8)),
        stg_snapshot_runs=runs.withColumns(
            mended("run_id", (hour == 5, F.lit(None)))
        ).unionByName(runs.filter(hour == 6)),
        stg_catalog_runs=catalog.unionByName(catalog).unionByName(
            catalog.withColumn("run_id", F.lit(None).cast("string"))
        ),
        stg_app_metadata=built.stg_app_metadata.withColumns(
            mended("steam_appid", (tenth == 2, F.lit(None)))
            | mended("price_currency", (tenth == 3, F.lit("EUR")))
        ),
    )


RELATIONS = ("fact", "daily", "trends", "hours", "board", "dim", "dates", "runs", "catalog", "meta")
# The checks read the broken relations, at a time when every load is old.
BREACHES = re.sub(
    rf"\b(FROM|JOIN) ({'|'.join(RELATIONS)})\b", r"\1 broken_\2", checks_sql()
).replace("FROM as_of", "FROM late").replace("FROM absent", "FROM lost")


@query(
    "model_checks_breaches",
    compose(
        f"""{MODEL},{BROKEN},
        late AS (SELECT moment + INTERVAL 60 HOUR AS moment FROM as_of),
        lost AS (SELECT -1 AS app_id UNION ALL SELECT -2)
        {BREACHES}""",
        *MODEL_NEEDS,
    ),
)
def model_checks_breaches(spark, sf):
    """Every check on the model with something wrong in each of its tables, and loads that are
    old. Two ids that no run could observe are unknown to the dimension."""
    built, raw, as_of = checked_model(spark, sf)
    broken = broken_model(built)
    lost = raw.snapshot_runs.select("run_id", F.explode(F.array(F.lit(-1), F.lit(-2))).alias("app_id"))
    raw = replace(raw, unobservable=lost.withColumn("app_id", F.col("app_id").cast("bigint")))
    return checks.summarize(model.model_checks(broken, raw, as_of + timedelta(hours=60)))


def current_model(
    spark: SparkSession, raw: model.Raw, built: model.Model, store: Store, as_of: datetime
) -> model.Model:
    """A model whose facts were refreshed since it was built, as the store has them now."""
    fact = store.read(FACT, built.fct_player_counts.schema)
    trended = store.read(TRENDS, built.fct_player_trends_daily.schema)
    runs = built.stg_snapshot_runs
    board = reports.leaderboard(
        built.dim_game, fact, trended, lambda rows: settled(rows, "board"), by_day=True
    )
    return replace(
        built,
        fct_player_counts=fact,
        fct_player_counts_daily=trended.select(*built.fct_player_counts_daily.columns),
        fct_player_trends_daily=trended,
        fct_snapshot_hours=ledger.ledger_of_counts(runs, store.read(HOURS), as_of),
        game_leaderboard=settled(board, "board"),
    )


@query(
    "model_checks_incremental",
    f"SELECT * FROM ({ORACLE['model_checks']}) WHERE \"check\" NOT LIKE 'stg_catalog_runs%'",
)
def model_checks_incremental(spark, sf):
    """The model built and checked up to the day before the last, refreshed with the last day, and
    checked again by what that day has, beside the states of all others."""
    (first, last), details = together(
        lambda: given.event_days(spark, sf), lambda: given.landed_details(spark, sf)
    )
    raw = given.raw_tables(spark, sf, details)
    landed = raw.player_counts.withColumn("dt", F.to_date("logical_hour"))
    root, as_of = scratch_dir(spark, "model"), last_hour(last)
    store = Store(spark, root)
    early = replace(raw, player_counts=landed.filter(F.col("dt") < F.lit(last)))
    built = model.build(spark, early, as_of, root, (first, last))
    check_states.refresh_states(
        store, check_states.split(model.model_checks(built, early, as_of))[0]
    )
    refresh(spark, landed, root, last)
    now = current_model(spark, raw, built, store, as_of)
    found = check_states.incremental_checks(now, raw, as_of, store, [last])
    return found.filter("check not like 'stg_catalog_runs%'")
