"""The whole model: raw tables in, marts out, and the checks that must hold on them."""

from __future__ import annotations

from dataclasses import dataclass, fields
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import checks as ck
from tidemark.operators.daily import dense_daily, trends
from tidemark.operators.ledger import ledger_of_counts, normalize_catalog_runs, normalize_runs
from tidemark.operators.metadata import extract_metadata
from tidemark.operators.observations import LINEAGE, fact_native, normalize_observations
from tidemark.operators.registry import dim_entity, listed_ids, normalize_registry
from tidemark.operators.reports import leaderboard
from tidemark.plans.refresh import FACT, HOURS, TRENDS, counts_of_days
from tidemark.session import together
from tidemark.sources.sinks import settled
from tidemark.sources.spines import CALENDAR_END, CALENDAR_START, dim_date
from tidemark.sources.versions import Store


@dataclass(frozen=True)
class Raw:
    """The raw tables. `unobservable` is (run_id, app_id); by default the runs' own lists."""

    player_counts: DataFrame
    tracked_universe: DataFrame
    app_metadata: DataFrame
    snapshot_runs: DataFrame
    catalog_runs: DataFrame
    unobservable: DataFrame | None = None


@dataclass(frozen=True)
class Model:
    """Field names are the names under which the views are registered."""

    stg_player_counts: DataFrame
    stg_tracked_universe: DataFrame
    stg_app_metadata: DataFrame
    stg_snapshot_runs: DataFrame
    stg_catalog_runs: DataFrame
    dim_date: DataFrame
    dim_game: DataFrame
    fct_player_counts: DataFrame
    fct_player_counts_daily: DataFrame
    fct_player_trends_daily: DataFrame
    fct_snapshot_hours: DataFrame
    game_leaderboard: DataFrame

    def register(self) -> None:
        """Make every frame a temporary view: the name a query uses."""
        for field in fields(self):
            getattr(self, field.name).createOrReplaceTempView(field.name)


def build(
    spark: SparkSession,
    raw: Raw,
    as_of: datetime,
    root: str | None = None,
    calendar: tuple[date, date] = (CALENDAR_START, CALENDAR_END),
    n: int = schemas.KNOWN_UNOBSERVABLE_HOURS,
) -> Model:
    """Compose the model. With `root`, the two facts are written there by day, the dimension, the
    leaderboard and the counts per hour beside them, and all are read back: the raw history is
    worked through once. All are new versions, which become current together when the last of
    them is written; until then, and if the build dies, readers see the versions before.

    The hour ledger stays a view, over the counts: its end moves with `as_of`.
    """
    runs = normalize_runs(raw.snapshot_runs)
    unobservable = raw.unobservable
    if unobservable is None:
        unobservable = listed_ids(raw.snapshot_runs)
    registry = normalize_registry(raw.tracked_universe)
    metadata = extract_metadata(raw.app_metadata)

    versions = Store(spark, root).build() if root else None

    def settle(frame: DataFrame, name: str, by: str | None = None) -> DataFrame:
        return versions.write(name, frame, by) if versions else frame

    def facts() -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
        hourly = fact_native(normalize_observations(raw.player_counts, carry=()))
        fact = settle(hourly, FACT, "date_day")
        # A written fact knows its last day from its folders; otherwise a raw column is cheapest.
        last_day = None if root else raw.player_counts.agg(F.to_date(F.max("logical_hour")))
        daily = dense_daily(fact, last_day)
        counted, trended = together(
            lambda: settle(counts_of_days(fact), HOURS),
            lambda: settle(trends(dense_daily(fact, last_day, folded=True)), TRENDS, "date_day"),
        )
        # The daily fact is the first columns of the trends, so it need not be built twice.
        return fact, counted, trended.select(*daily.columns) if versions else daily, trended

    entities = dim_entity(registry, metadata, runs, unobservable, n)
    dim, (fact, counted, daily, trended) = together(lambda: settle(entities, "dim_game"), facts)
    rows_once = (lambda frame: settled(frame, "board")) if versions else None
    board = leaderboard(dim, fact, trended, rows_once, by_day=versions is not None)
    board = settle(board, "game_leaderboard")
    if versions:
        versions.publish()
    return Model(
        stg_player_counts=normalize_observations(raw.player_counts, LINEAGE),
        stg_tracked_universe=registry,
        stg_app_metadata=metadata,
        stg_snapshot_runs=runs,
        stg_catalog_runs=normalize_catalog_runs(raw.catalog_runs),
        dim_date=dim_date(spark, *calendar),
        dim_game=dim,
        fct_player_counts=fact,
        fct_player_counts_daily=daily,
        fct_player_trends_daily=trended,
        fct_snapshot_hours=ledger_of_counts(runs, counted, as_of),
        game_leaderboard=board,
    )


def model_checks(model: Model, raw: Raw, as_of: datetime) -> list[ck.Check]:
    """Every declared check, as frames of violating rows that run when they are read.

    The ledger is a view, so it is settled first: one row per hour, read by several checks.
    """
    fact, daily = model.fct_player_counts, model.fct_player_counts_daily
    trended, ledger = model.fct_player_trends_daily, settled(model.fct_snapshot_hours, "ledger")
    board, dim, dates = model.game_leaderboard, model.dim_game, model.dim_date
    runs, meta = model.stg_snapshot_runs, model.stg_app_metadata
    unobservable = raw.unobservable
    if unobservable is None:
        unobservable = listed_ids(raw.snapshot_runs)

    # Written, the daily fact is the first columns of the trends: their rows are looked at once.
    if daily.sameSemantics(trended.select(*daily.columns)):
        daily = trended

    def unique(name: str, df: DataFrame, column: str) -> ck.Check:
        return ck.key_check(f"{name}.{column}.unique", df, column)

    def present(name: str, df: DataFrame, column: str) -> ck.Check:
        return ck.row_check(f"{name}.{column}.not_null", df, ck.is_null(column))

    def known(name: str, df: DataFrame, column: str, parent: DataFrame) -> ck.Check:
        return ck.reference_check(f"{name}.{column}.known", df, column, parent, column)

    def accepted(name: str, df: DataFrame, column: str, *values: str) -> ck.Check:
        rule = ck.is_unaccepted(column, values)
        return ck.row_check(f"{name}.{column}.accepted", df, rule)

    def grain(name: str, df: DataFrame, *key: str) -> ck.Check:
        return ck.key_check(f"{name}.grain", df, *key)

    def contract(name: str, df: DataFrame, rules: dict[str, str]) -> ck.Check:
        return ck.row_check(name, df, ck.any_of(rules))

    found: list[ck.Check] = []
    for name, df, column in (
        ("dim_game", dim, "app_id"),
        ("dim_date", dates, "date_day"),
        ("fct_snapshot_hours", ledger, "logical_hour"),
        ("game_leaderboard", board, "app_id"),
        ("stg_snapshot_runs", runs, "run_id"),
        ("stg_catalog_runs", model.stg_catalog_runs, "run_id"),
    ):
        found += [unique(name, df, column), present(name, df, column)]
    for name, df in (
        ("fct_player_counts", fact),
        ("fct_player_counts_daily", daily),
        ("fct_player_trends_daily", trended),
    ):
        found += [present(name, df, "app_id"), known(name, df, "app_id", dim)]
        found += [present(name, df, "date_day"), known(name, df, "date_day", dates)]
    found += [
        known("game_leaderboard", board, "app_id", dim),
        present("fct_player_counts", fact, "logical_hour"),
        present("fct_snapshot_hours", ledger, "status"),
        present("stg_app_metadata", meta, "steam_appid"),
        accepted("fct_snapshot_hours", ledger, "status", *schemas.HOUR_STATUSES),
        accepted("stg_app_metadata", meta, "app_type", "game"),
        accepted("stg_app_metadata", meta, "price_currency", "USD"),
        grain("fct_player_counts", fact, "app_id", "logical_hour"),
        grain("fct_player_counts_daily", daily, "app_id", "date_day"),
        grain("fct_player_trends_daily", trended, "app_id", "date_day"),
        contract("fct_player_counts.non_negative", fact, ck.NON_NEGATIVE),
        contract("fct_player_counts_daily.contract", daily, ck.DAILY_CONTRACT),
        contract("fct_player_trends_daily.contract", trended, ck.TRENDS_CONTRACT),
        contract("fct_snapshot_hours.contract", ledger, ck.LEDGER_CONTRACT),
        contract("game_leaderboard.contract", board, ck.BOARD_CONTRACT),
        contract("stg_app_metadata.same_id", meta, ck.SAME_ID),
        ck.Check("fct_snapshot_hours.dense", ck.ledger_not_dense(ledger)),
        ck.Check("game_leaderboard.ranks", ck.ranks_with_holes(board)),
        ck.Check(
            "dim_game.knows_every_unobservable",
            ck.unflagged_unobservable(runs, unobservable, dim),
            "warn",
        ),
    ]
    # How old the newest load may be, in hours.
    for name, table, column, hours in (
        ("player_counts", raw.player_counts, "loaded_at", 2),
        ("snapshot_runs", raw.snapshot_runs, "recorded_at", 2),
        ("app_metadata", raw.app_metadata, "updated_at", 26),
        ("catalog_runs", raw.catalog_runs, "recorded_at", 26),
    ):
        found.append(ck.Check(f"{name}.fresh", ck.stale(table, column, as_of, hours), "warn"))
    return found
