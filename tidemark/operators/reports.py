"""The reports: ranked, summed or reshaped views of the marts. All are small results."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators.observations import latest_per_entity
from tidemark.operators.ranking import top_k, with_dense_ranks


def leaderboard(
    dim: DataFrame,
    fact: DataFrame,
    trends: DataFrame,
    settle: Callable[[DataFrame], DataFrame] | None = None,
    by_day: bool = False,
) -> DataFrame:
    """Active entities with an observation, ranked by their own latest value and 7-day mean.

    The trend row is the one for the day of each entity's latest hour. With `by_day`, trends are
    a table in folders by day, and only the days that are some entity's current one are read.
    Otherwise that day is compared beside the entity key and not as a second key, so trends keep
    the partitioning by entity which their windows already gave them.

    Ranking reads the joined rows, one per entity, several times. `settle` may write them out
    and return what was written, so that the history behind them is worked through once.
    """
    latest = latest_per_entity(fact).select(
        "app_id",
        F.col("player_count").alias("current_player_count"),
        F.col("logical_hour").alias("current_hour"),
    )
    games = dim.filter("is_active").select(
        "app_id", "app_name", "release_date", "genre_names", "is_free", "price_final_usd",
        "tracked_source",
    )
    current = latest.join(games, "app_id")
    if by_day:
        current = current.withColumn("date_day", F.to_date("current_hour"))
        if settle is not None:
            current = settle(current)
        current = current.join(on_days_of(trends, current), ["app_id", "date_day"])
    else:
        same_day = F.datediff(F.to_date("current_hour"), "date_day") == 0
        current = current.join(trends, "app_id").filter(same_day)
    if settle is not None:
        current = settle(current)
    ranked = with_dense_ranks(
        current, {"current_player_count": "current_rank", "avg_player_count_7d": "rank_7d"}
    )
    return ranked.select(
        "app_id",
        "app_name",
        "current_rank",
        "current_player_count",
        "current_hour",
        F.col("avg_player_count").alias("avg_player_count_current_day"),
        F.col("peak_player_count").alias("peak_player_count_current_day"),
        F.col("observed_hours").alias("observed_hours_current_day"),
        "rank_7d",
        "avg_player_count_7d",
        "observed_days_7d",
        "peak_player_count_record",
        "last_record_day",
        "days_since_peak",
        "release_date",
        "genre_names",
        "is_free",
        "price_final_usd",
        "tracked_source",
    )


def on_days_of(trends: DataFrame, current: DataFrame) -> DataFrame:
    """Rows of `trends` on the days that occur in `current`; other folders are not read.

    The days are a value per calendar day, so they are broadcast whatever the rows, and the scan
    is pruned by them when the query runs.
    """
    entities = current.groupBy("date_day").agg(F.count(F.lit(1)).alias("entities"))
    days = entities.filter("entities > 0").select("date_day")
    return trends.join(F.broadcast(days), "date_day", "left_semi")


def board_table(board: DataFrame) -> DataFrame:
    """The board as displayed: names for people, the mean without decimals, the hour as text."""
    # The headings.
    return board.select(
        F.col("current_rank").alias("Rank"),
        F.col("app_name").alias("Game"),
        F.col("current_player_count").alias("Players now"),
        F.round("avg_player_count_7d", 0).cast("bigint").alias("7-day avg"),
        F.col("rank_7d").alias("7-day rank"),
        F.col("peak_player_count_record").alias("Record peak"),
        F.col("days_since_peak").alias("Days since peak"),
        F.date_format("current_hour", "yyyy-MM-dd HH:'00'").alias("Latest hour (UTC)"),
    ).orderBy("Rank", "Game")


def board_top(board: DataFrame, k: int = 15) -> DataFrame:
    """The first k of the board; app_id decides between equal ranks."""
    first = top_k(board, k, F.asc("current_rank"), F.asc("app_id"))
    return first.select("app_name", "current_player_count")


def board_summary(board: DataFrame) -> DataFrame:
    """Entities ranked, their sum at the latest hour, that hour, and how many lag behind it.

    One pass: entities are grouped by their current hour, then the hours are folded.
    """
    by_hour = board.groupBy("current_hour").agg(
        F.count(F.lit(1)).alias("entities"),
        F.sum(F.col("current_player_count").cast("bigint")).alias("players"),
    )
    return by_hour.agg(
        F.coalesce(F.sum("entities"), F.lit(0)).alias("ranked"),
        F.max_by("players", "current_hour").alias("players_at_latest_hour"),
        F.max("current_hour").alias("latest_hour"),
        F.coalesce(
            F.sum("entities") - F.max_by("entities", "current_hour"), F.lit(0)
        ).alias("behind_latest_hour"),
    )


def last_days(frame: DataFrame) -> DataFrame:
    """The last day in the frame, still in progress, and the last one before it, as one row."""
    newest = frame.select("date_day").distinct().orderBy(F.desc("date_day")).limit(2)
    earlier = F.when(F.count(F.lit(1)) == 2, F.min("date_day"))
    return newest.agg(F.max("date_day").alias("last_day"), earlier.alias("latest_day"))


def top_movers(trends: DataFrame, dim: DataFrame, k: int = 6) -> DataFrame:
    """The k largest gains and the k largest losses on the last complete day.

    An entity may be on both ends when fewer than 2k moved. app_id decides between equals.
    """
    rate = "avg_player_count_change_rate"
    day = last_days(trends).select("latest_day").scalar()
    moved = (
        trends.filter((F.col("date_day") == day) & F.col(rate).isNotNull())
        .join(dim.select("app_id", "app_name"), "app_id")
        .select("app_id", "app_name", F.col(rate).alias("change_rate"))
    )
    gains = top_k(moved, k, F.desc("change_rate"), F.asc("app_id"))
    losses = top_k(moved, k, F.asc("change_rate"), F.asc("app_id"))
    return gains.unionByName(losses).orderBy(F.desc("change_rate"), F.asc("app_id"))


def top_panels(trends: DataFrame, board: DataFrame, k: int = 6) -> DataFrame:
    """The daily series of the entities ranked up to k by 7-day mean, without the last day.

    Ties may bring more than k entities.
    """
    last_day = trends.agg(F.max("date_day")).scalar()
    ranked = board.filter(F.col("rank_7d") <= k).select("app_id", "app_name", "rank_7d")
    return (
        trends.filter(F.col("date_day") < last_day)
        .join(ranked, "app_id")
        .select(
            "rank_7d", "app_id", "app_name", "date_day", "avg_player_count",
            "avg_player_count_7d", "observed_hours",
        )
        .orderBy("rank_7d", "app_id", "date_day")
    )


def to_long(df: DataFrame, ids: Sequence[str], names: Mapping[str, str]) -> DataFrame:
    """One row per id and series; `names` maps each value column to its series name."""
    label = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    long = df.unpivot(list(ids), list(names), "series", "value")
    return long.withColumn("series", label[F.col("series")])


def full_days(daily: DataFrame, days: int = 7) -> DataFrame:
    """The latest days on which some entity has all 24 hours."""
    return (
        daily.groupBy("date_day")
        .agg(F.max("observed_hours").alias("best"))
        .filter("best = 24")
        .orderBy(F.desc("date_day"))
        .limit(days)
        .select("date_day")
    )


def hour_of_day_profile(fact: DataFrame, daily: DataFrame, days: int = 7) -> DataFrame:
    """Mean total by hour of day over the latest full days."""
    totals = (
        fact.join(full_days(daily, days), "date_day")
        .groupBy("logical_hour", "hour_of_day")
        .agg(F.sum(F.col("player_count").cast("bigint")).alias("players"))
    )
    return (
        totals.groupBy("hour_of_day").agg(F.avg("players").alias("players")).orderBy("hour_of_day")
    )


def status_histogram(ledger: DataFrame) -> DataFrame:
    return ledger.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def ledger_summary(ledger: DataFrame, dim: DataFrame) -> DataFrame:
    """Hours by status, the high-water mark, and the number of unobservable entities."""
    counts = [F.count_if(F.col("status") == s).alias(f"{s}_hours") for s in schemas.HOUR_STATUSES]
    mark = F.max(F.when(F.col("is_high_water_mark"), F.col("logical_hour")))
    hidden = dim.filter("is_unobservable").agg(F.count(F.lit(1))).scalar()
    return ledger.agg(*counts, mark.alias("high_water_mark")).withColumn(
        "unobservable_entities", hidden
    )


def status_cells(ledger: DataFrame) -> DataFrame:
    """One cell per hour: day, hour, status, and the line shown on hover."""
    seen = F.concat(
        F.lit(": "), F.col("observed_count").cast("string"),
        F.lit(" of "), F.col("tracked_count").cast("string"), F.lit(" observed"),
    )
    return ledger.select(
        F.to_date("logical_hour").alias("day"),
        F.hour("logical_hour").alias("hour"),
        "status",
        F.concat("status", F.coalesce(seen, F.lit(""))).alias("hover"),
    )


def status_grid(ledger: DataFrame) -> DataFrame:
    """Days down, the 24 hours across. A status outside the known four stops the report."""
    known = F.col("status").isin(*schemas.HOUR_STATUSES)
    status = F.when(known, F.col("status")).otherwise(
        F.raise_error(F.concat(F.lit("unknown status "), "status")).cast("string")
    )
    cells = status_cells(ledger).withColumn("status", status)
    grid = cells.groupBy("day").pivot("hour", list(range(24))).agg(F.first("status"))
    return grid.select("day", *[F.col(str(h)).alias(f"h{h:02d}") for h in range(24)])


def observed_per_hour(ledger: DataFrame) -> DataFrame:
    return ledger.select("logical_hour", "snapshot_rows").orderBy("logical_hour")


def latency_per_hour(ledger: DataFrame) -> DataFrame:
    return ledger.select("logical_hour", "latency_p50_ms", "latency_max_ms").orderBy("logical_hour")


def freshness(fact: DataFrame, ledger: DataFrame, by_day: bool = False) -> DataFrame:
    """How far the marts were built, beside how far hours were observed.

    With `by_day` the fact is a table in folders by day: its last day is known from their names,
    and only that folder's hours are read.
    """
    seen = ledger.filter("has_observations").agg(F.max("logical_hour")).scalar()
    if by_day:
        fact = fact.filter(F.col("date_day") == fact.agg(F.max("date_day")).scalar())
    return fact.agg(F.max("logical_hour").alias("built_through")).select(
        seen.alias("observed_through"), "built_through"
    )
