"""The dense daily fact and its trends.

Both run on one partitioning by entity. After the rollup an entity has at most one row per
calendar day, so the per-entity windows here are bounded by the calendar, however many raw
rows the entity had.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.exact import div_half_away, from_units, to_units


def daily_rollup(fact: DataFrame) -> DataFrame:
    """Mean (one decimal), peak and number of observed hours per entity and day."""
    total = F.sum(F.col("player_count").cast("bigint"))
    hours = F.count(F.lit(1))
    return fact.groupBy("app_id", "date_day").agg(
        from_units(div_half_away(total * 10, hours), 1).alias("avg_player_count"),
        F.max("player_count").alias("peak_player_count"),
        hours.cast("int").alias("observed_hours"),
    )


def dense_daily(
    fact: DataFrame, last_day: DataFrame | None = None, folded: bool = False
) -> DataFrame:
    """One row per entity and day from its first observed day to the last day of all.

    Days without an observation are rows with null measures and `observed_hours = 0`.
    `last_day` may be given as a one-row frame when it is known more cheaply than from the
    fact; a raw scan has the same last day. With `folded` the grid is left as its `stretches`,
    from which `trends` gives the same rows.
    """
    if last_day is None:
        last_day = fact.agg(F.max("date_day"))
    return (stretches if folded else fill_gaps)(daily_rollup(fact), last_day)


def stretches(days: DataFrame, last_day: DataFrame) -> DataFrame:
    """The rows of each entity with `until`, the day before its next row or the last day of all.

    A row stands for the days up to there. This needs neither the range join between entities and
    calendar nor an equi join of the grid with the rollup.
    """
    by_entity = Window.partitionBy("app_id").orderBy("date_day")
    end = F.coalesce(
        F.date_sub(F.lead("date_day").over(by_entity), 1),
        F.greatest(F.col("date_day"), F.col("last_day")),
    )
    # The grid outgrows its input, by as much as there are gaps, so the number of partitions is
    # the session's and not one that adaptive execution would derive from the input's bytes.
    partitions = int(days.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        days.filter("date_day is not null")
        .repartition(partitions, "app_id")
        .withColumn("last_day", last_day.scalar())
        .withColumn("until", end)
        .drop("last_day")
    )


def _unfolded(stretched: DataFrame) -> DataFrame:
    """A row per day of each stretch: `date_day` becomes `seen_day`, and `ago` counts from it.

    Counting is done in whole numbers; a sequence of dates adds an interval of time at each step.
    """
    ago = F.sequence(F.lit(0), F.datediff("until", "seen_day"))
    renamed = stretched.withColumnRenamed("date_day", "seen_day")
    return renamed.select("*", F.explode(ago).alias("ago"))


def fill_gaps(days: DataFrame, last_day: DataFrame) -> DataFrame:
    """Add the missing days of each entity between its rows and after its last one."""
    measures = [c for c in days.columns if c not in ("app_id", "date_day", "observed_hours")]
    seen = F.col("ago") == 0
    return _unfolded(stretches(days, last_day)).select(
        "app_id",
        F.expr("date_add(seen_day, ago)").alias("date_day"),
        *[F.when(seen, F.col(c)).alias(c) for c in measures],
        F.when(seen, F.col("observed_hours")).otherwise(0).alias("observed_hours"),
    )


def trends(daily: DataFrame, days: int = 7) -> DataFrame:
    """Window measures over the dense daily fact, all on one partitioning and one sort.

    `daily` must be dense: then a frame of rows is a frame of calendar days and a gap is seen
    as a null neighbour. Unobserved days are left out of the trailing mean, not counted as 0.
    Or it is the `stretches` of the dense fact: then the windows run over the rows that there
    are, and only their results are unfolded, so that the grid is neither sorted nor kept.

    Rows may carry what is already known as of their day, in `known_record` and
    `known_record_day`. History before the first row of an entity then need not be read, except
    for `days` rows.
    """
    peak, own_day = F.col("peak_player_count"), F.col("date_day")
    carried = "known_record" in daily.columns
    best = F.greatest(peak, F.col("known_record")) if carried else peak
    by_entity = Window.partitionBy("app_id").orderBy("date_day")
    so_far = by_entity.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    tenths = to_units(F.col("avg_player_count"), 1)
    record_day = F.when(peak == F.col("peak_player_count_record"), own_day)
    if carried:
        record_day = F.greatest(record_day, F.col("known_record_day"))
    record, last_record_day = F.max(best).over(so_far), F.max(record_day).over(so_far)

    if "until" in daily.columns:
        # At most `days` rows of an entity lie in a trailing frame: the row and those before it.
        back = range(1, days)
        known = daily.withColumns({"now": tenths, "peak_player_count_record": record})
        known = known.withColumns(
            {"last_record_day": last_record_day}
            | {f"day_{n}": F.lag("date_day", n).over(by_entity) for n in range(1, max(days, 2))}
            | {f"now_{n}": F.lag("now", n).over(by_entity) for n in range(1, max(days, 2))}
        )
        anchored = _unfolded(known)
        ago, seen = F.col("ago"), F.col("ago") == 0
        # A row is in the frame of the days that are less than `days` after it.
        inside = [(F.lit(0), F.col("now"))]
        inside += [(F.datediff("seen_day", f"day_{n}"), F.col(f"now_{n}")) for n in back]
        inside = [(value, (age + ago < days) & value.isNotNull()) for age, value in inside]

        def framed(terms: list[Column]) -> Column:
            return F.when(ago < days, reduce(Column.__add__, terms)).otherwise(0)

        none = F.lit(0).cast("bigint")
        yesterday = F.when(F.datediff("seen_day", "day_1") == 1, F.col("now_1"))
        anchored = anchored.withColumns(
            {
                "date_day": F.expr("date_add(seen_day, ago)"),
                "avg_player_count": F.when(seen, F.col("avg_player_count")),
                "peak_player_count": F.when(seen, peak),
                "observed_hours": F.when(seen, F.col("observed_hours")).otherwise(0),
                "before": F.when(seen, yesterday).when(ago == 1, F.col("now")),
                "now": F.when(seen, F.col("now")),
                "frame_total": framed([F.when(held, value).otherwise(none) for value, held in inside]),
                "frame_seen": framed([F.when(held, 1).otherwise(0) for _, held in inside]),
            }
        )
    else:
        # A trailing sum is the running sum less the running sum `days` rows earlier. Both are
        # exact in whole tenths, and neither adds a row up more than once.
        running = daily.withColumns(
            {
                "now": tenths,
                "before": F.lag(tenths).over(by_entity),
                "total": F.coalesce(F.sum(tenths).over(so_far), F.lit(0)),
                "seen": F.count("avg_player_count").over(so_far),
                "peak_player_count_record": record,
            }
        )
        anchored = running.withColumns(
            {
                "frame_total": F.col("total") - F.lag("total", days, 0).over(by_entity),
                "frame_seen": F.col("seen") - F.lag("seen", days, 0).over(by_entity),
                "last_record_day": last_record_day,
            }
        )
    change = F.col("now") - F.col("before")
    return anchored.select(
        "app_id",
        "date_day",
        "avg_player_count",
        "peak_player_count",
        "observed_hours",
        from_units(F.col("before"), 1).alias("avg_player_count_prev_day"),
        from_units(change, 1).alias("avg_player_count_change"),
        from_units(div_half_away(change * 10_000, F.col("before")), 4).alias(
            "avg_player_count_change_rate"
        ),
        from_units(div_half_away(F.col("frame_total"), F.col("frame_seen")), 1).alias(
            f"avg_player_count_{days}d"
        ),
        F.col("frame_seen").cast("int").alias(f"observed_days_{days}d"),
        "peak_player_count_record",
        F.datediff("date_day", "last_record_day").alias("days_since_peak"),
        "last_record_day",
    )
