"""Row counts that fall out of the rhythm of the week.

Everything here works on counts per hour (`ledger.hour_counts`), which are kept by the hours a
load touched: a check costs a row per hour of history and never reads the observations.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources.spines import hours_between

# Fixed value: the standard deviation of a normal distribution, in median absolute deviations.
SIGMA = 1.4826


def median_of(values: Column) -> Column:
    """Exact median of a short array as a double, NULL for an empty one."""
    ordered, n = F.array_sort(values), F.size(values)
    low, high = F.floor((n - 1) / 2).cast("int"), F.floor(n / 2).cast("int")
    return (F.get(ordered, low).cast("double") + F.get(ordered, high).cast("double")) / 2


def seasonal_baseline(
    counted: DataFrame, as_of: datetime | Column, weeks: int = 8
) -> DataFrame:
    """Every hour from the first counted one to `as_of` beside what its like were before.

    Columns `logical_hour`, `snapshot_rows` (0 where nothing is counted), `weeks_seen`, `expected`
    and `spread`: the median and the median absolute deviation of the same hour of the week in up
    to `weeks` weeks before it. Both shrug off outliers among those weeks, so one bad week neither
    hides the next nor makes it look bad. At most `weeks` numbers stand beside an hour.
    """
    spine = hours_between(counted.agg(F.min("logical_hour")), as_of, "logical_hour")
    rows = F.coalesce("snapshot_rows", F.lit(0)).cast("bigint")
    dense = spine.join(counted.select("logical_hour", "snapshot_rows"), "logical_hour", "left")
    before = (
        Window.partitionBy(F.weekday("logical_hour"), F.hour("logical_hour"))
        .orderBy("logical_hour")
        .rowsBetween(-weeks, -1)
    )
    known = dense.withColumn("snapshot_rows", rows).withColumn(
        "past", F.collect_list("snapshot_rows").over(before)
    )
    known = known.withColumn("expected", median_of(F.col("past")))
    apart = F.transform("past", lambda n: F.abs(n - F.col("expected")))
    return known.select(
        "logical_hour",
        "snapshot_rows",
        F.size("past").alias("weeks_seen"),
        "expected",
        median_of(apart).alias("spread"),
    )


def row_count_anomalies(
    counted: DataFrame,
    as_of: datetime | Column,
    weeks: int = 8,
    least_weeks: int = 3,
    width: float = 3.0,
    share: float = 0.1,
) -> DataFrame:
    """Hours with far fewer (`drop`) or far more rows (`spike`) than the same hour of the weeks
    before, with what `seasonal_baseline` says of them.

    Far is more than `width` standard deviations, estimated from the spread, and more than `share`
    of what is expected, so a steady feed is not reported for one row. Hours with fewer than
    `least_weeks` weeks before them are not judged. `as_of` lies in the last whole hour.
    """
    base = seasonal_baseline(counted, as_of, weeks).filter(F.col("weeks_seen") >= least_weeks)
    allowed = F.greatest(F.col("spread") * (width * SIGMA), F.col("expected") * share, F.lit(1.0))
    kind = F.when(F.col("snapshot_rows") < F.col("expected") - allowed, "drop").when(
        F.col("snapshot_rows") > F.col("expected") + allowed, "spike"
    )
    return base.withColumn("kind", kind).filter(F.col("kind").isNotNull())
