"""Key-aware loads as DataFrame rewrites, since Parquet tables have no keys and no MERGE.

Every function returns the rows to write or the new state. Keys are unique on each side, so a
join on them cannot be skewed. Inserts and flags read the target without a shuffle of it while
the incoming side is small enough for the planner to broadcast; an upsert reads both sides once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, key: Sequence[str], *order: str) -> DataFrame:
    """The first row of each key. Folded before the shuffle, so repeated keys are harmless."""
    return _pick(df, key, F.min_by(F.struct("*"), F.struct(*order)))


def newest_per_key(df: DataFrame, key: Sequence[str], *order: str) -> DataFrame:
    """The last row of each key."""
    return _pick(df, key, F.max_by(F.struct("*"), F.struct(*order)))


def _pick(df: DataFrame, key: Sequence[str], choice: Column) -> DataFrame:
    return df.groupBy(*key).agg(choice.alias("chosen")).select("chosen.*")


def absent_rows(
    incoming: DataFrame, target: DataFrame, key: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Incoming rows whose key the target lacks, the first of each key: insert, never replace."""
    return first_per_key(incoming, key, *order).join(target.select(*key), list(key), "left_anti")


def upsert(
    target: DataFrame,
    incoming: DataFrame,
    key: Sequence[str],
    keep: Sequence[str] = (),
    first_non_null: Sequence[str] = (),
) -> DataFrame:
    """The target after an upsert, in one pass over each side. `incoming` has at most one row per
    key.

    For a key on both sides: columns in `keep` stay as they were, columns in `first_non_null`
    are replaced only where they were NULL, all others take the incoming value. Rows with a NULL
    in their key match nothing and are kept from both sides.

    It is one full outer join, so both sides are arranged by the key. A target that `buckets`
    laid out by its key is so already: it is read in place and only the incoming side moves.
    """
    key = list(key)
    columns = target.columns
    values = [c for c in columns if c not in key]
    # The struct of a side is NULL exactly where the side has no row.
    there = F.lit(True).alias("there")
    old = target.select(*key, F.struct(there, *values).alias("old"))
    new = incoming.select(*key, F.struct(there, *values).alias("new"))

    def merged(column: str) -> Column:
        was, fresh = F.col(f"old.`{column}`"), F.col(f"new.`{column}`")
        if column in keep:
            chosen = F.when(F.col("old").isNotNull(), was).otherwise(fresh)
        elif column in first_non_null:
            chosen = F.coalesce(was, fresh)
        else:
            chosen = F.when(F.col("new").isNotNull(), fresh).otherwise(was)
        return chosen.alias(column)

    both = old.join(new, key, "full_outer")
    return both.select(*key, *[merged(c) for c in values]).select(*columns)


def flag_changes(
    target: DataFrame, ids: DataFrame, value: bool, key: str = "app_id", flag: str = "is_active"
) -> DataFrame:
    """Target rows that setting the flag for these ids would change."""
    return target.filter(F.col(flag) != F.lit(value)).join(ids.select(key), key, "left_semi")


def set_flag(
    target: DataFrame, ids: DataFrame, value: bool, key: str = "app_id", flag: str = "is_active"
) -> DataFrame:
    """The target with the flag set for these ids and untouched for the rest."""
    hit = ids.select(key).distinct().withColumn("hit", F.lit(True))
    flagged = F.when(F.col("hit"), F.lit(value)).otherwise(F.col(flag))
    return (
        target.join(hit, key, "left").withColumn(flag, flagged).select(*target.columns)
    )
