"""Ranks over a whole table without putting the table into one task."""

from __future__ import annotations

from collections.abc import Mapping
from functools import partial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import together
from tidemark.sources.sinks import settled

# Distinct values that one task puts in order.
PIECE_ROWS = 100_000


def pieces(df: DataFrame, value: str) -> DataFrame:
    """Every distinct non-null value with `place`: above 33 bits the number of the piece of the
    value range it lies in, from the largest values on, and below them its place in the piece.

    Pieces are cut where a sample of the distinct values says that they hold equally many, so
    values that crowd anywhere are spread as evenly as others. Both steps are written: what a task
    is given must not change when another is repeated.
    """
    values = settled(df.select(value).filter(F.col(value).isNotNull()).distinct(), "values")
    cuts = -(-values.count() // PIECE_ROWS) or 1
    order = F.col(value).desc()
    # Numbers of rows in the order of a sorted partition, above them the partition's number.
    number = F.monotonically_increasing_id()
    if cuts == 1:  # one piece needs no cut, and is the same whenever it is sorted
        return values.coalesce(1).sortWithinPartitions(order).withColumn("place", number)
    placed = values.repartitionByRange(cuts, order).sortWithinPartitions(order)
    return settled(placed.withColumn("place", number), "places")


def dense_ranks(df: DataFrame, value: str, name: str) -> DataFrame:
    """(value, rank) for every distinct non-null value, 1 for the largest, no holes.

    A window ordered over the whole table would sort it in one task. Here equal values are
    folded first, each piece of the value range is put in order by itself, and the number of
    values in the pieces above is added.
    """
    placed = pieces(df, value)
    piece = F.shiftright("place", 33)
    # One row per piece, so one task may order them.
    above = Window.orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(piece.alias("piece"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select("piece", F.coalesce(F.sum("n").over(above), F.lit(0)).alias("offset"))
    )
    within = F.col("place").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return placed.join(offsets, piece == F.col("piece")).select(
        value, (within + F.col("offset")).cast("int").alias(name)
    )


def with_dense_ranks(df: DataFrame, ranks: Mapping[str, str]) -> DataFrame:
    """Append a dense rank for every {value column: rank name}, descending.

    Ties share a rank, nulls have none. Many rows may share one value. The ranks are unique on
    it, so adaptive execution can split the crowded partition and repeat its single rank row.
    """
    found = together(*(partial(dense_ranks, df, value, name) for value, name in ranks.items()))
    ranked = df
    for value, places in zip(ranks, found):
        ranked = ranked.join(places, value, "left")
    return ranked


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """The first k rows in an order that the caller makes total."""
    return df.orderBy(*order).limit(k)
