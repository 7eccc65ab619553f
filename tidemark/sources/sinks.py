"""Writes that a rerun does not repeat."""

from __future__ import annotations

import hashlib
from collections.abc import Collection, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.merge import absent_rows
from tidemark.session import scratch_dir
from tidemark.sources.tables import read_player_counts


def insert_player_counts(
    rows: DataFrame,
    path: str,
    order: Sequence[str] = ("s3_key",),
    days: Collection[date] | None = None,
) -> int:
    """Append the rows whose (app_id, logical_hour) the table lacks; returns how many.

    Only the days of incoming rows are read back; `days` names them where the caller knows them,
    or else the rows are scanned for them (a value per calendar day, not per row). A load that died
    half-way is finished by running it again: whatever it had published is found and skipped.
    The number is counted in the table before and after, which reads file footers only. One
    writer at a time.
    """
    spark = rows.sparkSession
    rows = rows.withColumn("dt", F.to_date("logical_hour"))
    if days is None:
        days = [row["dt"] for row in rows.select("dt").dropna().distinct().collect()]
    if not days:
        return 0

    def held() -> DataFrame:
        table = read_player_counts(spark, path)
        return table.filter(F.col("dt").isin(*days))

    before = held()
    fresh = absent_rows(rows, before, ["app_id", "logical_hour"], order)
    count_before = before.count()
    (
        fresh.select(*before.columns)
        .hint("rebalance", F.col("dt"))
        .write.mode("append")
        .partitionBy("dt")
        .parquet(path)
    )
    return held().count() - count_before


def write_version(state: DataFrame, root: str, version: str) -> str:
    """Write a whole new state beside the old ones; readers go over by the returned path.

    An upsert reads the state it replaces, so it never writes over it.
    """
    path = f"{root}/version={version}"
    state.write.mode("overwrite").parquet(path)
    return path


def write_buckets(
    state: DataFrame, path: str, key: Sequence[str], buckets: int
) -> DataFrame:
    """Write a state in `buckets` files of rows with the same hash of their key, sorted by it, and
    return it as `read_buckets` does.

    Rows are dealt out by that hash first, so a bucket is one file and an upsert of the next load
    finds the target arranged. Choose `buckets` so that one fits a task with ease.
    """
    spark = state.sparkSession
    name = f"{scratch_name(path)}_write"
    dealt = state.repartition(buckets, *[F.col(c) for c in key])
    writer = dealt.write.mode("error").bucketBy(buckets, *key).sortBy(*key)
    writer.option("path", path).saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")  # the table is external: its files stay
    return read_buckets(spark, path, state.schema, key, buckets)


def read_buckets(
    spark: SparkSession, path: str, schema: T.StructType, key: Sequence[str], buckets: int
) -> DataFrame:
    """A bucketed state from its files alone, whichever session wrote them."""
    name = scratch_name(path)
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        keys = ", ".join(f"`{c}`" for c in key)
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({keys}) "
            f"SORTED BY ({keys}) INTO {buckets} BUCKETS LOCATION '{path}'"
        )
    return spark.table(name)


def scratch_name(path: str) -> str:
    """A table name of its own for a path."""
    return f"tidemark_{hashlib.sha256(path.encode()).hexdigest()[:24]}"


def write_days(fact: DataFrame, path: str, day: str = "date_day", whole: bool = False) -> None:
    """Write a fact partitioned by day, replacing only the days that occur in it.

    With `whole` the table is replaced altogether. Rows are first rebalanced by day, so a day is
    a few well-sized files and not a sliver from every task; a large day is split.
    """
    (
        fact.hint("rebalance", F.col(day))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if whole else "dynamic")
        .partitionBy(day)
        .parquet(path)
    )


def settled(frame: DataFrame, label: str) -> DataFrame:
    """Write a frame once to the shared scratch folder and return it as read back.

    For a result that is read several times and is small beside the history it came from. The
    files outlive any executor, so nothing upstream is ever computed again.
    """
    path = scratch_dir(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
