"""Hourly observations as a stream of landed documents.

The landing folder is the source and the raw table the sink. Everything downstream of the
table is a batch model. `availableNow` reads what has arrived since the checkpoint and stops,
which is what an hourly schedule needs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tidemark import schemas
from tidemark.operators.audit import bundle_rows
from tidemark.operators.observations import within_staleness
from tidemark.sources.landing import PLAYER_COUNTS
from tidemark.sources.sinks import insert_player_counts

HOUR_MS = 3_600_000

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# How long after its hour an observation may still begin, and so how long state is kept.
STALENESS = "2 hours"


def bundle_stream(
    spark: SparkSession, root: str, max_files: int | None = 1_000
) -> DataFrame:
    """Documents as they land. `max_files` bounds one micro-batch, also after a pause."""
    schema = T.StructType([*schemas.BUNDLE.fields, T.StructField("dt", T.DateType())])
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(f"{root}/{PLAYER_COUNTS}")


def observation_stream(bundles: DataFrame) -> DataFrame:
    """Observed rows of landed documents, late ones refused.

    The refusal compares each row with its own hour. A watermark compares it with the newest
    row seen by anyone, so it only ever bounds state.
    """
    rows = bundle_rows(bundles).withColumn("logical_date", F.col("logical_hour"))
    return within_staleness(rows).drop("logical_date")


def first_in_hour(observations: DataFrame, watermark: str = STALENESS) -> DataFrame:
    """Earliest observation per entity and hour, emitted once the hour can no longer change.

    Append mode leaves out hours the watermark has not closed and rows that arrive behind it.
    Where the result must not depend on arrival order, load the table and normalize that.
    """
    hour = F.window("logical_hour", "1 hour")
    return (
        observations.withWatermark("logical_hour", watermark)
        .groupBy("app_id", hour.alias("hour"))
        .agg(F.min_by("player_count", "logical_hour").alias("player_count"))
        .select("app_id", F.col("hour.start").alias("logical_hour"), "player_count")
    )


# One open hour of a share of the entities: a row per entity, as it is kept in the state.
OPEN = np.dtype(
    [("app_id", "i8"), ("no_id", "?"), ("at", "i8"), ("player_count", "i8"), ("no_count", "?"),
     ("fresh", "?"), ("emitted", "?")]
)


def _earliest(rows: np.ndarray) -> np.ndarray:
    """The earliest row of each entity, `emitted` if any of its rows is. Equal times are decided
    by the smaller count, and a fresh row does not replace one that is equal."""
    order = ("fresh", "player_count", "no_count", "at", "app_id", "no_id")
    rows = rows[np.lexsort([rows[c] for c in order])]
    changes = (rows["app_id"][1:] != rows["app_id"][:-1]) | (rows["no_id"][1:] != rows["no_id"][:-1])
    starts = np.flatnonzero(np.concatenate([[True], changes]))
    best = rows[starts]
    best["emitted"] = np.logical_or.reduceat(rows["emitted"], starts)
    return best


class CorrectedHours(StatefulProcessor):
    """Earliest observations of one hour and a share of the entities: emitted when the stream has
    gone past the hour, and again whenever a row that is still accepted turns out to be earlier.

    Two timers per hour. At the first, event time has left the hour, and what is known is emitted.
    At the second the watermark has left it too: no row can be accepted any more and the state
    goes. Rows in between are the late ones, and cost a correction only if they are earlier.
    Times are whole numbers here, hours in milliseconds and observations in microseconds.
    """

    def __init__(self, patience_ms: int):
        self.patience_ms = patience_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.best = handle.getValueState("best", "rows binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        known = self._held()
        found = known
        for chunk in rows:
            fresh = np.zeros(len(chunk), OPEN)
            for column in ("app_id", "no_id", "at", "player_count", "no_count"):
                fresh[column] = chunk[column].to_numpy()
            fresh["fresh"] = True
            found = _earliest(np.concatenate([found, fresh]))
        hour_end, now = int(key[1]) + HOUR_MS, timerValues.getCurrentWatermarkInMs()
        if not len(known):
            for expiry in (hour_end - self.patience_ms, hour_end):
                self.handle.registerTimer(max(expiry, now + 1))
        corrects = found["emitted"] & found["fresh"]
        out = corrects | (~found["emitted"] & (now >= hour_end - self.patience_ms))
        changed = out | found["fresh"]
        found["fresh"], found["emitted"] = False, found["emitted"] | out
        if changed.any():
            self.best.update((found.tobytes(),))
        if out.any():
            yield self._rows(key, found[out], corrects[out])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        found = self._held()
        if not len(found):
            return
        out = ~found["emitted"]
        if timerValues.getCurrentWatermarkInMs() >= int(key[1]) + HOUR_MS:
            self.best.clear()
        elif out.any():
            found["emitted"] = True
            self.best.update((found.tobytes(),))
        if out.any():
            yield self._rows(key, found[out], np.zeros(int(out.sum()), bool))

    def close(self) -> None:
        pass

    def _held(self) -> np.ndarray:
        held = self.best.get()[0] if self.best.exists() else b""
        return np.frombuffer(held, OPEN).copy()

    @staticmethod
    def _rows(key, found: np.ndarray, corrects: np.ndarray) -> pd.DataFrame:
        kept = {c: found[c] for c in ("app_id", "no_id", "player_count", "no_count")}
        return pd.DataFrame({**kept, "hour": int(key[1]), "corrects": corrects})


def corrected_hours(
    observations: DataFrame, patience_hours: int = 2, shares: int = 64
) -> DataFrame:
    """Earliest observation per entity and hour, early and then corrected, for update mode.

    Where `first_in_hour` holds an hour back until it can no longer change, this emits it as soon
    as the stream has passed it, and emits a row that `corrects` it for every earlier observation
    that comes up to `patience_hours` behind the newest. The last row of an entity and hour is
    what a batch over all accepted rows gives, in whatever order they came. Equal times are
    decided by the smaller count. State is one row per entity and open hour, in RocksDB.

    Entities are dealt to `shares`, and the state is called once per share and hour with arrays of
    rows: a call costs milliseconds, so calls must not grow with the entities. `shares` is part of
    the state's key and must stay the same over the life of a checkpoint.
    """
    spark = observations.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    rows = observations.withWatermark("logical_hour", f"{patience_hours} hours").select(
        F.pmod(F.xxhash64("app_id"), F.lit(shares)).alias("share"),
        F.unix_millis(F.date_trunc("hour", "logical_hour")).alias("hour"),
        *_without_nulls("app_id", "no_id"),
        F.unix_micros("logical_hour").alias("at"),
        *_without_nulls("player_count", "no_count"),
        "logical_hour",
    )
    emitted = rows.filter("logical_hour is not null").groupBy("share", "hour")
    emitted = emitted.transformWithStateInPandas(
        CorrectedHours(patience_hours * HOUR_MS),
        "app_id bigint, no_id boolean, player_count bigint, no_count boolean, hour bigint, "
        "corrects boolean",
        "update",
        "eventTime",
    )
    return emitted.select(
        F.when(~F.col("no_id"), F.col("app_id")).alias("app_id"),
        F.timestamp_millis("hour").alias("logical_hour"),
        F.when(~F.col("no_count"), F.col("player_count")).alias("player_count"),
        "corrects",
    )


def _without_nulls(column: str, flag: str) -> list[Column]:
    """A whole number and whether it is missing: numbers with gaps are no whole numbers in pandas."""
    value = F.col(column).cast("bigint")
    return [F.coalesce(value, F.lit(0)).alias(column), value.isNull().alias(flag)]


def first_delivery(observations: DataFrame, watermark: str = STALENESS) -> DataFrame:
    """Drop repeated deliveries of the same (entity, time) while the watermark remembers them."""
    return observations.withWatermark("logical_hour", watermark).dropDuplicatesWithinWatermark(
        ["app_id", "logical_hour"]
    )


def latest_in_stream(observations: DataFrame) -> DataFrame:
    """Newest value per entity, for update mode. State is one row per entity."""
    return observations.groupBy("app_id").agg(
        F.max("logical_hour").alias("logical_hour"),
        F.max_by("player_count", "logical_hour").alias("player_count"),
    )


def load_player_counts(
    observations: DataFrame, table: str, checkpoint: str, loaded_at: Callable[[], object]
) -> StreamingQuery:
    """Insert each micro-batch into the raw table, first writer wins.

    A micro-batch that is replayed after a failure finds its rows already there. The earliest
    of an hour is chosen when the table is read, so the order of arrival does not matter.
    """

    def insert(batch: DataFrame, _batch_id: int) -> None:
        # Read by two jobs. A lost executor only means that its share is read again.
        batch.persist()
        try:
            rows = batch.withColumn("loaded_at", F.lit(loaded_at()).cast("timestamp"))
            insert_player_counts(rows, table, order=["s3_key", "position"])
        finally:
            batch.unpersist()

    return (
        observations.writeStream.foreachBatch(insert)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def append_files(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append finished rows to Parquet, exactly once."""
    return (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def write_changes(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write the rows each micro-batch changed into a folder of its own.

    A replayed micro-batch overwrites its own folder. `read_changes` folds them.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return (
        stream.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_changes(spark: SparkSession, path: str, *key: str) -> DataFrame:
    """The current row of each key, from the changes written so far."""
    changes = spark.read.parquet(path)
    values = [c for c in changes.columns if c not in (*key, "batch")]
    return changes.groupBy(*key).agg(*[F.max_by(c, "batch").alias(c) for c in values])


def run_to_end(query: StreamingQuery) -> None:
    """Wait for an availableNow query, and fail if it failed."""
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
