"""Versions of tables, and one small record that says which of them are current.

A build writes each of its tables to a folder of its own. When all are written it appends one
record that names them, a single file that appears by one rename. Readers follow the newest
record, so they see the state before a build or after it, never a part of it, and a build that
dies leaves what they see as it was. One writer at a time.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RECORD = T.StructType(
    [
        T.StructField("build", T.LongType()),
        T.StructField("published_at", T.TimestampType()),
        T.StructField("tables", T.MapType(T.StringType(), T.StringType())),
    ]
)


class Store:
    """The tables under a root folder, as the newest record names them."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.records = f"{self.root}/builds"

    def _history(self) -> DataFrame:
        # Creating the folder makes reading it defined before the first build.
        self.spark.createDataFrame([], RECORD).write.mode("ignore").json(self.records)
        return self.spark.read.schema(RECORD).json(self.records)

    def current(self) -> tuple[int, dict[str, str]]:
        """Number of the newest build and the folder of each table, relative to the root."""
        newest = self._history().orderBy(F.desc("build")).first()
        return (newest.build, dict(newest.tables)) if newest else (0, {})

    def path(self, name: str) -> str:
        """Folder of a table: the current version's, or that of a table kept without versions."""
        return f"{self.root}/{self.current()[1].get(name, name)}"

    def read(self, name: str, schema: T.StructType | None = None) -> DataFrame:
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        return reader.parquet(self.path(name))

    def build(self) -> Build:
        return Build(self)

    def expire(self, keep: int = 2) -> list[str]:
        """Delete the folders that only builds before the last `keep` name; returns those deleted.

        Readers that began before those builds must have ended. Folders that a dead build left
        behind are named by no record and not touched.
        """
        builds = self._history().orderBy(F.desc("build")).collect()
        held = {folder for b in builds[:keep] for folder in b.tables.values()}
        old = sorted({f for b in builds[keep:] for f in b.tables.values()} - held)
        conf = self.spark._jsc.hadoopConfiguration()

        def deleted(folder: str) -> bool:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{folder}")
            return path.getFileSystem(conf).delete(path, True)

        return [folder for folder in old if deleted(folder)]


class Build:
    """New versions of some tables; the others stay as they are."""

    def __init__(self, store: Store):
        self.store = store
        last, self.tables = store.current()
        self.number = last + 1
        # A dead build may have had the same number, never the same folder.
        self.folder = f"build-{self.number}-{uuid.uuid4().hex[:8]}"

    def write(self, name: str, frame: DataFrame, by: str | None = None) -> DataFrame:
        """Write a whole new version of a table, by folders of `by`, and read it back."""
        path = f"{self.store.root}/{name}/{self.folder}"
        writer = frame.hint("rebalance", F.col(by)).write if by else frame.write
        (writer.partitionBy(by) if by else writer).parquet(path)
        self.tables[name] = f"{name}/{self.folder}"
        return self.store.spark.read.schema(frame.schema).parquet(path).select(*frame.columns)

    def publish(self) -> int:
        """Make all versions written current at once; returns the build's number."""
        now = datetime.now(timezone.utc)
        record = self.store.spark.createDataFrame([(self.number, now, self.tables)], RECORD)
        record.coalesce(1).write.mode("append").json(self.store.records)
        return self.number
