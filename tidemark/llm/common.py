"""What the operators share: scratch tables, checked broadcasts, tasks that keep memory low, and
connected components."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A side is broadcast only when it is known to hold no more bytes than this.
BROADCAST_BYTES = 64 << 20

# Rows go to Python in batches of about so many bytes, however wide they are.
BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of the session by bytes: 10,000 rows of text can be any size, and
    a batch is held by the JVM and by Python, for each task, before and after its work."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def trimmed(work: Callable) -> Callable:
    """`work` on batches, with the memory it freed given back to the system when a task ends;
    Python workers live on from one stage to the next."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library only
            if trim:
                trim(0)

    return run


class Workspace:
    """A new folder under the cluster's shared checkpoint folder, for tables that cut lineage.

    A saved table outlives any executor, so nothing upstream of it is computed again. On a
    cluster the folder must be named in `spark.checkpoint.dir`; a local master may go without.
    """

    def __init__(self, spark: SparkSession, label: str):
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            if not spark.sparkContext.master.startswith("local["):
                raise RuntimeError("spark.checkpoint.dir must name a folder all executors share")
            base = tempfile.mkdtemp(prefix="tidemark-llm-")
        small_batches(spark)
        self.spark = spark
        self.root = f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"

    def save(self, frame: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        frame.write.parquet(path)
        return self.spark.read.schema(frame.schema).parquet(path)

    def drop(self, name: str) -> None:
        """Delete a table that no later step reads."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def maybe_broadcast(frame: DataFrame, size: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast for a frame of `size` measured bytes; beyond the limit Spark shuffles."""
    return F.broadcast(frame) if size <= limit else frame


def without(docs: DataFrame, rejected: DataFrame, key: str = "doc_id") -> DataFrame:
    """Documents whose `key` is not among the distinct long `doc_id`s of `rejected`.

    `rejected` is counted first, so it should be a settled table.
    """
    bad = rejected.select(F.col("doc_id").alias("__rejected"))
    bad = maybe_broadcast(bad, 48 * bad.count())
    return docs.join(bad, F.col(key) == F.col("__rejected"), "left_anti")


def row_keys(ws: Workspace, docs: DataFrame) -> DataFrame:
    """`docs` with a long `key` by which a row can be judged alone, in the order of doc_id.

    Where every doc_id is there and unique it is the key. Otherwise each distinct pair of doc_id
    and text gets a place in the order of doc_id (null last) and of the texts' fingerprints, so
    rows that repeat a doc_id differ unless they are equal in text too. Only ids and fingerprints
    are sorted; texts are moved once, and only in that case.
    """
    counts = docs.groupBy("doc_id").count()
    if counts.where("doc_id is null or count > 1").isEmpty():
        return docs.withColumn("key", F.col("doc_id").cast("long"))
    mark = F.xxhash64("text", F.col("text").isNull())
    pairs = docs.select(F.col("doc_id").alias("__id"), mark.alias("__mark")).distinct()
    order = [F.asc_nulls_last("__id"), F.asc("__mark")]
    placed = pairs.orderBy(*order).withColumn("key", F.monotonically_increasing_id())
    placed = ws.save(placed, "keys")
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (mark == F.col("__mark"))
    return docs.join(placed, same).drop("__id", "__mark")


def components(ws: Workspace, edges: DataFrame, name: str) -> DataFrame:
    """Smallest reachable id of every vertex of an undirected graph: columns `v`, `root`.

    `edges` has long columns `a`, `b`. Each round links every vertex's larger neighbours, then
    its smaller ones, to the smallest neighbour known, until each component is a star around its
    smallest vertex. Only minima are aggregated, so a centre with any number of neighbours
    reaches that shuffle as one row per task. Minima are written before rows are joined with them,
    so both sides of a join are plain shuffles, and adaptive execution splits the neighbours of a
    crowded centre over tasks. Rounds grow with the logarithm of a component.
    """
    small, big = F.least("a", "b"), F.greatest("a", "b")
    state = edges.where("a <> b").select(big.alias("u"), small.alias("v")).distinct()
    state = ws.save(state, f"{name}-0")
    mark = None
    turn = 0
    while True:
        turn += 1
        step = f"{name}-{turn}"
        both = state.unionByName(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        low = ws.save(low.select("u", F.least("u", "m").alias("m")), f"{step}-low")
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = ws.save(large.where("u <> v").distinct(), f"{step}-large")
        least = ws.save(large.groupBy("u").agg(F.min("v").alias("m")), f"{step}-least")
        out = (
            large.join(least, "u")
            .where("v <> m")
            .select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v")))
            .distinct()
        )
        following = ws.save(out, step)
        now = following.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").bitwiseAND(F.lit((1 << 40) - 1)))
        ).first()
        for old in (f"{name}-{turn - 1}", f"{step}-low", f"{step}-large", f"{step}-least"):
            ws.drop(old)
        state = following
        if now == mark:
            break
        mark = now
    roots = state.select(F.col("u").alias("v"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("v"), "root").distinct())
