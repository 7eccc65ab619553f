"""Session helpers: what the operators assume about a session, and where scratch data goes."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

# Results depend on these two: hours and days are UTC, and arithmetic errors raise.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Tuning only. A partition keyed by the entity already serves a join on (entity, day),
# so the join need not shuffle again.
TUNING_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # A model build has more stages than the default number of compiled ones that are kept.
    "spark.sql.codegen.cache.maxEntries": "1000",
    # Streaming state outgrows the heap with the number of entities.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def local_session(cpus: str | int = "*", app: str = "tidemark", **conf: str) -> SparkSession:
    """A single-machine session for tests and the bench. Clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in {**REQUIRED_CONF, **TUNING_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Set the two settings that results depend on in a session somebody else made."""
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    return spark


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder under the cluster's shared checkpoint folder.

    Executors write here and others read it back, so a machine-local folder is only right on a
    local master; elsewhere the setting must be there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder all executors share")
        root = tempfile.mkdtemp(prefix="tidemark-")
    return f"{root.rstrip('/')}/tidemark-{label}-{uuid.uuid4().hex}"


def together(*tasks: Callable) -> list:
    """Results of tasks that run at the same time, each with its own jobs.

    For writes that do not read each other: the cluster works on one while another waits for its
    last task, or for the driver to plan it.
    """
    inherit = inheritable_thread_target(SparkSession.active())
    with ThreadPoolExecutor(len(tasks)) as pool:
        started = [pool.submit(inherit(task)) for task in tasks]
        return [task.result() for task in started]
