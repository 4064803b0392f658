"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Fixed value: rows of a source that one task takes where the work is CPU-heavy.
SPREAD_ROWS = 100_000

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot join key is split even where that costs a later stage one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.caseSensitive": "false",
    # Streaming state lives on disk next to its executor, not on the JVM heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.ui.enabled": "false",
}


def build_session(app: str = "feedloom", master: str | None = None, **extra: str) -> SparkSession:
    """Session with UTC times and adaptive execution; ``extra`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in extra.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``.

    A temporary folder stands in only for a local session that names none.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    local = tempfile.mkdtemp(prefix="feedloom-")
    spark.conf.set("spark.checkpoint.dir", local)
    spark.sparkContext.setCheckpointDir(local)
    return local


def new_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the shared folder."""
    return f"{shared_dir(spark)}/feedloom/{name}-{uuid.uuid4().hex}"


def pinned(df: DataFrame, name: str = "pinned") -> DataFrame:
    """Write ``df`` once and read it back: short lineage, survives executor loss, exact size known.

    The planner then sees the real file size, so it broadcasts the table only when
    it is below ``spark.sql.autoBroadcastJoinThreshold``.
    """
    path = new_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, rows: int = SPREAD_ROWS) -> DataFrame:
    """Deal a source into enough partitions for CPU-heavy work: one per core, and about ``rows`` rows in each at most.

    So what a task holds or caches does not grow with the table. A table whose own splits are that many is not shuffled.
    """
    parts = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // rows))
    return df if df.rdd.getNumPartitions() >= parts else df.repartition(parts)


@contextmanager
def spread_shuffles(spark: SparkSession, total: int, rows: int = SPREAD_ROWS) -> Iterator[None]:
    """Let shuffles inside the block have at least one partition per ``rows`` of ``total`` rows; adaptive execution merges small ones.

    Sets the session's number of shuffle partitions and restores it. A micro-batch has its stream's own session.
    """
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, str(max(int(before), -(-total // rows))))
    try:
        yield
    finally:
        spark.conf.set(name, before)
