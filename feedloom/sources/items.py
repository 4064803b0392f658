"""Keyed item table on plain files: each batch appends its changes, readers merge, compaction folds.

Layout below the table folder: ``base/upto=<n>`` holds one row per key as of batch n,
``changes/batch_id=<m>`` one row per key touched by batch m. Rewriting a batch replaces
its own folder only, so a retried batch leaves the same table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from feedloom.operators.aggregates import latest_per_key


def _complete(spark: SparkSession, folder: str, prefix: str) -> dict[int, str]:
    """Fully written sub-folders by number."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return {}
    found = {}
    for status in fs.listStatus(path):
        name = status.getPath().getName()
        done = jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
        if name.startswith(f"{prefix}=") and fs.exists(done):
            found[int(name.split("=")[1])] = f"{folder}/{name}"
    return found


def upsert(batch: DataFrame, table: str, batch_id: int, keys: list[str], order: list[str]) -> None:
    """Record one batch; within it the last row per key in ``order`` wins."""
    rows = latest_per_key(batch, keys, order)
    rows.write.mode("overwrite").parquet(f"{table}/changes/batch_id={batch_id}")


def read_items(
    spark: SparkSession, table: str, keys: list[str], before: int | None = None
) -> DataFrame | None:
    """One row per key, later batches first; ``before`` leaves out that batch and later ones.

    Returns None for an empty table. The base is only filtered by the changed keys, so it
    is not shuffled while the changes are small enough for the planner to broadcast.
    """
    def wanted(n: int) -> bool:
        return before is None or n < before

    bases = {n: p for n, p in _complete(spark, f"{table}/base", "upto").items() if wanted(n)}
    upto = max(bases, default=-1)
    changes = [
        p for n, p in _complete(spark, f"{table}/changes", "batch_id").items() if wanted(n) and n > upto
    ]
    base = spark.read.parquet(bases[upto]) if bases else None
    if not changes:
        return base
    newer = spark.read.option("basePath", f"{table}/changes").parquet(*changes)
    # One batch has one row per key already.
    newest = (latest_per_key(newer, keys, ["batch_id"]) if len(changes) > 1 else newer).drop("batch_id")
    if base is None:
        return newest
    return base.join(newest.select(*keys), keys, "left_anti").unionByName(newest)


def compact(spark: SparkSession, table: str, upto: int, keys: list[str]) -> None:
    """Fold all batches up to ``upto`` into a new base. Older folders stay for running readers.

    A base that stands already is left as it is, so a retried batch may ask for it again.
    """
    if upto in _complete(spark, f"{table}/base", "upto"):
        return
    merged = read_items(spark, table, keys, before=upto + 1)
    if merged is not None:
        merged.write.mode("overwrite").parquet(f"{table}/base/upto={upto}")
