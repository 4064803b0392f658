"""Running counts per key that do not put all rows of a hot key into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from feedloom.session import pinned

SLICE_ROWS = 200_000


def running_count(
    df: DataFrame, key: str, order: list[str], slices: list[Column], out: str = "author_activity_count"
) -> DataFrame:
    """Number of rows of the key up to and including this one, in the given order.

    ``slices`` cut the order into consecutive runs, for example the hour of a timestamp
    that leads ``order`` (or the timestamp itself followed by a block of the id, where
    many rows share one time). Every (key, slice) gets one extra head row that carries
    the row count of the key's earlier slices, so the running sum within the slice is
    the running count of the key. Only counts per slice meet in one task, and the rows
    are shuffled once, on (key, slice).
    """
    names = [f"_slice{i}" for i in range(len(slices))]
    cut = df.withColumns(dict(zip(names, slices)))
    earlier = Window.partitionBy(key).orderBy(*names).rowsBetween(Window.unboundedPreceding, -1)
    heads = cut.groupBy(key, *names).agg(F.count(F.lit(1)).alias("_n")).select(
        key, *names, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_step"), F.lit(0).alias("_row")
    )
    rows = cut.withColumns({"_step": F.lit(1).cast("bigint"), "_row": F.lit(1)})
    so_far = (
        Window.partitionBy(key, *names)
        .orderBy("_row", *order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        rows.unionByName(heads, allowMissingColumns=True)
        .withColumn(out, F.sum("_step").over(so_far))
        .where("_row = 1")
        .select(*df.columns, out)
    )


def sliced(
    df: DataFrame, key: str, order: list[str], rows: int = SLICE_ROWS, out: str = "_slice"
) -> DataFrame:
    """Tag rows with consecutive slices of about ``rows`` rows in the order of the key and ``order``.

    The slices are the ranges of a range partitioning, so a key that holds most rows is cut by its number of
    rows however close together they are in time. Written once, so the ranges stay as they were drawn.
    """
    parts = -(-df.count() // rows)
    if parts < 2:
        return df.withColumn(out, F.lit(0))
    return pinned(df.repartitionByRange(parts, key, *order).withColumn(out, F.spark_partition_id()), "slices")


def numbered(df: DataFrame, order: list[str], slices: list[Column], out: str) -> DataFrame:
    """Number all rows from 1 in the given order, without sorting them in one task."""
    whole = running_count(df.withColumn("_whole", F.lit(0)), "_whole", order, slices, out)
    return whole.drop("_whole")
