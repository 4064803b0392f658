"""Running count per author across micro-batches."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from feedloom.operators.lookups import fits
from feedloom.operators.running import SLICE_ROWS, running_count, sliced
from feedloom.sources.buckets import BUCKETS, merge_totals

COUNT = "author_activity_count"
# Fixed value: groups of authors in the state store.
GROUPS = 4096


def author_counts(
    events: DataFrame, author: str, order: list[str], out: str = COUNT, groups: int = GROUPS
) -> DataFrame:
    """Number each author's rows in arrival order, with the counts kept in the state store.

    Authors are hashed into ``groups``, and a group's counts are one state, so the handler is called per group and not
    per author; choose ``groups`` with the authors and keep it for a checkpoint. The handler holds one group's rows of one
    micro-batch, which the source's batch limit bounds. Where one author fills most of a batch, ``counted_batch`` splits it.
    """
    schema = T.StructType([*events.schema.fields, T.StructField(out, T.LongType())])

    def number(key: tuple, frames: Iterator[pd.DataFrame], state: Any) -> Iterator[pd.DataFrame]:
        seen = dict(zip(*state.get)) if state.exists else {}
        rows = pd.concat(list(frames), ignore_index=True).sort_values(order)
        names = rows["_name"].fillna("") if key[0] < 0 else rows["_name"]
        nth = names.groupby(names).cumcount() + 1
        rows[out] = nth + names.map(seen).fillna(0).astype("int64")
        seen.update((name, int(n)) for name, n in rows.groupby(names)[out].max().items())
        state.update((list(seen), list(seen.values())))
        yield rows[schema.names]

    # A missing author is one of its own; as text a name stays what it is beside missing ones.
    name = F.col(author).cast("string")
    group = F.when(F.col(author).isNull(), -1).otherwise(F.pmod(F.xxhash64(author), F.lit(groups)))
    return events.withColumns({"_name": name, "_group": group}).groupBy("_group").applyInPandasWithState(
        number, schema, "names array<string>, seen array<bigint>", "append", "NoTimeout"
    )


def counted_batch(
    batch: DataFrame, totals: str, batch_id: int, author: str = "author",
    order: tuple[str, ...] = ("created_time", "id"), out: str = COUNT,
    slice_rows: int = SLICE_ROWS, buckets: int = BUCKETS, expired: Column | None = None,
) -> DataFrame:
    """The same count inside ``foreachBatch``, for batches where one author may hold most rows.

    Two levels: rows are numbered within slices of bounded row count, each shifted by the author's rows in earlier
    slices, and all by the author's total from earlier batches. That comes from a bucketed table, of which only the
    buckets of the batch's authors are read and replaced; it lets a retry count from the same total. ``expired``
    forgets authors by the first column of ``order`` that was last seen of them.
    """
    before = merge_totals(batch, totals, batch_id, [author], order[0], buckets, expired)
    cut = sliced(batch, author, list(order), slice_rows)
    local = running_count(cut, author, list(order), [F.col("_slice")], out).drop("_slice")
    known = before.where("earlier > 0").select(F.col(author).alias("_author"), F.col("earlier").alias("_earlier"))
    side = F.broadcast(known) if fits(known) else known
    joined = local.join(side, local[author].eqNullSafe(F.col("_author")), "left")
    return joined.withColumn(out, F.col(out) + F.coalesce("_earlier", F.lit(0))).drop("_author", "_earlier")
