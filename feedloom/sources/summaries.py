"""Mergeable summaries of measures per key, kept in hashed partitions and brought up to date batch by batch.

A summary holds the number of values, their mean and sum of squared distances from it (M2), the extremes, and a
histogram whose bins grow by the factor ``GAMMA``: a quantile read from it is within ``(GAMMA - 1) / (GAMMA + 1)`` of the
value at that rank, about one percent. Summaries of two sets of rows merge into that of both, so a batch costs its own rows and the
buckets they touch, and the order of batches does not matter (but for the last digits of mean and M2). Histograms
have at most some thousand bins, whatever the number of rows.

NULL, NaN and infinite values are left out; a key without any other has no summary of that measure. NULL keys are
keys like any other.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from feedloom.sources.buckets import BATCH, BUCKET, BUCKETS, bucket_of, read_buckets, replace_buckets, touched

GAMMA = 1.02
# Above the number of any bin, so that the sign of a bin is that of its values.
_SHIFT = 100_000
MEASURE = "measure"
SUMMARY = "n bigint, mean double, m2 double, low double, high double, bins map<int,bigint>"


def bin_of(value: Column) -> Column:
    """Number of a value's bin, in the order of values; 0 is that of zero."""
    size = F.ceil(F.log(F.abs(value)) / math.log(GAMMA)).cast("int") + _SHIFT
    return F.when(value == 0, F.lit(0)).when(value > 0, size).otherwise(-size)


def value_of(number: Column) -> Column:
    """The value that stands for a bin."""
    size = F.pow(F.lit(GAMMA), F.abs(number) - _SHIFT) * 2 / (GAMMA + 1)
    return F.when(number != 0, F.signum(number) * size).otherwise(0.0)


def _moments(a: Column, b: Column) -> list[Column]:
    n, step = a["n"] + b["n"], b["mean"] - a["mean"]
    return [
        n.alias("n"), (a["mean"] + step * b["n"] / n).alias("mean"),
        (a["m2"] + b["m2"] + step * step * a["n"] * b["n"] / n).alias("m2"),
        F.least(a["low"], b["low"]).alias("low"), F.greatest(a["high"], b["high"]).alias("high"),
    ]


def merged(a: Column, b: Column) -> Column:
    """The summary of the rows of both."""
    bins = F.map_zip_with(a["bins"], b["bins"], lambda _, x, y: F.coalesce(x, F.lit(0)) + F.coalesce(y, F.lit(0)))
    return F.struct(*_moments(a, b), bins.alias("bins"))


def summaries(df: DataFrame, keys: list[str], measures: list[str], out: str = "now") -> DataFrame:
    """(keys, measure, summary). Values combine by bin ahead of the shuffle, so a hot key is a few rows per task."""
    values = F.array(*[F.struct(F.lit(m).alias(MEASURE), F.col(m).cast("double").alias("value")) for m in measures])
    rows = df.select(*keys, F.inline(values)).where(F.abs("value") < F.lit(math.inf))
    binned = rows.groupBy(*keys, MEASURE, bin_of(F.col("value")).alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean"), (F.var_pop("value") * F.count(F.lit(1))).alias("m2"),
        F.min("value").alias("low"), F.max("value").alias("high"),
    )
    parts = binned.groupBy(*keys, MEASURE).agg(
        F.sort_array(F.collect_list(F.struct("bin", "n", "mean", "m2", "low", "high"))).alias("parts"))
    none = F.struct(
        F.lit(0).cast("bigint").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"),
        F.lit(math.inf).alias("low"), F.lit(-math.inf).alias("high"))
    whole = parts.select(*keys, MEASURE, "parts", F.reduce("parts", none, lambda a, b: F.struct(*_moments(a, b))).alias("s"))
    bins = F.map_from_entries(F.transform("parts", lambda p: F.struct(p["bin"], p["n"])))
    return whole.select(*keys, MEASURE, F.struct("s.*", bins.alias("bins")).alias(out))


def summary_schema(batch: DataFrame, keys: list[str]) -> T.StructType:
    """Keys, measure, summary, summary ahead of the last batch that had the key, and that batch."""
    own = [T.StructField(f.name, f.dataType) for f in batch.select(*keys).schema.fields]
    summary = T.DataType.fromDDL(SUMMARY)
    return T.StructType([
        *own, T.StructField(MEASURE, T.StringType()), T.StructField("now", summary), T.StructField("before", summary),
        T.StructField(BATCH, T.LongType())])


def merge_summaries(
    batch: DataFrame, table: str, batch_id: int, keys: list[str], measures: list[str], buckets: int = BUCKETS
) -> None:
    """Merge a batch into the stored summaries. A retried batch starts from what stood before it."""
    spark, schema = batch.sparkSession, summary_schema(batch, keys)
    again = F.col(BATCH) == batch_id
    stored = read_buckets(spark, table, schema, touched(batch, keys, buckets)).drop(BUCKET)
    stored = stored.withColumn("_prior", F.when(again, F.col("before")).otherwise(F.col("now")))
    both = stored.unionByName(summaries(batch, keys, measures, "_fresh"), allowMissingColumns=True)
    # A key has one stored row and one of the batch at most.
    one = both.groupBy(*keys, MEASURE).agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("now", "before", BATCH, "_prior", "_fresh")])
    fresh, prior = F.col("_fresh"), F.col("_prior")
    rows = one.select(
        *keys, MEASURE,
        F.when(fresh.isNull(), F.col("now")).when(prior.isNull(), fresh).otherwise(merged(prior, fresh)).alias("now"),
        F.when(fresh.isNull(), F.col("before")).otherwise(prior).alias("before"),
        F.when(fresh.isNull(), F.col(BATCH)).otherwise(F.lit(batch_id)).cast("bigint").alias(BATCH),
    )
    replace_buckets(rows.withColumn(BUCKET, bucket_of(keys, buckets)), table)


def quantile(bins: Column, share: float) -> Column:
    """Value at rank ``floor(share * (n - 1))`` from 0, to the precision of the bins."""
    entries = F.array_sort(F.map_entries(bins))
    total = F.reduce(F.map_values(bins), F.lit(0).cast("bigint"), lambda a, b: a + b)
    rank = F.floor(F.lit(share) * (total - 1))
    start = F.struct(F.lit(0).cast("bigint").alias("seen"), F.lit(None).cast("int").alias("bin"))
    walk = F.reduce(entries, start, lambda a, e: F.struct(
        (a["seen"] + e["value"]).alias("seen"),
        F.when(a["bin"].isNull() & (a["seen"] + e["value"] > rank), e["key"]).otherwise(a["bin"]).alias("bin")))
    return value_of(walk["bin"])


def read_summaries(
    spark: SparkSession, table: str, schema: T.StructType, keys: list[str], shares: dict[str, float] | None = None
) -> DataFrame:
    """Stored statistics: keys, measure, n, mean, sample deviation, extremes, and a column per quantile."""
    rows = read_buckets(spark, table, schema)
    spread = F.when(F.col("now.n") > 1, F.sqrt(F.try_divide(F.col("now.m2"), F.col("now.n") - 1)))
    return rows.select(
        *keys, MEASURE, "now.n", "now.mean", spread.alias("std"), "now.low", "now.high",
        *[quantile(F.col("now.bins"), q).alias(name) for name, q in (shares or {}).items()])
