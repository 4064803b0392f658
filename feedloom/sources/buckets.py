"""Keyed tables in hashed partitions: a batch reads and replaces only the partitions its own keys fall into.

A table is plain Parquet partitioned by ``bucket``, one row per key, written with dynamic partition overwrite. What a
batch costs follows the buckets it touches, so choose the number of buckets with the table; ``rebucket`` writes a
table that outgrew it with more. NULL keys are keys like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from feedloom.operators.aggregates import latest_per_key

BUCKETS = 64
BUCKET = "bucket"
BATCH = "batch_id"


def bucket_of(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def touched(batch: DataFrame, keys: list[str], buckets: int) -> list[int]:
    """The buckets of the batch's keys, at most ``buckets`` numbers."""
    return sorted(r[0] for r in batch.select(bucket_of(keys, buckets)).distinct().collect())


def read_buckets(spark: SparkSession, table: str, schema: T.StructType, numbers: list[int] | None = None) -> DataFrame:
    """The table or some of its buckets; an absent table is empty."""
    whole = T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])
    if not exists(spark, table):
        return spark.createDataFrame([], whole)
    rows = spark.read.schema(whole).parquet(table)
    return rows if numbers is None else rows.where(F.col(BUCKET).isin(numbers))


def replace_buckets(rows: DataFrame, table: str) -> None:
    """Write whole buckets, one task each; buckets that are not in ``rows`` stay untouched."""
    spread = rows.repartition(F.col(BUCKET)).write.partitionBy(BUCKET)
    spread.option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(table)


def merge_items(
    batch: DataFrame, table: str, batch_id: int, keys: list[str], order: list[str], buckets: int = BUCKETS
) -> None:
    """Upsert: the last row per key, later batches over earlier ones and ``order`` within a batch.

    A retried batch meets its own rows again and leaves the same table.
    """
    rows = latest_per_key(batch, keys, order).withColumn(BATCH, F.lit(batch_id).cast("bigint"))
    numbers = touched(rows, keys, buckets)
    stored = read_buckets(batch.sparkSession, table, rows.schema, numbers)
    merged = latest_per_key(stored.drop(BUCKET).unionByName(rows), keys, [BATCH, *order])
    replace_buckets(merged.withColumn(BUCKET, bucket_of(keys, buckets)), table)


def totals_schema(batch: DataFrame, keys: list[str], seen: str) -> T.StructType:
    """Keys, running total, total ahead of the key's last batch, that batch, and when the key was last seen."""
    long = T.LongType()
    own = [T.StructField(f.name, f.dataType) for f in batch.select(*keys).schema.fields]
    rest = [T.StructField(c, long) for c in ("total", "earlier", BATCH)]
    return T.StructType([*own, *rest, T.StructField(seen, batch.schema[seen].dataType)])


def merge_totals(
    batch: DataFrame, table: str, batch_id: int, keys: list[str], seen: str, buckets: int = BUCKETS,
    expired: Column | None = None,
) -> DataFrame:
    """Add the batch's rows per key to running totals; gives each key of the batch its total ``earlier``.

    Every row keeps the total ahead of its last batch, so a retry of that batch starts from there again. ``expired``
    is a condition on the stored ``seen``: such keys leave the buckets the batch touches, and count anew.
    """
    spark = batch.sparkSession
    schema = totals_schema(batch, keys, seen)
    added = batch.groupBy(*keys).agg(F.count(F.lit(1)).alias("_added"), F.max(seen).alias(seen))
    numbers = touched(added, keys, buckets)
    again = F.col(BATCH) == batch_id
    stored = read_buckets(spark, table, schema, numbers).drop(BUCKET)
    if expired is not None:
        stored = stored.where(again | ~F.coalesce(expired, F.lit(False)))
    stored = stored.withColumn("_prior", F.when(again, F.col("earlier")).otherwise(F.col("total")))
    fresh = added.select(*keys, "_added", seen)
    both = stored.unionByName(fresh, allowMissingColumns=True).groupBy(*keys).agg(
        F.coalesce(F.sum("_prior"), F.lit(0)).alias("_prior"), F.coalesce(F.sum("_added"), F.lit(0)).alias("_added"),
        F.max("earlier").alias("_earlier"), F.max(BATCH).alias("_batch"), F.max(seen).alias(seen),
    )
    in_batch = F.col("_added") > 0
    rows = both.select(
        *keys, (F.col("_prior") + F.col("_added")).alias("total"),
        F.when(in_batch, F.col("_prior")).otherwise(F.col("_earlier")).alias("earlier"),
        F.when(in_batch, F.lit(batch_id)).otherwise(F.col("_batch")).cast("bigint").alias(BATCH), seen,
    )
    replace_buckets(rows.withColumn(BUCKET, bucket_of(keys, buckets)), table)
    return read_buckets(spark, table, schema, numbers).where(again).select(*keys, "earlier")


def rebucket(spark: SparkSession, table: str, target: str, schema: T.StructType, keys: list[str], buckets: int) -> None:
    """The table anew with another number of buckets, under another name."""
    rows = read_buckets(spark, table, schema).withColumn(BUCKET, bucket_of(keys, buckets))
    replace_buckets(rows, target)
