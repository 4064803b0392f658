"""Exact deduplication as a stateful stream over content digests.

Each text is reduced to a digest of its normalised form, its id and a locator (file and row). The digests
flow through a streaming aggregation whose keyed state lives in RocksDB and never expires: per digest it
retains the smallest id, the locator of that row and the number of rows. Changed groups leave the stream
after each micro-batch. Rows that hit an existing digest are then compared with the text they hit, byte by
byte; rows that differ (a digest collision) are grouped among themselves by their full text.

Defined cases: a null text counts as empty. A null id sorts behind all others, so it stays only in a group without
ids. Rows with one id are rows of their own: of several with the smallest id, every one is marked
kept. An empty table gives an empty result; other columns are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.session import new_dir, pinned

STATE = "spark.sql.streaming.stateStore."
# State on disk, checkpointed by its changes; many small stores reserve no disk ahead.
STATE_SETTINGS = {
    STATE + "providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    STATE + "rocksdb.changelogCheckpointing.enabled": "true",
    STATE + "rocksdb.allowFAllocate": "false",
}
# Digest files of one micro-batch.
FILES_PER_BATCH = 16


def normalised(text: Column) -> Column:
    """Every run of white space as one space. Runs that are one space already are left untouched."""
    run = r"\x20*[\x09-\x0D][\x20\x09-\x0D]*|\x20{2,}"
    return F.regexp_replace(F.coalesce(text, F.lit("")), run, " ")


def sha256_digest(text: Column) -> Column:
    return F.sha2(text, 256)


def content_digests(docs: DataFrame, digest=sha256_digest) -> DataFrame:
    """doc_id, key, SHA-256 and locator of every row, written as the files the stream reads."""
    text = normalised(F.col("text"))
    rows = docs.select(
        "doc_id", digest(text).alias("key"), F.sha2(text, 256).alias("text_sha256"),
        F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")).alias("place"),
    )
    return rows


def first_seen(spark: SparkSession, folder: str, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """Stream the digest files; per key the smallest id, its locator and the number of rows."""
    work = new_dir(spark, "exact")
    schema = spark.read.parquet(folder).schema
    before = {key: spark.conf.get(key, None) for key in STATE_SETTINGS}
    for key, value in STATE_SETTINGS.items():
        spark.conf.set(key, value)
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)
    by_id = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "place")
    state = rows.groupBy("key").agg(F.min(by_id).alias("first"), F.count(F.lit(1)).alias("n"))

    def write(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{work}/groups/batch={batch}")

    try:
        job = (
            state.writeStream.outputMode("update").foreachBatch(write)
            .option("checkpointLocation", f"{work}/checkpoint").trigger(availableNow=True).start()
        )
        job.awaitTermination()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    if job.lastProgress is None and not job.recentProgress:
        return spark.createDataFrame([], state.schema)
    # The last word on a key is the one with the most rows.
    groups = spark.read.schema(state.schema).parquet(f"{work}/groups")
    return groups.groupBy("key").agg(F.min("first").alias("first"), F.max("n").alias("n"))


def dedup(docs: DataFrame, digest=sha256_digest, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """One row per document with the id of the row that stays, the group's size and the text's SHA-256.

    ``docs`` is read straight from files, so that every row has a locator.
    """
    spark = docs.sparkSession
    folder = new_dir(spark, "digests")
    content_digests(docs, digest).write.parquet(folder)
    rows = spark.read.parquet(folder)
    if rows.isEmpty():
        return rows.select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(0).cast("long").alias("group_size"),
                           F.lit(True).alias("kept"), "text_sha256")
    groups = pinned(first_seen(spark, folder, files_per_batch), "groups")
    differing = pinned(_differing(docs, rows, groups), "differing")
    found = rows.join(groups, "key")
    if not differing.isEmpty():
        found = _regrouped(found, docs, differing)
    keep = F.col("first.doc_id")
    return found.select(
        "doc_id", keep.alias("keep_id"), F.col("n").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"), "text_sha256",
    )


def _located(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")).alias("place"),
        normalised(F.col("text")).alias("text"),
    )


def _differing(docs: DataFrame, rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Places of rows whose bytes differ from those of the row their digest hit."""
    shared = groups.filter("n > 1").select("key", F.col("first.place").alias("origin"))
    members = rows.select("key", "place").join(shared, "key")
    origins = members.filter("place = origin").select("place", F.col("key").alias("origin_key"))
    hits = members.filter("place != origin").select("place", "key")
    texts = _located(docs)
    origin_texts = origins.join(texts, "place").select(F.col("origin_key").alias("key"), F.col("text").alias("origin_text"))
    hit_texts = hits.join(texts, "place")
    return hit_texts.join(origin_texts, "key").filter(F.col("text") != F.col("origin_text")).select("place")


def _regrouped(found: DataFrame, docs: DataFrame, differing: DataFrame) -> DataFrame:
    """Groups of rows set apart by the byte check, and the sizes of the groups they leave."""
    gone = differing.withColumn("apart", F.lit(True))
    marked = found.join(gone, "place", "left")
    left = marked.groupBy("key").agg(F.count("apart").alias("moved"))
    stay = marked.filter("apart is null").drop("apart").join(left, "key").withColumn("n", F.col("n") - F.col("moved")).drop("moved")
    moved = marked.filter("apart").drop("apart", "first", "n").join(_located(docs), "place")
    by_id = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "place")
    own = moved.groupBy("text").agg(F.min(by_id).alias("first"), F.count(F.lit(1)).alias("n"))
    return stay.unionByName(moved.join(own, "text").drop("text"))
