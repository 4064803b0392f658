"""Streaming jobs: enrichment into an item table, anomaly log, republishing, observation features."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from feedloom.operators.anomaly import anomalies
from feedloom.operators.quality import decimals, fits_decimals
from feedloom.operators.shape import decode
from feedloom.plans.posts import enrich, is_usable
from feedloom.schemas import POST_EVENT
from feedloom.session import spread, spread_shuffles
from feedloom.sources.buckets import BUCKETS, exists, merge_items
from feedloom.sources.items import compact, upsert
from feedloom.streaming.activity import counted_batch
from feedloom.streaming.metrics import BatchLog, observed, record

# Run limits in seconds and the poll cadence.
CONSUMER_LIMIT = 55 * 60
PRODUCER_LIMIT = 60 * 60
POLL = "1 second"

RESUME, TAIL, REPLAY = "resume", "tail", "replay"
ORDER = ["created_time", "author_activity_count"]
COMPACT_EVERY = 20


def run(
    stream: DataFrame, checkpoint: str, batch: Callable[[DataFrame, int], None] | None = None,
    path: str | None = None, fmt: str = "parquet", once: bool = False, every: str = POLL,
    limit: float | None = None, start: str = RESUME, log: BatchLog | None = None, **options: str,
) -> StreamingQuery:
    """Start a stream into ``foreachBatch`` or an append sink and wait for it, up to a limit if there is one.

    ``once`` takes everything available, in bounded batches, then stops. ``start`` says where a stream begins:
    ``resume`` goes on from the checkpoint, or reads all if that is new; ``tail`` does so too but leaves out what
    a new checkpoint finds there already; ``replay`` reads all and refuses a checkpoint that is in use.
    ``log`` hears of every batch, and has heard of all when this returns.
    """
    used = exists(stream.sparkSession, f"{checkpoint}/offsets")
    if start == REPLAY and used:
        raise ValueError(f"{checkpoint} holds a position; replay into a new one")
    if start == TAIL and not used:
        skip_to_end(stream, checkpoint, path, fmt)
    writer = stream.writeStream.option("checkpointLocation", checkpoint).options(**options)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)
    writer = writer.foreachBatch(batch) if batch is not None else writer.format(fmt).outputMode("append")
    if log is not None:
        stream.sparkSession.streams.addListener(log)
    try:
        query = writer.start() if batch is not None else writer.start(path)
        if limit is None or once:
            query.awaitTermination()
        elif not query.awaitTermination(limit):
            query.stop()
        if log is not None and not log.wait(str(query.runId)):
            raise TimeoutError(f"the end of {query.runId} was not reported")
    finally:
        if log is not None:
            stream.sparkSession.streams.removeListener(log)
    return query


def skip_to_end(stream: DataFrame, checkpoint: str, path: str | None = None, fmt: str = "parquet") -> None:
    """Commit the present end of the sources as the position of a new checkpoint, without reading a row.

    The position is recorded beside the checkpoint, one line per source. Only for stateless streams: state that
    should have seen the skipped rows cannot be made up.
    """
    writer = stream.where(F.lit(False)).writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if path is None:
        query = writer.foreachBatch(lambda rows, batch_id: None).start()
    else:
        # A file sink numbers its own batches and must see these as well.
        query = writer.format(fmt).outputMode("append").start(path)
    query.awaitTermination()
    progress = query.lastProgress
    ends = [json.dumps({"source": s["description"], "end": s["endOffset"]}) for s in progress["sources"]] if progress else []
    spark = stream.sparkSession
    spark.createDataFrame([(e,) for e in ends], "value string").coalesce(1).write.mode("overwrite").text(f"{checkpoint}-start")


def post_batch(
    lexicon: DataFrame, items: str, as_of: Column | None = None, latest: tuple[str, ...] = (), buckets: int = BUCKETS,
) -> Callable[[DataFrame, int], None]:
    """Micro-batch handler over JSON messages: enrich, count, upsert, log anomalies, set bad ones aside.

    Bad ones are malformed, lack a time or title, or hold a number that no decimal can. Every output folder is
    named by batch, so a retried batch replaces its own output; totals and the ``latest`` post per given columns are
    bucketed tables, which a retry leaves as they are. The messages of the last batch stay too.
    Post changes are folded every ``COMPACT_EVERY`` batches. Rows, rejects and flags are counted by the passes that write them, and recorded
    per batch. The rows also set the number of shuffle partitions of the passes behind the first, so what a task of these reads or caches does not grow with the batch.
    """

    posts, authors = f"{items}/posts", f"{items}/authors"

    def handle(messages: DataFrame, batch_id: int) -> None:
        # The messages are worked out once: what is counted and dealt is read back, so an observed stream counts right.
        inbox, value = f"{items}/messages", messages.select("value")
        value.write.mode("overwrite").parquet(inbox)
        parsed = decode(spread(messages.sparkSession.read.schema(value.schema).parquet(inbox)), POST_EVENT)
        usable = F.coalesce(is_usable(F.col("malformed")), F.lit(False))
        enriched = enrich(parsed.withColumn("usable", usable), lexicon, as_of)
        enriched = enriched.withColumn("usable", F.col("usable") & fits_decimals(enriched)).persist()
        try:
            counted, seen = observed(enriched, F.count(F.lit(1)).alias("rows"), F.count_if(~F.col("usable")).alias("rejected"))
            counted.where(~F.col("usable")).select("raw").write.mode("overwrite").parquet(f"{items}/rejected/batch_id={batch_id}")
            with spread_shuffles(messages.sparkSession, seen.get.get("rows", 0)):
                good = enriched.where("usable").drop("raw", "malformed", "usable")
                done = decimals(counted_batch(good, authors, batch_id, buckets=buckets)).persist()
                upsert(done, posts, batch_id, ["id"], ORDER)
                if latest:
                    merge_items(done, f"{items}/latest", batch_id, list(latest), ORDER, buckets)
                done.unpersist()
                if batch_id % COMPACT_EVERY == COMPACT_EVERY - 1:
                    compact(messages.sparkSession, posts, batch_id - 1, ["id"])
                flags, hits = observed(anomalies(good), F.count(F.lit(1)).alias("flagged"))
                flags.write.mode("overwrite").parquet(f"{items}/anomalies/batch_id={batch_id}")
                counts = {"rows": 0, "rejected": 0, "flagged": 0, **seen.get, **hits.get}
                record(messages.sparkSession, f"{items}/metrics", batch_id, **counts)
        finally:
            enriched.unpersist()

    return handle
