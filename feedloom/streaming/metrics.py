"""Counts of a micro-batch, taken by the passes that write it anyway."""

from __future__ import annotations

import json
import threading
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql.streaming.listener import StreamingQueryListener

FIELDS = "batch_id bigint, rows bigint, rejected bigint, flagged bigint"


def observed(df: DataFrame, *counts: Column) -> tuple[DataFrame, Observation]:
    """The frame with named aggregates that its next action fills in, without a pass of their own."""
    seen = Observation()
    return df.observe(seen, *counts), seen


def record(spark: SparkSession, folder: str, batch_id: int, **counts: int) -> None:
    """One row of counts per batch, in a folder named by it: a retry replaces its own."""
    row = spark.createDataFrame([json.dumps(counts)], "string").coalesce(1)
    row.write.mode("overwrite").text(f"{folder}/batch_id={batch_id}")


def read_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """All recorded batches."""
    return spark.read.schema(FIELDS).json(folder)


class BatchLog(StreamingQueryListener):
    """Hands the progress of every micro-batch that read rows to ``on_batch``.

    It gets batch id, rows read and, by name, the aggregates that ``DataFrame.observe`` put on the stream. Spark
    reports a batch after it was committed, in order, from a thread of its own; ``wait`` returns once the end of a query
    was reported, so all its batches were. A batch that is repeated after a failure is reported when it succeeds.
    """

    def __init__(self, on_batch: Callable[[dict], None]):
        self.on_batch, self.ended, self.news = on_batch, set(), threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if progress.numInputRows:
            counts = {name: row.asDict() for name, row in progress.observedMetrics.items()}
            self.on_batch({"run": str(progress.runId), "batch_id": progress.batchId, "read": progress.numInputRows, **counts})

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self.news:
            self.ended.add(str(event.runId))
            self.news.notify_all()

    def wait(self, run_id: str, seconds: float = 60) -> bool:
        """Whether the end of a run was reported in time."""
        with self.news:
            return self.news.wait_for(lambda: run_id in self.ended, seconds)
