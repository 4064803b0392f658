"""Event-time statistics on streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from feedloom.operators.aggregates import mean_and_spread
from feedloom.operators.anomaly import LIMIT, METRICS, finite, flagged

SALTS = 32


def window_anomalies(
    events: DataFrame, time: str, key: str, metrics: tuple[str, ...] = METRICS, width: str = "1 hour",
    late: str = "10 minutes", limit: float = LIMIT, salts: int = SALTS,
) -> DataFrame:
    """Outliers against all rows of the same event-time window, on a batch or a stream.

    A window's mean and spread come out once the watermark has passed its end, and meet the rows of the window that
    waited for them. So the flags depend on event times alone and not on where micro-batches begin, as long as no row
    is later than ``late``; rows of windows still open are flagged by a later batch. A window's rows are
    salted by ``key``, so a crowded one spreads over ``salts`` tasks. State holds the open windows only.
    """
    timed = events.withWatermark(time, late).withColumn("_window", F.window(time, width))
    numbers = timed.select("_window", *[finite(F.col(m)).alias(m) for m in metrics])
    stats = mean_and_spread(numbers, list(metrics), "_window")
    stats = stats.withColumnRenamed("_window", "_of").withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    rows = timed.withColumn("_salt", F.pmod(F.xxhash64(key), F.lit(salts)).cast("int"))
    joined = rows.join(stats, (F.col("_window") == F.col("_of")) & (F.col("_salt") == F.col("_part")))
    return flagged(joined, metrics, limit).withColumn("window_start", F.col("_window.start")).drop("_window", "_of", "_salt", "_part")
