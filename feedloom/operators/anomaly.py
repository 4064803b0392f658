"""Z-score outliers against the whole batch or against each group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from feedloom.operators.aggregates import mean_and_spread
from feedloom.operators.lookups import lookup
from feedloom.session import pinned

# The checked metrics and the limit.
METRICS = ("score", "num_comments", "popularity_score")
LIMIT = 3.0


def finite(value: Column) -> Column:
    """The value as a double, NULL if it is NaN or infinite: one such value would spoil any mean."""
    number = value.cast("double")
    return F.when(~F.isnan(number) & (F.abs(number) < float("inf")), number)


def _z(value: Column, mean: Column, std: Column) -> Column:
    """Distance from the mean in deviations; NULL for NaN, so NaN is never flagged, while infinity always is."""
    number = value.cast("double")
    return F.when(~F.isnan(number), F.abs(F.try_divide(number - mean, std)))


def _flagged(df: DataFrame, metrics: tuple[str, ...], limit: float) -> DataFrame:
    """One row per (row, metric) whose ``<metric>_z`` exceeds the limit."""
    pairs = F.array(
        *[F.struct(F.lit(m).alias("metric"), F.col(f"{m}_z").alias("z_score")) for m in metrics]
    )
    hit = F.filter(pairs, lambda p: p["z_score"] > limit)
    drop = [f"{m}_{part}" for m in metrics for part in ("z", "mean", "std")]
    return df.withColumn("_hit", F.explode(hit)).select("*", "_hit.*").drop("_hit", *drop)


def flagged(df: DataFrame, metrics: tuple[str, ...] = METRICS, limit: float = LIMIT) -> DataFrame:
    """Outliers of rows that carry ``<metric>_mean`` and ``<metric>_std``."""
    z = {f"{m}_z": _z(F.col(m), F.col(f"{m}_mean"), F.col(f"{m}_std")) for m in metrics}
    return _flagged(df.withColumns(z), metrics, limit)


def anomalies(
    df: DataFrame, metrics: tuple[str, ...] = METRICS, limit: float = LIMIT
) -> DataFrame:
    """Outliers against the whole frame; its statistics are one row, read as a scalar subquery."""
    numbers = df.select(*[finite(F.col(m)).alias(m) for m in metrics])
    row = mean_and_spread(numbers, list(metrics)).select(F.struct("*").alias("s"))
    z = {f"{m}_z": _z(F.col(m), F.col("_s")[f"{m}_mean"], F.col("_s")[f"{m}_std"]) for m in metrics}
    return _flagged(df.withColumn("_s", row.scalar()).withColumns(z).drop("_s"), metrics, limit)


def anomalies_by(
    df: DataFrame, group: str, metrics: tuple[str, ...] = METRICS, limit: float = LIMIT
) -> DataFrame:
    """Outliers against each row's own group.

    The statistics are aggregated with map-side combine and written once; the rows then
    stay where they are unless the statistics turn out too large to broadcast.
    """
    numbers = df.select(group, *[finite(F.col(m)).alias(m) for m in metrics])
    stats = pinned(mean_and_spread(numbers, list(metrics), group), "group-stats")
    return flagged(lookup(df, stats, group, "inner"), metrics, limit)
