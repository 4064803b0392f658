"""Where queries and their SQL forms are registered."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from feedloom.session import spread

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name; it runs with times in UTC."""

    def register(run: Query) -> Query:
        @wraps(run)
        def in_utc(spark: SparkSession, folder: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return run(spark, folder)

        QUERIES[run.__name__] = in_utc
        if sql is not None:
            ORACLES[run.__name__] = sql
        return run

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread_table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """Some columns of a table, over enough partitions for CPU-heavy work."""
    return spread(table(spark, folder, name).select(*columns))
