"""Small helpers shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Rows of one Arrow batch: whole texts may be long, so batches stay short.
BATCH_ROWS = 512


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def short_batches(spark: SparkSession) -> None:
    """Bound what a Python worker holds at once, also when texts are long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def ascii_lower(column: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(column, UPPER, LOWER)


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, mod ``folds``; a null id counts as empty text."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(folds))
