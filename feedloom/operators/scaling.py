"""Min-max scaling, category indices and the fitted feature stages."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import MinMaxScaler, VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from feedloom.operators.aggregates import count_by
from feedloom.operators.lookups import lookup
from feedloom.operators.running import SLICE_ROWS, numbered, sliced
from feedloom.session import pinned


def not_nan(column: str) -> Column:
    """The column without NaN, which would stand for the maximum."""
    return F.when(~F.isnan(F.col(column).cast("double")), F.col(column))


def min_max(df: DataFrame, column: str) -> DataFrame:
    known = not_nan(column)
    return df.agg(F.min(known).alias("min"), F.max(known).alias("max"))


def scale(df: DataFrame, column: str, out: str) -> DataFrame:
    """Scale to [0, 1]; a constant column gives 0.5. The bounds are one row, read as a scalar subquery."""
    bounds = min_max(df, column).select(F.struct("min", "max")).scalar()
    low, high = F.col("_bounds.min"), F.col("_bounds.max")
    scaled = F.when(low == high, 0.5).otherwise(F.try_divide(F.col(column) - low, high - low))
    return df.withColumn("_bounds", bounds).withColumn(
        out, F.when(not_nan(column).isNotNull(), scaled)
    ).drop("_bounds")


def category_index(df: DataFrame, column: str, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Labels numbered from 0 by falling frequency, ties alphabetical: (label, count, index).

    The labels are cut into ranges of this order; each range numbers its own and adds the rows of earlier ones.
    """
    counted = count_by(df.where(F.col(column).isNotNull()), column).withColumn("_down", -F.col("count"))
    ranges = sliced(pinned(counted, "labels"), "_down", [column], slice_rows)
    placed = numbered(ranges, ["_down", column], [F.col("_slice")], "_place")
    return placed.select(column, "count", (F.col("_place") - 1).cast("bigint").alias("index"))


def with_index(df: DataFrame, column: str, out: str, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Add the category index as a double; NULL takes the number after the last label."""
    labels = pinned(category_index(df, column, slice_rows), "label-index")
    known = labels.select(column, F.col("index").cast("double").alias(out))
    unknown = labels.agg(F.count(F.lit(1)).cast("double")).scalar()
    return lookup(df, known, column).withColumn("_unknown", unknown).withColumn(
        out, F.coalesce(out, "_unknown")
    ).select(*df.columns, out)


def fit_features(df: DataFrame, category: str, price: str, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Category index, one-element price vector and scaled price.

    The index is joined, not fitted: a fitted indexer would hold all labels on the driver.
    """
    stages = [
        VectorAssembler(inputCols=[price], outputCol="price_features", handleInvalid="keep"),
        MinMaxScaler(inputCol="price_features", outputCol="scaled_price"),
    ]
    return Pipeline(stages=stages).fit(df).transform(with_index(df, category, "carrier_index", slice_rows))
