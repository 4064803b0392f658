"""Filters, defaults, casts and sentinels over whole frames."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from feedloom.functions import numeric
from feedloom.schemas import PUBLISHED_COLUMNS, RECORD_METRICS, SENTINELS


def null_sentinels(df: DataFrame, *columns: str, sentinels: tuple[str, ...] = SENTINELS) -> DataFrame:
    """Texts that mean "missing" become NULL, in the named or in all string columns."""
    wanted = columns or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: numeric.nulled(F.col(f"`{c}`"), sentinels) for c in wanted})


def valid_records(df: DataFrame, columns: tuple[str, ...] = PUBLISHED_COLUMNS) -> DataFrame:
    """Records whose seven metrics are all numbers, with those metrics as decimals."""
    typed = [
        numeric.safe_decimal(c).alias(c) if c in RECORD_METRICS else F.col(c) for c in columns
    ]
    return df.where(numeric.all_numeric(RECORD_METRICS)).select(*typed)


def decimals(df: DataFrame) -> DataFrame:
    """Every floating-point column as a decimal; a value too large for it becomes NULL."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.col(c).try_cast(numeric.DECIMAL) for c in floats}) if floats else df


def fits_decimals(df: DataFrame) -> Column:
    """Whether every floating-point value of a row that is there has a decimal: it is a number and not too large."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    good = [F.col(c).isNull() | F.col(c).try_cast(numeric.DECIMAL).isNotNull() for c in floats]
    return reduce(Column.__and__, good, F.lit(True))


def defaults(df: DataFrame, values: dict[str, object]) -> DataFrame:
    """Missing values of the named columns take a default."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in values.items()})


def above(df: DataFrame, column: str, threshold: float = 1) -> DataFrame:
    return df.where(F.col(column) > threshold)


def one_of(df: DataFrame, column: str, values: list) -> DataFrame:
    """Rows of several categories in one pass; text compares case-sensitively."""
    return df.where(F.col(column).isin(*values))


def contains_ci(df: DataFrame, column: str, part: str) -> DataFrame:
    """Case-insensitive substring filter; NULL does not match."""
    return df.where(F.contains(F.lower(column), F.lit(part.lower())))


def all_present(df: DataFrame, *columns: str) -> DataFrame:
    return df.dropna(subset=list(columns))
