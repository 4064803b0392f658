"""Safe casts, price and traffic buckets, unit conversion."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_

from pyspark.sql import Column, functions as F

DECIMAL = "decimal(38,9)"

# Thresholds and labels.
CHEAP_BELOW, MODERATE_UP_TO = 10000, 20000
HIGH_TRAFFIC_ABOVE_MIN = 10
COMMENT_WEIGHT = 0.5
SCORE_RANGE = (80, 100)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_int(text: Column | str) -> Column:
    """Text to int by way of double, so ``12.0`` is 12; non-numbers are NULL."""
    return _col(text).try_cast("double").try_cast("int")


def safe_double(text: Column | str) -> Column:
    return _col(text).try_cast("double")


def safe_decimal(text: Column | str) -> Column:
    return _col(text).try_cast(DECIMAL)


def all_numeric(columns: Iterable[str]) -> Column:
    """True where every column holds a number; the cast test covers NULL and empty text."""
    return reduce(and_, [safe_decimal(c).isNotNull() for c in columns])


def price_bucket(price: Column | str) -> Column:
    """Cheap, Moderate (both ends included) or Expensive; NULL counts as Expensive."""
    c = _col(price)
    return (
        F.when(c < CHEAP_BELOW, "Cheap")
        .when(c.between(CHEAP_BELOW, MODERATE_UP_TO), "Moderate")
        .otherwise("Expensive")
    )


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0; NULL counts as 0."""
    return F.when(condition, 1).otherwise(0)


def is_non_stop(stops: Column | str) -> Column:
    return flag(_col(stops) == 0)


def is_high_traffic(delay_min: Column | str) -> Column:
    return flag(_col(delay_min) > HIGH_TRAFFIC_ABOVE_MIN)


def post_type(thumbnail: Column | str) -> Column:
    """``text`` for a self post, ``media`` for anything else, a missing thumbnail included."""
    return F.when(_col(thumbnail).eqNullSafe("self"), "text").otherwise("media")


def popularity(score: Column, upvote_ratio: Column, num_comments: Column) -> Column:
    return score * upvote_ratio + num_comments * F.lit(COMMENT_WEIGHT)


def km(metres: Column | str) -> Column:
    return _col(metres) / 1000


def minutes(seconds: Column | str) -> Column:
    return _col(seconds) / 60


def efficiency(travel_min: Column | str, distance_km: Column | str) -> Column:
    """Minutes per kilometre; zero distance is NULL."""
    return F.try_divide(_col(travel_min), _col(distance_km))


def imputed_score(score: Column | str, key: Column | str) -> Column:
    """Fill a missing score with a value in 80..100 that depends only on the row key."""
    low, high = SCORE_RANGE
    digest = F.md5(_col(key).cast("string").cast("binary"))
    unit = F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint"), F.lit(1000000)) / 1000000
    return F.coalesce(_col(score), F.round(low + (high - low) * unit, 1))


def nulled(c: Column | str, sentinels: Iterable[str]) -> Column:
    """Texts that stand for "missing" become NULL."""
    return F.when(~_col(c).isin(*sentinels), _col(c))
