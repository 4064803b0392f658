"""Counts, sums, top-k, word frequencies and duplicate removal.

Every aggregate combines on the map side first, so a hot key reaches its reducer as one
row per map task, and every top-k is cut per task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from feedloom.session import pinned


def count_by(df: DataFrame, *keys: str, out: str = "count") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def sum_by(df: DataFrame, key: str, value: str | Column, out: str) -> DataFrame:
    """Sum per key; a group of NULLs only stays NULL."""
    return df.groupBy(key).agg(F.sum(value).alias(out))


def descending(df: DataFrame, measure: str, *ties: str) -> DataFrame:
    return df.orderBy(F.col(measure).desc(), *ties)


def ascending(df: DataFrame, *keys: str) -> DataFrame:
    return df.orderBy(*[F.col(k).asc_nulls_first() for k in keys])


def top_n(df: DataFrame, n: int, measure: str, *ties: str) -> DataFrame:
    """The n rows with the largest measure; ties go to the smaller key."""
    return descending(df, measure, *ties).limit(n)


def sums_by_digest(df: DataFrame, key: str, value: str | Column, out: str) -> DataFrame:
    """Sum per key by the key's 128-bit digest (``_digest``), which is all that is shuffled of a long key."""
    return df.select(digest_of(key), F.col(value).alias("_value") if isinstance(value, str) else value.alias("_value")).groupBy(
        "_digest").agg(F.sum("_value").alias(out))


def digest_of(key: str) -> Column:
    """16 bytes of a key; NULL has none of them."""
    return F.coalesce(F.unhex(F.md5(F.col(key).cast("binary"))), F.expr("X''")).alias("_digest")


def top_sums(df: DataFrame, key: str, value: str | Column, n: int, out: str) -> DataFrame:
    """The n largest sums per long key; ties go to the smaller key, NULL sums come last.

    Sums are found by digest. Only winners, with all that tie with the last of them, then get their keys from ``df``.
    """
    sums = pinned(sums_by_digest(df, key, value, out), "digest-sums")
    first = sums.select(out).orderBy(F.col(out).desc_nulls_last()).limit(n)
    known, least = first.agg(F.count(out), F.min(out)).first()
    won = pinned(sums if known < n else sums.where(F.col(out) >= F.lit(least)), "digest-winners")
    keyed = df.select(digest_of(key), key).join(won, "_digest")
    found = keyed.groupBy("_digest").agg(F.first(key).alias(key), F.first(out).alias(out)).drop("_digest")
    return found.orderBy(F.col(out).desc_nulls_last(), key).limit(n)


def top_n_per_group(df: DataFrame, group: str | list[str], n: int, measure: str, *ties: str) -> DataFrame:
    """The n largest rows of each group. Each task keeps n rows per group before the shuffle."""
    keys = [group] if isinstance(group, str) else group
    w = Window.partitionBy(*keys).orderBy(F.col(measure).desc(), *ties)
    return df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= n).drop("_rank")


def busiest_hour(df: DataFrame, category: str, hour: str) -> DataFrame:
    """Hour with most rows per category; ties go to the earlier hour."""
    return top_n_per_group(count_by(df, category, hour), category, 1, "count", hour)


def word_counts(df: DataFrame, category: str, text: str, keep_empty: bool = True) -> DataFrame:
    """Frequency of space-separated words per category; an empty text counts as one empty word."""
    words = df.select(category, F.explode(F.split(text, " ")).alias("word"))
    return count_by(words if keep_empty else words.where("word != ''"), category, "word")


def top_words(df: DataFrame, category: str, text: str, n: int = 15) -> DataFrame:
    return top_n_per_group(word_counts(df, category, text), category, n, "count", "word")


def joined_text(
    df: DataFrame, category: str, key: str, text: str, rows_per_chunk: int = 256
) -> DataFrame:
    """All texts of a category joined by spaces, as ordered chunks.

    A chunk holds one block of a unique integer key, so no task ever builds more than
    ``rows_per_chunk`` texts; reading the chunks in order gives the whole text.
    """
    block = F.floor(F.col(key) / rows_per_chunk).alias("chunk")
    members = F.array_sort(F.collect_list(F.struct(key, text)))
    return df.where(F.col(text).isNotNull()).groupBy(category, block).agg(
        F.array_join(F.transform(members, lambda m: m[text]), " ").alias("joined_text")
    )


def present_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows and non-NULL values per column, as one row."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"), *[F.count(c).alias(f"{c}_present") for c in columns]
    )


def mean_and_spread(df: DataFrame, columns: list[str], *keys: str) -> DataFrame:
    """Mean and sample standard deviation per column."""
    return df.groupBy(*keys).agg(
        *[F.avg(c).alias(f"{c}_mean") for c in columns],
        *[F.stddev_samp(c).alias(f"{c}_std") for c in columns],
    )


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Last row per key. A maximum combines on the map side, so copies of one key do not pile up."""
    rest = [c for c in df.columns if c not in keys]
    last = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return last.select(*keys, *[F.col("_row")[c].alias(c) for c in rest]).select(*df.columns)
