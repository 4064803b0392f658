"""Equi-join lookups. A side is broadcast only after its size was checked; AQE splits hot keys otherwise."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from feedloom.operators.shape import exploded

BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 << 20
LEXICON_ROWS = 20_000
_BUCKETS = 512


def fits(dim: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether a table is small; reads at most ``max_rows + 1`` of its rows."""
    width = F.sum(F.octet_length(F.to_json(F.struct("*"))))
    rows, size = dim.limit(max_rows + 1).agg(F.count(F.lit(1)), width).first()
    return rows <= max_rows and (size or 0) <= max_bytes


def lookup(
    df: DataFrame, dim: DataFrame, on: str | list[str], how: str = "left", max_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Join with a dimension: broadcast when it is small, else a shuffle join open to skew splitting."""
    return df.join(F.broadcast(dim) if fits(dim, max_rows) else dim, on, how)


def convert_currency(
    df: DataFrame, rates: DataFrame, amount: str, from_currency: str, to_currency: str = "ZAR",
    out: str = "price_in_zar",
) -> DataFrame:
    """Convert an amount; without a usable rate it stays as it is and ``converted`` is false."""
    # Of several rates for a pair the highest counts.
    wanted = rates.where((F.col("to_currency") == to_currency) & (F.col("rate") != 0)).groupBy(
        F.col("from_currency").alias(from_currency)
    ).agg(F.max("rate").alias("_rate"))
    return lookup(df, wanted, from_currency).withColumns(
        {
            out: F.col(amount) * F.coalesce("_rate", F.lit(1.0)),
            "converted": F.col("_rate").isNotNull(),
        }
    ).drop("_rate")


def geocode(df: DataFrame, gazetteer: DataFrame, name: str) -> DataFrame:
    """Add latitude and longitude by place name; unknown names get NULL for both, repeated ones the smallest pair."""
    place = F.min(F.struct("latitude", "longitude")).alias("_place")
    places = gazetteer.groupBy(F.col("name").alias(name)).agg(place).select(name, "_place.*")
    return lookup(df, places, name)


def drop_stop_rows(words: DataFrame, stop_words: DataFrame, word: str = "word") -> DataFrame:
    """Keep the rows whose word is not in the stop-word table."""
    stops = stop_words.select(F.col("word").alias(word)).distinct()
    return lookup(words, stops, word, "left_anti")


def _packed_lexicon(lexicon: DataFrame) -> Column:
    """One-row lookup structure of a small lexicon: an array of tiny maps addressed by word hash."""
    slots = lexicon.groupBy(_slot(F.col("word")).alias("slot")).agg(
        F.map_from_entries(F.collect_list(F.struct("word", "polarity"))).alias("words")
    )
    by_slot = slots.agg(F.map_from_entries(F.collect_list(F.struct("slot", "words"))).alias("slots"))
    return by_slot.select(
        F.transform(F.sequence(F.lit(0), F.lit(_BUCKETS - 1)), lambda i: F.col("slots")[i])
    ).scalar()


def _slot(word: Column) -> Column:
    return F.pmod(F.hash(word), F.lit(_BUCKETS))


def add_polarity(
    df: DataFrame, tokens: str, lexicon: DataFrame, out: str = "sentiment", max_rows: int = LEXICON_ROWS
) -> DataFrame:
    """Mean polarity of the tokens found in the lexicon, 0.0 if none is or the list is NULL.

    Of a repeated word the highest polarity counts. A lexicon of checked size is looked up
    inside each row, without any shuffle, on batches and streams alike. A larger one is joined
    with the exploded tokens, and the means come back by a digest of the token list, whose
    copies combine before the shuffle; a stream takes that join inside ``foreachBatch``, as the
    post job does, and is refused here.
    """
    lexicon = lexicon.select("word", "polarity").dropna().groupBy("word").agg(F.max("polarity").alias("polarity"))
    small = fits(lexicon, max_rows)
    if df.isStreaming and not small:
        raise ValueError(f"a lexicon of more than {max_rows} words needs foreachBatch on a stream")
    if small:
        df = df.withColumn("_lexicon", _packed_lexicon(lexicon))
        found = F.filter(
            F.transform(tokens, lambda t: F.col("_lexicon")[_slot(t)][t]), lambda p: p.isNotNull()
        )
        mean = F.aggregate(found, F.lit(0.0), lambda total, p: total + p) / F.greatest(
            F.size(found), F.lit(1)
        )
        return df.withColumn(out, F.coalesce(mean, F.lit(0.0))).drop("_lexicon")
    keyed = df.withColumn("_digest", F.sha2(F.to_json(tokens), 256))
    words = exploded(keyed, tokens, "word", "_digest")
    scores = words.join(lexicon, "word").groupBy("_digest").agg(F.avg("polarity").alias(out))
    scored = keyed.join(scores, "_digest", "left").drop("_digest")
    return scored.withColumn(out, F.coalesce(out, F.lit(0.0)))
