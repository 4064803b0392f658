"""Post jobs: preparation, analytics text features and the enrichment shared by batch and stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from feedloom.functions import numeric, temporal, text
from feedloom.functions.stemmer import stem_tokens
from feedloom.operators.lookups import add_polarity
from feedloom.operators.quality import null_sentinels

def prepare_posts(raw: DataFrame) -> DataFrame:
    """Raw text posts to typed posts: missing texts to NULL, counts to int, creation time parsed."""
    return null_sentinels(raw).withColumns(
        {
            "num_comments": numeric.safe_int("num_comments"),
            "Upvotes": numeric.safe_int("Upvotes"),
            "creation_timestamp": temporal.parse_stamp("creation_date"),
        }
    )


def cleaned_posts(posts: DataFrame, body: str = "Body") -> DataFrame:
    """Add the cleaned body without stop words and the calendar parts."""
    return posts.withColumn("cleaned_body", text.strip_stop_words(text.clean_post(body))).withColumns(
        temporal.calendar_parts("creation_timestamp")
    )


def text_features(posts: DataFrame, body: str = "Body") -> DataFrame:
    """Cleaned body, tokens, stems and tokens without stop words."""
    cleaned = text.strip_punctuation(text.strip_stop_words(text.clean_post(body)))
    return (
        posts.withColumn("cleaned_body", cleaned)
        .withColumn("tokens", text.word_tokens("cleaned_body"))
        .withColumns(
            {
                "stems": stem_tokens("tokens"),
                "tokens_nostop": text.without_words(F.col("tokens"), text.BODY_STOP_WORDS),
            }
        )
    )


def is_usable(malformed: Column | None = None) -> Column:
    """Whether a record can be enriched: it parsed, and it has a creation time and a title."""
    usable = temporal.parse_stamp("created_time").isNotNull() & F.col("title").isNotNull()
    return usable if malformed is None else usable & ~malformed


def enrich(events: DataFrame, lexicon: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Per-record enrichment, everything but the author's running count.

    Works on a batch or a stream. ``as_of`` is the time ages refer to, now by default.
    """
    as_of = temporal.ingest_time(as_of)
    created = F.col("_created")
    score = F.coalesce("score", F.lit(0))
    comments = F.coalesce("num_comments", F.lit(0))
    ratio = F.coalesce("upvote_ratio", F.lit(0.0))
    base = events.withColumns(
        {
            "_created": temporal.parse_stamp("created_time"),
            "title": text.normalise_title("title"),
            "flair_text": F.lower("flair_text"),
        }
    ).withColumn("_words", text.space_tokens("title"))
    featured = base.withColumns(
        {
            "created_time": temporal.utc_text(created),
            "score": score,
            "num_comments": comments,
            "title_tokens": text.without_words(F.col("_words"), text.TITLE_STOP_WORDS),
            "post_age_minutes": temporal.age_minutes(created, as_of),
            "popularity_score": numeric.popularity(score, ratio, comments),
            "post_type": numeric.post_type("thumbnail"),
            "time_of_day": temporal.time_of_day(created),
        }
    )
    return add_polarity(featured, "_words", lexicon).drop("_created", "_words")


def created_hour() -> Column:
    """Slice of the creation order used to number an author's posts."""
    return F.date_trunc("hour", temporal.parse_stamp("created_time"))
