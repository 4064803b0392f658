"""Post analytics, record features and table operators over the events table."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedloom.functions import numeric, temporal
from feedloom.operators import aggregates as agg
from feedloom.operators import anomaly, quality, running
from feedloom.plans.posts import created_hour, enrich
from feedloom.queries.registry import query, table
from feedloom.queries.views import (
    AS_OF, ENRICHED, ENRICHED_COLUMNS, POSTS, as_of, posts, records, title_lexicon,
)


@query("SELECT event_type AS category, count(*) AS count FROM events GROUP BY 1")
def posts_per_category(spark, folder):
    return agg.descending(agg.count_by(posts(spark, folder), "category"), "count", "category")


@query(f"WITH {POSTS} SELECT category, CAST(sum(num_comments) AS BIGINT) AS total_num_of_comments FROM posts GROUP BY 1")
def comments_per_category(spark, folder):
    sums = agg.sum_by(posts(spark, folder), "category", "num_comments", "total_num_of_comments")
    return agg.descending(sums, "total_num_of_comments", "category")


@query(f"WITH {POSTS} SELECT category, round(sum(score), 4) AS total_score FROM posts GROUP BY 1")
def score_per_category(spark, folder):
    sums = agg.sum_by(posts(spark, folder), "category", "score", "total_score")
    return agg.descending(sums.withColumn("total_score", F.round("total_score", 4)), "total_score", "category")


@query("""
SELECT text AS title, CAST(sum(n_chars) AS BIGINT) AS num_of_upvotes
FROM documents GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10
""")
def top10_titles(spark, folder):
    titles = table(spark, folder, "documents").select(F.col("text").alias("title"), "n_chars")
    return agg.top_sums(titles, "title", "n_chars", 10, "num_of_upvotes")


def _per_part(spark, folder, part):
    parts = table(spark, folder, "orders").select(F.col("o_orderdate").alias("created"))
    if part == "hour":
        parts = posts(spark, folder).select("created")
    name = f"post_{part}"
    value = temporal.calendar_parts("created")[name].cast("bigint").alias(name)
    return agg.ascending(agg.count_by(parts.select(value), name), name)


@query("SELECT year(o_orderdate) AS post_year, count(*) AS count FROM orders GROUP BY 1")
def posts_by_year(spark, folder):
    return _per_part(spark, folder, "year")


@query("SELECT month(o_orderdate) AS post_month, count(*) AS count FROM orders GROUP BY 1")
def posts_by_month(spark, folder):
    return _per_part(spark, folder, "month")


@query("SELECT hour(ts) AS post_hour, count(*) AS count FROM events GROUP BY 1")
def posts_by_hour(spark, folder):
    return _per_part(spark, folder, "hour")


def _with_hour(spark, folder):
    return posts(spark, folder).select("category", F.hour("created").cast("bigint").alias("post_hour"))


@query("SELECT event_type AS category, hour(ts) AS post_hour, count(*) AS count FROM events GROUP BY 1, 2")
def posts_by_category_hour(spark, folder):
    return agg.count_by(_with_hour(spark, folder), "category", "post_hour")


@query("""
SELECT category, post_hour, count FROM (
  SELECT event_type AS category, hour(ts) AS post_hour, count(*) AS count,
         row_number() OVER (PARTITION BY event_type ORDER BY count(*) DESC, hour(ts)) AS rn
  FROM events GROUP BY 1, 2) WHERE rn = 1
""")
def busiest_hour_per_category(spark, folder):
    return agg.busiest_hour(_with_hour(spark, folder), "category", "post_hour")


@query("""
SELECT event_id AS id, strftime(ts, '%Y-%m-%d') AS post_date, strftime(ts, '%H:%M:%S') AS post_time,
       year(ts) AS post_year, month(ts) AS post_month, day(ts) AS post_day, hour(ts) AS post_hour
FROM events
""")
def date_time_parts(spark, folder):
    parts = temporal.calendar_parts("created")
    parts["post_date"] = parts["post_date"].cast("string")
    wide = {n: c.cast("bigint") if n[5:] in ("year", "month", "day", "hour") else c for n, c in parts.items()}
    return posts(spark, folder).select("id", *[c.alias(n) for n, c in wide.items()])


@query("""
SELECT event_id AS id, CASE WHEN hour(ts) >= 6 AND hour(ts) < 18 THEN 'day' ELSE 'night' END AS time_of_day
FROM events
""")
def time_of_day(spark, folder):
    return posts(spark, folder).select("id", temporal.time_of_day("created").alias("time_of_day"))


@query("""
SELECT event_id AS id, dayofweek(ts) + 1 AS sunday_one, isodow(ts) - 1 AS monday_zero FROM events
""")
def weekday_both_conventions(spark, folder):
    return posts(spark, folder).select(
        "id",
        temporal.weekday_sunday_one("created").cast("bigint").alias("sunday_one"),
        temporal.weekday_monday_zero("created").cast("bigint").alias("monday_zero"),
    )


@query(f"""
SELECT event_id AS id, (epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(ts)) / 60000000.0::DOUBLE AS post_age_minutes
FROM events
""")
def post_age_minutes(spark, folder):
    return posts(spark, folder).select("id", temporal.age_minutes("created", as_of()).alias("post_age_minutes"))


@query("""
SELECT event_id AS id, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS plain,
       strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS iso,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS free_iso,
       CASE WHEN event_id % 2 = 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS from_epoch,
       CAST(NULL AS VARCHAR) AS unparsed
FROM events
""")
def parse_timestamps(spark, folder):
    """Write each time in every input layout, parse it back, and render it as UTC text."""
    epoch = F.when(F.col("id") % 2 == 0, F.unix_timestamp("created")).otherwise(0)
    layouts = posts(spark, folder).select(
        "id",
        F.date_format("created", temporal.STAMP).alias("plain"),
        F.date_format("created", temporal.ISO_STAMP).alias("iso"),
        F.date_format("created", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("free_iso"),
        epoch.alias("epoch"),
    )
    return layouts.select(
        "id",
        temporal.utc_text(temporal.parse_stamp("plain")).alias("plain"),
        temporal.utc_text(temporal.parse_iso("iso")).alias("iso"),
        temporal.utc_text(temporal.parse_free_iso("free_iso")).alias("free_iso"),
        temporal.epoch_to_text("epoch").alias("from_epoch"),
        temporal.utc_text(temporal.parse_stamp("free_iso")).alias("unparsed"),
    )


@query(f"""
WITH {POSTS} SELECT id, CASE WHEN thumbnail IS NOT DISTINCT FROM 'self' THEN 'text' ELSE 'media' END AS post_type
FROM posts
""")
def post_type(spark, folder):
    return posts(spark, folder).select("id", numeric.post_type("thumbnail").alias("post_type"))


@query(f"""
WITH {POSTS} SELECT id, score * upvote_ratio + coalesce(nullif(num_comments, 3), 0) * 0.5::DOUBLE AS popularity_score
FROM posts
""")
def popularity_score(spark, folder):
    gaps = posts(spark, folder).withColumn("num_comments", F.nullif("num_comments", F.lit(3)))
    filled = quality.defaults(gaps, {"score": 0, "num_comments": 0, "upvote_ratio": 0})
    value = numeric.popularity(F.col("score"), F.col("upvote_ratio"), F.col("num_comments"))
    return filled.select("id", value.alias("popularity_score"))


@query(f"""
WITH {POSTS} SELECT id, author,
  count(*) OVER (PARTITION BY author ORDER BY created, id ROWS UNBOUNDED PRECEDING) AS author_activity_count
FROM posts
""")
def running_author_count(spark, folder):
    narrow = posts(spark, folder).select("id", "author", "created")
    counted = running.running_count(narrow, "author", ["created", "id"], [F.date_trunc("hour", "created")])
    return counted.drop("created")


def _z_sql(partition: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT id, category, '{m}' AS metric,
            round(abs(({m} - avg({m}) OVER w) / nullif(stddev_samp({m}) OVER w, 0)), 6) AS z_score
            FROM p WINDOW w AS ({partition})"""
        for m in anomaly.METRICS
    )


_P = f"WITH {POSTS}, p AS (SELECT *, score * upvote_ratio + num_comments * 0.5::DOUBLE AS popularity_score FROM posts)"


def _scored(spark, folder):
    value = numeric.popularity(F.col("score"), F.col("upvote_ratio"), F.col("num_comments"))
    return posts(spark, folder).withColumn("popularity_score", value).select("id", "category", *anomaly.METRICS)


def _flag_columns(df):
    return df.select("id", "category", "metric", F.round("z_score", 6).alias("z_score"))


@query(f"{_P} SELECT * FROM ({_z_sql('')}) WHERE z_score > 3")
def anomalies_zscore(spark, folder):
    return _flag_columns(anomaly.anomalies(_scored(spark, folder)))


@query(f"{_P} SELECT * FROM ({_z_sql('PARTITION BY category')}) WHERE z_score > 3")
def anomalies_by_category(spark, folder):
    return _flag_columns(anomaly.anomalies_by(_scored(spark, folder), "category"))


@query(f"""
WITH {POSTS} SELECT round(avg(score), 6) AS score_mean, round(avg(num_comments), 6) AS num_comments_mean,
  round(stddev_samp(score), 6) AS score_std, round(stddev_samp(num_comments), 6) AS num_comments_std FROM posts
""")
def mean_and_spread(spark, folder):
    stats = agg.mean_and_spread(posts(spark, folder), ["score", "num_comments"])
    return stats.select(*[F.round(c, 6).alias(c) for c in stats.columns])


@query(f"WITH {POSTS} SELECT id, category, score FROM posts WHERE score > 1")
def score_above_threshold(spark, folder):
    return quality.above(posts(spark, folder), "score").select("id", "category", "score")


@query("SELECT event_id AS id, event_type AS category FROM events WHERE event_type IN ('click', 'view', 'CLICK')")
def category_filter(spark, folder):
    return quality.one_of(posts(spark, folder), "category", ["click", "view", "CLICK"]).select("id", "category")


@query(f"""
WITH {POSTS} SELECT id, coalesce(thumbnail, 'unknown') AS thumbnail, coalesce(nullif(num_comments, 5), 0) AS num_comments,
  coalesce(CASE WHEN id % 3 = 0 THEN score END, 0) AS score FROM posts
""")
def fill_and_default(spark, folder):
    gaps = posts(spark, folder).select(
        "id", "thumbnail", F.nullif("num_comments", F.lit(5)).alias("num_comments"),
        F.when(F.col("id") % 3 == 0, F.col("score")).alias("score"),
    )
    return quality.defaults(gaps.fillna({"thumbnail": "unknown"}), {"num_comments": 0, "score": 0.0})


_SENTINEL_CASE = """CASE event_id % 6 WHEN 0 THEN '' WHEN 1 THEN 'nan' WHEN 2 THEN 'None' WHEN 3 THEN 'N/A'
                    WHEN 4 THEN 'NaN' ELSE event_type END"""


@query("SELECT event_id AS id, CASE WHEN event_id % 6 = 5 THEN event_type END AS flair FROM events")
def sentinels_to_null(spark, folder):
    marked = table(spark, folder, "events").select(
        F.col("event_id").alias("id"), F.expr(_SENTINEL_CASE).alias("flair")
    )
    return quality.null_sentinels(marked)


@query(f"""
WITH {POSTS} SELECT id, CAST(CAST(score AS DECIMAL(38, 9)) AS VARCHAR) AS score,
  CAST(CAST(upvote_ratio AS DECIMAL(38, 9)) AS VARCHAR) AS upvote_ratio FROM posts
""")
def decimal_metrics(spark, folder):
    done = quality.decimals(posts(spark, folder).select("id", "score", "upvote_ratio"))
    return done.select("id", F.col("score").cast("string").alias("score"), F.col("upvote_ratio").cast("string").alias("upvote_ratio"))


@query(f"""
WITH {POSTS} SELECT id, num_comments % 4 = 0 AS was_missing,
  CASE WHEN num_comments % 4 <> 0 THEN score
       ELSE round(80 + 20 * ((('0x' || substr(md5(id::VARCHAR), 1, 8))::BIGINT % 1000000) / 1000000.0::DOUBLE), 1) END AS filled
FROM posts
""")
def impute_score(spark, folder):
    """Missing scores are filled from a digest of the row's key."""
    gap = F.when(F.col("num_comments") % 4 != 0, F.col("score"))
    return posts(spark, folder).withColumn("gap", gap).select(
        "id", F.col("gap").isNull().alias("was_missing"), numeric.imputed_score("gap", "id").alias("filled")
    )


@query("""
SELECT event_id AS id, event_type AS category, value * 2 AS doubled_score, upper(event_type) AS flair FROM events
""")
def reshape_columns(spark, folder):
    renamed = table(spark, folder, "events").withColumnsRenamed({"event_id": "id", "event_type": "category"})
    derived = renamed.withColumns({"doubled_score": F.col("value") * 2, "flair": F.upper("category")})
    return derived.drop("props", "ts", "user_id", "value")


@query("SELECT DISTINCT user_id AS author, event_type AS category FROM events")
def distinct_rows(spark, folder):
    return posts(spark, folder).select("author", "category").dropDuplicates()


@query(f"""
WITH {POSTS} SELECT author, id, category, score FROM (
  SELECT *, row_number() OVER (PARTITION BY author ORDER BY created DESC, id DESC) AS rn FROM posts) WHERE rn = 1
""")
def latest_per_key(spark, folder):
    narrow = posts(spark, folder).select("author", "id", "category", "score", "created")
    return agg.latest_per_key(narrow, ["author"], ["created", "id"]).drop("created")


def _flat(df):
    return df.withColumn("title_tokens", F.array_join("title_tokens", " "))


@query(f"WITH {ENRICHED} SELECT * FROM enriched")
def enriched_posts(spark, folder):
    done = enrich(records(spark, folder), title_lexicon(spark, folder), as_of())
    return _flat(done).select(*ENRICHED_COLUMNS)


@query(f"""
WITH {ENRICHED}, counted AS (
  SELECT *, count(*) OVER (PARTITION BY author ORDER BY created_time, id ROWS UNBOUNDED PRECEDING)
    AS author_activity_count FROM enriched)
SELECT subreddit AS category, count(*) AS posts, round(avg(popularity_score), 6) AS mean_popularity,
  round(avg(sentiment), 6) AS mean_sentiment, max(author_activity_count) AS busiest_author_posts
FROM counted GROUP BY 1
""")
def enriched_summary(spark, folder):
    """Flagship: enrichment, running author count and a summary per category."""
    done = enrich(records(spark, folder), title_lexicon(spark, folder), as_of())
    narrow = done.select("id", "author", "subreddit", "created_time", "popularity_score", "sentiment")
    counted = running.running_count(narrow, "author", ["created_time", "id"], [created_hour()])
    return counted.groupBy(F.col("subreddit").alias("category")).agg(
        F.count(F.lit(1)).alias("posts"),
        F.round(F.avg("popularity_score"), 6).alias("mean_popularity"),
        F.round(F.avg("sentiment"), 6).alias("mean_sentiment"),
        F.max("author_activity_count").alias("busiest_author_posts"),
    )
