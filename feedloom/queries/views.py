"""Domain views of the driver tables, as frames and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from feedloom import schemas
from feedloom.queries.registry import spread_table, table
from feedloom.sources.readers import local_rows

AS_OF = "2024-02-01 00:00:00"


def as_of():
    return F.lit(AS_OF).cast("timestamp")


def as_posts(events: DataFrame) -> DataFrame:
    """Events, batch or stream, as posts."""
    k = F.from_json("props", "k int")["k"]
    return events.select(
        F.col("event_id").alias("id"),
        F.col("user_id").alias("author"),
        F.col("event_type").alias("category"),
        F.col("ts").cast("timestamp").alias("created"),
        F.col("value").alias("score"),
        k.alias("num_comments"),
        (k / 100).alias("upvote_ratio"),
        F.when(k % 7 == 0, None).when(k % 2 == 0, "self").otherwise("https://img.example/t.png").alias("thumbnail"),
    )


def posts(spark: SparkSession, folder: str) -> DataFrame:
    return as_posts(table(spark, folder, "events"))


POSTS = """
posts AS (
  SELECT event_id AS id, user_id AS author, event_type AS category, ts AS created, value AS score,
         k AS num_comments, k / 100.0::DOUBLE AS upvote_ratio,
         CASE WHEN k % 7 = 0 THEN NULL WHEN k % 2 = 0 THEN 'self'
              ELSE 'https://img.example/t.png' END AS thumbnail
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
)"""


def as_records(events: DataFrame) -> DataFrame:
    """Events, batch or stream, as stream records."""
    return as_posts(events).select(
        F.col("id").cast("string").alias("id"),
        F.concat(F.lit("u"), "author").alias("author"),
        F.concat("category", F.lit(" isn't the BEST page, No. "), "num_comments", F.lit("! Café_"), "author").alias("title"),
        F.col("category").alias("subreddit"),
        F.date_format("created", "yyyy-MM-dd HH:mm:ss").alias("created_time"),
        F.floor("score").alias("score"),
        F.col("num_comments").cast("bigint").alias("num_comments"),
        F.col("thumbnail").eqNullSafe("self").alias("is_self_post"),
        F.upper("category").alias("flair_text"),
        "upvote_ratio",
        F.lit("false").alias("edited"),
        F.lit(False).alias("over_18"),
        "thumbnail",
        F.lit(False).alias("stickied"),
    )


def records(spark: SparkSession, folder: str) -> DataFrame:
    return as_records(spread_table(spark, folder, "events", "event_id", "user_id", "event_type", "ts", "value", "props"))


def title_lexicon(spark: SparkSession, folder: str) -> DataFrame:
    """Polarities of the words in record titles, from the event types plus one adjective."""
    kinds = table(spark, folder, "events").select(F.col("event_type").alias("word")).distinct()
    scored = kinds.withColumn("polarity", (F.length("word") % 5 - 2) / 2)
    return scored.unionByName(spark.sql("SELECT 'best' AS word, 1.0D AS polarity"))


# The enriched record; the counted form adds the author's running count.
ENRICHED = f"""
{POSTS},
enriched AS (
  SELECT CAST(id AS VARCHAR) AS id, 'u' || author AS author,
         category || ' isnt the best page no ' || num_comments || ' café_' || author AS title,
         category AS subreddit, strftime(created, '%Y-%m-%d %H:%M:%S') AS created_time,
         CAST(floor(score) AS BIGINT) AS score, CAST(num_comments AS BIGINT) AS num_comments,
         category AS flair_text,
         category || ' isnt best page ' || num_comments || ' café_' || author AS title_tokens,
         (1.0::DOUBLE + (length(category) % 5 - 2) / 2.0::DOUBLE) / 2 AS sentiment,
         (epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(date_trunc('second', created))) / 60000000.0::DOUBLE
           AS post_age_minutes,
         CAST(floor(score) AS BIGINT) * upvote_ratio + num_comments * 0.5::DOUBLE AS popularity_score,
         CASE WHEN thumbnail IS NOT DISTINCT FROM 'self' THEN 'text' ELSE 'media' END AS post_type,
         CASE WHEN hour(created) >= 6 AND hour(created) < 18 THEN 'day' ELSE 'night' END AS time_of_day
  FROM posts
)"""

ENRICHED_COLUMNS = (
    "id", "author", "title", "subreddit", "created_time", "score", "num_comments", "flair_text",
    "title_tokens", "sentiment", "post_age_minutes", "popularity_score", "post_type", "time_of_day",
)


def flights(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines as flights."""
    lines = table(spark, folder, "lineitem")
    orders = table(spark, folder, "orders")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("l_extendedprice").alias("price"),
        F.col("o_orderdate").alias("departure"),
        F.col("l_shipdate").alias("arrival"),
        F.col("o_orderpriority").alias("carrier"),
        (F.col("l_linenumber") - 1).alias("num_stops"),
        F.col("o_orderstatus").alias("currency"),
        F.col("o_orderkey").alias("order_id"),
    )


FLIGHTS = """
flights AS (
  SELECT l_extendedprice AS price, o_orderdate AS departure, l_shipdate AS arrival,
         o_orderpriority AS carrier, l_linenumber - 1 AS num_stops, o_orderstatus AS currency,
         o_orderkey AS order_id
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)"""


def routes(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines as route observations."""
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("route_id"),
        F.col("l_quantity").alias("distance_km"),
        (F.col("l_extendedprice") / 1000).alias("travel_time_min"),
        (F.col("l_discount") * 200).alias("traffic_delay_min"),
        F.col("l_shipdate").cast("timestamp").alias("timestamp"),
    )


ROUTES = """
routes AS (
  SELECT l_orderkey AS route_id, l_quantity AS distance_km, l_extendedprice / 1000 AS travel_time_min,
         l_discount * 200 AS traffic_delay_min, l_shipdate AS "timestamp"
  FROM lineitem
)"""

RATES = (("P", "ZAR", 18.2), ("F", "ZAR", 19.75), ("F", "USD", 1.1))


def rates(spark: SparkSession) -> DataFrame:
    """Exchange rates; currency O has none."""
    return local_rows(spark, list(RATES), schemas.RATES)


RATES_SQL = "rates(from_currency, rate) AS (VALUES ('P', 18.2::DOUBLE), ('F', 19.75::DOUBLE))"



