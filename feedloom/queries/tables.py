"""Readers and writers: each query writes a driver table in one form and reads it back."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedloom import schemas
from feedloom.operators import shape
from feedloom.operators.quality import valid_records
from feedloom.plans.logistics import offer_durations, split_logistics
from feedloom.plans.posts import prepare_posts
from feedloom.queries.registry import query, table
from feedloom.queries.views import POSTS, flights, posts, records
from feedloom.session import new_dir
from feedloom.sources import items, readers, writers

_MESSAGE = """'{"id":' || id || ',"author":' || author || ',"category":"' || category || '","score":' || score
  || ',"thumbnail":' || CASE WHEN thumbnail IS NULL THEN 'null' ELSE '"' || thumbnail || '"' END || '}'"""

KEYED_SQL = f"WITH {POSTS} SELECT CAST(id AS VARCHAR) AS key, {_MESSAGE} AS value FROM posts"


def narrow(df):
    return df.select("id", "author", "category", "score", "thumbnail")


@query(KEYED_SQL)
def keyed_json(spark, folder):
    return shape.keyed_json(narrow(posts(spark, folder)))


@query(f"WITH {POSTS} SELECT {_MESSAGE} AS value FROM posts")
def published_messages(spark, folder):
    path = new_dir(spark, "messages")
    writers.publish(narrow(posts(spark, folder)), "text", path)
    return readers.read_any(spark, "text", path)


@query(f"""
WITH {POSTS} SELECT CASE WHEN id % 10 <> 0 THEN CAST(id AS VARCHAR) END AS id, id % 10 = 0 AS malformed,
  CASE WHEN id % 10 <> 0 THEN thumbnail END AS thumbnail FROM posts
""")
def json_decode(spark, folder):
    """Every tenth message is broken and must come back as a malformed row of NULLs."""
    messages = shape.keyed_json(records(spark, folder))
    broken = F.when(F.col("key").cast("bigint") % 10 == 0, F.concat(F.lit("{"), "value")).otherwise(F.col("value"))
    decoded = shape.decode(messages.withColumn("value", broken), schemas.POST_EVENT)
    return decoded.select("id", "malformed", "thumbnail")


@query("SELECT doc_id, text, lang FROM documents")
def csv_round_trip(spark, folder):
    """Texts with line breaks and quotes survive a CSV export."""
    path = new_dir(spark, "csv")
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    writers.write_csv(docs, path)
    return readers.read_csv(spark, path, docs.schema, multi_line=True)


@query(f"""
WITH {POSTS} SELECT CAST(id AS VARCHAR) AS id, category AS title, coalesce(num_comments, 0) AS num_comments,
  NULL AS body, strftime(created, '%Y-%m-%d %H:%M:%S') AS created FROM posts
UNION ALL SELECT CAST(doc_id AS VARCHAR), NULL, -1, text, NULL FROM documents
""")
def feeds_union(spark, folder):
    """Two CSV feeds with different columns, one holding names that differ in case only."""
    first, second = new_dir(spark, "feed"), new_dir(spark, "feed")
    kept = posts(spark, folder).select(
        F.col("id").alias("Unnamed: 0"), F.col("id").alias("ID"), F.col("category").alias("Title"),
        F.concat("num_comments", F.lit(".0")).alias("num_comments"),
        F.date_format("created", "yyyy-MM-dd HH:mm:ss").alias("creation_date"),
    )
    writers.write_csv(kept, first)
    texts = table(spark, folder, "documents")
    writers.write_csv(texts.select(F.col("text").alias("Body"), F.col("doc_id").alias("ID")), second)
    feeds = prepare_posts(readers.read_feeds(spark, [first, second], schemas.POSTS_RAW))
    both = feeds.select(
        F.col("ID").alias("id"), F.col("Title").alias("title"), F.col("num_comments"),
        F.col("Body").alias("body"), F.date_format("creation_timestamp", "yyyy-MM-dd HH:mm:ss").alias("created"),
    )
    return both.withColumn("num_comments", F.coalesce("num_comments", F.lit(-1)))


@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def managed_table(spark, folder):
    path = new_dir(spark, "table")
    customers = table(spark, folder, "customer").select("c_custkey", "c_name", "c_acctbal")
    writers.save_table(customers, "feedloom_customers", path)
    return readers.read_table(spark, "feedloom_customers")


@query(f"""
WITH {POSTS} SELECT CAST(id AS VARCHAR) AS title, CAST(floor(score) AS BIGINT) AS score FROM posts
ORDER BY score DESC, id LIMIT 100
""")
def batch_snapshot(spark, folder):
    listing = posts(spark, folder).select(
        F.col("id").cast("string").alias("title"), F.floor("score").alias("score"), "id"
    )
    path = writers.snapshot(
        listing, new_dir(spark, "snapshots"), "2024-02-01_00-00-00", ["title", "score", "id"], [F.desc("score"), "id"]
    )
    return readers.read_csv(spark, path, listing.schema).drop("id")


@query("SELECT doc_id, lang FROM documents UNION ALL SELECT page_id, 'page' FROM pages")
def appended_csv(spark, folder):
    path = new_dir(spark, "append")
    docs = table(spark, folder, "documents").select("doc_id", "lang")
    writers.append_csv(docs, path)
    writers.append_csv(table(spark, folder, "pages").select(F.col("page_id").alias("doc_id"), F.lit("page").alias("lang")), path)
    return readers.read_csv(spark, path, docs.schema)


@query("""
SELECT doc_id AS id, CAST(CAST(n_chars AS DECIMAL(38, 9)) AS VARCHAR) AS score FROM documents WHERE lang <> 'fr'
""")
def publish_latest(spark, folder):
    """Valid records replace an earlier "latest" result."""
    path = new_dir(spark, "latest")
    score = F.when(F.col("lang") == "fr", F.lit("n/a")).otherwise(F.col("n_chars").cast("string"))
    stored = table(spark, folder, "documents").select(
        F.col("doc_id").alias("id"), *[score.alias(m) for m in schemas.RECORD_METRICS]
    )
    valid = valid_records(stored, ("id", *schemas.RECORD_METRICS)).select("id", "score")
    writers.publish_latest(stored.select("id", "score"), path)
    status = writers.publish_latest(valid, path)
    if status["statusCode"] != 200:
        raise RuntimeError(str(status["body"]))
    return readers.read_csv(spark, path, stored.select("id", "score").schema)


@query("""
SELECT 'before' AS read, lang, count(*) AS rows, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents WHERE lang <> 'fr' GROUP BY lang
UNION ALL SELECT 'after', lang, count(*), CAST(sum(n_chars) AS BIGINT) FROM documents GROUP BY lang
""")
def published_versions(spark, folder):
    """What a reader gets who resolved a version before the next ones were published, and one who resolves it after."""
    path = new_dir(spark, "versions")
    docs = table(spark, folder, "documents").select("doc_id", "lang", "n_chars")
    resolved = []
    for rows in (docs.where("lang <> 'fr'"), docs.where("lang = 'de'"), docs):
        status = writers.publish_version(rows, path)
        if status["statusCode"] != 200:
            raise RuntimeError(str(status["body"]))
        resolved.append(writers.latest_version(spark, path))
    read = [
        readers.read_csv(spark, place, docs.schema).select(F.lit(name).alias("read"), "lang", "n_chars")
        for name, place in (("before", resolved[0]), ("after", resolved[-1]))
    ]
    return shape.union_all(read).groupBy("read", "lang").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("n_chars").cast("bigint").alias("chars"))


@query("SELECT o_orderpriority AS carrier, count(*) AS count, round(sum(l_extendedprice), 2) AS price FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1")
def feature_files(spark, folder):
    path = new_dir(spark, "features")
    writers.write_features(flights(spark, folder).select("carrier", "price", "num_stops"), path, "carrier")
    stored = readers.read_any(spark, "parquet", path)
    return stored.groupBy("carrier").agg(F.count(F.lit(1)).alias("count"), F.round(F.sum("price"), 2).alias("price"))


@query(f"""
WITH {POSTS} SELECT author, id, category, score FROM (
  SELECT *, row_number() OVER (PARTITION BY author ORDER BY created DESC, id DESC) AS rn FROM posts) WHERE rn = 1
""")
def item_table(spark, folder):
    """Three upserted batches, one of them repeated, with a compaction between."""
    root = new_dir(spark, "items")
    rows = posts(spark, folder).select("author", "id", "category", "score", "created")
    day = F.dayofmonth("created")
    thirds = [day <= 10, day.between(11, 20), day > 20]
    for batch_id, part in enumerate(thirds):
        items.upsert(rows.where(part), root, batch_id, ["author"], ["created", "id"])
        if batch_id == 1:
            items.compact(spark, root, 0, ["author"])
            items.upsert(rows.where(part), root, batch_id, ["author"], ["created", "id"])
    return items.read_items(spark, root, ["author"]).drop("created")


@query("""
SELECT 'offers' AS part, count(*) AS rows, round(sum(o_totalprice), 2) AS total,
       CAST(sum(61) AS BIGINT) AS stated_minutes FROM orders
UNION ALL SELECT 'weather', count(*), round(sum(value), 2), 0 FROM events
UNION ALL SELECT 'routes', count(*), CAST(sum(s_suppkey) AS DOUBLE), 0 FROM supplier
""")
def logistics_split(spark, folder):
    """Orders, events and suppliers written as one sparse logistics file, read back and split."""
    offers = table(spark, folder, "orders").select(
        F.col("o_totalprice").alias("Price"), F.lit("PT1H1M").alias("Duration"), F.lit("KL").alias("Airline"),
        F.col("o_orderdate").cast("timestamp").alias("Departure Time"),
    )
    weather = table(spark, folder, "events").select(
        F.col("ts").cast("timestamp").alias("Time"), F.col("value").alias("Temperature (C)")
    )
    routes = table(spark, folder, "supplier").select(
        F.lit("N/A").alias("Traffic Level"), F.col("s_suppkey").cast("double").alias("Distance (meters)")
    )
    empty = readers.local_rows(spark, [], schemas.LOGISTICS_WIDE)
    path = new_dir(spark, "logistics")
    writers.write_csv(shape.union_all([empty, offers, weather, routes]), path)
    parts = split_logistics(readers.read_csv(spark, path, schemas.LOGISTICS_WIDE))
    stated = F.sum("stated_minutes").alias("stated_minutes")

    def summary(name, df, column, *more):
        return df.agg(F.count(F.lit(1)).alias("rows"), F.round(F.sum(column), 2).alias("total"), *more).select(
            F.lit(name).alias("part"), "*"
        )

    rows = shape.union_all([
        summary("offers", offer_durations(parts["offers"]), "Price", stated),
        summary("weather", parts["weather"], "`Temperature (C)`"),
        summary("routes", parts["routes"].where("`Traffic Level` IS NULL"), "`Distance (meters)`"),
    ])
    return rows.withColumn("stated_minutes", F.coalesce("stated_minutes", F.lit(0)))
