"""Streaming jobs run to completion over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedloom import schemas
from feedloom.functions import numeric
from feedloom.operators import shape
from feedloom.operators.anomaly import METRICS
from feedloom.plans import observations
from feedloom.plans.posts import enrich
from feedloom.queries.logistics import (
    ROUTE_SQL, WEATHER_SQL, route_columns, route_documents, weather_columns, weather_documents,
)
from feedloom.queries.posts import _z_sql
from feedloom.queries.registry import query, table
from feedloom.queries.tables import KEYED_SQL, narrow
from feedloom.queries.views import (
    ENRICHED, ENRICHED_COLUMNS, POSTS, as_of, as_posts, as_records, title_lexicon,
)
from feedloom.session import new_dir
from feedloom.sources import items, readers, summaries
from feedloom.streaming import jobs
from feedloom.streaming.activity import author_counts, counted_batch
from feedloom.streaming.metrics import BatchLog, read_metrics
from feedloom.streaming.windows import window_anomalies


def _event_stream(spark, folder):
    """The events as a stream, whether the table is one file or a folder of part files."""
    path = f"{folder}/events.parquet"
    schema = table(spark, folder, "events").schema
    # A stream takes no single file as its folder, but a glob over the parent does.
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    status = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(hadoop)
    if status.isDirectory():
        return readers.read_stream(spark, "parquet", path, schema, maxFilesPerTrigger="64")
    return readers.read_stream(
        spark, "parquet", folder, schema, pathGlobFilter="events.parquet", maxFilesPerTrigger="1"
    )


def _finished(stream, name, fmt="parquet"):
    """Run an append stream to its end and read its output."""
    spark = stream.sparkSession
    path = new_dir(spark, name)
    jobs.run(stream, f"{path}/checkpoint", path=f"{path}/out", fmt=fmt, once=True)
    return spark.read.schema(stream.schema).parquet(f"{path}/out")


@query(f"WITH {ENRICHED} SELECT * FROM enriched")
def stream_enrich(spark, folder):
    messages = shape.keyed_json(as_records(_event_stream(spark, folder)))
    decoded = shape.decode(messages, schemas.POST_EVENT).drop("raw", "malformed")
    done = _finished(enrich(decoded, title_lexicon(spark, folder), as_of()), "enrich")
    return done.withColumn("title_tokens", F.array_join("title_tokens", " ")).select(*ENRICHED_COLUMNS)


def _time_slices(spark, folder, parts=4):
    """The events cut into equal spans of their time, oldest first."""
    events = table(spark, folder, "events")
    time = F.unix_micros(F.col("ts").cast("timestamp"))
    first, last = events.agg(F.min(time), F.max(time)).first()
    for k in range(parts):
        rows = events
        if k:
            rows = rows.where(time >= first + (last - first) * k // parts)
        if k + 1 < parts:
            rows = rows.where(time < first + (last - first) * (k + 1) // parts)
        yield rows


def _landing(spark, folder):
    """A folder that the slices of the events land in one after the other, and the stream over it."""
    landing = new_dir(spark, "landing")
    schema = table(spark, folder, "events").schema
    spark.createDataFrame([], schema).write.parquet(landing)
    return landing, readers.read_stream(spark, "parquet", landing, schema)


def _slice_by_slice(spark, folder, step):
    """Land each slice and run ``step`` over what is new, from the checkpoint it left."""
    landing, stream = _landing(spark, folder)
    for part in _time_slices(spark, folder):
        part.write.mode("append").parquet(landing)
        step(stream)


COUNTED_SQL = f"""
WITH {POSTS} SELECT id, author,
  count(*) OVER (PARTITION BY author ORDER BY created, id ROWS UNBOUNDED PRECEDING) AS author_activity_count
FROM posts
"""


@query(COUNTED_SQL)
def stream_author_count(spark, folder):
    """Counts kept in the state store, over four runs from one checkpoint."""
    root = new_dir(spark, "author-count")

    def step(stream):
        counted = author_counts(as_posts(stream).select("id", "author", "created"), "author", ["created", "id"])
        jobs.run(counted, f"{root}/checkpoint", path=f"{root}/out", once=True)

    _slice_by_slice(spark, folder, step)
    return spark.read.parquet(f"{root}/out").drop("created")


@query(COUNTED_SQL)
def stream_author_count_buckets(spark, folder):
    """Counts from bucketed totals and slices of bounded row count, over four batches."""
    root = new_dir(spark, "author-buckets")

    def batch(rows, batch_id):
        rows = rows.persist()
        try:
            counted = counted_batch(rows, f"{root}/totals", batch_id, order=("created", "id"), buckets=8)
            counted.write.mode("overwrite").parquet(f"{root}/out/batch_id={batch_id}")
        finally:
            rows.unpersist()

    def step(stream):
        jobs.run(as_posts(stream).select("id", "author", "created"), f"{root}/checkpoint", batch=batch, once=True)

    _slice_by_slice(spark, folder, step)
    return spark.read.parquet(f"{root}/out").select("id", "author", "author_activity_count")


@query(f"""
WITH {ENRICHED}, counted AS (
  SELECT *, count(*) OVER (PARTITION BY author ORDER BY created_time, id ROWS UNBOUNDED PRECEDING) AS author_activity_count
  FROM enriched
)
SELECT author, subreddit, id, author_activity_count, post_type, round(popularity_score, 6) AS popularity_score
FROM (SELECT *, row_number() OVER (PARTITION BY author, subreddit ORDER BY created_time DESC, author_activity_count DESC) AS nth FROM counted)
WHERE nth = 1
""")
def stream_upsert_latest(spark, folder):
    """Each author's latest post per category from the post job: most rows are overwritten by later batches."""
    root = new_dir(spark, "latest")
    handle = jobs.post_batch(title_lexicon(spark, folder), root, as_of(), latest=("author", "subreddit"), buckets=8)

    def step(stream):
        jobs.run(shape.keyed_json(as_records(stream)), f"{root}/checkpoint", batch=handle, once=True)

    _slice_by_slice(spark, folder, step)
    return spark.read.parquet(f"{root}/latest").select(
        "author", "subreddit", "id", "author_activity_count", "post_type",
        F.round(F.col("popularity_score").cast("double"), 6).alias("popularity_score"),
    )


@query(f"""
WITH {POSTS}, slices AS (
  SELECT id, CASE WHEN epoch_us(created) < cut THEN 'old' ELSE 'new' END AS age
  FROM posts, (SELECT epoch_us(min(created)) + (epoch_us(max(created)) - epoch_us(min(created))) // 2 AS cut FROM posts)
), parts AS (
  SELECT 'tail' AS start, * FROM slices WHERE age = 'new' UNION ALL SELECT 'replay', * FROM slices
  UNION ALL SELECT 'resume', * FROM slices
)
SELECT start, count(*) AS rows, sum(id)::BIGINT AS ids FROM parts GROUP BY start
""")
def stream_start_positions(spark, folder):
    """What three streams read that start when the older half is there: its end, its begin, and an interrupted one."""
    root = new_dir(spark, "starts")
    landing, stream = _landing(spark, folder)
    narrow_stream = stream.select("event_id")
    for nth, part in enumerate(_time_slices(spark, folder, 2)):
        part.write.mode("append").parquet(landing)
        # The tail starts here without a row to read, and reads what lands next.
        jobs.run(narrow_stream, f"{root}/tail-checkpoint", path=f"{root}/start=tail", once=True, start=jobs.TAIL)
        jobs.run(narrow_stream, f"{root}/resume-checkpoint", path=f"{root}/start=resume", once=True)
        if nth:
            jobs.run(narrow_stream, f"{root}/replay-checkpoint", path=f"{root}/start=replay", once=True, start=jobs.REPLAY)
    read = [
        spark.read.schema("event_id long").parquet(f"{root}/start={s}").select(F.lit(s).alias("start"), "event_id")
        for s in (jobs.TAIL, jobs.RESUME, jobs.REPLAY)
    ]
    return shape.union_all(read).groupBy("start").agg(F.count(F.lit(1)).alias("rows"), F.sum("event_id").alias("ids"))


@query(f"""
WITH {POSTS}, p AS (
  SELECT id, created, make_timestamp(epoch_us(created) // 21600000000 * 21600000000) AS window_start, max(created) OVER () AS last,
    score, num_comments, score * upvote_ratio + num_comments * 0.5::DOUBLE AS popularity_score FROM posts
), z AS (
  SELECT id, window_start, last, 'score' AS metric, abs((score - avg(score) OVER w) / nullif(stddev_samp(score) OVER w, 0)) AS z_score FROM p WINDOW w AS (PARTITION BY window_start)
  UNION ALL SELECT id, window_start, last, 'num_comments', abs((num_comments - avg(num_comments) OVER w) / nullif(stddev_samp(num_comments) OVER w, 0)) FROM p WINDOW w AS (PARTITION BY window_start)
  UNION ALL SELECT id, window_start, last, 'popularity_score', abs((popularity_score - avg(popularity_score) OVER w) / nullif(stddev_samp(popularity_score) OVER w, 0)) FROM p WINDOW w AS (PARTITION BY window_start)
)
SELECT id, metric, epoch_us(window_start) AS window_start, round(z_score, 6) AS z_score FROM z
WHERE z_score > 2.5 AND window_start + INTERVAL 6 HOUR <= last - INTERVAL 10 MINUTE
""")
def stream_window_anomalies(spark, folder):
    """Outliers of six hours of event time, from a stream of four batches; the last windows are still open."""
    root = new_dir(spark, "window-anomalies")

    def step(stream):
        value = numeric.popularity(F.col("score"), F.col("upvote_ratio"), F.col("num_comments"))
        scored = as_posts(stream).withColumn("popularity_score", value).select("id", "created", *METRICS)
        found = window_anomalies(scored, "created", "id", width="6 hours", limit=2.5, salts=4)
        log = found.select("id", "metric", F.unix_micros("window_start").alias("window_start"), F.round("z_score", 6).alias("z_score"))
        jobs.run(log, f"{root}/checkpoint", path=f"{root}/out", once=True)

    _slice_by_slice(spark, folder, step)
    return spark.read.schema("id long, metric string, window_start long, z_score double").parquet(f"{root}/out")


def _post_job(spark, folder):
    root = new_dir(spark, "posts")
    messages = shape.keyed_json(as_records(_event_stream(spark, folder)))
    handle = jobs.post_batch(title_lexicon(spark, folder), root, as_of())
    jobs.run(messages, f"{root}/checkpoint", batch=handle, once=True)
    return root


@query(f"""
WITH {ENRICHED}
SELECT id, author, count(*) OVER (PARTITION BY author ORDER BY created_time, id ROWS UNBOUNDED PRECEDING)
  AS author_activity_count, time_of_day, post_type, title_tokens, round(popularity_score, 6) AS popularity_score
FROM enriched
""")
def stream_upsert(spark, folder):
    """Messages through the whole post job; the item table holds one enriched row per id."""
    stored = items.read_items(spark, f"{_post_job(spark, folder)}/posts", ["id"])
    return stored.select(
        "id", "author", "author_activity_count", "time_of_day", "post_type",
        F.array_join("title_tokens", " ").alias("title_tokens"),
        F.round(F.col("popularity_score").cast("double"), 6).alias("popularity_score"),
    )


@query(f"""
WITH {ENRICHED}, p AS (SELECT id, subreddit AS category, score, num_comments, popularity_score FROM enriched)
SELECT id, metric, z_score FROM ({_z_sql('')}) WHERE z_score > 3
""")
def stream_anomalies(spark, folder):
    """The anomaly log of the post job; the one input file makes one batch."""
    log = spark.read.parquet(f"{_post_job(spark, folder)}/anomalies")
    return log.select("id", "metric", F.round("z_score", 6).alias("z_score"))


_BATCHES = f"""
{ENRICHED}, p AS (
  SELECT e.id, e.subreddit AS category, e.score, e.num_comments, e.popularity_score, e.num_comments % 10 = 3 AS cut_off,
    (us >= lo + span // 4)::BIGINT + (us >= lo + span * 2 // 4)::BIGINT + (us >= lo + span * 3 // 4)::BIGINT AS batch_id
  FROM enriched e JOIN (SELECT id, epoch_us(created) AS us FROM posts) t ON e.id = CAST(t.id AS VARCHAR),
    (SELECT epoch_us(min(created)) AS lo, epoch_us(max(created)) - epoch_us(min(created)) AS span FROM posts)
)"""


@query(f"""
WITH {_BATCHES}, z AS (
  SELECT batch_id, unnest([
    abs((score - avg(score) OVER w) / nullif(stddev_samp(score) OVER w, 0)),
    abs((num_comments - avg(num_comments) OVER w) / nullif(stddev_samp(num_comments) OVER w, 0)),
    abs((popularity_score - avg(popularity_score) OVER w) / nullif(stddev_samp(popularity_score) OVER w, 0))]) AS z_score
  FROM p WHERE NOT cut_off WINDOW w AS (PARTITION BY batch_id)
), flags AS (SELECT batch_id, count(*) AS flagged FROM z WHERE z_score > 3 GROUP BY 1)
SELECT batch_id, count(*) AS rows, count(*) FILTER (WHERE cut_off) AS rejected, coalesce(max(flagged), 0) AS flagged
FROM p LEFT JOIN flags USING (batch_id) GROUP BY 1
""")
def stream_batch_counts(spark, folder):
    """Rows, rejects and flags of four batches of the post job, as its writes counted them; some messages are cut off."""
    root = new_dir(spark, "batch-counts")
    handle = jobs.post_batch(title_lexicon(spark, folder), root, as_of(), buckets=8)

    def step(stream):
        rows = as_records(stream)
        cut_off = F.pmod("num_comments", F.lit(10)) == 3
        messages = rows.select(F.to_json(F.struct("*")).alias("value"), cut_off.alias("cut_off"))
        value = F.when(F.col("cut_off"), F.substring("value", 1, 20)).otherwise(F.col("value"))
        jobs.run(messages.select(value.alias("value")), f"{root}/checkpoint", batch=handle, once=True)

    _slice_by_slice(spark, folder, step)
    return read_metrics(spark, f"{root}/metrics")


@query(f"""
WITH {_BATCHES} SELECT batch_id, count(*) AS read, count(*) FILTER (WHERE NOT cut_off) AS kept,
  sum(num_comments)::BIGINT AS comments FROM p GROUP BY 1
""")
def stream_progress_log(spark, folder):
    """What a listener hears of four batches of an append stream that observes its own rows."""
    root, heard = new_dir(spark, "progress"), []
    log = BatchLog(heard.append)

    def step(stream):
        rows = as_records(stream)
        kept = F.pmod("num_comments", F.lit(10)) != 3
        seen = rows.observe("posts", F.count_if(kept).alias("kept"), F.sum("num_comments").alias("comments"))
        jobs.run(seen.where(kept).select("id"), f"{root}/checkpoint", path=f"{root}/out", once=True, log=log)

    _slice_by_slice(spark, folder, step)
    rows = [(h["batch_id"], h["read"], h["posts"]["kept"], h["posts"]["comments"]) for h in heard]
    return spark.createDataFrame(rows, "batch_id bigint, read bigint, kept bigint, comments bigint")


@query(KEYED_SQL)
def stream_republish(spark, folder):
    events = narrow(as_posts(_event_stream(spark, folder)))
    return _finished(shape.keyed_json(events), "republish")


def _landed(spark, documents, schema):
    """Documents written to a landing folder and picked up from there as a stream."""
    landing = new_dir(spark, "landing")
    documents.write.text(landing)
    return readers.observations(spark, landing, schema)


@query(WEATHER_SQL)
def stream_weather(spark, folder):
    docs = _landed(spark, weather_documents(spark, folder), schemas.WEATHER)
    return weather_columns(_finished(observations.weather_features(docs), "weather"))


@query(ROUTE_SQL)
def stream_routes(spark, folder):
    docs = _landed(spark, route_documents(spark, folder), schemas.ROUTE)
    return route_columns(_finished(observations.route_features(docs), "routes"))


ROUTE_MEASURES = ["distance_km", "travel_time_min", "traffic_delay_min", "efficiency_ratio"]


@query(f"""
WITH rows AS (SELECT day_of_week, is_high_traffic, unnest([
    {{'measure': 'distance_km', 'value': distance_km}}, {{'measure': 'travel_time_min', 'value': travel_time_min}},
    {{'measure': 'traffic_delay_min', 'value': traffic_delay_min}}, {{'measure': 'efficiency_ratio', 'value': efficiency_ratio}}
  ], recursive := true) FROM ({ROUTE_SQL})),
ranked AS (
  SELECT *, row_number() OVER g - 1 AS nth, floor(0.9 * (count(*) OVER (PARTITION BY day_of_week, is_high_traffic, measure) - 1)) AS wanted
  FROM rows WHERE value IS NOT NULL WINDOW g AS (PARTITION BY day_of_week, is_high_traffic, measure ORDER BY value))
SELECT day_of_week, is_high_traffic, measure, count(*) AS n, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std,
  min(value) AS low, max(value) AS high,
  round(max(CASE WHEN nth = wanted THEN CASE WHEN value = 0 THEN 0 ELSE pow(1.02, ceil(ln(value) / ln(1.02))) * 2 / 2.02 END END), 6) AS p90
FROM ranked GROUP BY 1, 2, 3
""")
def stream_route_summaries(spark, folder):
    """Statistics of routes per weekday and traffic, merged from five runs of a stream over documents as they land."""
    root = new_dir(spark, "route-summaries")
    keys = ["day_of_week", "is_high_traffic"]
    landing = f"{root}/landing"
    spark.createDataFrame([], "value string").write.text(landing)
    documents = route_documents(spark, folder)
    features = observations.route_features(readers.observations(spark, landing, schemas.ROUTE))
    rows = features.select(F.col("day_of_week").cast("bigint").alias("day_of_week"), "is_high_traffic", *ROUTE_MEASURES)

    def batch(part, batch_id):
        summaries.merge_summaries(part, f"{root}/table", batch_id, keys, ROUTE_MEASURES, buckets=4)

    for k in range(5):
        documents.where(F.pmod(F.xxhash64("value"), F.lit(5)) == k).write.mode("append").text(landing)
        jobs.run(rows, f"{root}/checkpoint", batch=batch, once=True)
    found = summaries.read_summaries(spark, f"{root}/table", summaries.summary_schema(rows, keys), keys, {"p90": 0.9})
    return found.select(*keys, "measure", "n", *[F.round(c, 6).alias(c) for c in ("mean", "std")], "low", "high", F.round("p90", 6).alias("p90"))
