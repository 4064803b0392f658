"""Streams equal their batch form, also over several batches and after a restart."""

from __future__ import annotations

import datetime as dt
import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from feedloom import schemas
from feedloom.operators.shape import keyed_json
from feedloom.plans.posts import enrich
from feedloom.session import spread, spread_shuffles
from feedloom.sources import items, readers
from feedloom.sources.readers import local_rows
from feedloom.streaming import activity, jobs
from tests.conftest import plan_of

AS_OF = dt.datetime(2024, 2, 1)


def events(n, seed=1):
    """Records in time order; one author wrote most of them."""
    rng = random.Random(seed)
    start = dt.datetime(2024, 1, 1)
    return [
        (
            f"{i:05d}", "hot" if rng.random() < 0.7 else f"a{rng.randrange(5)}", f"Good post, {i}!", "s",
            (start + dt.timedelta(minutes=i * 7)).strftime("%Y-%m-%d %H:%M:%S"), rng.randrange(20), i % 9, True,
            None, 0.5, "false", False, "self" if i % 2 else None, False,
        )
        for i in range(n)
    ]


def brute_counts(rows):
    seen, out = Counter(), {}
    for r in rows:
        seen[r[1]] += 1
        out[r[0]] = seen[r[1]]
    return out


@pytest.fixture
def lexicon(spark):
    return local_rows(spark, [("good", 0.7)], schemas.LEXICON)


def land(spark, folder, number, rows, extra=()):
    """One landed file, older files first."""
    lines = [r["value"] for r in keyed_json(spark.createDataFrame(rows, schemas.POST_EVENT)).collect()]
    folder.mkdir(exist_ok=True)
    path = folder / f"part-{number:03d}.txt"
    path.write_text("\n".join([*lines, *extra]) + "\n", encoding="utf-8")
    os.utime(path, (1_700_000_000 + number, 1_700_000_000 + number))


def source(spark, folder):
    return readers.read_stream(spark, "text", str(folder), maxFilesPerTrigger="1")


def stored(spark, root):
    return {r["id"]: r for r in items.read_items(spark, f"{root}/posts", ["id"]).collect()}


def test_post_job_over_batches_and_a_restart(spark, tmp_path, lexicon):
    rows = events(300)
    landing, root = tmp_path / "in", str(tmp_path / "out")
    handle = jobs.post_batch(lexicon, root, F.lit(AS_OF))
    land(spark, landing, 0, rows[:100], ['{"id": broken', '{"id":"x","title":"no time"}'])
    land(spark, landing, 1, rows[100:200])
    jobs.run(source(spark, landing), f"{root}/checkpoint", batch=handle, once=True)
    land(spark, landing, 2, rows[200:])
    jobs.run(source(spark, landing), f"{root}/checkpoint", batch=handle, once=True)

    got = stored(spark, root)
    assert {i: r["author_activity_count"] for i, r in got.items()} == brute_counts(rows)
    batch = {r["id"]: r for r in enrich(spark.createDataFrame(rows, schemas.POST_EVENT), lexicon, F.lit(AS_OF)).collect()}
    for i, r in got.items():
        assert (r["title"], r["title_tokens"], r["post_type"]) == (batch[i]["title"], batch[i]["title_tokens"], batch[i]["post_type"])
        assert float(r["popularity_score"]) == pytest.approx(batch[i]["popularity_score"])
        assert float(r["sentiment"]) == pytest.approx(0.7)
    assert dict(items.read_items(spark, f"{root}/posts", ["id"]).dtypes)["popularity_score"] == "decimal(38,9)"
    assert spark.read.parquet(f"{root}/rejected").count() == 2
    # Nothing new arrived: a third start changes nothing.
    jobs.run(source(spark, landing), f"{root}/checkpoint", batch=handle, once=True)
    assert stored(spark, root).keys() == got.keys()


def test_retried_batch_writes_the_same(spark, tmp_path, lexicon):
    rows = events(120)
    handle = jobs.post_batch(lexicon, str(tmp_path), F.lit(AS_OF))

    def batch(part):
        return keyed_json(spark.createDataFrame(part, schemas.POST_EVENT))

    handle(batch(rows[:60]), 0)
    handle(batch(rows[60:]), 1)
    first = stored(spark, tmp_path)
    handle(batch(rows[60:]), 1)
    assert stored(spark, tmp_path) == first
    assert {i: r["author_activity_count"] for i, r in first.items()} == brute_counts(rows)


def test_state_store_count_equals_brute_force(spark, tmp_path):
    rows = events(160)
    landing = tmp_path / "in"
    land(spark, landing, 0, rows[:70])
    land(spark, landing, 1, rows[70:110])
    stream = source(spark, landing)
    parsed = stream.select(F.from_json("value", schemas.POST_EVENT).alias("r")).select("r.id", "r.author", "r.created_time")
    counted = activity.author_counts(parsed, "author", ["created_time", "id"])
    out = str(tmp_path / "out")
    jobs.run(counted, f"{out}/c", path=f"{out}/data", once=True)
    land(spark, landing, 2, rows[110:])
    jobs.run(counted, f"{out}/c", path=f"{out}/data", once=True)
    got = {r["id"]: r["author_activity_count"] for r in spark.read.parquet(f"{out}/data").collect()}
    assert got == brute_counts(rows)


def test_state_holds_groups_of_authors(spark, tmp_path):
    rows = [(i, None if i % 31 == 30 else i % 31, i // 62) for i in range(310)]
    landing, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "id long, author long, at long"
    spark.createDataFrame([], schema).write.parquet(landing)
    stream = spark.readStream.schema(schema).parquet(landing)
    counted = activity.author_counts(stream, "author", ["at", "id"], groups=5)
    for part in (rows[:150], rows[150:]):
        spark.createDataFrame(part, schema).write.mode("append").parquet(landing)
        query = jobs.run(counted, f"{out}/c", path=f"{out}/data", once=True)
        assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 6
    got = {tuple(r) for r in spark.read.parquet(f"{out}/data").collect()}
    assert got == {(i, a, at, i // 31 + 1) for i, a, at in rows}


def test_timed_run_stops_at_its_limit(spark, tmp_path):
    land(spark, tmp_path / "in", 0, events(5))
    out = str(tmp_path / "out")
    query = jobs.run(source(spark, tmp_path / "in"), f"{out}/c", path=f"{out}/data", every="200 milliseconds", limit=6)
    assert not query.isActive and spark.read.parquet(f"{out}/data").count() == 5
    assert (jobs.CONSUMER_LIMIT, jobs.PRODUCER_LIMIT, jobs.POLL) == (3300, 3600, "1 second")


def test_anomaly_log_is_per_batch(spark, tmp_path, lexicon):
    rows = events(40)
    spike = list(rows[0])
    spike[0], spike[5] = "99999", 10_000
    handle = jobs.post_batch(lexicon, str(tmp_path), F.lit(AS_OF))
    handle(keyed_json(spark.createDataFrame(rows, schemas.POST_EVENT)), 0)
    handle(keyed_json(spark.createDataFrame([*rows[1:], tuple(spike)], schemas.POST_EVENT)), 1)
    log = spark.read.parquet(f"{tmp_path}/anomalies").select("id", "metric").collect()
    assert ("99999", "score") in {tuple(r) for r in log} and {r["id"] for r in log} == {"99999"}


def test_post_job_bounds_the_rows_of_a_cached_part(spark, tmp_path, lexicon, monkeypatch):
    seen = []

    def enriched(rows, *rest):
        done = enrich(rows, *rest)
        seen.extend(r[0] for r in done.groupBy(F.spark_partition_id()).count().select("count").collect())
        return done

    monkeypatch.setattr(jobs, "spread", lambda df: spread(df, rows=10))
    monkeypatch.setattr(jobs, "enrich", enriched)
    rows = events(160)
    messages = keyed_json(spark.createDataFrame(rows, schemas.POST_EVENT)).repartition(8)
    jobs.post_batch(lexicon, str(tmp_path), F.lit(AS_OF))(messages, 0)
    assert sum(seen) == 160 and max(seen) <= 15
    assert {i: r["author_activity_count"] for i, r in stored(spark, tmp_path).items()} == brute_counts(rows)


def test_post_job_bounds_the_rows_of_a_part_behind_its_shuffles(spark, tmp_path, lexicon, monkeypatch):
    sizes = []

    def recorded(batch, *rest):
        sizes.extend(r[0] for r in batch.groupBy(F.spark_partition_id()).count().select("count").collect())
        items.upsert(batch, *rest)

    monkeypatch.setattr(jobs, "spread_shuffles", lambda session, total: spread_shuffles(session, total, rows=10), raising=False)
    monkeypatch.setattr(jobs, "upsert", recorded)
    rows = [(r[0], f"a{i % 80}", *r[2:]) for i, r in enumerate(events(320))]
    land(spark, tmp_path / "in", 0, rows)
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "4"}
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, setting in settings.items():
            spark.conf.set(name, setting)
        root = str(tmp_path / "out")
        handle = jobs.post_batch(lexicon, root, F.lit(AS_OF))
        jobs.run(source(spark, tmp_path / "in"), f"{root}/checkpoint", batch=handle, once=True)
        # Outside a stream the session is the caller's own, and gets its setting back.
        handle(keyed_json(spark.createDataFrame(rows, schemas.POST_EVENT)), 1)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "4"
    finally:
        for name, setting in before.items():
            spark.conf.set(name, setting)
    assert sum(sizes) == 640 and max(sizes) <= 40
    assert {i: r["author_activity_count"] for i, r in stored(spark, root).items()} == {i: n + 4 for i, n in brute_counts(rows).items()}


def test_one_batch_of_an_item_table_is_read_without_a_shuffle(spark, tmp_path):
    table, rows = str(tmp_path), [(f"{i % 50:02d}", i) for i in range(200)]
    items.upsert(spark.createDataFrame(rows[:100], "id string, n long"), table, 0, ["id"], ["n"])
    one = items.read_items(spark, table, ["id"])
    assert one.columns == ["id", "n"] and {tuple(r) for r in one.collect()} == {(f"{i % 50:02d}", i) for i in range(50, 100)}
    assert "Exchange" not in plan_of(one)
    items.upsert(spark.createDataFrame(rows[125:], "id string, n long"), table, 1, ["id"], ["n"])
    assert {tuple(r) for r in items.read_items(spark, table, ["id"]).collect()} == {(f"{i % 50:02d}", i) for i in range(150, 200)}
