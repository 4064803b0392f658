"""Bucketed tables and running counts over batches: pruning, retries, expiry, hot and NULL keys."""

from __future__ import annotations

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from feedloom.operators.running import running_count, sliced
from feedloom.sources import buckets
from feedloom.streaming import activity
from tests.conftest import plan_of

START = dt.datetime(2024, 1, 1)
SCHEMA = "id string, author string, created_time timestamp, score long"


def rows_of(n, first=0, seed=3, authors=9, hot=0.9, step=0.01):
    """Rows in time order, most by one author and some by nobody."""
    rng = random.Random(seed + first)
    names = [None, *(f"a{k}" for k in range(authors))]
    return [
        (f"{first + i:06d}", "hot" if rng.random() < hot else rng.choice(names), START + dt.timedelta(seconds=step * (first + i)), rng.randrange(100))
        for i in range(n)
    ]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def brute(rows):
    seen, out = Counter(), {}
    for r in rows:
        seen[r[1]] += 1
        out[r[0]] = seen[r[1]]
    return out


def test_counts_over_batches_of_one_minute_with_a_hot_and_a_null_author(spark, tmp_path):
    rows, got = rows_of(4000), {}
    for n in range(4):
        batch = frame(spark, rows[n * 1000:(n + 1) * 1000])
        done = activity.counted_batch(batch, str(tmp_path / "totals"), n, slice_rows=100, buckets=8)
        got |= {r["id"]: r["author_activity_count"] for r in done.collect()}
    assert got == brute(rows)
    assert rows[-1][2] - rows[0][2] < dt.timedelta(minutes=1) and None in {r[1] for r in rows}


def test_hot_author_is_cut_by_rows(spark):
    batch = frame(spark, rows_of(5000, hot=0.95))
    cut = sliced(batch, "author", ["created_time", "id"], 250)
    sizes = [r["count"] for r in cut.where("author = 'hot'").groupBy("_slice").count().collect()]
    assert len(sizes) >= 15 and max(sizes) <= 3 * 250
    counted = running_count(cut, "author", ["created_time", "id"], [F.col("_slice")])
    assert {r["id"]: r["author_activity_count"] for r in counted.collect()} == brute(rows_of(5000, hot=0.95))


def test_retried_batch_counts_from_the_same_totals(spark, tmp_path):
    rows, totals = rows_of(300), str(tmp_path / "totals")
    first = frame(spark, rows[:100])
    activity.counted_batch(first, totals, 0, buckets=4)
    for _ in range(3):
        done = activity.counted_batch(frame(spark, rows[100:200]), totals, 1, buckets=4)
        assert {r["id"]: r["author_activity_count"] for r in done.collect()} == {k: v for k, v in brute(rows[:200]).items() if k >= rows[100][0]}
    done = activity.counted_batch(frame(spark, rows[200:]), totals, 2, buckets=4)
    assert {r["id"]: r["author_activity_count"] for r in done.collect()} == {k: v for k, v in brute(rows).items() if k >= rows[200][0]}


def test_expired_authors_count_anew(spark, tmp_path):
    totals = str(tmp_path / "totals")
    old = [("1", "gone", START, 1), ("2", "back", START, 1), ("3", "here", START, 1)]
    new = [("4", "here", START + dt.timedelta(days=3), 1)]
    late = [("5", "back", START + dt.timedelta(days=4), 1), ("6", "here", START + dt.timedelta(days=4), 1)]
    expired = F.col("created_time") < F.lit(START + dt.timedelta(days=2))
    activity.counted_batch(frame(spark, old), totals, 0, buckets=1)
    activity.counted_batch(frame(spark, new), totals, 1, buckets=1, expired=F.lit(False))
    for _ in range(2):
        done = activity.counted_batch(frame(spark, late), totals, 2, buckets=1, expired=expired)
        assert {r["id"]: r["author_activity_count"] for r in done.collect()} == {"5": 1, "6": 3}
    schema = buckets.totals_schema(frame(spark, old), ["author"], "created_time")
    assert {r["author"] for r in buckets.read_buckets(spark, totals, schema).collect()} == {"back", "here"}


@pytest.mark.parametrize("size", [400, 4000])
def test_a_batch_reads_and_replaces_its_own_buckets_only(spark, tmp_path, size):
    """As many buckets as the table needs: what a batch of two keys reads stays, while the table grows tenfold."""
    table, number = str(tmp_path / "items"), size // 20
    base = spark.range(size).select(F.format_string("k%06d", "id").alias("id"), F.lit(0).alias("v"))
    buckets.merge_items(base, table, 0, ["id"], ["v"], number)
    before = {f.name: sorted(x.name for x in f.glob("*.parquet")) for f in (tmp_path / "items").glob("bucket=*")}
    batch = spark.createDataFrame([("k000001", 1), ("k000002", 2), ("k000001", 3)], "id string, v int")
    numbers = buckets.touched(batch, ["id"], number)
    read = buckets.read_buckets(spark, table, batch.withColumn("batch_id", F.lit(1).cast("bigint")).schema, numbers)
    assert "PartitionFilters" in plan_of(read) and "bucket" in plan_of(read).split("PartitionFilters")[1][:60]
    assert read.select(F.input_file_name()).distinct().count() == len(numbers) <= 2 and read.count() <= 120
    for _ in range(2):
        buckets.merge_items(batch, table, 1, ["id"], ["v"], number)
    after = {f.name: sorted(x.name for x in f.glob("*.parquet")) for f in (tmp_path / "items").glob("bucket=*")}
    assert {k for k in after if after[k] != before.get(k)} == {f"bucket={n}" for n in numbers}
    stored = {r["id"]: r["v"] for r in spark.read.parquet(table).collect()}
    assert len(stored) == size and stored["k000001"] == 3 and stored["k000002"] == 2 and stored["k000003"] == 0


def test_later_batches_win_and_a_table_moves_to_more_buckets(spark, tmp_path):
    table, more = str(tmp_path / "items"), str(tmp_path / "more")
    rng, want = random.Random(4), {}
    for n in range(4):
        rows = [(rng.choice(["a", "b", "c", "d", None]), rng.randrange(1000), f"{n}-{i}") for i in range(20)]
        buckets.merge_items(spark.createDataFrame(rows, "id string, at int, v string"), table, n, ["id"], ["at", "v"], 3)
        for key in {r[0] for r in rows}:
            want[key] = max(r[1:] for r in rows if r[0] == key)[1]
    stored = spark.read.parquet(table)
    assert {r["id"]: r["v"] for r in stored.collect()} == want and stored.count() == len(want)
    buckets.rebucket(spark, table, more, stored.drop("bucket").schema, ["id"], 16)
    assert {r["id"]: r["v"] for r in spark.read.parquet(more).collect()} == want
    assert buckets.touched(stored, ["id"], 16) == sorted(int(f.name.split("=")[1]) for f in (tmp_path / "more").glob("bucket=*"))
