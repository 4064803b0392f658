"""Mergeable summaries, sums by digest and versions behind a marker."""

from __future__ import annotations

import itertools
import math
import random
import statistics
import threading

import pytest
from pyspark.sql import functions as F

from feedloom.operators import aggregates
from feedloom.sources import readers, summaries, writers
from tests.conftest import plan_of

SCHEMA = "k string, v double, w double"


def measured(n=600):
    rng = random.Random(4)
    odd = {3: math.nan, 4: math.inf, 5: -math.inf, 6: None, 7: 0.0, 8: -0.0, 9: 1e-300, 10: -1e300}
    # One key holds most rows, and NULL is a key.
    return [("hot" if i % 10 else rng.choice(["a", None]), odd.get(i, rng.uniform(-50, 1000)), float(i) if i % 3 else None) for i in range(n)]


def brute(rows):
    groups = {}
    for k, *values in rows:
        for name, x in zip("vw", values, strict=True):
            if x is not None and math.isfinite(x):
                groups.setdefault((k, name), []).append(x)
    return groups


def check(found, groups):
    assert {(r["k"], r["measure"]) for r in found} == set(groups) and len(found) == len(groups)
    for r in found:
        values = sorted(groups[(r["k"], r["measure"])])
        assert (r["n"], r["low"], r["high"]) == (len(values), values[0], values[-1])
        assert math.isclose(r["mean"], statistics.fmean(values), rel_tol=1e-9)
        if max(map(abs, values)) < 1e100:
            assert r["std"] is None if len(values) == 1 else math.isclose(r["std"], statistics.stdev(values), rel_tol=1e-9)
        for name, q in (("p0", 0.0), ("p50", 0.5), ("p90", 0.9), ("p100", 1.0)):
            exact = values[math.floor(q * (len(values) - 1))]
            assert abs(r[name] - exact) <= abs(exact) * 0.0101


SHARES = {"p0": 0.0, "p50": 0.5, "p90": 0.9, "p100": 1.0}


@pytest.mark.parametrize("order", [[0, 1, 2, 3, 4], [4, 2, 0, 3, 1]])
def test_summaries_of_batches_equal_the_whole(spark, tmp_path, order):
    rows, table = measured(), str(tmp_path / "table")
    whole = spark.createDataFrame(rows, SCHEMA)
    schema = summaries.summary_schema(whole, ["k"])
    for batch_id, part in enumerate(order):
        batch = spark.createDataFrame(rows[part::5], SCHEMA)
        # Every other batch is run twice, as after a lost driver.
        for _ in range(1 + batch_id % 2):
            summaries.merge_summaries(batch, table, batch_id, ["k"], ["v", "w"], buckets=4)
    check(summaries.read_summaries(spark, table, schema, ["k"], SHARES).collect(), brute(rows))


def test_summaries_of_nothing(spark, tmp_path):
    none = spark.createDataFrame([("a", None, math.nan)], SCHEMA)
    summaries.merge_summaries(none, str(tmp_path / "t"), 0, ["k"], ["v", "w"], buckets=2)
    schema = summaries.summary_schema(none, ["k"])
    assert summaries.read_summaries(spark, str(tmp_path / "t"), schema, ["k"], SHARES).count() == 0


def test_a_batch_reads_its_own_buckets_alone(spark, tmp_path):
    table = str(tmp_path / "table")
    rows = spark.range(400).select(F.concat(F.lit("k"), "id").alias("k"), F.col("id").cast("double").alias("v"))
    summaries.merge_summaries(rows, table, 0, ["k"], ["v"], buckets=8)
    before = {p.name: {f.name for f in p.glob("*.parquet")} for p in (tmp_path / "table").glob("bucket=*")}
    summaries.merge_summaries(rows.where("k = 'k7'"), table, 1, ["k"], ["v"], buckets=8)
    after = {p.name: {f.name for f in p.glob("*.parquet")} for p in (tmp_path / "table").glob("bucket=*")}
    assert len(before) == 8 and sum(before[b] != after[b] for b in before) == 1


@pytest.mark.parametrize("n", [1, 2, 3, 4, 6, 50])
def test_top_sums_equal_sums_by_key(spark, n):
    long = "x" * 5000
    rows = [(long + "b", 3), (long + "b", 4), (long + "a", 7), (long, 7), (None, 9), ("", 1), ("z", None), ("y", None), ("neg", -5)]
    df = spark.createDataFrame(rows * 3, "title string, v long")
    want = {}
    for k, v in rows * 3:
        want[k] = want.get(k) if v is None else (want.get(k) or 0) + v
    # Spark puts a NULL key before others of the same sum.
    ranked = sorted(want.items(), key=lambda x: (x[1] is None, -(x[1] or 0), x[0] is not None, x[0] or ""))
    got = [(r["title"], r["total"]) for r in aggregates.top_sums(df, "title", "v", n, "total").collect()]
    assert got == ranked[:n]


def test_sums_by_digest_shuffle_no_titles(spark, tmp_path):
    spark.createDataFrame([("a" * 100, 1)], "title string, v long").write.parquet(str(tmp_path / "t"))
    plan = plan_of(aggregates.sums_by_digest(spark.read.parquet(str(tmp_path / "t")), "title", "v", "total"))
    exchange = plan[plan.index("Exchange"):]
    assert "title" not in exchange.split("\n")[0] and "HashAggregate(keys=[_digest" in exchange


def test_readers_of_versions_never_miss_a_result(spark, tmp_path):
    path = str(tmp_path / "result")
    assert writers.latest_version(spark, path) is None
    schema = spark.range(1).schema
    assert writers.publish_version(spark.range(5, numPartitions=1), path)["statusCode"] == 200
    seen, failures, stop = [], [], threading.Event()

    def poll():
        while not stop.is_set():
            try:
                seen.append(readers.read_csv(spark, writers.latest_version(spark, path), schema).count())
            except Exception as failure:
                failures.append(str(failure))

    reader = threading.Thread(target=poll)
    reader.start()
    for n in itertools.islice(itertools.cycle((5, 6)), 30):
        assert writers.publish_version(spark.range(n, numPartitions=1), path, keep=20)["statusCode"] == 200
    stop.set()
    reader.join()
    assert not failures and seen and set(seen) <= {5, 6}


def test_a_failed_version_leaves_the_latest(spark, tmp_path):
    path = str(tmp_path / "result")
    writers.publish_version(spark.range(3), path)
    first = writers.latest_version(spark, path)
    broken = spark.range(1).select(F.raise_error(F.lit("boom")).cast("string").alias("id"))
    failed = writers.publish_version(broken, path)
    assert failed["statusCode"] == 500 and "boom" in failed["body"]["reason"]
    assert writers.latest_version(spark, path) == first
    for _ in range(4):
        writers.publish_version(spark.range(4), path, keep=2)
    assert len(list((tmp_path / "result" / "versions").iterdir())) <= 3
    assert readers.read_csv(spark, writers.latest_version(spark, path), spark.range(1).schema).count() == 4
