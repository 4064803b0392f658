"""Event-time statistics, start positions and poison records on streams of several batches."""

from __future__ import annotations

import datetime as dt
import json
import math
import os
import random
import statistics
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from feedloom import schemas
from feedloom.operators import anomaly
from feedloom.operators.shape import keyed_json
from feedloom.sources import readers
from feedloom.sources.readers import local_rows
from feedloom.streaming import jobs, metrics, windows
from tests.test_streams import events, land, source

START = dt.datetime(2024, 1, 1)
SCHEMA = "id string, created timestamp, score double, num_comments double, popularity_score double"


def metric_rows(n=400):
    rng, rows = random.Random(6), []
    for i in range(n):
        score = {50: 900.0, 120: math.nan, 130: math.inf, 131: -math.inf, 220: 700.0, 399: 999.0}.get(i, float(rng.randrange(10)))
        rows.append((f"{i:04d}", START + dt.timedelta(minutes=3 * i), score, None if i % 9 == 0 else 1.0, float(rng.randrange(5))))
    return rows


def brute_flags(rows, limit, closed=None):
    groups, out = defaultdict(list), set()
    for r in rows:
        groups[(r[1] - START) // dt.timedelta(hours=4)].append(r)
    for k, members in groups.items():
        if closed is not None and START + dt.timedelta(hours=4) * (k + 1) > closed:
            continue
        for m, at in (("score", 2), ("num_comments", 3), ("popularity_score", 4)):
            good = [r[at] for r in members if r[at] is not None and math.isfinite(r[at])]
            spread = statistics.stdev(good) if len(good) > 1 else 0
            if spread:
                mean = statistics.mean(good)
                out |= {(r[0], m) for r in members if r[at] is not None and abs(r[at] - mean) / spread > limit}
    return out


@pytest.mark.parametrize("files", [1, 8])
def test_window_flags_do_not_depend_on_batches(spark, tmp_path, files):
    rows, landing, out = metric_rows(), tmp_path / "in", str(tmp_path / "out")
    landing.mkdir()
    size = len(rows) // files
    for n in range(files):
        part = rows[n * size:(n + 1) * size]
        random.Random(n).shuffle(part)
        path = landing / f"part-{n:03d}.json"
        lines = [json.dumps(dict(zip(["id", "created", "score", "num_comments", "popularity_score"], [r[0], str(r[1]), *("Infinity" if v == math.inf else "-Infinity" if v == -math.inf else "NaN" if v is not None and math.isnan(v) else v for v in r[2:])]))) for r in part]
        path.write_text("\n".join(lines) + "\n")
        os.utime(path, (1_700_000_000 + n, 1_700_000_000 + n))
    stream = readers.read_stream(spark, "json", str(landing), spark.createDataFrame([], SCHEMA).schema, maxFilesPerTrigger="1")
    found = windows.window_anomalies(stream, "created", "id", width="4 hours", limit=2.5, salts=3)
    jobs.run(found.select("id", "metric"), f"{out}/c", path=f"{out}/data", once=True)
    got = [tuple(r) for r in spark.read.parquet(f"{out}/data").collect()]
    closed = rows[-1][1] - dt.timedelta(minutes=10)
    assert len(got) == len(set(got)) and set(got) == brute_flags(rows, 2.5, closed)
    assert {("0050", "score"), ("0130", "score"), ("0131", "score"), ("0220", "score")} <= set(got) and ("0120", "score") not in got
    # The same operator on a batch flags the last window, too.
    batch = windows.window_anomalies(spark.createDataFrame(rows, SCHEMA), "created", "id", width="4 hours", limit=2.5, salts=3)
    assert {(r["id"], r["metric"]) for r in batch.collect()} == brute_flags(rows, 2.5)


def test_one_nan_flags_nothing_else(spark):
    rows = [(f"{i}", START, 1.0 + i % 2, 1.0, 1.0) for i in range(50)] + [("nan", START, math.nan, math.nan, None), ("inf", START, math.inf, 1.0, 1.0)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("kind", F.lit("k"))
    for found in (anomaly.anomalies(df), anomaly.anomalies_by(df, "kind")):
        assert [(r["id"], r["metric"]) for r in found.collect()] == [("inf", "score")]


@pytest.mark.parametrize("sink", ["files", "batches"])
def test_start_at_the_end_at_the_begin_and_at_the_checkpoint(spark, tmp_path, sink):
    landing, rows = tmp_path / "in", events(30)
    land(spark, landing, 0, rows[:10])
    land(spark, landing, 1, rows[10:20])
    seen = defaultdict(list)

    def go(name, start):
        if sink == "files":
            jobs.run(source(spark, landing), f"{tmp_path}/{name}-c", path=f"{tmp_path}/{name}", once=True, start=start)
            return spark.read.schema("value string").parquet(f"{tmp_path}/{name}").count()
        jobs.run(source(spark, landing), f"{tmp_path}/{name}-c", batch=lambda df, n: seen[name].extend(df.collect()), once=True, start=start)
        return len(seen[name])

    assert go("tail", jobs.TAIL) == 0 and go("resume", jobs.RESUME) == 20
    mark = json.loads(spark.read.text(f"{tmp_path}/tail-c-start").first()["value"])
    assert "FileStreamSource" in mark["source"] and mark["end"]
    land(spark, landing, 2, rows[20:])
    assert go("tail", jobs.TAIL) == 10 and go("resume", jobs.RESUME) == 30 and go("replay", jobs.REPLAY) == 30
    with pytest.raises(ValueError, match="replay"):
        go("replay", jobs.REPLAY)
    assert go("tail", jobs.RESUME) == 10


def test_numbers_no_decimal_holds_are_rejected(spark, tmp_path):
    rows = events(6)
    large = (*rows[0][:9], 1e35, *rows[0][10:])
    lexicon = local_rows(spark, [("good", 0.7)], schemas.LEXICON)
    handle = jobs.post_batch(lexicon, str(tmp_path), F.lit(START), latest=("author",), buckets=2)
    handle(keyed_json(spark.createDataFrame([large, *rows[1:]], schemas.POST_EVENT)), 0)
    rejected = [json.loads(r["raw"]) for r in spark.read.parquet(f"{tmp_path}/rejected").collect()]
    assert [r["id"] for r in rejected] == [rows[0][0]]
    latest = {r["author"]: r["id"] for r in spark.read.parquet(f"{tmp_path}/latest").collect()}
    assert latest == {r[1]: r[0] for r in rows[1:]}


def test_posts_are_folded_and_latest_is_overwritten(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(jobs, "COMPACT_EVERY", 2)
    rows = events(80)
    lexicon = local_rows(spark, [("good", 0.7)], schemas.LEXICON)
    handle = jobs.post_batch(lexicon, str(tmp_path), F.lit(START), latest=("author",), buckets=3)
    for n in range(4):
        for _ in range(1 + n % 2):
            handle(keyed_json(spark.createDataFrame(rows[n * 20:(n + 1) * 20], schemas.POST_EVENT)), n)
    assert sorted(p.name for p in (tmp_path / "base").parent.glob("posts/base/*")) == ["upto=0", "upto=2"]
    latest = {r["author"]: (r["id"], r["author_activity_count"]) for r in spark.read.parquet(f"{tmp_path}/latest").collect()}
    counts = defaultdict(int)
    want = {}
    for r in rows:
        counts[r[1]] += 1
        want[r[1]] = (r[0], counts[r[1]])
    assert latest == want


def test_recorded_counts_equal_the_written_tables(spark, tmp_path):
    rows, landing, root = events(300), tmp_path / "in", str(tmp_path / "out")
    rows[7] = (*rows[7][:5], 10**6, *rows[7][6:])
    lexicon = local_rows(spark, [("good", 0.7)], schemas.LEXICON)
    for n in range(3):
        land(spark, landing, n, rows[n * 100:(n + 1) * 100], ["{broken"] * n)
    heard = []
    jobs.run(
        source(spark, landing).observe("lines", F.count(F.lit(1)).alias("n")), f"{root}/checkpoint",
        batch=jobs.post_batch(lexicon, root), once=True, log=metrics.BatchLog(heard.append))
    got = {r["batch_id"]: (r["rows"], r["rejected"], r["flagged"]) for r in metrics.read_metrics(spark, f"{root}/metrics").collect()}

    def written(name):
        return dict(spark.read.parquet(f"{root}/{name}").groupBy("batch_id").count().collect())

    rejected, flagged = written("rejected"), written("anomalies")
    assert got == {n: (100 + n, rejected.get(n, 0), flagged.get(n, 0)) for n in range(3)}
    assert [got[n][1] for n in range(3)] == [0, 1, 2] and got[0][2] > 0
    assert [(h["batch_id"], h["lines"]["n"]) for h in heard] == [(n, 100 + n) for n in range(3)]


def test_a_retried_batch_replaces_its_counts(spark, tmp_path):
    for counts in ({"rows": 5, "rejected": 1, "flagged": 0}, {"rows": 6, "rejected": 2, "flagged": 3}):
        metrics.record(spark, str(tmp_path / "m"), 4, **counts)
    assert metrics.read_metrics(spark, str(tmp_path / "m")).collect()[0].asDict() == {"batch_id": 4, "rows": 6, "rejected": 2, "flagged": 3}
