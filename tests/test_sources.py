"""Readers, writers and the item table."""

from __future__ import annotations

import hashlib
import json
import pathlib

import pytest
from pyspark.sql import functions as F

from feedloom import schemas
from feedloom.plans.posts import cleaned_posts, prepare_posts
from feedloom.queries import QUERIES
from feedloom.session import new_dir, pinned, shared_dir, spread
from feedloom.sources import items, readers, writers
from tests.conftest import plan_of


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_feeds_with_different_columns(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        "Unnamed: 0,ID,is_original,is_Original,num_comments,Title\n0,p1,x,True,12.0,nan\n1,p2,y,False,abc,Hi\n"
    )
    (tmp_path / "b.csv").write_text('Body,ID,Upvotes,creation_date\n"said ""hi"", ok",p3,7,2024-01-02 03:04:05\n')
    raw = readers.read_feeds(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")], schemas.POSTS_RAW)
    assert raw.columns == [*schemas.POSTS_RAW.names, "source_file"]
    posts = {r["ID"]: r for r in cleaned_posts(prepare_posts(raw)).collect()}
    assert posts["p1"]["is_Original"] == "True" and posts["p1"]["Title"] is None
    assert posts["p1"]["num_comments"] == 12 and posts["p2"]["num_comments"] is None
    assert posts["p3"]["Body"] == 'said "hi", ok' and posts["p3"]["Upvotes"] == 7
    assert posts["p3"]["post_hour"] == 3 and str(posts["p3"]["post_date"]) == "2024-01-02"
    assert posts["p3"]["cleaned_body"] == "said hi ok" and posts["p1"]["cleaned_body"] is None
    assert posts["p3"]["source_file"].endswith("b.csv")


def test_multi_line_csv(spark, tmp_path):
    text = "Monday: Closed\nTuesday: \"5\""
    source = spark.createDataFrame([("SF", text), (" edge ", "x")], "City string, Hours string")
    writers.write_csv(source, str(tmp_path / "out"))
    assert rows(readers.read_csv(spark, str(tmp_path / "out"), source.schema, multi_line=True)) == rows(source)


def test_append_and_snapshot(spark, tmp_path):
    df = spark.range(250).select("id", (F.col("id") % 7).alias("score"))
    writers.append_csv(df, str(tmp_path / "log"))
    writers.append_csv(df, str(tmp_path / "log"))
    assert readers.read_csv(spark, str(tmp_path / "log"), df.schema).count() == 500
    path = writers.snapshot(df, str(tmp_path), "2024-01-01_00-00-00", ["id", "score"], [F.desc("score"), "id"])
    taken = readers.read_csv(spark, path, df.schema)
    assert path.endswith("batch_ts=2024-01-01_00-00-00") and taken.count() == 100
    assert taken.agg(F.min("score")).first()[0] == 4
    writers.append_json(df.limit(3), str(tmp_path / "json"))
    assert readers.read_documents(spark, str(tmp_path / "json"), df.schema).count() == 3


def test_publish_and_features(spark, tmp_path):
    df = spark.createDataFrame([("a", None, 1.5), ("b", "t", 2.0)], "id string, title string, price double")
    writers.publish(df, "text", str(tmp_path / "messages"))
    got = [json.loads(r["value"]) for r in readers.read_any(spark, "text", str(tmp_path / "messages")).collect()]
    assert {"id": "a", "title": None, "price": 1.5} in got and len(got) == 2
    writers.publish(df, "parquet", str(tmp_path / "keyed"))
    assert sorted(r["key"] for r in spark.read.parquet(str(tmp_path / "keyed")).collect()) == ["a", "b"]
    writers.write_features(df, str(tmp_path / "features"), "id")
    assert (tmp_path / "features" / "id=a").is_dir()


def test_publish_latest_replaces_only_on_success(spark, tmp_path):
    path = str(tmp_path / "latest")
    assert writers.publish_latest(spark.range(3), path)["statusCode"] == 200
    broken = spark.range(1).select(F.raise_error(F.lit("boom")).cast("string").alias("id"))
    failed = writers.publish_latest(broken, path)
    assert failed["statusCode"] == 500 and "boom" in failed["body"]["reason"]
    assert readers.read_csv(spark, path, spark.range(1).schema).count() == 3
    assert writers.publish_latest(spark.range(5), path)["statusCode"] == 200
    assert readers.read_csv(spark, path, spark.range(1).schema).count() == 5


def test_markers_table_and_preview(spark, tmp_path, capsys):
    df = spark.createDataFrame([("A", 1.0, 2.0), ("B", None, 2.0)], "n string, latitude double, longitude double")
    writers.write_markers(df, str(tmp_path / "map"), "n")
    assert spark.read.text(str(tmp_path / "map")).count() == 1
    writers.save_table(df, "places_saved")
    writers.save_table(df.limit(1), "places_saved")
    assert readers.read_table(spark, "places_saved").count() == 1
    assert readers.read_table(spark, "places_saved", limit=5).count() == 1
    writers.preview(df, 1)
    assert "latitude" in capsys.readouterr().out


def test_bounded_rows(spark):
    assert len(writers.bounded_rows(spark.range(5), 5)) == 5
    with pytest.raises(ValueError):
        writers.bounded_rows(spark.range(6), 5)


def test_local_rows_and_pages(spark, tmp_path):
    assert rows(readers.local_rows(spark, [("P", "ZAR", 2.0)], schemas.RATES)) == [("P", "ZAR", 2.0)]
    assert readers.local_rows(spark, [], schemas.RATES).count() == 0
    spark.createDataFrame([(1, "u", "h", "x")], "page_id long, url string, html string, more string").write.parquet(str(tmp_path / "p"))
    assert readers.read_pages(spark, str(tmp_path / "p")).columns == ["page_id", "url", "html"]
    urls = readers.page_urls(spark.createDataFrame([("h/page/1/3",)], "url string"), "url", F.lit(9999))
    assert urls.count() == 9999 and "h/page/9999/3" in {r["page_url"] for r in urls.collect()}


def test_addresses_listed_in_the_row(spark):
    rows = [(1, ["h/page/1/3"]), (2, ["b/page/1", "a/page/7"]), (3, ["no number", "x/page/1page/2"]), (4, [])]
    listed = readers.page_urls(spark.createDataFrame(rows, "id int, urls array<string>"), "urls", F.lit(12), rows=False)
    found = {r["id"]: r["page_url"] for r in listed.collect()}
    single = spark.createDataFrame([(i, u) for i, us in rows for u in us], "id int, url string")
    for i, urls in found.items():
        one_by_one = readers.page_urls(single.where(F.col("id") == i), "url", F.lit(12)).collect()
        assert urls == [u for _, u in sorted((r["page"], r["page_url"]) for r in one_by_one)]


def test_listed_addresses_are_not_shuffled(spark, tmp_path):
    spark.createDataFrame(
        [(1, "https://a.b/c"), (1, "https://b.c/d"), (1, None), (2, None), (None, "https://a.b/c")], "page_id long, url string"
    ).write.parquet(f"{tmp_path}/pages.parquet")
    done = QUERIES["page_url_list"](spark, str(tmp_path))
    assert "Generate" not in plan_of(done) and plan_of(done).count("Exchange") == 1
    found = {r["page_id"]: (r["pages"], r["urls_sha256"]) for r in done.collect()}

    def digest(*hosts):
        lines = "\n".join(f"https://{h}/search/page/{n}/3" for n in range(1, 10000) for h in hosts)
        return hashlib.sha256(lines.encode()).hexdigest()

    assert found == {1: (29997, digest("a.b", "b.c")), 2: (9999, digest()), None: (9999, digest("a.b"))}


def test_item_table_against_brute_force(spark, tmp_path):
    table = str(tmp_path / "items")
    assert items.read_items(spark, table, ["k"]) is None
    want = {}
    for batch in range(6):
        data = [(f"k{(batch * 3 + i) % 11}" if i % 2 else "hot", i, batch * 100 + i) for i in range(40)]
        for k, seq, v in data:
            want[k] = v
        df = spark.createDataFrame(data, "k string, seq int, v int")
        items.upsert(df, table, batch, ["k"], ["seq"])
        items.upsert(df, table, batch, ["k"], ["seq"])
        if batch in (2, 4):
            items.compact(spark, table, batch - 1, ["k"])
        assert {r["k"]: r["v"] for r in items.read_items(spark, table, ["k"]).collect()} == want
    assert (tmp_path / "items" / "base" / "upto=3").is_dir()
    early = items.read_items(spark, table, ["k"], before=2)
    assert early is not None and early.agg(F.max("v")).first()[0] < 200


def test_unfinished_batches_are_not_read(spark, tmp_path):
    table = tmp_path / "items"
    df = spark.createDataFrame([("a", 1)], "k string, seq int")
    items.upsert(df, str(table), 0, ["k"], ["seq"])
    items.upsert(df.withColumn("seq", F.lit(9)), str(table), 1, ["k"], ["seq"])
    (table / "changes" / "batch_id=1" / "_SUCCESS").unlink()
    assert rows(items.read_items(spark, str(table), ["k"])) == [("a", 1)]


def test_shared_folder_and_pins(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert new_dir(spark, "x") != new_dir(spark, "x")
    df = pinned(spark.range(10).withColumn("k", F.col("id") % 3))
    assert df.count() == 10 and "FileScan parquet" in df._jdf.queryExecution().executedPlan().toString()
    assert all(pathlib.Path(f.removeprefix("file://")).is_file() for f in df.inputFiles())
    wide = spark.range(100, numPartitions=50)
    assert spread(wide) is wide and spread(wide.coalesce(1)).rdd.getNumPartitions() == 8


def test_spread_bounds_the_rows_of_a_task(spark):
    dealt = spread(spark.range(0, 5000, 1, 8), rows=100)
    assert dealt.rdd.getNumPartitions() == 50 and dealt.count() == 5000
    assert max(dealt.rdd.glom().map(len).collect()) <= 150
    enough = spark.range(0, 5000, 1, 50)
    assert spread(enough, rows=100) is enough


def test_each_file_is_read_by_its_own_header(spark, tmp_path):
    (tmp_path / "one.csv").write_text("ID,Title,Body\np1,title one,body one\n")
    (tmp_path / "two [x].csv").write_text('﻿ID,Body,Title,extra\np2,"body\ntwo",title two,?\n')
    (tmp_path / "three four.csv").write_text("Body,ID\nbody three,p3\n,p4\n")
    (tmp_path / "five.csv").write_text("ID,Title,Body\np5,title five,body five\n")
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "_hidden.csv").write_text("ID\nno\n")
    feed = readers.read_feed(spark, f"{tmp_path}/*.csv", schemas.POSTS_RAW)
    got = {r["ID"]: (r["Title"], r["Body"]) for r in feed.collect()}
    assert got == {
        "p1": ("title one", "body one"), "p2": ("title two", "body\ntwo"), "p3": (None, "body three"), "p4": (None, None),
        "p5": ("title five", "body five"),
    }
    assert feed.select("ID").where("source_file LIKE '%two%'").collect()[0]["ID"] == "p2"
    found = readers.layouts(spark, str(tmp_path))
    assert {h: len(f) for h, f in found.items()} == {("ID", "Title", "Body"): 2, ("ID", "Body", "Title", "extra"): 1, ("Body", "ID"): 1}
    assert {len(p.split("FileScan csv")) - 1 for p in [plan_of(feed)]} == {3}
    none = readers.read_feed(spark, f"{tmp_path}/none*.csv", schemas.POSTS_RAW)
    assert none.columns == feed.columns and none.count() == 0


def test_plain_feeds_are_split(spark, tmp_path):
    (tmp_path / "a.csv").write_text("ID,Title\n" + "".join(f"p{i},title {i}\n" for i in range(2000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        feed = readers.read_feed(spark, f"{tmp_path}/a.csv", schemas.POSTS_RAW, multi_line=False)
        assert feed.rdd.getNumPartitions() > 4 and feed.select("ID").distinct().count() == 2000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
