"""Operators against hand-made rows, brute force and skewed keys."""

from __future__ import annotations

import datetime as dt
import random
from collections import Counter, defaultdict
from statistics import mean, stdev

import pytest
from pyspark.ml.feature import StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from feedloom import schemas
from feedloom.operators import aggregates as agg
from feedloom.operators import anomaly, lookups, quality, running, scaling, shape
from feedloom.plans.observations import route_features
from feedloom.sources.readers import local_rows
from tests.conftest import SMALL, plan_of


def tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def hot_posts(rows=3000, seed=5):
    """Posts of which one author wrote two thirds, many at the same second."""
    rng = random.Random(seed)
    start = dt.datetime(2024, 1, 1)
    return [
        (i, "hot" if rng.random() < 0.66 else f"a{rng.randrange(40)}", start + dt.timedelta(seconds=rng.randrange(40) * 600))
        for i in range(rows)
    ]


def brute_running(posts):
    seen, out = Counter(), {}
    for i, author, ts in sorted(posts, key=lambda p: (p[2], p[0])):
        seen[author] += 1
        out[i] = seen[author]
    return out


@pytest.mark.parametrize(
    "slices",
    [["hour"], ["exact", "block"]],
    ids=["hour", "time and id block"],
)
def test_running_count(spark, slices):
    forms = {"hour": F.date_trunc("hour", "ts"), "exact": F.col("ts"), "block": F.floor(F.col("id") / 100)}
    posts = hot_posts()
    df = spark.createDataFrame(posts, "id long, author string, ts timestamp").repartition(7)
    got = running.running_count(df, "author", ["ts", "id"], [forms[s] for s in slices])
    assert {r["id"]: r["author_activity_count"] for r in got.collect()} == brute_running(posts)
    assert got.columns == ["id", "author", "ts", "author_activity_count"]


def test_running_count_keeps_null_keys(spark):
    df = spark.createDataFrame(
        [(1, None, None), (2, None, dt.datetime(2024, 1, 1)), (3, "a", None)], "id long, author string, ts timestamp"
    )
    got = running.running_count(df, "author", ["ts", "id"], [F.date_trunc("hour", "ts")])
    assert {r["id"]: r["author_activity_count"] for r in got.collect()} == {1: 1, 2: 2, 3: 1}


def test_numbered(spark):
    df = spark.range(500).withColumn("k", F.col("id") * 3).repartition(5)
    got = running.numbered(df, ["k"], [F.floor(F.col("k") / 100)], "n")
    assert all(r["n"] == r["id"] + 1 for r in got.collect())


def test_latest_per_key_with_many_copies(spark):
    rows = [("hot", i, i % 7) for i in range(2000)] + [("cold", 5, None)]
    df = spark.createDataFrame(rows, "k string, seq int, v int")
    assert tuples(agg.latest_per_key(df, ["k"], ["seq"])) == [("cold", 5, None), ("hot", 1999, 1999 % 7)]


def test_sum_of_nulls_and_orders(spark):
    df = spark.createDataFrame([("a", None), ("b", 3), ("b", 4), ("c", 7)], "k string, v int")
    sums = agg.sum_by(df, "k", "v", "s")
    assert [tuple(r) for r in agg.descending(sums, "s", "k").collect()] == [("b", 7), ("c", 7), ("a", None)]
    parts = spark.createDataFrame([(2,), (None,), (1,)], "p int")
    assert [r["p"] for r in agg.ascending(parts, "p").collect()] == [None, 1, 2]


def test_top_n_plan_and_ties(spark):
    df = spark.createDataFrame([("b", 1), ("a", 1), ("c", 0)], "t string, n int")
    top = agg.top_n(df, 2, "n", "t")
    assert [r["t"] for r in top.collect()] == ["a", "b"]
    assert "TakeOrderedAndProject" in plan_of(top)


def test_top_words_cut_before_the_shuffle(spark):
    rows = [("x", "b b a a c"), ("x", ""), ("y", "q")]
    words = agg.top_words(spark.createDataFrame(rows, "k string, t string"), "k", "t", 2)
    assert plan_of(words).count("WindowGroupLimit") == 2
    assert tuples(words) == [("x", "a", 2), ("x", "b", 2), ("y", "q", 1)]
    counts = agg.word_counts(spark.createDataFrame(rows, "k string, t string"), "k", "t")
    assert ("x", "", 1) in tuples(counts)


def test_busiest_hour_ties_to_the_earlier(spark):
    df = spark.createDataFrame([("x", 5), ("x", 3), ("x", 5), ("x", 3), ("y", 9)], "k string, h int")
    assert tuples(agg.busiest_hour(df, "k", "h")) == [("x", 3, 2), ("y", 9, 1)]


def test_joined_text_chunks(spark):
    df = spark.createDataFrame([("x", i, f"t{i}") for i in range(10)] + [("x", 10, None)], "k string, i int, t string")
    chunks = agg.joined_text(df, "k", "i", "t", rows_per_chunk=4)
    whole = " ".join(r["joined_text"] for r in sorted(chunks.collect(), key=lambda r: r["chunk"]))
    assert whole == " ".join(f"t{i}" for i in range(10)) and chunks.count() == 3


def scored(spark, groups):
    rows = [(i, g, float(v), float(v) / 2, float(v)) for i, (g, v) in enumerate(groups)]
    return spark.createDataFrame(rows, "id long, category string, score double, num_comments double, popularity_score double")


def test_anomalies_against_brute_force(spark):
    rng = random.Random(3)
    groups = [("hot", rng.gauss(0, 1)) for _ in range(900)] + [("b", rng.gauss(50, 5)) for _ in range(60)]
    groups += [("hot", 9.0), ("b", 90.0), ("single", 4.0)]
    df = scored(spark, groups)

    def brute(keyed):
        by = defaultdict(list)
        for g, v in groups:
            by[g if keyed else ""].append(v)
        out = set()
        for i, (g, v) in enumerate(groups):
            xs = by[g if keyed else ""]
            if len(xs) > 1 and abs((v - mean(xs)) / stdev(xs)) > 3:
                out |= {(i, m) for m in anomaly.METRICS}
        return out

    def found(result):
        return {(r["id"], r["metric"]) for r in result.collect()}

    assert found(anomaly.anomalies(df)) == brute(False)
    assert found(anomaly.anomalies_by(df, "category")) == brute(True)


def test_no_anomaly_without_spread_or_in_small_batches(spark):
    assert anomaly.anomalies(scored(spark, [("a", 1)] * 50)).count() == 0
    assert anomaly.anomalies(scored(spark, [("a", 0)] * 9 + [("a", 10**9)])).count() == 0
    eleven = anomaly.anomalies(scored(spark, [("a", 0)] * 10 + [("a", 1)]))
    assert eleven.count() == 3


def test_scale(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (2.0,), (None,)], "v double")
    assert sorted((r["s"] for r in scaling.scale(df, "v", "s").collect()), key=str) == [0.0, 0.5, 1.0, None]
    same = spark.createDataFrame([(4.0,), (4.0,)], "v double")
    assert [r["s"] for r in scaling.scale(same, "v", "s").collect()] == [0.5, 0.5]


LABELS = [("KL",)] * 3 + [("LH",)] * 3 + [("UA",)] * 5 + [("AF",)] + [(None,)]


@pytest.mark.parametrize("rows", [scaling.SLICE_ROWS, 1])
def test_category_index_equals_fitted_indexer(spark, rows):
    df = spark.createDataFrame(LABELS, "c string")
    got = {r["c"]: r["index"] for r in scaling.category_index(df, "c", rows).collect()}
    assert got == {"UA": 0, "KL": 1, "LH": 2, "AF": 3}
    fitted = StringIndexer(inputCol="c", outputCol="i", handleInvalid="keep").fit(df).transform(df)
    assert tuples(scaling.with_index(df, "c", "i", rows).select("c", "i")) == tuples(fitted.select("c", "i"))


def test_category_index_of_many_labels_is_numbered_in_ranges(spark):
    n = 3000
    df = spark.range(n * (n + 1) // 2, numPartitions=8).select(F.concat(F.lit("l"), F.floor((F.sqrt(8 * F.col("id") + 1) - 1) / 2)).alias("c"))
    got = [(r["index"], r["c"], r["count"]) for r in scaling.category_index(df, "c", 100).collect()]
    counts = df.groupBy("c").count().collect()
    assert sorted(got) == [(i, r["c"], r["count"]) for i, r in enumerate(sorted(counts, key=lambda r: (-r["count"], r["c"])))]


@pytest.mark.parametrize("rows", [scaling.SLICE_ROWS, 1])
def test_fit_features(spark, rows):
    df = spark.createDataFrame([("a", 10.0), ("a", 30.0), ("b", 20.0), (None, 10.0)], "c string, p double")
    done = scaling.fit_features(df, "c", "p", rows)
    got = tuples(done.select("c", "carrier_index", vector_to_array("scaled_price")[0]))
    assert got == [("a", 0.0, 0.0), ("a", 0.0, 1.0), ("b", 1.0, 0.5), (None, 2.0, 0.0)]


@pytest.mark.parametrize("small", [True, False])
def test_lookups_agree_with_and_without_broadcast(spark, monkeypatch, small):
    monkeypatch.setattr(lookups, "fits", lambda *a, **k: small)
    df = spark.createDataFrame([(1, 10.0, "P")] * 400 + [(2, 5.0, "O"), (3, 4.0, None), (4, 8.0, "Z")], "id int, price double, cur string")
    rates = local_rows(spark, [("P", "ZAR", 2.0), ("P", "USD", 9.0), ("Z", "ZAR", 0.0)], schemas.RATES)
    got = lookups.convert_currency(df, rates, "price", "cur")
    want = [(20.0, True)] * 400 + [(5.0, False), (4.0, False), (8.0, False)]
    assert tuples(got.select("price_in_zar", "converted")) == sorted(want, key=repr)


def test_size_check(spark):
    df = spark.range(100).withColumn("t", F.repeat(F.lit("x"), 1000))
    assert lookups.fits(df) and not lookups.fits(df, max_rows=99) and not lookups.fits(df, max_bytes=50_000)
    assert lookups.fits(df.limit(0))


def test_geocode(spark):
    df = spark.createDataFrame([("A",), ("B",), (None,)], "name string")
    places = local_rows(spark, [("A", 1.0, 2.0), ("A", 1.0, 2.0), ("C", 3.0, None)], schemas.GAZETTEER)
    assert tuples(lookups.geocode(df, places, "name")) == [("A", 1.0, 2.0), ("B", None, None), (None, None, None)]


@pytest.mark.parametrize("max_rows", [lookups.LEXICON_ROWS, 0])
def test_polarity(spark, max_rows):
    lexicon = local_rows(spark, [("good", 0.7), ("bad", -0.7), ("great", 0.8), (None, 1.0)], schemas.LEXICON)
    rows = [(1, ["good", "day"]), (2, ["bad", "great", "x"]), (3, []), (4, ["day"]), (5, None)] + [(6, ["good"])] * 50
    df = spark.createDataFrame(rows, "id int, words array<string>")
    got = {r["id"]: r["sentiment"] for r in lookups.add_polarity(df, "words", lexicon, max_rows=max_rows).collect()}
    assert got[1] == 0.7 and got[2] == pytest.approx(0.05) and got[3] == got[4] == 0 and got[6] == pytest.approx(0.7)
    assert got[5] in (0.0, None)


def test_in_row_lookup_does_not_shuffle_rows(spark):
    lexicon = local_rows(spark, [("good", 0.7)], schemas.LEXICON)
    df = spark.range(10).select(F.array(F.lit("good")).alias("w"))
    plan = plan_of(lookups.add_polarity(df, "w", lexicon))
    outer = plan.split("Subquery")[0]
    assert "Exchange" not in outer and "EvalPython" not in plan


def test_stop_rows(spark):
    words = spark.createDataFrame([("the",), ("cat",), ("the",)], "word string")
    stops = local_rows(spark, [("the",), ("a",)], schemas.STOP_WORDS)
    assert tuples(lookups.drop_stop_rows(words, stops)) == [("cat",)]


def test_valid_records(spark):
    good = {m: "1.5" for m in schemas.RECORD_METRICS}
    rows = [good, {**good, "score": ""}, {**good, "sentiment": None}, {**good, "num_comments": "abc"}, {**good, "score": "1e-3"}]
    names = [c for c in schemas.PUBLISHED_COLUMNS]
    data = [tuple(r.get(c, f"{c}{i}") for c in names) for i, r in enumerate(rows)]
    df = spark.createDataFrame(data, ", ".join(f"{c} string" for c in names))
    valid = quality.valid_records(df)
    assert valid.columns == list(schemas.PUBLISHED_COLUMNS) and len(valid.columns) == 20
    assert sorted(str(r["score"]) for r in valid.collect()) == ["0.001000000", "1.500000000"]
    assert dict(valid.dtypes)["sentiment"] == "decimal(38,9)"


def test_quality(spark):
    df = spark.createDataFrame([("nan", 1.5, 2), ("", None, 1), ("x", 0.1, 0)], "t string, d double, n int")
    assert [r["t"] for r in quality.null_sentinels(df).collect()] == [None, None, "x"]
    assert dict(quality.decimals(df).dtypes) == {"t": "string", "d": "decimal(38,9)", "n": "int"}
    assert quality.decimals(df.select("n")).columns == ["n"]
    assert quality.above(df, "n").count() == 1
    assert quality.one_of(df, "t", ["X", "x"]).count() == 1
    assert quality.contains_ci(df, "t", "NA").count() == 1
    assert quality.all_present(df, "d", "t").count() == 2
    assert [r["d"] for r in quality.defaults(df, {"d": 0.0}).collect()] == [1.5, 0.0, 0.1]


def test_threshold_reaches_the_scan(spark):
    events = spark.read.parquet(f"{SMALL}/events.parquet")
    plan = plan_of(quality.above(events, "value", 50).select("event_id"))
    assert "GreaterThan(value,50.0)" in plan
    assert "ReadSchema: struct<event_id:bigint,value:double>" in plan


def test_unions(spark):
    a = spark.createDataFrame([(1, "x")], "id int, a string")
    b = spark.createDataFrame([("y", 2)], "b string, id int")
    both = shape.union_all([a, b])
    assert both.columns == ["id", "a", "b"] and tuples(both) == [(1, "x", None), (2, None, "y")]
    parts = shape.split_union(both, {"a": ("a", ["id", "a"]), "b": ("b", ["id", "b"])})
    assert tuples(parts["a"]) == tuples(a) and tuples(parts["b"]) == [(2, "y")]


def test_decode_and_encode(spark):
    good = '{"id":"1","score":null,"title":"Zoë","edited":12.5}'
    df = spark.createDataFrame([(good,), ('{"id":',), ("[]",), (None,)], "value string")
    rows = shape.decode(df, schemas.POST_EVENT).collect()
    assert [r["malformed"] for r in rows][:2] == [False, True] and rows[3]["malformed"]
    assert rows[0]["title"] == "Zoë" and rows[0]["score"] is None and rows[0]["edited"] == "12.5"
    assert rows[1]["raw"] == '{"id":'
    encoded = shape.keyed_json(spark.createDataFrame([(7, None)], "id int, t string")).first()
    assert tuple(encoded) == ("7", '{"id":7,"t":null}')


def test_nested_documents(spark):
    route = '{"routes":[{"summary":{"lengthInMeters":0,"travelTimeInSeconds":600,"trafficDelayInSeconds":601}}],"timestamp":"2024-01-07T10:00:00"}'
    docs = spark.createDataFrame([(route,), ('{"routes":[],"timestamp":"x"}',)], "value string")
    rows = route_features(shape.decode(docs, schemas.ROUTE)).collect()
    assert (rows[0]["is_high_traffic"], rows[0]["efficiency_ratio"], rows[0]["day_of_week"]) == (1, None, 6)
    assert (rows[1]["distance_km"], rows[1]["is_high_traffic"], rows[1]["timestamp"]) == (None, 0, None)


def test_documents_are_parsed_once(spark):
    df = spark.createDataFrame([("{}",)], "value string")
    for flat in (
        shape.flight_segments(shape.decode(df, schemas.FLIGHT_OFFER)),
        shape.destinations(shape.decode(df, schemas.FLIGHT_DESTINATIONS)),
    ):
        assert plan_of(flat).count("from_json") == 1
        assert flat.count() == 0


def test_zip_of_uneven_lists(spark):
    df = spark.createDataFrame([(1, ["a", "b"], ["x"])], "id int, l array<string>, r array<string>")
    assert tuples(shape.zip_lists(df, ["id"], ["l", "r"])) == [(1, 0, "a", "x"), (1, 1, "b", None)]


HOURS = (
    "Monday: Closed\nTuesday: 5:00\u2009\u2013\u200910:30\u202fPM\n"
    "Wednesday: 11:30\u202fAM\u2009\u2013\u20092:30\u202fPM, 5:00\u2009\u2013\u200910:00\u202fPM\n"
    "Sunday: 12:00\u202fPM\u2009\u2013\u200912:00\u202fAM"
)


def test_opening_hours(spark):
    df = spark.createDataFrame([(1, HOURS), (2, None)], "id int, hours string")
    assert tuples(shape.opening_shifts(df, "hours", "id")) == sorted(
        [
            (1, "Monday", None, None, True), (1, "Tuesday", "17:00", "22:30", False),
            (1, "Wednesday", "11:30", "14:30", False), (1, "Wednesday", "17:00", "22:00", False),
            (1, "Sunday", "12:00", "00:00", False),
        ],
        key=repr,
    )


def test_markers(spark):
    df = spark.createDataFrame([("A", 1.5, -2.0), ("B", None, 3.0)], "n string, latitude double, longitude double")
    assert [r["value"] for r in shape.markers(df, "n").collect()] == [
        '{"type":"Feature","geometry":{"type":"Point","coordinates":[-2.0,1.5]},"properties":{"name":"A"}}'
    ]
