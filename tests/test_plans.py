"""Whole jobs on small hand-made inputs."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from feedloom import schemas
from feedloom.plans.catalogue import Selectors, listing_rows, venue_catalogue
from feedloom.plans.flights import flight_features, flight_table
from feedloom.plans.observations import weather_features
from feedloom.plans.posts import enrich
from feedloom.operators.shape import decode
from feedloom.sources.readers import local_rows

EVENT = ("1", "ann", "The Good, the BAD!", "x", "2024-01-01 06:00:00", 10, 4, True, "NewS", 0.5, "false", False, "self", False)


def test_enrich(spark):
    late = dt.datetime(2024, 1, 1, 7, 30)
    gaps = ("2", "bob", "Nothing", "x", "2024-01-01 18:00:00", None, None, False, None, None, None, None, None, None)
    bad = ("3", "bob", None, "x", "01.01.2024", 1, 1, False, None, 1.0, None, None, "self", None)
    df = spark.createDataFrame([EVENT, gaps, bad], schemas.POST_EVENT)
    lexicon = local_rows(spark, [("good", 1.0), ("bad", -0.5), ("the", 0.1)], schemas.LEXICON)
    done = {r["id"]: r for r in enrich(df, lexicon, F.lit(late)).collect()}
    one, two, three = done["1"], done["2"], done["3"]
    assert one["title"] == "the good the bad" and one["title_tokens"] == ["good", "bad"]
    # Stop words still count towards the polarity.
    assert one["sentiment"] == pytest.approx((0.1 + 1.0 + 0.1 - 0.5) / 4)
    assert (one["post_age_minutes"], one["popularity_score"]) == (90.0, 7.0)
    assert (one["post_type"], one["time_of_day"], one["flair_text"]) == ("text", "day", "news")
    assert (two["score"], two["num_comments"], two["popularity_score"], two["sentiment"]) == (0, 0, 0.0, 0.0)
    assert (two["post_type"], two["time_of_day"], two["upvote_ratio"]) == ("media", "night", None)
    assert three["created_time"] is None and three["title"] is None


def offer(price, at, stops, carrier="KL"):
    stop = "" if stops is None else f',"stopQuantity":{stops}'
    leg = (
        f'{{"departure":{{"iataCode":"CPT","at":{at}}},"arrival":{{"iataCode":"AMS","at":"2024-11-15T20:00:00"}},'
        f'"carrierCode":"{carrier}","number":"1"{stop}}}'
    )
    return f'{{"itineraries":[{{"segments":[{leg},{leg}]}},{{"segments":[{leg}]}}],"price":{{"grandTotal":"{price}"}}}}'


def test_flights(spark):
    lines = [
        offer("1000.00", '"2024-11-15T08:00:00"', None), offer("1000.00", '"2024-11-15T08:00:00"', None),
        offer("500", "null", 2, "LH"), offer("3000", '"2024-11-15T21:00:00"', 0),
    ]
    offers = decode(spark.createDataFrame([(x,) for x in lines], "value string"), schemas.FLIGHT_OFFER)
    rates = local_rows(spark, [("USD", "ZAR", 10.0)], schemas.RATES)
    table = {r["price"]: r for r in flight_table(offers, rates).collect()}
    # Three segments per offer collapse to one distinct row each, and the repeated offer with them.
    assert len(table) == 3 == flight_table(offers, rates).count()
    assert (table[1000.0]["price_category"], table[1000.0]["duration"]) == ("Moderate", 12.0)
    assert (table[1000.0]["num_stops"], table[1000.0]["is_non_stop"]) == (0, 1)
    assert (table[500.0]["price_category"], table[500.0]["departure_time"], table[500.0]["duration"]) == ("Cheap", None, None)
    assert (table[3000.0]["price_category"], table[3000.0]["duration"]) == ("Expensive", -1.0)
    done = flight_features(offers, rates).select("price", "carrier_index", vector_to_array("scaled_price")[0].alias("s"))
    assert sorted(tuple(r) for r in done.collect()) == [(500.0, 1.0, 0.0), (1000.0, 0.0, 0.2), (3000.0, 0.0, 1.0)]


def test_weather_without_condition(spark):
    doc = '{"name":"Cape Town","weather":[],"main":{"temp":1.5,"humidity":2,"pressure":3},"timestamp":"2024-01-07T23:00:00.5"}'
    row = weather_features(decode(spark.createDataFrame([(doc,)], "value string"), schemas.WEATHER)).first()
    assert (row["city"], row["description"], row["wind_speed"]) == ("Cape Town", None, None)
    assert (row["hour_of_day"], row["day_of_week"]) == (23, 1)


def listing(*entries):
    css = Selectors()
    parts = [
        f'<div class="{css.container}">{head}</div><div class="{css.region}">{region}</div>'
        f'<div class="{css.appellation}">{place}</div>{score}'
        for head, region, place, score in entries
    ]
    return "<html><div class='row'>" + "".join(parts) + "</div></html>"


def test_catalogue(spark):
    score = '<div class="x WineGeneral_--score__5wRg8"> 93 </div>'
    pages = spark.createDataFrame(
        [
            (1, listing(("<h5>A</h5><h6>Brand</h6>", "Napa, CALIFORNIA", "Napa", score), ("<h5>B</h5>", "Oregon", "", ""))),
            (2, listing(("<h5></h5><h6>No title</h6>", "California", "", score), ("<h5>C</h5><h6></h6>", "california", "x", ""))),
            (3, "<html>nothing</html>"),
            (4, None),
        ],
        "page_id long, html string",
    )
    got = [tuple(r)[2:] for r in listing_rows(pages).orderBy("page_id", "position").collect()]
    assert got == [
        ("A", "Brand", "Napa, CALIFORNIA", "Napa", "93"), ("B", None, "Oregon", None, None),
        ("C", None, "california", "x", None),
    ]
    table = venue_catalogue(pages, F.lit("09:00"), F.lit(16), pages_per_slice=1)
    rows = {r["Wine Name"]: r for r in table.collect()}
    assert [rows[n]["Restaurant ID"] for n in "ABC"] == [1, 2, 3]
    assert rows["A"]["Tasting Score"] == "93.0" and 80 <= float(rows["B"]["Tasting Score"]) <= 100
    assert rows["A"]["Closing Time"] == "01:00"
    kept = venue_catalogue(pages, F.lit("09:00"), F.lit(8), place="California")
    assert sorted(r["Wine Name"] for r in kept.collect()) == ["A", "C"]
