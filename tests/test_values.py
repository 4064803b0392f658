"""Time, number and HTML expressions on boundary values."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from feedloom.functions import html, numeric, temporal
from feedloom.schemas import SENTINELS
from tests.conftest import value


@pytest.mark.parametrize(
    "parse,raw,ok",
    [
        (temporal.parse_stamp, "2024-03-01 05:06:07", True),
        (temporal.parse_stamp, "2024-03-01 05:06:07.5", False),
        (temporal.parse_stamp, "unknown", False),
        (temporal.parse_iso, "2024-03-01T05:06:07", True),
        (temporal.parse_iso, "2024-03-01 05:06:07", False),
        (temporal.parse_free_iso, "2024-03-01T05:06:07.250Z", True),
        (temporal.parse_free_iso, "soon", False),
    ],
)
def test_parsing(spark, parse, raw, ok):
    got = value(spark, parse(F.lit(raw)))
    assert (got is not None) == ok
    if ok:
        assert got.replace(microsecond=0) == dt.datetime(2024, 3, 1, 5, 6, 7)


def test_epoch(spark):
    assert value(spark, temporal.epoch_to_text(F.lit(86400))) == "1970-01-02 00:00:00"
    assert value(spark, temporal.epoch_to_text(F.lit(0))) is None
    assert value(spark, temporal.epoch_to_text(F.lit(None).cast("bigint"))) is None


@pytest.mark.parametrize("hour,want", [(5, "night"), (6, "day"), (17, "day"), (18, "night")])
def test_time_of_day(spark, hour, want):
    assert value(spark, temporal.time_of_day(F.lit(dt.datetime(2024, 1, 1, hour)))) == want


def test_weekdays(spark):
    sunday = F.lit(dt.datetime(2024, 1, 7))
    assert value(spark, temporal.weekday_sunday_one(sunday)) == 1
    assert value(spark, temporal.weekday_monday_zero(sunday)) == 6


def test_durations(spark):
    start, end = F.lit(dt.datetime(2024, 12, 1, 18, 25)), F.lit(dt.datetime(2024, 12, 2, 12, 45))
    assert value(spark, temporal.hours_between(start, end)) == pytest.approx(18 + 20 / 60)
    assert value(spark, temporal.hours_between(end, start)) < 0
    assert value(spark, temporal.age_minutes(start, end)) == 1100


@pytest.mark.parametrize(
    "raw,want",
    [("PT28H20M", 1700), ("PT5H", 300), ("PT45M", 45), ("PT", None), ("P1DT2H", None), ("", None), (None, None)],
)
def test_iso_duration(spark, raw, want):
    assert value(spark, temporal.iso_duration_minutes(F.lit(raw).cast("string"))) == want


@pytest.mark.parametrize(
    "opening,hours,want", [("08:30", 9, "17:30"), ("16:00", 8, "00:00"), ("09:00", 16, "01:00"), ("NaN", 3, None)]
)
def test_closing_time(spark, opening, hours, want):
    assert value(spark, temporal.closing_time(F.lit(opening), F.lit(hours))) == want


@pytest.mark.parametrize("raw,want", [("12", 12), ("12.0", 12), ("abc", None), ("nan", None), ("", None), (" 7 ", 7), (None, None)])
def test_safe_int(spark, raw, want):
    assert value(spark, numeric.safe_int(F.lit(raw).cast("string"))) == want


@pytest.mark.parametrize("raw,want", [("0.1234567895", "0.123456790"), ("1e-3", "0.001000000"), (" 1 ", "1.000000000"), ("", None), ("abc", None)])
def test_safe_decimal(spark, raw, want):
    got = value(spark, numeric.safe_decimal(F.lit(raw)))
    assert (None if got is None else str(got)) == want


@pytest.mark.parametrize("price,want", [(9999.99, "Cheap"), (10000.0, "Moderate"), (20000.0, "Moderate"), (20000.01, "Expensive"), (None, "Expensive")])
def test_price_bucket(spark, price, want):
    assert value(spark, numeric.price_bucket(F.lit(price).cast("double"))) == want


def test_flags(spark):
    assert [value(spark, numeric.is_high_traffic(F.lit(m).cast("double"))) for m in (10.0, 10.01, None)] == [0, 1, 0]
    assert [value(spark, numeric.is_non_stop(F.lit(n).cast("int"))) for n in (0, 1, None)] == [1, 0, 0]
    assert [value(spark, numeric.post_type(F.lit(t).cast("string"))) for t in ("self", "http://t", None)] == ["text", "media", "media"]


def test_efficiency_of_no_distance(spark):
    assert value(spark, numeric.efficiency(F.lit(5.0), F.lit(0.0))) is None
    assert value(spark, numeric.km(F.lit(1500))) == 1.5 and value(spark, numeric.minutes(F.lit(90))) == 1.5


def test_imputed_score(spark):
    df = spark.range(200).select(numeric.imputed_score(F.lit(None).cast("double"), "id").alias("s"))
    scores = [r["s"] for r in df.collect()]
    assert all(80 <= s <= 100 and round(s, 1) == s for s in scores) and len(set(scores)) > 50
    assert scores == [r["s"] for r in df.collect()]
    assert value(spark, numeric.imputed_score(F.lit(91.5), F.lit("k"))) == 91.5


def test_sentinels(spark):
    got = [value(spark, numeric.nulled(F.lit(s), SENTINELS)) for s in (*SENTINELS, "ok")]
    assert got == [None] * len(SENTINELS) + ["ok"]


PAGE = """<html><div class="x box y"><a><h5> Big <b>Red</b>&amp;Co </h5></a><h6></h6></div><p class="box">p</p>
<div class="box other"><h5></h5></div><div class="a b">AB</div><div class="b a">BA</div></html>"""


def test_blocks(spark):
    assert len(value(spark, html.blocks(F.lit(PAGE), "div", "box"))) == 2
    assert value(spark, html.blocks(F.lit(PAGE), "div", "a b")) == ["AB"]
    assert value(spark, html.blocks(F.lit(PAGE), "div", "bo")) == []
    assert value(spark, html.first_block(F.lit(PAGE), "table")) is None
    assert len(value(spark, html.sections(F.lit(PAGE), "div", "box"))) == 2
    assert value(spark, html.attributes(F.lit(PAGE), "p", "class")) == ["box"]


@pytest.mark.parametrize(
    "raw,want",
    [(" Big <b>Red</b>&amp;Co ", "BigRed&Co"), ("  ", None), ("<i></i>", None), ("&nbsp;x&nbsp;", "x"), ("a &lt;b&gt;", "a <b>")],
)
def test_node_text(spark, raw, want):
    assert value(spark, html.node_text(F.lit(raw))) == want


def test_durations_too_long_to_count_are_null(spark):
    for text, want in (("PT" + "9" * 25 + "H5M", None), ("PT5H" + "9" * 25 + "M", None), ("PT2H5M", 125), ("PT7M", 7), ("PT3H", 180), ("PT", None), ("PT9223372036854775807H", None)):
        assert value(spark, temporal.iso_duration_minutes(F.lit(text))) == want
