from __future__ import annotations

import re
import string

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import functions as F

from feedloom.functions import text
from feedloom.functions.stemmer import stem, stem_tokens, stem_word
from feedloom.functions.wordlists import BODY_STOP_WORDS, TITLE_STOP_WORDS
from feedloom.plans.posts import text_features
from tests.conftest import plan_of, value


def brute_clean(body):
    for pattern, replacement in text.BODY_RULES:
        body = re.sub(pattern, replacement.replace("\\", "\\\\"), body, flags=re.ASCII)
    return body.lower()


CLEAN = {
    "Hello, World!  2 cats": "hello world cats",
    "see https://a.b/c?d=1 and www.x.org now": "see website and website now",
    "café \U0001f600 déjà": "caf dj",
    "tab\there\nand \\u00e9 there": "tab here and there",
    "anything at all, write to me@site.com": "emailaddress",
    "me@site.com is first": "me@site com is first",
    "#tag @name": "#tag @name",
    "   ": "",
    "123": "",
}


@pytest.mark.parametrize("raw,want", CLEAN.items())
def test_clean_post(spark, raw, want):
    assert value(spark, text.clean_post(F.lit(raw))) == want


def test_clean_keeps_null(spark):
    assert value(spark, text.strip_stop_words(text.clean_post(F.lit(None).cast("string")))) is None


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet=string.printable + "é’中\\@", max_size=60), min_size=1, max_size=30))
def test_clean_matches_brute_force(spark, bodies):
    df = spark.createDataFrame([(b,) for b in bodies], "body string")
    got = [r["c"] for r in df.select(text.clean_post("body").alias("c")).collect()]
    # A final line break ends "$" differently between engines only for whole-text addresses.
    pairs = [(g, brute_clean(b)) for g, b in zip(got, bodies) if "@" not in b]
    assert all(g == w for g, w in pairs)


def test_clean_is_idempotent(spark):
    once = text.clean_post(F.lit("Some TEXT, with 3 odd--bits & https://x.y"))
    assert value(spark, text.clean_post(once)) == value(spark, once)


def test_stop_words(spark):
    assert value(spark, text.strip_stop_words(F.lit("the cat is on the mat"))) == "cat mat"
    assert value(spark, text.strip_stop_words(F.lit("the is"))) == ""
    assert len(BODY_STOP_WORDS) == 179 and len(TITLE_STOP_WORDS) == 174


def test_title_list_is_the_default_list_less_seven(spark):
    default = set(StopWordsRemover.loadDefaultStopWords("english"))
    assert default - set(TITLE_STOP_WORDS) == {"can", "don", "just", "now", "s", "t", "will"}
    assert set(TITLE_STOP_WORDS) <= default


@pytest.mark.parametrize(
    "raw,title,tokens",
    [
        ("Can't STOP, won't_stop! Été 42", "cant stop wont_stop été 42",
         ["cant", "stop", "wont_stop", "été", "42"]),
        ("The Best of", "the best of", ["best"]),
        ("", "", []),
    ],
)
def test_title(spark, raw, title, tokens):
    assert value(spark, text.normalise_title(F.lit(raw))) == title
    assert value(spark, text.title_tokens(text.normalise_title(F.lit(raw)))) == tokens
    python = re.sub(r"[^\w\s]", "", raw.lower())
    assert python == title and [w for w in python.split() if w not in TITLE_STOP_WORDS] == tokens


def test_punctuation_and_tokens(spark):
    bare = text.strip_punctuation(F.lit("I Cannot, (really) #wanna go_"))
    assert value(spark, bare) == "i cannot really wanna go"
    assert value(spark, text.word_tokens(bare)) == ["i", "can", "not", "really", "wan", "na", "go"]


STEMS = """
consign consign|consigned consign|consistency consist|consolations consol|consolatory consolatori
conspiracy conspiraci|conspirators conspir|constancy constanc|knackeries knackeri|knavish knavish
kneeling kneel|knightly knight|knitted knit|hoping hope|hopping hop|happily happili
generously generous|relational relat|cries cri|ties tie|gas gas|this this|agreed agre|feed feed
luxuriated luxuri|skies sky|dying die|news news|innings inning|proceed proceed|apologies apolog
easily easili|university univers|communism communism|by by|saying say|youth youth
""".replace("\n", "|").split("|")


@pytest.mark.parametrize("pair", [p for p in STEMS if p])
def test_stem(pair):
    word, want = pair.split()
    assert stem(word) == want


def test_stem_columns(spark):
    df = spark.createDataFrame([(["running", "cats"], "flies"), ([], None), (None, "a")], "t array<string>, w string")
    got = df.select(stem_tokens("t").alias("t"), stem_word("w").alias("w")).collect()
    assert [tuple(r) for r in got] == [(["run", "cat"], "fli"), ([], None), (None, "a")]


def test_text_features(spark):
    df = spark.createDataFrame([(1, "The cats cannot be running, really!")], "id int, Body string")
    row = text_features(df).first()
    assert row["cleaned_body"] == "cats cannot running really"
    assert row["tokens"] == ["cats", "can", "not", "running", "really"]
    assert row["stems"] == ["cat", "can", "not", "run", "realli"]
    assert row["tokens_nostop"] == ["cats", "running", "really"]


def test_text_chain_needs_no_python(spark):
    df = spark.createDataFrame([("x",)], "body string")
    plan = plan_of(df.select(text.strip_stop_words(text.clean_post("body"))))
    assert "EvalPython" not in plan


def test_addresses(spark):
    url = F.lit("https://site.example/search/page/1/3")
    assert value(spark, text.page_url(url, F.lit(27))) == "https://site.example/search/page/27/3"
    assert value(spark, text.key_in_bucket(F.lit("s3://results/temp/q.csv"), "results")) == "temp/q.csv"
