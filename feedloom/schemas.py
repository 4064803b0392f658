"""Explicit input schemas and the sentinel texts that stand for a missing value."""

from __future__ import annotations

from pyspark.sql import types as T


_TEXT, _LONG, _INT = T.StringType(), T.LongType(), T.IntegerType()
_DOUBLE, _BOOL, _TIME = T.DoubleType(), T.BooleanType(), T.TimestampType()


def _struct(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns])


def _all(kind: T.DataType, *names: str) -> tuple[tuple[str, T.DataType], ...]:
    return tuple((name, kind) for name in names)


# Field names and types of the inputs, and the texts written for "missing".
SENTINELS = ("", "nan", "NaN", "None", "N/A")

POSTS_RAW = _struct(
    *_all(
        _TEXT, "ID", "is_Original", "Flair", "num_comments", "Title", "Subreddit", "Body", "URL",
        "Upvotes", "Comments", "creation_date", "Text", "Sentiment",
    )
)

POST_EVENT = _struct(
    *_all(_TEXT, "id", "author", "title", "subreddit", "created_time"),
    *_all(_LONG, "score", "num_comments"),
    ("is_self_post", _BOOL),
    ("flair_text", _TEXT),
    ("upvote_ratio", _DOUBLE),
    ("edited", _TEXT),
    ("over_18", _BOOL),
    ("thumbnail", _TEXT),
    ("stickied", _BOOL),
)

POST_EVENT_BRIEF = T.StructType(POST_EVENT.fields[:7])

POST_LISTING = _struct(("title", _TEXT), ("score", _LONG), ("url", _TEXT), ("comments", _LONG))

_STOP = _struct(*_all(_TEXT, "iataCode", "at"))
_SEGMENT = _struct(
    ("departure", _STOP),
    ("arrival", _STOP),
    *_all(_TEXT, "carrierCode", "number"),
    ("stopQuantity", _INT),
)
FLIGHT_OFFER = _struct(
    ("itineraries", T.ArrayType(_struct(("segments", T.ArrayType(_SEGMENT))))),
    ("price", _struct(("grandTotal", _TEXT))),
)

_DESTINATION = _struct(
    *_all(_TEXT, "origin", "destination", "departureDate", "returnDate"),
    ("price", _struct(("total", _TEXT))),
)
FLIGHT_DESTINATIONS = _struct(("data", T.ArrayType(_DESTINATION)))

WEATHER = _struct(
    ("name", _TEXT),
    ("weather", T.ArrayType(_struct(("description", _TEXT)))),
    ("main", _struct(("temp", _DOUBLE), *_all(_INT, "humidity", "pressure"))),
    ("wind", _struct(("speed", _DOUBLE))),
    ("clouds", _struct(("all", _INT))),
    ("timestamp", _TEXT),
)

_SUMMARY = _struct(*_all(_LONG, "lengthInMeters", "travelTimeInSeconds", "trafficDelayInSeconds"))
ROUTE = _struct(
    ("routes", T.ArrayType(_struct(("summary", _SUMMARY)))),
    ("timestamp", _TEXT),
)

LOGISTICS_WIDE = _struct(
    ("Price", _DOUBLE),
    ("Duration", _TEXT),
    *_all(_TIME, "Departure Time", "Arrival Time"),
    ("Airline", _TEXT),
    ("Stops", _DOUBLE),
    ("Cabin Class", _TEXT),
    ("Flight Price", _DOUBLE),
    *_all(_TEXT, "Flight Duration", "Origin", "Destination"),
    ("Time", _TIME),
    *_all(_DOUBLE, "Temperature (C)", "Max Temperature (C)", "Min Temperature (C)", "Humidity (%)"),
    ("Weather", _TEXT),
    *_all(_DOUBLE, "Wind Speed (m/s)", "Wind Direction", "Cloudiness (%)"),
    *_all(_TEXT, "Start Point", "End Point"),
    *_all(_DOUBLE, "Distance (meters)", "Travel Time (seconds)", "Traffic Delay (seconds)"),
    *_all(_TEXT, "Average Speed (m/s)", "Traffic Level"),
)

RESTAURANTS = _struct(
    ("City", _TEXT),
    ("Timestamp", _TIME),
    *_all(_TEXT, "Restaurant Name", "Address"),
    *_all(_DOUBLE, "Latitude", "Longitude"),
    *_all(_TEXT, "Opening Hours", "Wine Type", "Supplier", "Quality Tier"),
    ("Quantity Available", _INT),
)

WINE_CATALOGUE = _struct(
    ("Restaurant ID", _INT),
    *_all(_TEXT, "Wine Name", "Wine Type"),
    ("Wine Price", _DOUBLE),
    *_all(_TEXT, "Company Name", "Location", "Tasting Score", "Opening Time", "Closing Time"),
)

WINE_LOCATIONS = T.StructType(
    [*WINE_CATALOGUE.fields, *_struct(*_all(_DOUBLE, "latitude", "longitude")).fields]
)

RATES = _struct(*_all(_TEXT, "from_currency", "to_currency"), ("rate", _DOUBLE))
GAZETTEER = _struct(("name", _TEXT), *_all(_DOUBLE, "latitude", "longitude"))
LEXICON = _struct(("word", _TEXT), ("polarity", _DOUBLE))
STOP_WORDS = _struct(("word", _TEXT))

# The metrics a stored record must hold as numbers, and its published columns.
RECORD_METRICS = (
    "sentiment", "upvote_ratio", "author_activity_count", "score", "num_comments",
    "post_age_minutes", "popularity_score",
)
PUBLISHED_COLUMNS = (
    "created_time", "sentiment", "upvote_ratio", "thumbnail", "author_activity_count", "edited",
    "over_18", "author", "title", "subreddit", "score", "num_comments", "is_self_post", "stickied",
    "time_of_day", "post_type", "id", "post_age_minutes", "popularity_score", "flair_text",
)
