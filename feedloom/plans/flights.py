"""Flight features from nested offers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from feedloom.functions import numeric, temporal
from feedloom.operators.lookups import convert_currency
from feedloom.operators.scaling import fit_features
from feedloom.operators.shape import flight_segments
from feedloom.session import pinned


def flight_table(offers: DataFrame, rates: DataFrame, currency: str | None = None) -> DataFrame:
    """Distinct segments with price in ZAR, price bucket, duration and non-stop flag.

    Offers are priced in USD unless ``currency`` names a column of theirs.
    """
    if currency is None:
        offers, currency = offers.withColumn("currency", F.lit("USD")), "currency"
    priced = convert_currency(flight_segments(offers, currency), rates, "price", currency)
    # A missing departure is filled before duplicates are dropped, then parses to NULL again.
    filled = priced.fillna({"price_in_zar": 0, "departure_time": "unknown"}).dropDuplicates()
    return filled.withColumns(
        {
            "departure_time": temporal.parse_iso("departure_time"),
            "arrival_time": temporal.parse_iso("arrival_time"),
            "price_category": numeric.price_bucket("price_in_zar"),
            "is_non_stop": numeric.is_non_stop("num_stops"),
        }
    ).withColumn("duration", temporal.hours_between("departure_time", "arrival_time"))


def flight_features(offers: DataFrame, rates: DataFrame, currency: str | None = None) -> DataFrame:
    """Flight table plus carrier index and scaled price.

    The table is written once; fitting then reads single columns of it instead of
    flattening and deduplicating the offers again for every stage.
    """
    flights = pinned(flight_table(offers, rates, currency), "flights")
    return fit_features(flights, "carrier_code", "price_in_zar")
