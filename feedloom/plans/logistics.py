"""The wide logistics file: unlike records in one sparse table, split into typed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from feedloom.functions import temporal
from feedloom.operators.quality import null_sentinels
from feedloom.operators.shape import split_union

# Per kind of record, the column that marks it and the columns it fills.
PARTS = {
    "offers": (
        "Price",
        ["Price", "Duration", "Departure Time", "Arrival Time", "Airline", "Stops", "Cabin Class"],
    ),
    "cheapest_flights": (
        "Flight Price",
        ["Flight Price", "Flight Duration", "Departure Time", "Arrival Time", "Airline", "Stops",
         "Cabin Class", "Origin", "Destination"],
    ),
    "weather": (
        "Time",
        ["Time", "Temperature (C)", "Max Temperature (C)", "Min Temperature (C)", "Humidity (%)",
         "Weather", "Wind Speed (m/s)", "Wind Direction", "Cloudiness (%)"],
    ),
    "routes": (
        "Distance (meters)",
        ["Start Point", "End Point", "Distance (meters)", "Travel Time (seconds)",
         "Traffic Delay (seconds)", "Average Speed (m/s)", "Traffic Level"],
    ),
}


def split_logistics(wide: DataFrame) -> dict[str, DataFrame]:
    """One typed table per kind of record, texts like ``N/A`` as NULL."""
    return split_union(null_sentinels(wide), PARTS)


def offer_durations(offers: DataFrame) -> DataFrame:
    """The stated duration next to the difference of the local clock times, both in minutes.

    Departure and arrival are airport-local, so the two differ by the zone offset.
    """
    clock = temporal.hours_between("Departure Time", "Arrival Time") * 60
    return offers.withColumns(
        {
            "stated_minutes": temporal.iso_duration_minutes("Duration"),
            "clock_minutes": F.round(clock).cast("bigint"),
        }
    )
