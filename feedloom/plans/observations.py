"""Time and traffic features of weather and route observations, for batches and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from feedloom.functions import numeric, temporal
from feedloom.operators.shape import route_rows, weather_rows


def weather_features(docs: DataFrame) -> DataFrame:
    """Flat weather rows with hour and weekday (Sunday is 1)."""
    rows = weather_rows(docs).withColumn("timestamp", temporal.parse_free_iso("timestamp"))
    return rows.withColumns(
        {
            "hour_of_day": F.hour("timestamp"),
            "day_of_week": temporal.weekday_sunday_one("timestamp"),
        }
    )


def route_features(docs: DataFrame) -> DataFrame:
    """First-route measures with traffic flag, minutes per km, hour and weekday (Monday is 0)."""
    rows = route_rows(docs).withColumn("timestamp", temporal.parse_free_iso("timestamp"))
    return rows.withColumns(
        {
            "is_high_traffic": numeric.is_high_traffic("traffic_delay_min"),
            "efficiency_ratio": numeric.efficiency("travel_time_min", "distance_km"),
            "hour_of_day": F.hour("timestamp"),
            "day_of_week": temporal.weekday_monday_zero("timestamp"),
        }
    )
