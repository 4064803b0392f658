"""Unions of unlike frames, nested documents and parallel lists."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Union by column name; columns a frame lacks are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def split_union(df: DataFrame, parts: dict[str, tuple[str, list[str]]]) -> dict[str, DataFrame]:
    """Undo a sparse union: per part, the rows where its marker column is set and its own columns."""
    return {
        name: df.where(F.col(f"`{marker}`").isNotNull()).select(*[F.col(f"`{c}`") for c in columns])
        for name, (marker, columns) in parts.items()
    }


def decode(df: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """JSON text to columns. Malformed text gives a row of NULLs, told apart by ``malformed``."""
    corrupt = "_corrupt_record"
    parsed = F.from_json(
        F.col(value).cast("string"),
        T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())]),
        {"columnNameOfCorruptRecord": corrupt},
    )
    rows = df.select(parsed.alias("_doc"), F.col(value).cast("string").alias("raw"))
    bad = F.col("_doc").isNull() | F.col(f"_doc.{corrupt}").isNotNull()
    return rows.select(*[F.col("_doc")[n].alias(n) for n in schema.names], "raw", bad.alias("malformed"))


def keyed_json(df: DataFrame, key: str = "id") -> DataFrame:
    """Rows as (key, value) messages; NULL fields are written out."""
    body = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    return df.select(F.col(key).cast("string").alias("key"), body.alias("value"))


def zip_lists(df: DataFrame, keep: list[str], lists: list[str]) -> DataFrame:
    """Parallel arrays of one row to one row per position; short lists end in NULLs."""
    zipped = F.arrays_zip(*[F.col(c) for c in lists])
    return df.select(*keep, F.posexplode(zipped).alias("position", "_item")).select(
        *keep, "position", *[F.col("_item")[c].alias(c) for c in lists]
    )


def exploded(df: DataFrame, array: str, out: str, *keep: str | Column) -> DataFrame:
    """One row per array element that is not NULL.

    A plain explode makes the planner test the array's size below, which parses or builds
    the array a second and third time when it is a computed column.
    """
    return df.select(*keep, F.explode_outer(array).alias(out)).where(F.col(out).isNotNull())


def flight_segments(offers: DataFrame, *keep: str) -> DataFrame:
    """Flight offers to one row per segment, with the offer's price on each."""
    trips = exploded(offers, "itineraries", "_trip", *keep, F.col("price.grandTotal").alias("_price"))
    legs = exploded(trips, "_trip.segments", "s", *keep, "_price")
    return legs.select(
        *keep,
        F.col("s.departure.iataCode").alias("origin"),
        F.col("s.arrival.iataCode").alias("destination"),
        F.col("s.departure.at").alias("departure_time"),
        F.col("s.arrival.at").alias("arrival_time"),
        F.col("s.carrierCode").alias("carrier_code"),
        F.col("s.number").alias("flight_number"),
        F.col("_price").try_cast("double").alias("price"),
        F.coalesce("s.stopQuantity", F.lit(0)).alias("num_stops"),
    )


def destinations(response: DataFrame) -> DataFrame:
    """Destination lists to one row per destination."""
    return exploded(response, "data", "d").select(
        F.col("d.origin").alias("Origin"),
        F.col("d.destination").alias("Destination"),
        F.col("d.departureDate").alias("DepartureDate"),
        F.col("d.returnDate").alias("ReturnDate"),
        F.col("d.price.total").alias("Price"),
    )


def weather_rows(docs: DataFrame) -> DataFrame:
    """Weather documents to flat rows; the first condition names the weather."""
    return docs.select(
        F.col("name").alias("city"),
        F.get("weather", F.lit(0))["description"].alias("description"),
        F.col("main.temp").alias("temperature"),
        F.col("main.humidity").alias("humidity"),
        F.col("wind.speed").alias("wind_speed"),
        F.col("main.pressure").alias("pressure"),
        F.col("clouds.all").alias("cloudiness"),
        "timestamp",
    )


def route_rows(docs: DataFrame) -> DataFrame:
    """Route documents to the first route's measures in kilometres and minutes."""
    first: Column = F.get("routes", F.lit(0))["summary"]
    return docs.select(
        "timestamp",
        (first["lengthInMeters"] / 1000).alias("distance_km"),
        (first["travelTimeInSeconds"] / 60).alias("travel_time_min"),
        (first["trafficDelayInSeconds"] / 60).alias("traffic_delay_min"),
    )


def opening_shifts(df: DataFrame, hours: str, *keep: str) -> DataFrame:
    """Weekly opening-hours text to (weekday, opens, closes) rows, several per day if need be.

    A closed day has NULL times, a day and night one 00:00 and 24:00. Where the first time lacks AM/PM it
    takes the second's.
    """
    plain = F.translate(F.col(hours), "\u2009\u202f\u2013", "  -")
    days = df.select(*keep, F.explode(F.split(plain, r"\n")).alias("_day"))
    shifts = days.select(
        *keep,
        F.trim(F.split_part("_day", F.lit(": "), F.lit(1))).alias("weekday"),
        F.explode(F.split(F.regexp_extract("_day", r"^[^:]*: (.*)$", 1), ", ")).alias("_shift"),
    )
    pattern = r"^(\d{1,2}(?::\d{2})?) ?([AP]M)? ?- ?(\d{1,2}(?::\d{2})?) ?([AP]M)?$"
    part = [F.nullif(F.regexp_extract("_shift", pattern, i), F.lit("")) for i in range(1, 5)]
    always = F.trim("_shift") == "Open 24 hours"
    return shifts.select(
        *keep,
        "weekday",
        F.when(always, "00:00").otherwise(_clock(part[0], F.coalesce(part[1], part[3]))).alias("opens"),
        F.when(always, "24:00").otherwise(_clock(part[2], part[3])).alias("closes"),
        (F.trim("_shift") == "Closed").alias("closed"),
    )


def _clock(time: Column, half: Column) -> Column:
    """Time with or without minutes to ``HH:MM``; without AM or PM it is on the 24-hour clock."""
    full = F.when(F.contains(time, F.lit(":")), time).otherwise(F.concat(time, F.lit(":00")))
    noon = F.try_to_timestamp(F.concat_ws(" ", full, half), F.lit("h:mm a"))
    return F.date_format(F.when(half.isNotNull(), noon).otherwise(F.try_to_timestamp(full, F.lit("H:mm"))), "HH:mm")


def markers(df: DataFrame, label: str, latitude: str = "latitude", longitude: str = "longitude") -> DataFrame:
    """One GeoJSON point per row that has both coordinates."""
    geometry = F.struct(
        F.lit("Point").alias("type"), F.array(F.col(longitude), F.col(latitude)).alias("coordinates")
    )
    feature = F.struct(
        F.lit("Feature").alias("type"),
        geometry.alias("geometry"),
        F.struct(F.col(label).alias("name")).alias("properties"),
    )
    return df.dropna(subset=[latitude, longitude]).select(F.to_json(feature).alias("value"))
