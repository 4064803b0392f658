"""Flights, routes, places and nested documents."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from feedloom import schemas
from feedloom.functions import numeric, temporal
from feedloom.operators import aggregates as agg
from feedloom.operators import lookups, quality, scaling, shape
from feedloom.plans import flights as flight_plans
from feedloom.plans import observations
from feedloom.queries.registry import query, spread_table, table
from feedloom.queries.views import FLIGHTS, RATES_SQL, ROUTES, flights, rates, routes
from feedloom.sources.readers import local_rows


@query(f"""
WITH {FLIGHTS} SELECT order_id, price, (epoch(arrival) - epoch(departure)) / 3600 AS duration FROM flights
""")
def flight_duration_hours(spark, folder):
    duration = temporal.hours_between("departure", "arrival").alias("duration")
    return flights(spark, folder).select("order_id", "price", duration)


@query(f"""
WITH {FLIGHTS} SELECT CASE WHEN price < 10000 THEN 'Cheap' WHEN price BETWEEN 10000 AND 20000 THEN 'Moderate'
  ELSE 'Expensive' END AS price_category, count(*) AS count FROM flights GROUP BY 1
""")
def price_bucket(spark, folder):
    bucketed = table(spark, folder, "lineitem").join(
        table(spark, folder, "orders"), F.col("l_orderkey") == F.col("o_orderkey"), "left_semi"
    )
    return agg.count_by(
        bucketed.select(numeric.price_bucket("l_extendedprice").alias("price_category")), "price_category"
    )


@query(f"""
WITH {FLIGHTS} SELECT order_id, num_stops, CASE WHEN num_stops = 0 THEN 1 ELSE 0 END AS is_non_stop FROM flights
""")
def non_stop_flag(spark, folder):
    return flights(spark, folder).select("order_id", "num_stops", numeric.is_non_stop("num_stops").alias("is_non_stop"))


@query(f"""
WITH {ROUTES} SELECT route_id, CASE WHEN traffic_delay_min > 10 THEN 1 ELSE 0 END AS is_high_traffic FROM routes
""")
def high_traffic_flag(spark, folder):
    return routes(spark, folder).select("route_id", numeric.is_high_traffic("traffic_delay_min").alias("is_high_traffic"))


@query(f"""
WITH {ROUTES} SELECT route_id, travel_time_min / nullif(distance_km - 1, 0) AS efficiency_ratio,
  distance_km * 1000 / 1000 AS km, travel_time_min * 60 / 60 AS minutes, round(travel_time_min * 2) / 2 AS half_minutes
FROM routes
""")
def efficiency_ratio(spark, folder):
    return routes(spark, folder).select(
        "route_id",
        numeric.efficiency(F.col("travel_time_min"), F.col("distance_km") - 1).alias("efficiency_ratio"),
        numeric.km(F.col("distance_km") * 1000).alias("km"),
        numeric.minutes(F.col("travel_time_min") * 60).alias("minutes"),
        (F.round(F.col("travel_time_min") * 2) / 2).alias("half_minutes"),
    )


@query(f"""
WITH {RATES_SQL} SELECT o_orderkey, CAST(o_totalprice AS DOUBLE) * coalesce(rate, 1.0::DOUBLE) AS price_in_zar,
  rate IS NOT NULL AS converted FROM orders LEFT JOIN rates ON o_orderstatus = from_currency
""")
def currency_convert(spark, folder):
    priced = table(spark, folder, "orders").select(
        "o_orderkey", "o_orderstatus", F.col("o_totalprice").cast("string").alias("text_price")
    ).withColumn("price", numeric.safe_double("text_price"))
    done = lookups.convert_currency(priced, rates(spark), "price", "o_orderstatus")
    return done.select("o_orderkey", "price_in_zar", "converted")


_PLACES = """
places AS (SELECT n_name AS name, n_nationkey * 2.5::DOUBLE - 30 AS latitude, n_nationkey * 5.25::DOUBLE - 60 AS longitude
           FROM nation WHERE n_regionkey <> 2)"""


def _places(spark, folder):
    """A gazetteer without the places of one region."""
    return table(spark, folder, "nation").where("n_regionkey <> 2").select(
        F.col("n_name").alias("name"),
        (F.col("n_nationkey") * F.lit(2.5) - 30).alias("latitude"),
        (F.col("n_nationkey") * F.lit(5.25) - 60).alias("longitude"),
    )


def _located(spark, folder):
    venues = table(spark, folder, "supplier").join(
        table(spark, folder, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    ).select("s_suppkey", F.col("s_name").alias("company"), F.col("n_name").alias("place"))
    return lookups.geocode(venues, _places(spark, folder), "place")


_LOCATED = f"""
{_PLACES}, located AS (
  SELECT s_suppkey, s_name AS company, n_name AS place, latitude, longitude
  FROM supplier JOIN nation ON s_nationkey = n_nationkey LEFT JOIN places ON n_name = name)"""


@query(f"WITH {_LOCATED} SELECT * FROM located")
def geocode_lookup(spark, folder):
    return _located(spark, folder)


@query(f"WITH {_LOCATED} SELECT s_suppkey, latitude, longitude FROM located WHERE latitude IS NOT NULL AND longitude IS NOT NULL")
def not_null_pair(spark, folder):
    return quality.all_present(_located(spark, folder), "latitude", "longitude").select("s_suppkey", "latitude", "longitude")


@query(f"""
WITH {_LOCATED} SELECT '{{"type":"Feature","geometry":{{"type":"Point","coordinates":[' || longitude || ',' || latitude
  || ']}},"properties":{{"name":"' || company || '"}}}}' AS value FROM located WHERE latitude IS NOT NULL
""")
def map_markers(spark, folder):
    return shape.markers(_located(spark, folder), "company")


_SPARSE_SQL = """
SELECT 'customer' AS kind, CAST(c_custkey AS VARCHAR) AS c_key, c_mktsegment AS segment, NULL AS s_key, c_acctbal AS balance FROM customer
UNION ALL SELECT 'supplier', NULL, NULL, CAST(s_suppkey AS VARCHAR), s_acctbal FROM supplier
UNION ALL SELECT 'part', NULL, NULL, NULL, NULL FROM part"""


def _sparse(spark, folder):
    customer = table(spark, folder, "customer").select(
        F.lit("customer").alias("kind"), F.col("c_custkey").cast("string").alias("c_key"),
        F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance"),
    )
    supplier = table(spark, folder, "supplier").select(
        F.lit("supplier").alias("kind"), F.col("s_suppkey").cast("string").alias("s_key"), F.col("s_acctbal").alias("balance")
    )
    part = table(spark, folder, "part").select(F.lit("part").alias("kind"))
    return shape.union_all([customer, supplier, part])


@query(_SPARSE_SQL)
def union_by_name_sparse(spark, folder):
    return _sparse(spark, folder)


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS key, c_acctbal AS balance, 'customer' AS source FROM customer
UNION ALL SELECT CAST(s_suppkey AS VARCHAR), s_acctbal, 'supplier' FROM supplier
""")
def split_sparse_union(spark, folder):
    parts = shape.split_union(
        _sparse(spark, folder),
        {"customer": ("c_key", ["c_key", "balance"]), "supplier": ("s_key", ["s_key", "balance"])},
    )
    return shape.union_all(
        [df.withColumnRenamed(df.columns[0], "key").withColumn("source", F.lit(n)) for n, df in parts.items()]
    )


_INDEX = """
labels AS (SELECT carrier, count(*) AS count FROM flights GROUP BY 1),
indexed AS (SELECT carrier, count, row_number() OVER (ORDER BY count DESC, carrier) - 1 AS index FROM labels)"""


@query(f"WITH {FLIGHTS}, {_INDEX} SELECT carrier, count, index FROM indexed")
def category_index(spark, folder):
    return scaling.category_index(flights(spark, folder).select("carrier"), "carrier")


@query("SELECT min(value) + 0.0::DOUBLE AS min, max(value) + 0.0::DOUBLE AS max FROM events")
def min_max(spark, folder):
    """Bounds of a column; adding zero turns -0.0 into 0.0, which compare as equal."""
    bounds = scaling.min_max(table(spark, folder, "events"), "value")
    return bounds.select(*[(F.col(c) + F.lit(0.0)).alias(c) for c in bounds.columns])


@query("""
SELECT event_id, round((value - min(value) OVER ()) / (max(value) OVER () - min(value) OVER ()), 9) AS scaled,
       0.5::DOUBLE AS constant FROM events
""")
def scaled_price(spark, folder):
    events = table(spark, folder, "events").select("event_id", "value", F.lit(7.0).alias("same"))
    done = scaling.scale(scaling.scale(events, "value", "scaled"), "same", "constant")
    return done.select("event_id", F.round("scaled", 9).alias("scaled"), "constant")


@query("""
SELECT l_orderkey, l_linenumber,
       CASE l_linenumber % 3 WHEN 0 THEN CAST(l_quantity AS BIGINT) * 60
            WHEN 1 THEN CAST(l_quantity AS BIGINT) ELSE CAST(l_quantity AS BIGINT) * 60 + l_linenumber END AS minutes,
       true AS rejected
FROM lineitem
""")
def iso_duration(spark, folder):
    """Durations written from order lines in hours, minutes and mixed form, then parsed."""
    n = F.col("l_quantity").cast("bigint")
    form = F.col("l_linenumber") % 3
    written = (
        F.when(form == 0, F.format_string("PT%dH", n))
        .when(form == 1, F.format_string("PT%dM", n))
        .otherwise(F.format_string("PT%dH%dM", n, "l_linenumber"))
    )
    return spread_table(spark, folder, "lineitem", "l_orderkey", "l_linenumber", "l_quantity").select(
        "l_orderkey",
        "l_linenumber",
        temporal.iso_duration_minutes(written).alias("minutes"),
        temporal.iso_duration_minutes(F.concat(F.lit("P1D"), written)).isNull().alias("rejected"),
    )


@query("""
WITH base AS (SELECT s_suppkey, 1 + s_suppkey % 5 AS o, 6 + s_suppkey % 5 AS c FROM supplier)
SELECT s_suppkey, 'Monday' AS weekday, NULL AS opens, NULL AS closes, true AS closed FROM base
UNION ALL SELECT s_suppkey, 'Tuesday', printf('%02d:00', o + 12), printf('%02d:30', c + 12), false FROM base
UNION ALL SELECT s_suppkey, 'Wednesday', printf('%02d:00', o + 6), printf('%02d:15', o + 12), false FROM base
UNION ALL SELECT s_suppkey, 'Wednesday', printf('%02d:00', c + 12), '00:00', false FROM base
""")
def opening_hours(spark, folder):
    """Opening-hours texts written from supplier rows (thin spaces, dashes, two shifts), then parsed."""
    text = (
        "Monday: Closed\nTuesday: %1$d:00\u2009\u2013\u2009%2$d:30\u202fPM\n"
        "Wednesday: %3$d:00\u202fAM\u2009\u2013\u2009%1$d:15\u202fPM, %2$d:00\u202fPM\u2009\u2013\u200912:00\u202fAM"
    )
    opens, closes = F.col("s_suppkey") % 5 + 1, F.col("s_suppkey") % 5 + 6
    hours = F.format_string(text, opens, closes, opens + 6).alias("hours")
    return shape.opening_shifts(table(spark, folder, "supplier").select("s_suppkey", hours), "hours", "s_suppkey")


@query("""
SELECT l_orderkey, l_linenumber, printf('%02d:%02d', h, m) AS opening,
       printf('%02d:%02d', ((h + add_h) % 24)::BIGINT, m) AS closing
FROM (SELECT l_orderkey, l_linenumber, (l_suppkey % 24)::BIGINT AS h, (l_partkey % 60)::BIGINT AS m,
             8 + l_linenumber AS add_h FROM lineitem)
""")
def closing_time(spark, folder):
    opening = F.format_string("%02d:%02d", F.col("l_suppkey") % 24, F.col("l_partkey") % 60)
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", opening.alias("opening"),
        temporal.closing_time(opening, F.col("l_linenumber") + 8).alias("closing"),
    )


def _offers(spark, folder):
    """One offer message per order: two trips, the first of two segments; some stop counts are absent."""
    at = F.date_format("o_orderdate", temporal.ISO_STAMP)
    later = F.date_format(F.col("o_orderdate") + F.expr("INTERVAL 5 HOURS 30 MINUTES"), temporal.ISO_STAMP)

    def leg(origin, destination, stops):
        return F.struct(
            F.struct(F.lit(origin).alias("iataCode"), F.when(F.col("o_orderkey") % 11 != 0, at).alias("at")).alias("departure"),
            F.struct(F.lit(destination).alias("iataCode"), later.alias("at")).alias("arrival"),
            F.substring("o_orderpriority", 3, 3).alias("carrierCode"),
            F.col("o_orderkey").cast("string").alias("number"),
            stops.alias("stopQuantity"),
        )

    present, absent = F.when(F.col("o_orderkey") % 2 == 0, 1), F.lit(None).cast("int")
    trips = F.array(
        F.struct(F.array(leg("CPT", "AMS", present), leg("AMS", "LAX", absent)).alias("segments")),
        F.struct(F.array(leg("CPT", "LAX", F.lit(2))).alias("segments")),
    )
    body = F.struct(trips.alias("itineraries"), F.struct(F.col("o_totalprice").cast("string").alias("grandTotal")).alias("price"))
    orders = spread_table(spark, folder, "orders", "o_orderkey", "o_orderdate", "o_orderpriority", "o_totalprice")
    return orders.select(F.to_json(body).alias("value"))


_SEGMENTS = """
segments AS (
  SELECT s.origin, s.destination, CASE WHEN o_orderkey % 11 <> 0 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') END
           AS departure_time,
         strftime(o_orderdate + INTERVAL 330 MINUTE, '%Y-%m-%dT%H:%M:%S') AS arrival_time,
         substring(o_orderpriority, 3, 3) AS carrier_code, CAST(o_orderkey AS VARCHAR) AS flight_number,
         o_totalprice AS price, CASE s.leg WHEN 1 THEN 1 - o_orderkey % 2 WHEN 2 THEN 0 ELSE 2 END AS num_stops
  FROM orders, (VALUES (1, 'CPT', 'AMS'), (2, 'AMS', 'LAX'), (3, 'CPT', 'LAX')) AS s(leg, origin, destination))"""


@query(f"WITH {_SEGMENTS} SELECT * FROM segments")
def flight_segments(spark, folder):
    offers = shape.decode(_offers(spark, folder), schemas.FLIGHT_OFFER)
    return shape.flight_segments(offers).withColumn("num_stops", F.col("num_stops").cast("bigint"))


@query(f"""
WITH {_SEGMENTS}, priced AS (SELECT DISTINCT *, price * 18.5::DOUBLE AS price_in_zar FROM segments),
labels AS (SELECT carrier_code, row_number() OVER (ORDER BY count(*) DESC, carrier_code) - 1 AS idx FROM priced GROUP BY 1)
SELECT origin, destination, flight_number, strftime(CAST(departure_time AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS departure_time,
  price_in_zar, CASE WHEN price_in_zar < 10000 THEN 'Cheap' WHEN price_in_zar <= 20000 THEN 'Moderate' ELSE 'Expensive' END
    AS price_category,
  CASE WHEN departure_time IS NOT NULL THEN 5.5::DOUBLE END AS duration,
  CASE WHEN num_stops = 0 THEN 1 ELSE 0 END AS is_non_stop, CAST(idx AS DOUBLE) AS carrier_index,
  round((price_in_zar - min(price_in_zar) OVER ()) / (max(price_in_zar) OVER () - min(price_in_zar) OVER ()), 9) AS scaled_price
FROM priced JOIN labels USING (carrier_code)
""")
def flight_features(spark, folder):
    offers = shape.decode(_offers(spark, folder), schemas.FLIGHT_OFFER)
    dollars = local_rows(spark, [("USD", "ZAR", 18.5)], schemas.RATES)
    done = flight_plans.flight_features(offers, dollars)
    return done.select(
        "origin", "destination", "flight_number",
        F.date_format("departure_time", temporal.STAMP).alias("departure_time"),
        "price_in_zar", "price_category", "duration", "is_non_stop", "carrier_index",
        F.round(vector_to_array("scaled_price")[0], 9).alias("scaled_price"),
    )


@query("""
SELECT 'PAR' AS "Origin", n_name AS "Destination", strftime(o_orderdate, '%Y-%m-%d') AS "DepartureDate",
       strftime(o_orderdate + INTERVAL 7 DAY, '%Y-%m-%d') AS "ReturnDate", CAST(o_totalprice AS VARCHAR) AS "Price"
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
UNION ALL SELECT 'PAR', o_orderpriority, strftime(o_orderdate, '%Y-%m-%d'), NULL, '1.5' FROM orders
JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
""")
def destinations_flatten(spark, folder):
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    back = F.date_format(F.date_add("o_orderdate", 7), "yyyy-MM-dd")

    def item(place, returned, price):
        return F.struct(
            F.lit("PAR").alias("origin"), place.alias("destination"), day.alias("departureDate"),
            returned.alias("returnDate"), F.struct(price.alias("total")).alias("price"),
        )

    trips = table(spark, folder, "orders").join(
        table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey")
    ).join(table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    listed = F.array(
        item(F.col("n_name"), back, F.col("o_totalprice").cast("string")),
        item(F.col("o_orderpriority"), F.lit(None).cast("string"), F.lit("1.5")),
    )
    messages = trips.select(F.to_json(F.struct(listed.alias("data"))).alias("value"))
    return shape.destinations(shape.decode(messages, schemas.FLIGHT_DESTINATIONS))


def weather_documents(spark, folder):
    """Events as weather documents; a third of them carry no condition."""
    doc = F.struct(
        F.col("event_type").alias("name"),
        F.when(F.col("event_id") % 3 != 0, F.array(
            F.struct(F.lit("overcast clouds").alias("description")), F.struct(F.lit("mist").alias("description"))
        )).otherwise(F.array().cast("array<struct<description:string>>")).alias("weather"),
        F.struct(F.col("value").alias("temp"), F.lit(75).alias("humidity"), F.lit(1013).alias("pressure")).alias("main"),
        F.struct((F.col("value") / 4).alias("speed")).alias("wind"),
        F.struct((F.col("user_id") % 100).cast("int").alias("all")).alias("clouds"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
    )
    columns = ("event_id", "event_type", "value", "user_id", "ts")
    return spread_table(spark, folder, "events", *columns).select(F.to_json(doc).alias("value"))


WEATHER_SQL = """
SELECT event_type AS city, CASE WHEN event_id % 3 <> 0 THEN 'overcast clouds' END AS description, value AS temperature,
       75::BIGINT AS humidity, value / 4 AS wind_speed, 1013::BIGINT AS pressure, user_id % 100 AS cloudiness,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS observed, hour(ts) AS hour_of_day, dayofweek(ts) + 1 AS day_of_week
FROM events"""


def weather_columns(df):
    return df.select(
        "city", "description", "temperature", F.col("humidity").cast("bigint").alias("humidity"), "wind_speed",
        F.col("pressure").cast("bigint").alias("pressure"), F.col("cloudiness").cast("bigint").alias("cloudiness"),
        F.date_format("timestamp", temporal.STAMP).alias("observed"),
        F.col("hour_of_day").cast("bigint").alias("hour_of_day"), F.col("day_of_week").cast("bigint").alias("day_of_week"),
    )


@query(WEATHER_SQL)
def weather_flatten(spark, folder):
    docs = shape.decode(weather_documents(spark, folder), schemas.WEATHER)
    return weather_columns(observations.weather_features(docs))


def route_documents(spark, folder):
    """Order lines as route documents; the first route counts, and some lists are empty."""
    def summary(factor):
        return F.struct(F.struct(
            (F.col("l_quantity") * 100 * factor).cast("bigint").alias("lengthInMeters"),
            (F.col("l_linenumber") * 600).cast("bigint").alias("travelTimeInSeconds"),
            (F.col("l_linenumber") * 200).cast("bigint").alias("trafficDelayInSeconds"),
        ).alias("summary"))

    empty = F.array_remove(F.array(summary(0)), summary(0))
    routes_ = F.when(F.col("l_partkey") % 10 == 0, empty).otherwise(F.array(summary(F.col("l_suppkey") % 2), summary(9)))
    doc = F.struct(routes_.alias("routes"), F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"))
    columns = ("l_quantity", "l_linenumber", "l_suppkey", "l_partkey", "l_shipdate")
    return spread_table(spark, folder, "lineitem", *columns).select(F.to_json(doc).alias("value"))


ROUTE_SQL = """
WITH measured AS (
  SELECT strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS observed, hour(l_shipdate) AS hour_of_day,
         isodow(l_shipdate) - 1 AS day_of_week, l_partkey % 10 <> 0 AS present,
         CAST(l_quantity * 100 * (l_suppkey % 2) AS BIGINT) AS m, l_linenumber AS n FROM lineitem)
SELECT observed, hour_of_day, day_of_week, CASE WHEN present THEN m / 1000.0::DOUBLE END AS distance_km,
  CASE WHEN present THEN n * 600 / 60.0::DOUBLE END AS travel_time_min,
  CASE WHEN present THEN n * 200 / 60.0::DOUBLE END AS traffic_delay_min,
  CASE WHEN present AND n * 200 / 60.0::DOUBLE > 10 THEN 1 ELSE 0 END AS is_high_traffic,
  CASE WHEN present THEN (n * 600 / 60.0::DOUBLE) / nullif(m / 1000.0::DOUBLE, 0) END AS efficiency_ratio
FROM measured"""


def route_columns(df):
    return df.select(
        F.date_format("timestamp", temporal.STAMP).alias("observed"),
        F.col("hour_of_day").cast("bigint").alias("hour_of_day"), F.col("day_of_week").cast("bigint").alias("day_of_week"),
        "distance_km", "travel_time_min", "traffic_delay_min", "is_high_traffic", "efficiency_ratio",
    )


@query(ROUTE_SQL)
def route_summary(spark, folder):
    docs = shape.decode(route_documents(spark, folder), schemas.ROUTE)
    return route_columns(observations.route_features(docs))
