"""Flight jobs on orders and lines dressed as flights."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerloom import Workspace
from layerloom.constants import LINEAGE, OPEN_END
from layerloom.operators.tracked import TrackedFrame
from layerloom.operators.writing import stored_edges
from layerloom.plans import flights
from queries.common import load, load_tracked, own_folder, tracked, with_source_counts

ZONES = ["America/New_York", "Europe/Amsterdam", "Asia/Kolkata", "UTC", "America/Los_Angeles"]
AS_OF = dt.datetime(2024, 7, 1, 12, 0)


def _zone(key: str) -> Column:
    return F.element_at(F.array(*[F.lit(z) for z in ZONES]), F.col(key) % len(ZONES) + 1)


def _zone_sql(key: str) -> str:
    return f"[{', '.join(repr(z) for z in ZONES)}][{key} % {len(ZONES)} + 1]"


def _offset_sql(zone: str, instant: str) -> str:
    """Minutes between the local clock of a zone and UTC."""
    return f"""cast(round(epoch((({instant}) AT TIME ZONE 'UTC') AT TIME ZONE ({zone})
                 - ({instant})) / 60) AS bigint)"""


def zone_offsets(spark: SparkSession, folder: str) -> DataFrame:
    """Offset of the customer's zone on the day of each order, summer time included."""
    orders = load(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customers = load(spark, folder, "customer").select("c_custkey", _zone("c_nationkey").alias("TimeZone"))
    joined = orders.join(customers, orders.o_custkey == customers.c_custkey)
    placed = F.col("o_orderdate").cast("timestamp")
    return flights.zone_offsets(joined, placed).select("o_orderkey", "TimeZone", "TimeZoneOffset")


ZONE_OFFSETS_SQL = f"""
WITH j AS (SELECT o_orderkey, o_orderdate, {_zone_sql("c_nationkey")} AS "TimeZone"
           FROM orders JOIN customer ON o_custkey = c_custkey)
SELECT o_orderkey, "TimeZone", {_offset_sql('"TimeZone"', "o_orderdate")} AS "TimeZoneOffset" FROM j
"""


def _airport_zones(spark: SparkSession, folder: str) -> TrackedFrame:
    """Customers as airports; those of one segment have no known zone."""
    customers = load(spark, folder, "customer").where("c_mktsegment <> 'BUILDING'")
    zones = customers.select(
        F.col("c_custkey").cast("string").alias("Airport"), _zone("c_nationkey").alias("TimeZone")
    )
    return tracked(flights.zone_offsets(zones, AS_OF), "timezone_raw", "Airport")


def _raw_flights(spark: SparkSession, folder: str) -> TrackedFrame:
    """Orders as flights: hours run to 24, every fifth priority is a cancelled flight."""
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    day = F.col("o_orderdate")
    cancelled = F.col("o_orderpriority") == "5-LOW"

    def if_flown(value: Column) -> Column:
        return F.when(~cancelled, value.cast("bigint"))

    def number(value: Column) -> Column:
        return value.cast("bigint")

    clock = F.concat(
        F.lpad((customer % 25).cast("string"), 2, "0"), F.lpad((key % 60).cast("string"), 2, "0")
    )
    raw = load(spark, folder, "orders").select(
        number(F.year(day)).alias("YEAR"),
        number(F.month(day)).alias("MONTH"),
        number(F.day(day)).alias("DAY"),
        number(F.weekday(day) + 1).alias("DAY_OF_WEEK"),
        F.substring("o_orderpriority", 3, 2).alias("AIRLINE"),
        key.cast("string").alias("FLIGHT_NUMBER"),
        F.concat(F.lit("N"), customer.cast("string")).alias("TAIL_NUMBER"),
        customer.cast("string").alias("ORIGIN_AIRPORT"),
        (key % 2000).cast("string").alias("DESTINATION_AIRPORT"),
        clock.alias("SCHEDULED_DEPARTURE"),
        clock.alias("DEPARTURE_TIME"),
        if_flown(key % 90 - 20).alias("DEPARTURE_DELAY"),
        if_flown(customer % 30).alias("TAXI_OUT"),
        clock.alias("WHEELS_OFF"),
        number(key % 300 + 40).alias("SCHEDULED_TIME"),
        if_flown(key % 310 + 40).alias("ELAPSED_TIME"),
        if_flown(key % 280 + 30).alias("AIR_TIME"),
        number(key % 2500).alias("DISTANCE"),
        clock.alias("WHEELS_ON"),
        if_flown(key % 15).alias("TAXI_IN"),
        clock.alias("SCHEDULED_ARRIVAL"),
        clock.alias("ARRIVAL_TIME"),
        if_flown(key % 100 - 30).alias("ARRIVAL_DELAY"),
        number(F.when(F.col("o_orderstatus") == "P", 1).otherwise(0)).alias("DIVERTED"),
        number(F.when(cancelled, 1).otherwise(0)).alias("CANCELLED"),
        F.when(cancelled, "B").alias("CANCELLATION_REASON"),
        *[
            F.lit(None).cast("bigint").alias(f"{cause}_DELAY")
            for cause in ("AIR_SYSTEM", "SECURITY", "AIRLINE", "LATE_AIRCRAFT", "WEATHER")
        ],
    )
    return tracked(raw, "flights_raw", "FLIGHT_NUMBER")


def flight_times(spark: SparkSession, folder: str) -> DataFrame:
    model = flights.flights_model(_raw_flights(spark, folder), _airport_zones(spark, folder))
    return model.df.select(
        "Flight_Number",
        "Flight_Date",
        "Weekday",
        "Scheduled_Departure",
        "Departure_Time",
        "Wheels_Off",
        "Wheels_On",
        "Arrival_Time",
        "Scheduled_Arrival",
        "Diverted",
        "Cancelled",
        F.size(LINEAGE).alias("n_sources"),
    )


FLIGHT_TIMES_SQL = f"""
WITH z AS (SELECT c_custkey, {_offset_sql(_zone_sql("c_nationkey"), f"timestamp '{AS_OF}'")} AS zone_offset
           FROM customer WHERE c_mktsegment <> 'BUILDING'),
f AS (SELECT o.*, o_orderpriority <> '5-LOW' AS flown, cast(o_orderdate AS date) AS day,
             origin.c_custkey AS a, destination.c_custkey AS b,
             to_minutes(cast(coalesce(destination.zone_offset - origin.zone_offset, 0) AS integer)) AS shift
      FROM orders o LEFT JOIN z origin ON o_custkey = origin.c_custkey
      LEFT JOIN z destination ON o_orderkey % 2000 = destination.c_custkey),
s AS (SELECT *, CASE WHEN o_custkey % 25 < 24 THEN cast(day AS timestamp)
        + to_hours(cast(o_custkey % 25 AS integer)) + to_minutes(cast(o_orderkey % 60 AS integer)) END AS base FROM f),
d AS (SELECT *, CASE WHEN flown THEN base + to_minutes(cast(o_orderkey % 90 - 20 AS integer)) END AS departed FROM s),
w AS (SELECT *, departed + to_minutes(cast(o_custkey % 30 AS integer)) AS off FROM d),
n AS (SELECT *, off + to_minutes(cast(o_orderkey % 280 + 30 AS integer)) AS landed FROM w)
SELECT cast(o_orderkey AS varchar) AS "Flight_Number", day AS "Flight_Date", isodow(day) AS "Weekday",
       base AS "Scheduled_Departure", departed AS "Departure_Time", off AS "Wheels_Off",
       landed + shift AS "Wheels_On",
       landed + to_minutes(cast(o_orderkey % 15 AS integer)) + shift AS "Arrival_Time",
       base + to_minutes(cast(o_orderkey % 300 + 40 AS integer)) + shift AS "Scheduled_Arrival",
       o_orderstatus = 'P' AS "Diverted", NOT flown AS "Cancelled",
       cast(1 + (a IS NOT NULL)::integer + (b IS NOT NULL AND b IS DISTINCT FROM a)::integer AS integer) AS n_sources
FROM n
"""


def departures(spark: SparkSession, folder: str) -> DataFrame:
    """Lines as flights: parts are airports, suppliers airlines, returned lines cancelled."""
    lines = load_tracked(spark, folder, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    flown = F.col("l_returnflag") != "R"
    model = lines.with_columns(
        Flight_Date=F.col("l_shipdate").cast("date"),
        Airline_Code=F.nullif(F.col("l_suppkey"), F.lit(3)).cast("string"),
        Origin_Airport=F.col("l_partkey").cast("string"),
        Taxi_Out=F.when(flown, F.col("l_quantity").cast("bigint")),
        Departure_Delay=F.when(flown, F.round(F.col("l_discount") * 100).cast("bigint") - 5),
    )
    airports = load_tracked(spark, folder, "part", "p_partkey").with_columns(
        IATA_Airport_Code=F.col("p_partkey").cast("string"), Airport=F.col("p_brand")
    )
    airlines = load_tracked(spark, folder, "supplier", "s_suppkey").with_columns(
        IATA_Airline_Code=F.col("s_suppkey").cast("string"), Airline=F.col("s_name")
    )
    keys = ["Flight_Date", "Airline_Name", "Airport_Name"]
    return with_source_counts(
        flights.departures(model, airports, airlines), keys, "lineitem", "part", "supplier"
    )


DEPARTURES_SQL = """
WITH m AS (SELECT *, cast(l_shipdate AS date) AS day,
                  CASE WHEN l_returnflag <> 'R' THEN cast(round(l_discount * 100) AS bigint) - 5 END AS delay,
                  CASE WHEN l_returnflag <> 'R' THEN cast(l_quantity AS bigint) END AS taxi
           FROM lineitem LEFT JOIN part ON l_partkey = p_partkey
           LEFT JOIN supplier ON nullif(l_suppkey, 3) = s_suppkey)
SELECT day AS "Flight_Date", s_name AS "Airline_Name", p_brand AS "Airport_Name", count(*) AS "Amount_Flights",
       avg(delay) AS "Average_Delay", avg(taxi) AS "Average_Taxi", max(delay) AS "Max_Delay",
       count(DISTINCT (l_orderkey, l_linenumber, l_partkey, l_suppkey)) AS n_lineitem,
       count(DISTINCT p_partkey) AS n_part, count(DISTINCT s_suppkey) AS n_supplier
FROM m GROUP BY 1, 2, 3
"""


def flight_chain(spark: SparkSession, folder: str) -> DataFrame:
    """Landing files to the enriched table through every job, each table written, checked and read again."""
    space = Workspace(spark, own_folder(spark), processing_date=AS_OF.date())
    customers, orders = load(spark, folder, "customer"), load(spark, folder, "orders")
    code = F.col("c_custkey").cast("string")
    airline = F.substring("o_orderpriority", 3, 2)
    landing = {
        "flights": _raw_flights(spark, folder).data,
        "airlines": orders.select(airline.alias("IATA_CODE"), F.concat(F.lit("Airline "), airline).alias("AIRLINE")).distinct(),
        "airports": customers.select(
            code.alias("IATA_CODE"),
            F.col("c_name").alias("AIRPORT"),
            F.col("c_mktsegment").alias("CITY"),
            F.lit("NA").alias("STATE"),
            F.col("c_nationkey").cast("string").alias("COUNTRY"),
            F.lit(1).cast("decimal(25,10)").alias("LATITUDE"),
            F.lit(None).cast("decimal(25,10)").alias("LONGITUDE"),
        ),
        "cancellation_codes": orders.select(
            airline.alias("CANCELLATION_REASON"), F.col("o_orderpriority").alias("CANCELLATION_DESCRIPTION")
        ).distinct(),
        "timezone": customers.select(code.alias("Airport"), _zone("c_nationkey").alias("TimeZone")),
    }
    for topic, rows in landing.items():
        rows.write.option("header", True).csv(space.path(space.catalog.find(f"{topic}_landingzone")))
    for table in flights.TABLES:
        flights.generate(space, table, AS_OF)
    stored = space.read("flight_airport_departures_enriched").data
    edges = stored_edges(space, "flight_airport_departures_enriched")
    # Record ids are SHA-256: half as many bytes as digits.
    sources = edges.groupBy(F.unhex("target_RecordID").alias("_id")).agg(
        *[
            F.count_if(F.col("source_table_name") == f"{topic}_datamodel").alias(f"n_{topic}")
            for topic in ("flights", "airports", "airlines")
        ]
    )
    return stored.withColumn("_id", F.unhex("RecordID")).drop("RecordID").join(sources, "_id").drop("_id")


FLIGHT_CHAIN_SQL = f"""
SELECT cast(o_orderdate AS date) AS "Flight_Date", 'Airline ' || substr(o_orderpriority, 3, 2) AS "Airline_Name",
       c_name AS "Airport_Name", count(*) AS "Amount_Flights",
       avg(CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderkey % 90 - 20 END) AS "Average_Delay",
       avg(CASE WHEN o_orderpriority <> '5-LOW' THEN o_custkey % 30 END) AS "Average_Taxi",
       max(CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderkey % 90 - 20 END) AS "Max_Delay",
       date '{AS_OF.date()}' AS from_date, date '{OPEN_END}' AS to_date, count(*) AS n_flights,
       count(DISTINCT c_custkey) AS n_airports, cast(1 AS bigint) AS n_airlines
FROM orders LEFT JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3
"""


QUERIES = {
    "flight_chain": (flight_chain, FLIGHT_CHAIN_SQL),
    "zone_offsets": (zone_offsets, ZONE_OFFSETS_SQL),
    "flight_times": (flight_times, FLIGHT_TIMES_SQL),
    "departures": (departures, DEPARTURES_SQL),
}
