"""Flight operations: landing zone to raw, data model and enriched tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerloom.catalog.tables import DATAMODEL_COLUMNS
from layerloom.functions.times import clock_time, minutes, zone_offset_minutes
from layerloom.operators.tracked import TrackedFrame
from layerloom.workspace import Workspace

# Column names before and after the data model.
FLIGHT_NAMES = {
    "DAY_OF_WEEK": "Weekday",
    "AIRLINE": "Airline_Code",
    "FLIGHT_NUMBER": "Flight_Number",
    "TAIL_NUMBER": "Tail_Number",
    "ORIGIN_AIRPORT": "Origin_Airport",
    "DESTINATION_AIRPORT": "Destination_Airport",
    "DEPARTURE_DELAY": "Departure_Delay",
    "TAXI_OUT": "Taxi_Out",
    "SCHEDULED_TIME": "Scheduled_Time",
    "ELAPSED_TIME": "Elapsed_Time",
    "AIR_TIME": "Air_Time",
    "DISTANCE": "Distance",
    "TAXI_IN": "Taxi_In",
    "ARRIVAL_DELAY": "Arrival_Delay",
    "CANCELLATION_REASON": "Cancellation_Reason",
    "AIR_SYSTEM_DELAY": "Air_System_Delay",
    "SECURITY_DELAY": "Security_Delay",
    "AIRLINE_DELAY": "Airline_Delay",
    "LATE_AIRCRAFT_DELAY": "Late_Aircraft_Delay",
    "WEATHER_DELAY": "Weather_Delay",
}
AIRLINE_NAMES = {"IATA_CODE": "IATA_Airline_Code", "AIRLINE": "Airline"}
AIRPORT_NAMES = {
    "IATA_CODE": "IATA_Airport_Code",
    "AIRPORT": "Airport",
    "CITY": "City",
    "STATE": "State",
    "COUNTRY": "Country",
    "LATITUDE": "Latitude",
    "LONGITUDE": "Longitude",
}


def zone_offsets(zones: DataFrame, as_of: dt.datetime | Column | None = None) -> DataFrame:
    """Add ``TimeZoneOffset``: minutes from UTC at ``as_of`` (default: now)."""
    if as_of is None:
        as_of = F.current_timestamp()
    elif isinstance(as_of, dt.datetime):
        as_of = F.lit(as_of).cast("timestamp")
    return zones.withColumn("TimeZoneOffset", zone_offset_minutes(F.col("TimeZone"), as_of))


def flight_times(flights: DataFrame) -> DataFrame:
    """Derive the date, the six timestamps and the two flags of each flight.

    Needs ``TimeZoneOffset``, the destination offset minus the origin offset; a missing one counts as
    0. Any other missing part (a cancelled flight has no delays) makes the timestamp null.
    """
    year, month, day = F.col("YEAR"), F.col("MONTH"), F.col("DAY")
    scheduled = F.col("Scheduled_Departure_Time")
    shift = minutes(F.coalesce(F.col("TimeZoneOffset"), F.lit(0)))
    departed = scheduled + minutes(F.col("DEPARTURE_DELAY"))
    off = departed + minutes(F.col("TAXI_OUT"))
    on = off + minutes(F.col("AIR_TIME"))
    # Column names ignore case, so the old text columns leave before the new ones arrive.
    base = flights.withColumn(
        "Scheduled_Departure_Time", clock_time(year, month, day, F.col("SCHEDULED_DEPARTURE"))
    ).drop("SCHEDULED_DEPARTURE", "SCHEDULED_ARRIVAL", "DEPARTURE_TIME", "WHEELS_OFF", "WHEELS_ON", "ARRIVAL_TIME")
    return base.withColumns(
        {
            "Flight_Date": F.make_date(year.cast("int"), month.cast("int"), day.cast("int")),
            "Departure_Time": departed,
            "Wheels_Off": off,
            "Wheels_On": on + shift,
            "Arrival_Time": on + minutes(F.col("TAXI_IN")) + shift,
            "Scheduled_Arrival": scheduled + minutes(F.col("SCHEDULED_TIME")) + shift,
            "DIVERTED": F.col("DIVERTED").cast("boolean"),
            "CANCELLED": F.col("CANCELLED").cast("boolean"),
        }
    ).withColumnsRenamed(
        {
            "Scheduled_Departure_Time": "Scheduled_Departure",
            "DIVERTED": "Diverted",
            "CANCELLED": "Cancelled",
        }
    )


def flights_model(flights: TrackedFrame, zones: TrackedFrame) -> TrackedFrame:
    """Flights with local timestamps, looked up twice in the airport offsets."""
    zones = zones.select("Airport", "TimeZoneOffset")
    origin = zones.rename({"TimeZoneOffset": "_origin"})
    destination = zones.rename({"TimeZoneOffset": "_destination"})
    joined = flights.join(origin, left_on="ORIGIN_AIRPORT", right_on="Airport", how="left").join(
        destination, left_on="DESTINATION_AIRPORT", right_on="Airport", how="left"
    )
    offset = (F.col("_destination") - F.col("_origin")).cast("long")
    timed = joined.with_df(flight_times(joined.df.withColumn("TimeZoneOffset", offset)))
    return timed.rename(FLIGHT_NAMES).select(*DATAMODEL_COLUMNS["flights"].names)


def departures(
    flights: TrackedFrame, airports: TrackedFrame, airlines: TrackedFrame
) -> TrackedFrame:
    """Flights, delays and taxi times per day, airline and origin airport."""
    named = (
        flights.select("Flight_Date", "Airline_Code", "Origin_Airport", "Taxi_Out", "Departure_Delay")
        .join(
            airports.select("IATA_Airport_Code", "Airport"),
            left_on="Origin_Airport",
            right_on="IATA_Airport_Code",
            how="left",
        )
        .join(
            airlines.select("IATA_Airline_Code", "Airline"),
            left_on="Airline_Code",
            right_on="IATA_Airline_Code",
            how="left",
        )
    )
    return named.group_by(
        ["Flight_Date", "Airline", "Airport"],
        F.count(F.lit(1)).alias("Amount_Flights"),
        F.avg("Departure_Delay").alias("Average_Delay"),
        F.avg("Taxi_Out").alias("Average_Taxi"),
        F.max("Departure_Delay").alias("Max_Delay"),
        small=True,  # what one airline flies from one airport on one day
    ).rename({"Airline": "Airline_Name", "Airport": "Airport_Name"})


# -- jobs ---------------------------------------------------------------------------------------


def _raw_copy(topic: str) -> Callable[[Workspace, Column | dt.datetime | None], TrackedFrame]:
    return lambda space, as_of: space.read(f"{topic}_landingzone")


def _raw_zones(space: Workspace, as_of: Column | dt.datetime | None) -> TrackedFrame:
    zones = space.read("timezone_landingzone")
    return zones.with_df(zone_offsets(zones.df, as_of))


RAW_TABLES = {
    "flights_raw": _raw_copy("flights"),
    "cancellation_codes_raw": _raw_copy("cancellation_codes"),
    "airlines_raw": _raw_copy("airlines"),
    "airports_raw": _raw_copy("airports"),
    "timezone_raw": _raw_zones,
}
LATER_TABLES: dict[str, Callable[[Workspace], TrackedFrame]] = {
    "flights_datamodel": lambda s: flights_model(s.read("flights_raw"), s.read("timezone_raw")),
    "airlines_datamodel": lambda s: s.read("airlines_raw").rename(AIRLINE_NAMES),
    "airports_datamodel": lambda s: s.read("airports_raw").rename(AIRPORT_NAMES),
    "flight_airport_departures_enriched": lambda s: departures(
        s.read("flights_datamodel"), s.read("airports_datamodel"), s.read("airlines_datamodel")
    ),
}
TABLES = (*RAW_TABLES, *LATER_TABLES)


def generate(
    space: Workspace, table_name: str, as_of: Column | dt.datetime | None = None
) -> TrackedFrame:
    """Build one table from the layer below and store it."""
    if table_name in RAW_TABLES:
        frame = RAW_TABLES[table_name](space, as_of)
    elif table_name in LATER_TABLES:
        frame = LATER_TABLES[table_name](space)
    else:
        raise ValueError(f"No job makes {table_name}: it is not specified")
    return space.frame(table_name, frame).write()
