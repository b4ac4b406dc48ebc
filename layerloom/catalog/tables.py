"""The shipped table definitions: flight operations and monitoring."""

from __future__ import annotations

from pyspark.sql import types as T

from layerloom.catalog import TableDef, struct_of, with_history
from layerloom.catalog.rules import signalling_rules

# Column names, types, gates and file names of the public flight data set.
LANDING_COLUMNS = {
    "airports": struct_of(
        """
        string  IATA_CODE AIRPORT CITY STATE COUNTRY
        decimal LATITUDE LONGITUDE
        """
    ),
    "airlines": struct_of("string IATA_CODE AIRLINE"),
    "cancellation_codes": struct_of("string CANCELLATION_REASON CANCELLATION_DESCRIPTION"),
    "timezone": struct_of("string Airport TimeZone"),
    "flights": struct_of(
        """
        long   YEAR MONTH DAY DAY_OF_WEEK
        string AIRLINE FLIGHT_NUMBER TAIL_NUMBER ORIGIN_AIRPORT DESTINATION_AIRPORT
        string SCHEDULED_DEPARTURE DEPARTURE_TIME
        long   DEPARTURE_DELAY TAXI_OUT
        string WHEELS_OFF
        long   SCHEDULED_TIME ELAPSED_TIME AIR_TIME DISTANCE
        string WHEELS_ON
        long   TAXI_IN
        string SCHEDULED_ARRIVAL ARRIVAL_TIME
        long   ARRIVAL_DELAY DIVERTED CANCELLED
        string CANCELLATION_REASON
        long   AIR_SYSTEM_DELAY SECURITY_DELAY AIRLINE_DELAY LATE_AIRCRAFT_DELAY WEATHER_DELAY
        """
    ),
}

DATAMODEL_COLUMNS = {
    "flights": struct_of(
        """
        date      Flight_Date
        long      Weekday
        string    Airline_Code Flight_Number Tail_Number Origin_Airport Destination_Airport
        timestamp Scheduled_Departure Departure_Time
        long      Departure_Delay Taxi_Out
        timestamp Wheels_Off
        long      Scheduled_Time Elapsed_Time Air_Time Distance
        timestamp Wheels_On
        long      Taxi_In
        timestamp Scheduled_Arrival Arrival_Time
        long      Arrival_Delay
        boolean   Diverted Cancelled
        string    Cancellation_Reason
        long      Air_System_Delay Security_Delay Airline_Delay Late_Aircraft_Delay Weather_Delay
        """
    ),
    "airports": struct_of(
        """
        string  IATA_Airport_Code Airport City State Country
        decimal Latitude Longitude
        """
    ),
    "airlines": struct_of("string IATA_Airline_Code Airline"),
}

DEPARTURES_COLUMNS = struct_of(
    """
    date   Flight_Date
    string Airline_Name Airport_Name
    long   Amount_Flights
    double Average_Delay Average_Taxi
    long   Max_Delay
    """
)

BLOCKING_CHECKS = {
    "airports_raw": ({"check": "values are unique", "columns": ["IATA_CODE"]},),
    "flights_raw": (
        {"check": "values in range", "columns": ["YEAR"], "range_start": 1980, "range_end": 2025},
        {"check": "values have format", "columns": ["AIRLINE"], "format": r"[A-Z0-9]{2}"},
    ),
    "airports_datamodel": ({"check": "values are unique", "columns": ["IATA_Airport_Code"]},),
}

METRIC_COLUMNS = struct_of(
    """
    long   signalling_id
    string check_id column_name check_name
    long   total_count valid_count
    """
)

EDGE_COLUMNS = struct_of("string source_RecordID source_table_name target_RecordID")


def _table(topic: str, layer: str, columns: T.StructType) -> TableDef:
    name = f"{topic}_{layer}"
    landing = layer == "landingzone"
    return TableDef(
        name=name,
        layer=f"{layer}_layer",
        container=layer,
        location=f"{topic}.csv" if landing else topic,
        file_format="csv" if landing else "parquet",
        columns=columns if landing else with_history(columns),
        quality_checks=BLOCKING_CHECKS.get(name, ()),
        signalling_checks=signalling_rules(name),
    )


def shipped_tables() -> list[TableDef]:
    offset = T.StructField("TimeZoneOffset", T.LongType())
    tables = [_table(t, "landingzone", c) for t, c in LANDING_COLUMNS.items()]
    for topic, columns in LANDING_COLUMNS.items():
        raw = T.StructType([*columns.fields, offset]) if topic == "timezone" else columns
        tables.append(_table(topic, "raw", raw))
    tables += [_table(t, "datamodel", c) for t, c in DATAMODEL_COLUMNS.items()]
    tables.append(_table("flight_airport_departures", "enriched", DEPARTURES_COLUMNS))
    tables += [
        TableDef(
            "monitoring_values",
            "monitoring_layer",
            "monitoring",
            "monitoring_values",
            "parquet",
            with_history(METRIC_COLUMNS),
            partition_column="table_name",
        ),
        TableDef(
            "record_tracing",
            "monitoring_layer",
            "monitoring",
            "record_tracing",
            "parquet",
            EDGE_COLUMNS,
            partition_column="target_table_name",
        ),
    ]
    return tables
