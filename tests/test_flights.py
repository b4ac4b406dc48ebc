import datetime as dt

import pytest
from pyspark.sql import functions as F

from layerloom.plans import flights
from tests.conftest import rows

AS_OF = dt.datetime(2024, 1, 15, 12, 0)
HEADER = (
    "YEAR,MONTH,DAY,DAY_OF_WEEK,AIRLINE,FLIGHT_NUMBER,TAIL_NUMBER,ORIGIN_AIRPORT,DESTINATION_AIRPORT,"
    "SCHEDULED_DEPARTURE,DEPARTURE_TIME,DEPARTURE_DELAY,TAXI_OUT,WHEELS_OFF,SCHEDULED_TIME,ELAPSED_TIME,"
    "AIR_TIME,DISTANCE,WHEELS_ON,TAXI_IN,SCHEDULED_ARRIVAL,ARRIVAL_TIME,ARRIVAL_DELAY,DIVERTED,CANCELLED,"
    "CANCELLATION_REASON,AIR_SYSTEM_DELAY,SECURITY_DELAY,AIRLINE_DELAY,LATE_AIRCRAFT_DELAY,WEATHER_DELAY"
)
FLIGHTS = [
    "2015,1,1,4,AA,10,N3KUAA,JFK,LAX,0930,0925,-5,15,0940,360,350,330,2475,1210,5,1230,1215,-15,0,0,,,,,,",
    "2015,1,1,4,AA,11,N3KUAB,LAX,JFK,2350,0010,20,10,0020,300,290,275,2475,0755,5,0750,0800,10,0,0,,1,2,3,4,5",
    "2015,1,2,5,UA,12,N3KUAC,JFK,XXX,1200,,,,,100,,,500,,,1340,,,0,1,A,,,,,",
    "2015,1,2,5,UA,13,NA,JFK,LAX,2400,2405,5,10,2415,360,350,330,2475,1210,5,1230,1215,-15,1,0,,,,,,",
]
FILES = {
    "flights": "\n".join([HEADER, *FLIGHTS]) + "\n",
    "airlines": "IATA_CODE,AIRLINE\nAA,American\nUA,United\n",
    "airports": (
        "IATA_CODE,AIRPORT,CITY,STATE,COUNTRY,LATITUDE,LONGITUDE\n"
        "JFK,Kennedy,New York,NY,USA,40.63975,-73.77893\nLAX,Los Angeles,Los Angeles,CA,USA,33.94254,-118.40807\n"
    ),
    "cancellation_codes": "CANCELLATION_REASON,CANCELLATION_DESCRIPTION\nA,Carrier\nB,Weather\n",
    "timezone": "Airport,TimeZone\nJFK,America/New_York\nLAX,America/Los_Angeles\n",
}


@pytest.fixture
def landed(space):
    for topic, text in FILES.items():
        with open(f"{space.root}/testing/landingzone/{topic}.csv", "w") as file:
            file.write(text)
    return space


def test_zone_offsets(spark):
    zones = spark.createDataFrame(
        [("a", "America/New_York"), ("b", "Asia/Kolkata"), ("c", None)], "Airport string, TimeZone string"
    )
    winter = flights.zone_offsets(zones, AS_OF)
    assert rows(winter, "Airport", "TimeZoneOffset") == [("a", -300), ("b", 330), ("c", None)]
    summer = flights.zone_offsets(zones, dt.datetime(2024, 7, 1))
    assert rows(summer, "Airport", "TimeZoneOffset")[0] == ("a", -240)
    assert flights.zone_offsets(zones).schema["TimeZoneOffset"].dataType.simpleString() == "bigint"


def test_all_tables_end_to_end(landed):
    for name in flights.TABLES:
        stored = flights.generate(landed, name, AS_OF)
        assert stored.name == name
    model = {r.Flight_Number: r for r in landed.read("flights_datamodel").df.collect()}
    assert len(model) == 4

    first = model["10"]
    assert first.Flight_Date == dt.date(2015, 1, 1)
    assert first.Scheduled_Departure == dt.datetime(2015, 1, 1, 9, 30)
    assert first.Departure_Time == dt.datetime(2015, 1, 1, 9, 25)
    assert first.Wheels_Off == dt.datetime(2015, 1, 1, 9, 40)
    assert first.Wheels_On == dt.datetime(2015, 1, 1, 12, 10)
    assert first.Arrival_Time == dt.datetime(2015, 1, 1, 12, 15)
    assert first.Scheduled_Arrival == dt.datetime(2015, 1, 1, 12, 30)
    assert (first.Diverted, first.Cancelled) == (False, False)
    assert model["11"].Arrival_Time == dt.datetime(2015, 1, 2, 8, 0)
    assert model["11"].Weather_Delay == 5

    cancelled = model["12"]
    assert cancelled.Scheduled_Arrival == dt.datetime(2015, 1, 2, 13, 40)
    assert cancelled.Departure_Time is None and cancelled.Cancelled is True
    assert model["13"].Scheduled_Departure is None and model["13"].Tail_Number is None

    departures = landed.read("flight_airport_departures_enriched").df
    assert rows(departures.drop("_lineage", "RecordID", "from_date", "to_date")) == [
        (dt.date(2015, 1, 1), "American", "Kennedy", 1, -5.0, 15.0, -5),
        (dt.date(2015, 1, 1), "American", "Los Angeles", 1, 20.0, 10.0, 20),
        (dt.date(2015, 1, 2), "United", "Kennedy", 2, 5.0, 10.0, 5),
    ]

    edges = landed.read("record_tracing", "flight_airport_departures_enriched").df
    counts = edges.groupBy("source_table_name").agg(F.count(F.lit(1)).alias("n"))
    assert rows(counts) == [("airlines_datamodel", 3), ("airports_datamodel", 3), ("flights_datamodel", 4)]
    sources = landed.read("record_tracing", "flights_datamodel").df.select("source_table_name").distinct()
    assert rows(sources) == [("flights_raw",), ("timezone_raw",)]

    metrics = landed.read("monitoring_values", "flights_datamodel").df
    found = {(r.check_id, r.column_name): (r.total_count, r.valid_count) for r in metrics.collect()}
    assert found[("dq_10", "all")] == (4, 3)
    assert found[("dq_7", "Flight_Date,Flight_Number")] == (4, 4)
    assert found[("dq_5", "Tail_Number")] == (4, 3)
    assert found[("dq_1", "Tail_Number")] == (4, 3)
    airports = landed.read("monitoring_values", "airports_datamodel").df
    assert {r.check_name for r in airports.collect()} >= {
        'values within list of: "USA"',
        "values between -90 and 90",
        "unique values in column `IATA_Airport_Code`",
    }


def test_rerun_changes_nothing(landed):
    for _ in range(2):
        flights.generate(landed, "airlines_raw")
    assert landed.read("airlines_raw", history="complete").df.count() == 2


def test_gate_of_raw_flights(landed):
    with open(f"{landed.root}/testing/landingzone/flights.csv", "a") as file:
        file.write(FLIGHTS[0].replace("2015,", "1905,", 1) + "\n")
    with pytest.raises(ValueError, match="values in range"):
        flights.generate(landed, "flights_raw")


def test_unknown_table_raises(space):
    with pytest.raises(ValueError, match="not specified"):
        flights.generate(space, "cargo_raw")
