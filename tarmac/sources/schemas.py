"""Explicit schemas of the source files. Columns are matched by header name, not by position."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


_I, _S, _D = T.IntegerType(), T.StringType(), T.DoubleType()

AIRLINES = _struct(IATA_CODE=_S, AIRLINE=_S)

AIRPORTS = _struct(
    IATA_CODE=_S, AIRPORT=_S, CITY=_S, STATE=_S, COUNTRY=_S, LATITUDE=_D, LONGITUDE=_D
)

# Clock columns stay text (HHMM); they are parsed by tarmac.functions.clocks.
FLIGHTS = _struct(
    YEAR=_I,
    MONTH=_I,
    DAY=_I,
    DAY_OF_WEEK=_I,
    AIRLINE=_S,
    FLIGHT_NUMBER=_I,
    TAIL_NUMBER=_S,
    ORIGIN_AIRPORT=_S,
    DESTINATION_AIRPORT=_S,
    SCHEDULED_DEPARTURE=_S,
    DEPARTURE_TIME=_S,
    DEPARTURE_DELAY=_D,
    TAXI_OUT=_D,
    WHEELS_OFF=_S,
    SCHEDULED_TIME=_D,
    ELAPSED_TIME=_D,
    AIR_TIME=_D,
    DISTANCE=_I,
    WHEELS_ON=_S,
    TAXI_IN=_D,
    SCHEDULED_ARRIVAL=_S,
    ARRIVAL_TIME=_S,
    ARRIVAL_DELAY=_D,
    DIVERTED=_I,
    CANCELLED=_I,
    CANCELLATION_REASON=_S,
    AIR_SYSTEM_DELAY=_D,
    SECURITY_DELAY=_D,
    AIRLINE_DELAY=_D,
    LATE_AIRCRAFT_DELAY=_D,
    WEATHER_DELAY=_D,
)

CIRCUITS = _struct(
    circuitId=_I, circuitRef=_S, name=_S, location=_S, country=_S, lat=_D, lng=_D, alt=_I, url=_S
)

CONSTRUCTORS = _struct(constructorId=_I, constructorRef=_S, name=_S, nationality=_S, url=_S)

REQUIRED = {
    "airlines": ["IATA_CODE", "AIRLINE"],
    "airports": ["IATA_CODE", "AIRPORT", "CITY", "STATE", "COUNTRY"],
    "flights": [
        "YEAR", "MONTH", "DAY", "AIRLINE", "ORIGIN_AIRPORT", "DESTINATION_AIRPORT", "SCHEDULED_DEPARTURE",
    ],
}

# Fields without which a flight record cannot be placed in the star schema.
CRITICAL = ["YEAR", "MONTH", "DAY", "AIRLINE", "ORIGIN_AIRPORT", "DESTINATION_AIRPORT"]
