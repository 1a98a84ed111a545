"""Hand-written flight records."""

from tarmac.sources.schemas import FLIGHTS

DEFAULT = {
    "YEAR": 2015, "MONTH": 1, "DAY": 5, "DAY_OF_WEEK": 1, "AIRLINE": "AA", "FLIGHT_NUMBER": 1,
    "TAIL_NUMBER": "N1", "ORIGIN_AIRPORT": "P0", "DESTINATION_AIRPORT": "P1",
    "SCHEDULED_DEPARTURE": "0900", "DEPARTURE_TIME": "0910", "DEPARTURE_DELAY": 10.0, "TAXI_OUT": 10.0,
    "WHEELS_OFF": "0920", "SCHEDULED_TIME": 90.0, "ELAPSED_TIME": 85.0, "AIR_TIME": 70.0, "DISTANCE": 500,
    "WHEELS_ON": "1030", "TAXI_IN": 5.0, "SCHEDULED_ARRIVAL": "1030", "ARRIVAL_TIME": "1035",
    "ARRIVAL_DELAY": 5.0, "DIVERTED": 0, "CANCELLED": 0,
}


def flights(spark, *overrides):
    rows = []
    for number, changed in enumerate(overrides):
        record = {**DEFAULT, "FLIGHT_NUMBER": number, **changed}
        rows.append(tuple(record.get(name) for name in FLIGHTS.fieldNames()))
    return spark.createDataFrame(rows, FLIGHTS)
