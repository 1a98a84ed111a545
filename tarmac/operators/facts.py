"""The flight fact: cleaning, keys, measures, causes and flags.

Every step takes and returns a DataFrame, so the whole build is one lazy plan. All lookups are joins
against the small file-backed dimensions, which Catalyst broadcasts after checking their size; the
fact rows are never shuffled until they are written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.functions import clocks, rules
from tarmac.sources.files import FLIGHT_IDENTITY, require_columns
from tarmac.sources.schemas import CRITICAL


CODES = ["AIRLINE", "ORIGIN_AIRPORT", "DESTINATION_AIRPORT"]


def _code(name: str) -> Column:
    return F.upper(F.trim(name))


def _minutes(name: str) -> Column:
    """Minutes as an integer, missing or unparseable values as 0."""
    return F.coalesce(F.col(name).try_cast("int"), F.lit(0))


def _flag(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0)) == 1


def has_critical_fields() -> Column:
    present = F.lit(True)
    for name in CRITICAL:
        present = present & F.col(name).isNotNull()
    return present


def clean(flights: DataFrame) -> DataFrame:
    """Drop records that lack a critical field; normalise codes, numbers and flags of the rest."""
    require_columns(flights, CRITICAL)
    text = {c: F.col(c).cast("string") for c in FLIGHT_IDENTITY} | {c: _code(c) for c in CODES}
    identity = F.concat_ws("|", *[F.coalesce(text[c], F.lit("")) for c in FLIGHT_IDENTITY])
    return flights.filter(has_critical_fields()).select(
        F.md5(identity).alias("flight_key"),
        "YEAR",
        "MONTH",
        "DAY",
        _code("AIRLINE").alias("airline_code"),
        _code("ORIGIN_AIRPORT").alias("origin_code"),
        _code("DESTINATION_AIRPORT").alias("destination_code"),
        F.coalesce(F.col("FLIGHT_NUMBER").try_cast("int"), F.lit(0)).alias("flight_number"),
        F.coalesce("TAIL_NUMBER", F.lit("")).alias("tail_number"),
        F.col("SCHEDULED_DEPARTURE").alias("scheduled_departure"),
        F.col("DEPARTURE_DELAY").try_cast("int").alias("reported_departure_delay"),
        _minutes("DEPARTURE_DELAY").alias("departure_delay_minutes"),
        _minutes("ARRIVAL_DELAY").alias("arrival_delay_minutes"),
        _minutes("SCHEDULED_TIME").alias("scheduled_elapsed_minutes"),
        _minutes("ELAPSED_TIME").alias("actual_elapsed_minutes"),
        _minutes("AIR_TIME").alias("air_time_minutes"),
        _minutes("TAXI_OUT").alias("taxi_out_minutes"),
        _minutes("TAXI_IN").alias("taxi_in_minutes"),
        _minutes("DISTANCE").alias("distance_miles"),
        _flag("CANCELLED").alias("is_cancelled"),
        _flag("DIVERTED").alias("is_diverted"),
        F.upper(F.trim("CANCELLATION_REASON")).alias("cancellation_reason"),
        _minutes("AIR_SYSTEM_DELAY").alias("air_system_delay_minutes"),
        _minutes("SECURITY_DELAY").alias("security_delay_minutes"),
        _minutes("AIRLINE_DELAY").alias("airline_delay_minutes"),
        _minutes("LATE_AIRCRAFT_DELAY").alias("late_aircraft_delay_minutes"),
        _minutes("WEATHER_DELAY").alias("weather_delay_minutes"),
    )


def add_date_key(cleaned: DataFrame) -> DataFrame:
    """Flight date and YYYYMMDD key; a record with an impossible date has no place in the fact."""
    date = clocks.calendar_date(F.col("YEAR"), F.col("MONTH"), F.col("DAY"))
    return (
        cleaned.withColumn("flight_date", date)
        .filter(F.col("flight_date").isNotNull())
        .withColumn("date_key", clocks.date_key(F.col("flight_date")))
    )


def add_hour(flights: DataFrame) -> DataFrame:
    # The clock is parsed in its own step, so that the parse runs once per row.
    return (
        flights.withColumn("_clock", clocks.hhmm_number(F.col("scheduled_departure")))
        .withColumn("departure_hour", clocks.nearest_hour(F.col("_clock")))
        .drop("_clock")
    )


def _lookup(flights: DataFrame, dim: DataFrame, code: str, key: str, on: str, to: str, how: str) -> DataFrame:
    pairs = dim.select(F.col(code).alias(on), F.col(key).alias(to))
    return flights.join(pairs, on, how)


def resolve_airline(flights: DataFrame, airlines: DataFrame) -> DataFrame:
    """Airline key; a carrier that is not in the dimension gets key 0."""
    keyed = _lookup(flights, airlines, "airline_code", "airline_key", "airline_code", "airline_key", "left")
    return keyed.withColumn("airline_key", F.coalesce("airline_key", F.lit(0)))


def resolve_airports(flights: DataFrame, airports: DataFrame) -> DataFrame:
    """Origin and destination keys; a flight from or to an unknown airport is dropped."""
    keyed = flights
    for role in ("origin", "destination"):
        keyed = _lookup(
            keyed, airports, "airport_code", "airport_key", f"{role}_code", f"{role}_airport_key", "inner"
        )
    return keyed


def resolve_time(flights: DataFrame, times: DataFrame) -> DataFrame:
    keyed = _lookup(flights, times, "hour", "time_key", "departure_hour", "departure_time_key", "left")
    return keyed.withColumn("departure_time_key", F.coalesce("departure_time_key", F.lit(0)))


def delay_metrics() -> dict[str, Column]:
    dep, arr = F.col("departure_delay_minutes"), F.col("arrival_delay_minutes")
    return {
        "delay_indicator": (dep > 0).cast("int"),
        "significant_delay": (dep > 15).cast("int"),
        "severe_delay": (dep > 60).cast("int"),
        "delay_recovery": F.when((dep > 0) & (arr < dep), dep - arr).otherwise(0),
    }


def business_flags() -> dict[str, Column]:
    date = F.col("flight_date")
    return {
        "is_weekend_flight": clocks.iso_weekday(date) >= 6,
        "is_holiday_period": F.month(date).isin(6, 7, 11, 12),
        "is_long_haul": F.col("distance_miles") > 1500,
    }


def add_primary_cause(flights: DataFrame) -> DataFrame:
    code = rules.primary_cause(F.col("departure_delay_minutes"), F.col("_most"))
    return flights.withColumn("_most", rules.most_cause_minutes()).withColumn("primary_cause", code).drop("_most")


def resolve_cause(flights: DataFrame, causes: DataFrame) -> DataFrame:
    caused = add_primary_cause(flights)
    keyed = _lookup(caused, causes, "cause_code", "delay_cause_key", "primary_cause", "delay_cause_key", "left")
    unknown = causes.filter("cause_code = 'UNKNOWN'").select("delay_cause_key").scalar()
    return keyed.withColumn("delay_cause_key", F.coalesce("delay_cause_key", unknown))


FACT_COLUMNS = [
    "flight_key", "date_key", "airline_key", "origin_airport_key", "destination_airport_key",
    "departure_time_key", "delay_cause_key", "flight_number", "tail_number",
    "departure_delay_minutes", "arrival_delay_minutes", "reported_departure_delay",
    "scheduled_elapsed_minutes", "actual_elapsed_minutes",
    "taxi_out_minutes", "taxi_in_minutes", "air_time_minutes", "distance_miles",
    "is_cancelled", "is_diverted", "cancellation_reason",
    "air_system_delay_minutes", "security_delay_minutes", "airline_delay_minutes",
    "late_aircraft_delay_minutes", "weather_delay_minutes",
    "total_delay_minutes", "delay_severity_category",
]


# The columns that exist in every version of the fact table.
LOADED_COLUMNS = [
    "date_key", "airline_key", "origin_airport_key", "destination_airport_key", "departure_time_key",
    "delay_cause_key", "flight_number", "tail_number", "departure_delay_minutes", "arrival_delay_minutes",
    "scheduled_elapsed_minutes", "actual_elapsed_minutes", "distance_miles", "is_cancelled", "is_diverted",
]


def finalize(flights: DataFrame) -> DataFrame:
    """The stored columns: keys, measures, the two derived measures and the partition columns."""
    derived = flights.withColumns(
        {
            "total_delay_minutes": rules.total_delay(),
            "delay_severity_category": rules.delay_severity(
                F.col("is_cancelled"), F.col("departure_delay_minutes")
            ),
            "year": F.year("flight_date"),
            "month": F.month("flight_date"),
        }
    )
    return derived.select(*FACT_COLUMNS, "year", "month")


def resolve_keys(flights: DataFrame, dims) -> DataFrame:
    """Clean records with every dimension key; ``dims`` has airline, airport, time and cause frames."""
    placed = add_hour(add_date_key(clean(flights)))
    placed = resolve_airports(placed, dims.airport)
    placed = resolve_airline(placed, dims.airline)
    placed = resolve_time(placed, dims.time)
    return resolve_cause(placed, dims.cause)


def build_fact(flights: DataFrame, dims) -> DataFrame:
    return finalize(resolve_keys(flights, dims))
