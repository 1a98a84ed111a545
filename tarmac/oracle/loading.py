"""Sources, profiling, dimensions, fact steps and integrity checks as DuckDB SQL."""

from __future__ import annotations

from tarmac.oracle import star as s
from tarmac.oracle.mapping import CIRCUITS_SQL, CONSTRUCTORS_SQL
from tarmac.oracle.views import pct
from tarmac.oracle.star import with_star
from tarmac.sources.files import FLIGHT_IDENTITY
from tarmac.sources.schemas import CRITICAL, FLIGHTS

SQL: dict[str, str] = {}

_FLIGHT_COLUMNS = FLIGHTS.fieldNames()
_MISSING = "concat_ws(',', " + ", ".join(f"CASE WHEN {c} IS NULL THEN '{c}' END" for c in CRITICAL) + ")"
_IDENTITY_ORDER = ", ".join(f"{c} NULLS FIRST" for c in FLIGHT_IDENTITY)

# Sources ---------------------------------------------------------------------------------------------
SQL["src_airlines"] = "SELECT * FROM airlines"
SQL["src_airports"] = "SELECT * FROM airports"
SQL["src_flights"] = "SELECT * FROM flights"
SQL["src_row_count"] = "SELECT count(*) AS row_count FROM flights"
SQL["src_null_tokens"] = (
    "SELECT "
    + ", ".join(
        f"count(*) FILTER (WHERE {c} IS NULL) AS {c.lower()}"
        for c in ("AIRLINE", "DESTINATION_AIRPORT", "DEPARTURE_DELAY", "CANCELLATION_REASON", "WEATHER_DELAY")
    )
    + " FROM flights"
)
SQL["src_backslash_n"] = CIRCUITS_SQL
SQL["src_constructors"] = CONSTRUCTORS_SQL
SQL["sample_first_n"] = f"SELECT * FROM flights ORDER BY {_IDENTITY_ORDER} LIMIT 1000"
SQL["sink_append"] = "SELECT * FROM flights"
SQL["sink_fact"] = "SELECT * FROM fact"
SQL["sink_load_once"] = """SELECT CAST(row_number() OVER (ORDER BY airline_code < 'M', airline_code) AS INT)
  AS airline_key, airline_code, airline_name, airline_type FROM dim_airline"""
SQL["ingest_batches"] = "SELECT * EXCLUDE (year, month) FROM fact"
SQL["ingest_resume"] = "SELECT * EXCLUDE (year, month) FROM fact"
SQL["ingest_redelivered"] = "SELECT * EXCLUDE (year, month) FROM fact"
SQL["load_counts"] = f"""WITH judged AS (SELECT CASE WHEN NOT ({s.PRESENT}) THEN 'missing'
    WHEN {s.FLIGHT_DATE} IS NULL THEN 'impossible date'
    WHEN upper(trim(ORIGIN_AIRPORT)) NOT IN (SELECT airport_code FROM dim_airport) THEN 'unknown origin airport'
    WHEN upper(trim(DESTINATION_AIRPORT)) NOT IN (SELECT airport_code FROM dim_airport)
    THEN 'unknown destination airport' ELSE 'loaded' END AS outcome FROM flights)
  SELECT outcome, count(j.outcome) AS row_count FROM (VALUES ('missing'), ('impossible date'),
    ('unknown origin airport'), ('unknown destination airport'), ('loaded')) v(outcome)
    LEFT JOIN judged j USING (outcome) GROUP BY outcome
  UNION ALL SELECT 'read', count(*) FROM flights"""

# Profiling -------------------------------------------------------------------------------------------
SQL["check_required_columns"] = """SELECT 'airlines' AS source, count(*) AS row_count, '' AS missing_columns
  FROM airlines UNION ALL SELECT 'airports', count(*), '' FROM airports
  UNION ALL SELECT 'flights', count(*), '' FROM flights
  UNION ALL SELECT 'flights without carrier', count(*), 'AIRLINE' FROM flights"""
SQL["check_sources"] = """SELECT 'flights' AS name, count(*) > 0 AS ok FROM flights
  UNION ALL SELECT 'airports', count(*) > 0 FROM airports UNION ALL SELECT 'absent', FALSE"""


def _metrics(source_column: str, source: str, table: str, **metrics: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{source}' AS {source_column}, '{name}' AS metric, CAST({expr} AS BIGINT) AS value FROM {table}"
        for name, expr in metrics.items()
    )


SQL["source_summary"] = " UNION ALL ".join(
    [
        _metrics(
            "source", "airlines", "airlines",
            record_count="count(*)", column_count="max(2)", unique_airlines="count(DISTINCT IATA_CODE)",
        ),
        _metrics(
            "source", "airports", "airports", record_count="count(*)", column_count="max(7)",
            unique_airports="count(DISTINCT IATA_CODE)", countries="count(DISTINCT COUNTRY)",
        ),
        _metrics(
            "source", "flights", "flights", record_count="count(*)", column_count=f"max({len(_FLIGHT_COLUMNS)})",
            unique_airlines="count(DISTINCT AIRLINE)", min_year="min(YEAR)", max_year="max(YEAR)",
        ),
    ]
)

_NULLS = " UNION ALL ".join(
    f"SELECT '{f.name}' AS column_name, '{f.dataType.simpleString()}' AS data_type,"
    f" count(*) FILTER (WHERE {f.name} IS NULL) AS null_count, count(*) AS n FROM flights"
    for f in FLIGHTS.fields
)
SQL["profile_columns"] = (
    f"SELECT column_name, data_type, null_count, {pct('null_count', 'n', 4)} AS null_pct FROM ({_NULLS})"
)
SQL["fill_factor"] = (
    f"SELECT column_name AS variable, null_count AS missing_values,"
    f" {pct('(n - null_count)', 'n', 4)} AS filling_factor_pct FROM ({_NULLS})"
)

_DIMS = {
    "airline": ("dim_airline", ["airline_key", "airline_code", "airline_name", "airline_type"],
                {"unique_types": "count(DISTINCT airline_type)"}),
    "airport": ("dim_airport",
                ["airport_key", "airport_code", "airport_name", "city", "state", "country", "latitude",
                 "longitude", "timezone", "airport_size_category"],
                {"unique_countries": "count(DISTINCT country)", "unique_states": "count(DISTINCT state)"}),
    "date": ("dim_date",
             ["date_key", "date", "year", "quarter", "month", "month_name", "day", "day_of_week", "day_name",
              "day_of_year", "week_of_year", "is_weekend", "is_holiday", "is_business_day", "season",
              "fiscal_quarter"],
             {"min_date_key": "min(date_key)", "max_date_key": "max(date_key)",
              "weekend_count": "count(*) FILTER (WHERE is_weekend)",
              "holiday_count": "count(*) FILTER (WHERE is_holiday)"}),
    "time": ("dim_time",
             ["time_key", "time_value", "hour", "minute", "hour_category", "is_business_hours", "time_period"], {}),
    "cause": ("dim_delay_cause",
              ["delay_cause_key", "cause_code", "cause_name", "cause_category", "cause_description",
               "is_controllable", "severity_weight"], {}),
}


def _dim_summary(name: str) -> str:
    table, columns, extra = _DIMS[name]
    metrics = {
        "record_count": "count(*)",
        "column_count": f"max({len(columns)})",
        **{f"null_{c}": f"count(*) FILTER (WHERE {c} IS NULL)" for c in columns},
        **extra,
    }
    repeated = f"(SELECT count(*) AS n FROM {table} GROUP BY {', '.join(columns)})"
    duplicates = _metrics("dimension", name, repeated, duplicate_count="coalesce(sum(n - 1), 0)")
    return _metrics("dimension", name, table, **metrics) + " UNION ALL " + duplicates


SQL["dim_summary"] = " UNION ALL ".join(_dim_summary(name) for name in _DIMS)

_FACT_COLUMNS = [
    "flight_key", "date_key", "airline_key", "origin_airport_key", "destination_airport_key",
    "departure_time_key", "delay_cause_key", "flight_number", "tail_number",
    "departure_delay_minutes", "arrival_delay_minutes", "reported_departure_delay",
    "scheduled_elapsed_minutes", "actual_elapsed_minutes",
    "taxi_out_minutes", "taxi_in_minutes", "air_time_minutes", "distance_miles",
    "is_cancelled", "is_diverted", "cancellation_reason",
    "air_system_delay_minutes", "security_delay_minutes", "airline_delay_minutes",
    "late_aircraft_delay_minutes", "weather_delay_minutes",
    "total_delay_minutes", "delay_severity_category", "year", "month",
]
_D = "departure_delay_minutes"
_FACT_METRICS = {
    "total_flights": "count(*)",
    "cancelled_flights": "count(*) FILTER (WHERE is_cancelled)",
    "diverted_flights": "count(*) FILTER (WHERE is_diverted)",
    "delayed_flights": f"count(*) FILTER (WHERE {_D} > 0)",
    "on_time_flights": f"count(*) FILTER (WHERE {_D} <= 0)",
    "avg_delay_minutes": f"avg({_D})",
    "median_delay_minutes": f"median({_D})",
    "max_delay_minutes": f"max({_D})",
    "min_delay_minutes": f"min({_D})",
    "avg_distance_miles": "avg(distance_miles)",
    "median_distance_miles": "median(distance_miles)",
    "max_distance_miles": "max(distance_miles)",
    "zero_distance_flights": "count(*) FILTER (WHERE distance_miles = 0)",
    "airline_key_zeros": "count(*) FILTER (WHERE airline_key = 0)",
    "airport_key_zeros": "count(*) FILTER (WHERE origin_airport_key = 0)"
    " + count(*) FILTER (WHERE destination_airport_key = 0)",
    **{f"null_{c}": f"count(*) FILTER (WHERE {c} IS NULL)" for c in _FACT_COLUMNS},
}
SQL["fact_summary"] = " UNION ALL ".join(
    f"SELECT '{name}' AS metric, CAST({expr} AS DOUBLE) AS value FROM fact" for name, expr in _FACT_METRICS.items()
)
SQL["bad_rows"] = f"SELECT *, {_MISSING} AS missing_columns FROM flights WHERE {_MISSING} <> ''"
SQL["extreme_delays"] = f"""SELECT count(*) FILTER (WHERE {_D} < -30) AS very_early,
  count(*) FILTER (WHERE {_D} > 200) AS very_late FROM fact"""

_HOUR = s.NEAREST_HOUR.format("scheduled_departure")


def _unmapped(name: str, code: str, table: str, column: str) -> str:
    return f"""SELECT '{name}' AS dimension, count(DISTINCT {code}) AS unmapped_codes, count(*) AS unmapped_rows
  FROM placed WHERE CAST({code} AS VARCHAR) NOT IN (SELECT CAST({column} AS VARCHAR) FROM {table})"""


SQL["unmapped_codes"] = " UNION ALL ".join(
    [
        _unmapped("airline", "airline_code", "dim_airline", "airline_code"),
        _unmapped("origin", "origin_code", "dim_airport", "airport_code"),
        _unmapped("destination", "destination_code", "dim_airport", "airport_code"),
        _unmapped("time", _HOUR, "dim_time", "hour"),
    ]
)

# Dimensions ------------------------------------------------------------------------------------------
SQL["dim_airline"] = "SELECT * FROM dim_airline"
SQL["airline_type"] = """SELECT airline_type, count(DISTINCT airline_code) AS airlines, count(*) AS flights
  FROM fact JOIN dim_airline USING (airline_key) GROUP BY airline_type"""
SQL["dim_airport"] = "SELECT * FROM dim_airport"
SQL["airport_timezone"] = """SELECT timezone, count(DISTINCT airport_code) AS airports, count(*) AS flights
  FROM fact JOIN dim_airport ON airport_key = origin_airport_key GROUP BY timezone"""
SQL["airport_size"] = """SELECT airport_key, airport_code, coalesce(n, 0) AS departures,
  CASE WHEN coalesce(n, 0) < 1000 THEN 'Small' WHEN n < 10000 THEN 'Medium' WHEN n <= 50000 THEN 'Large'
    ELSE 'Hub' END AS airport_size_category
  FROM dim_airport LEFT JOIN (SELECT upper(trim(ORIGIN_AIRPORT)) AS airport_code, count(*) AS n FROM flights GROUP BY 1)
  USING (airport_code)"""
_FLOWN_DATES = f"SELECT {s.FLIGHT_DATE} AS d FROM flights"
SQL["dim_date"] = s.calendar_select(
    f"""SELECT CAST(unnest(generate_series(min(d), max(d), INTERVAL 1 DAY)) AS DATE) AS d FROM ({_FLOWN_DATES})"""
)
SQL["is_holiday"] = f"""SELECT d AS flight_date, d IN ({s.HOLIDAY_LIST}) AS is_holiday, count(*) AS flights
  FROM ({_FLOWN_DATES}) WHERE d IS NOT NULL GROUP BY d"""
SQL["season"] = f"""SELECT {s.SEASON.format("MONTH")} AS season, count(*) AS flights FROM flights GROUP BY 1"""
SQL["is_business_day"] = f"""SELECT NOT (isodow(d) > 5 OR d IN ({s.HOLIDAY_LIST})) AS is_business_day,
  count(DISTINCT d) AS days, count(*) AS flights FROM ({_FLOWN_DATES}) WHERE d IS NOT NULL GROUP BY 1"""
_HOURS = f"SELECT {s.NEAREST_HOUR.format('SCHEDULED_DEPARTURE')} AS hour, count(*) AS n FROM flights GROUP BY 1"
SQL["dim_time"] = f"SELECT t.*, coalesce(n, 0) AS flights FROM dim_time t LEFT JOIN ({_HOURS}) USING (hour)"
SQL["dim_time_seed"] = f"""SELECT t.*, coalesce(n, 0) AS flights FROM ({s.times_select(seed=True)}) t
  LEFT JOIN ({_HOURS}) USING (hour)"""
SQL["hour_category"] = f"""SELECT {s.HOUR_CATEGORY.format("hour")} AS hour_category,
  CAST(sum(n) AS BIGINT) AS flights FROM ({_HOURS}) GROUP BY 1"""
SQL["time_period"] = f"""SELECT {s.TIME_PERIOD.format("hour")} AS time_period,
  CAST(sum(n) AS BIGINT) AS flights FROM ({_HOURS}) GROUP BY 1"""
_CAUSED = f"SELECT {s.PRIMARY_CAUSE} AS cause_code, count(*) AS n FROM cleaned GROUP BY 1"
SQL["dim_delay_cause"] = f"""SELECT cause_code, cause_name, cause_category, coalesce(n, 0) AS flights
  FROM dim_delay_cause LEFT JOIN ({_CAUSED}) USING (cause_code) WHERE cause_code <> 'CANCELLED'"""
SQL["dim_delay_cause_seed"] = f"""SELECT d.*, coalesce(n, 0) AS flights
  FROM dim_delay_cause d LEFT JOIN ({_CAUSED}) USING (cause_code)"""

# Fact steps ------------------------------------------------------------------------------------------
_DATE_KEY = "CAST(year(flight_date) * 10000 + month(flight_date) * 100 + day(flight_date) AS INT)"
SQL["fact_clean"] = "SELECT * FROM cleaned"
SQL["fact_date_key"] = f"SELECT flight_key, flight_date, {_DATE_KEY} AS date_key FROM placed"
SQL["hhmm_to_hour"] = f"""SELECT SCHEDULED_DEPARTURE AS scheduled_departure,
  {s.NEAREST_HOUR.format("SCHEDULED_DEPARTURE")} AS hour, count(*) AS flights FROM flights
  GROUP BY SCHEDULED_DEPARTURE"""
SQL["resolve_airline"] = """SELECT flight_key, coalesce(airline_key, 0) AS airline_key
  FROM cleaned LEFT JOIN dim_airline USING (airline_code)"""
SQL["resolve_airports"] = """SELECT flight_key, o.airport_key AS origin_airport_key,
  d.airport_key AS destination_airport_key FROM cleaned
  JOIN dim_airport o ON o.airport_code = origin_code JOIN dim_airport d ON d.airport_code = destination_code"""
SQL["resolve_time"] = f"""SELECT flight_key, hour AS departure_hour, time_key AS departure_time_key
  FROM cleaned JOIN dim_time ON hour = {_HOUR}"""
SQL["delay_metrics"] = f"""SELECT flight_key, CAST({_D} > 0 AS INT) AS delay_indicator,
  CAST({_D} > 15 AS INT) AS significant_delay, CAST({_D} > 60 AS INT) AS severe_delay,
  CASE WHEN {_D} > 0 THEN greatest({_D} - arrival_delay_minutes, 0) ELSE 0 END AS delay_recovery FROM cleaned"""
SQL["primary_cause"] = f"""SELECT flight_key, cause_code AS primary_cause, delay_cause_key FROM cleaned
  JOIN dim_delay_cause ON cause_code = {s.PRIMARY_CAUSE}"""
SQL["business_flags"] = """SELECT flight_key, isodow(flight_date) > 5 AS is_weekend_flight,
  month(flight_date) IN (6, 7, 11, 12) AS is_holiday_period, distance_miles > 1500 AS is_long_haul FROM placed"""
SQL["fact_finalize"] = """SELECT date_key, airline_key, origin_airport_key, destination_airport_key,
  departure_time_key, delay_cause_key, flight_number, tail_number, departure_delay_minutes, arrival_delay_minutes,
  scheduled_elapsed_minutes, actual_elapsed_minutes, distance_miles, is_cancelled, is_diverted FROM fact"""
SQL["total_delay"] = "SELECT flight_key, total_delay_minutes FROM fact"
SQL["delay_severity"] = "SELECT flight_key, delay_severity_category FROM fact"
SQL["fact_flights"] = "SELECT * FROM fact"
SQL["lookup_codes"] = """SELECT 'airline' AS dimension, airline_code AS code, airline_key AS key FROM dim_airline
  UNION ALL SELECT 'airport', airport_code, airport_key FROM dim_airport
  UNION ALL SELECT 'date', CAST(date AS VARCHAR), date_key FROM dim_date
  UNION ALL SELECT 'time', time_value, time_key FROM dim_time
  UNION ALL SELECT 'cause', cause_code, delay_cause_key FROM dim_delay_cause"""

# Integrity, on a star that was damaged on purpose ---------------------------------------------------------
_SPOILT = """(SELECT * REPLACE (distance_miles - 400 AS distance_miles, scheduled_elapsed_minutes - 90 AS
    scheduled_elapsed_minutes, departure_delay_minutes * 8 AS departure_delay_minutes,
    CASE WHEN flight_number % 5 <> 0 THEN reported_departure_delay END AS reported_departure_delay,
    CASE WHEN flight_number % 3 <> 0 THEN cancellation_reason WHEN flight_number % 2 = 0 THEN 'X'
    END AS cancellation_reason) FROM fact)"""


def _orphans(key: str, table: str, column: str, kept: str, zero_allowed: bool = True) -> str:
    allowed = f" AND {key} > 0" if zero_allowed else ""
    return f"""SELECT count(*) AS violations FROM fact
  WHERE {key} NOT IN (SELECT {column} FROM {table} WHERE {kept}){allowed}"""


SQL["orphan_airlines"] = _orphans("airline_key", "dim_airline", "airline_key", "airline_code <> 'DL'")
SQL["orphan_origins"] = _orphans("origin_airport_key", "dim_airport", "airport_key", "airport_code <> 'P3'")
SQL["orphan_destinations"] = _orphans("destination_airport_key", "dim_airport", "airport_key", "airport_code <> 'P3'")
SQL["orphan_dates"] = _orphans("date_key", "dim_date", "date_key", "month <> 3", False)
SQL["orphan_causes"] = _orphans("delay_cause_key", "dim_delay_cause", "delay_cause_key", "cause_code <> 'WEATHER'")
SQL["fk_time"] = _orphans("departure_time_key", "dim_time", "time_key", "hour <> 7", False)


def _violations(condition: str) -> str:
    return f"SELECT count(*) FILTER (WHERE {condition}) AS violations FROM {_SPOILT}"


SQL["negative_distances"] = _violations("distance_miles < 0")
SQL["extreme_delay_count"] = _violations(f"{_D} > 1440")
SQL["cancelled_not_flagged"] = _violations("reported_departure_delay IS NULL AND NOT is_cancelled")
SQL["chk_distance"] = _violations("distance_miles <= 0")
SQL["chk_scheduled_time"] = _violations("scheduled_elapsed_minutes <= 0")
SQL["chk_cancellation_reason"] = _violations(
    "CASE WHEN is_cancelled THEN cancellation_reason NOT IN ('A', 'B', 'C', 'D')"
    " ELSE cancellation_reason IS NOT NULL END"
)
_CHECKS = {
    "total_orphans": ["orphan_airlines", "orphan_origins", "orphan_destinations", "orphan_dates", "orphan_causes"],
    "total_quality": ["negative_distances", "extreme_delay_count", "cancelled_not_flagged"],
}
_ALL_CHECKS = " UNION ALL ".join(
    f"SELECT '{kind}' AS kind, '{check}' AS check_name, violations FROM ({SQL[check]})"
    for kind, checks in _CHECKS.items()
    for check in checks
)
SQL["integrity_report"] = f"""SELECT check_name, violations FROM ({_ALL_CHECKS})
  UNION ALL SELECT kind, CAST(sum(violations) AS BIGINT) FROM ({_ALL_CHECKS}) GROUP BY kind"""
SQL["unique_codes"] = " UNION ALL ".join(
    f"SELECT '{name}' AS dimension, count(*) FILTER (WHERE n > 1) AS violations FROM"
    f" (SELECT count(*) AS n FROM (SELECT {code} FROM {table} UNION ALL SELECT {code} FROM {table} WHERE {again})"
    f" GROUP BY {code})"
    for name, code, table, again in (
        ("airline", "airline_code", "dim_airline", "airline_code = 'DL'"),
        ("airport", "airport_code", "dim_airport", "airport_code = 'P3'"),
        ("date", "date", "dim_date", "month = 3"),
        ("cause", "cause_code", "dim_delay_cause", "cause_code = 'WEATHER'"),
    )
)
SQL["table_stats"] = "SELECT count(*) AS row_count, count(*) > 0 AS has_size FROM fact"


def oracle(name: str) -> str | None:
    if name not in SQL:
        return None
    query = SQL[name]
    return with_star(f"SELECT * FROM ({query})" if query.startswith("WITH") else query)
