"""The star schema and the flight-shaped inputs as DuckDB common table expressions."""

from __future__ import annotations

from tarmac.operators.dims import DELAY_CAUSES, SEED_CAUSES
from tarmac.oracle import mapping


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


# The holidays of the years in the mapping.
HOLIDAYS = [
    "2015-01-01", "2015-05-25", "2015-07-04", "2015-09-07", "2015-11-26", "2015-12-25",
    "2016-01-01", "2016-05-30", "2016-07-04", "2016-09-05", "2016-11-24", "2016-12-25",
]
HOLIDAY_LIST = ", ".join(f"DATE '{d}'" for d in HOLIDAYS)

AIRLINE_TYPE = """CASE
  WHEN regexp_matches(upper({0}), 'AMERICAN|DELTA|UNITED|SOUTHWEST|JETBLUE') THEN 'Major'
  WHEN regexp_matches(upper({0}), 'REGIONAL|EXPRESS|CONNECTION|EAGLE|SKYWEST') THEN 'Regional'
  WHEN regexp_matches(upper({0}), 'SPIRIT|FRONTIER|ALLEGIANT') THEN 'Low-Cost'
  ELSE 'Other' END"""

TIMEZONE = """CASE WHEN {0} IN ('CA', 'WA', 'OR') THEN 'America/Los_Angeles'
  WHEN {0} IN ('TX', 'IL') THEN 'America/Chicago' ELSE 'America/New_York' END"""

SEASON = """CASE WHEN {0} IN (12, 1, 2) THEN 'Winter' WHEN {0} < 6 THEN 'Spring'
  WHEN {0} < 9 THEN 'Summer' ELSE 'Fall' END"""

HOUR_CATEGORY = """CASE WHEN {0} < 5 OR {0} > 20 THEN 'Late Night' WHEN {0} < 9 THEN 'Early Morning'
  WHEN {0} < 12 THEN 'Morning' WHEN {0} < 17 THEN 'Afternoon' ELSE 'Evening' END"""

TIME_PERIOD = """CASE WHEN {0} < 6 OR {0} > 21 THEN 'Overnight' WHEN {0} < 12 THEN 'Morning'
  WHEN {0} < 18 THEN 'Afternoon' ELSE 'Evening' END"""

SEED_HOUR_CATEGORY = """CASE WHEN {0} < 5 OR {0} > 21 THEN 'Late Night' WHEN {0} < 8 THEN 'Early Morning'
  WHEN {0} < 12 THEN 'Morning' WHEN {0} < 18 THEN 'Afternoon' ELSE 'Evening' END"""

SEED_TIME_PERIOD = """CASE WHEN {0} < 5 OR {0} > 21 THEN 'Overnight' WHEN {0} < 7 THEN 'Early'
  WHEN {0} < 12 THEN 'Morning' WHEN {0} < 18 THEN 'Afternoon' ELSE 'Evening' END"""

NUMBER = "TRY_CAST(trunc(TRY_CAST({0} AS DOUBLE)) AS INT)"

# Hour slot nearest to an HHMM clock.
NEAREST_HOUR = f"""CASE WHEN {NUMBER} BETWEEN 0 AND 9999
  THEN ({NUMBER} // 100 + CASE WHEN {NUMBER} % 100 BETWEEN 30 AND 59 THEN 1 ELSE 0 END) % 24 ELSE 0 END"""

SECONDS = f"""CASE WHEN {NUMBER} = 2400 THEN 0
  WHEN {NUMBER} BETWEEN 0 AND 2359 AND {NUMBER} % 100 < 60
  THEN ({NUMBER} // 100) * 3600 + ({NUMBER} % 100) * 60 END"""

FLIGHT_DATE = """TRY_CAST(concat_ws('-', lpad(CAST(YEAR AS VARCHAR), 4, '0'),
  lpad(CAST(MONTH AS VARCHAR), 2, '0'), lpad(CAST(DAY AS VARCHAR), 2, '0')) AS DATE)"""

PRESENT = (
    "YEAR IS NOT NULL AND MONTH IS NOT NULL AND DAY IS NOT NULL AND AIRLINE IS NOT NULL"
    " AND ORIGIN_AIRPORT IS NOT NULL AND DESTINATION_AIRPORT IS NOT NULL"
)


def calendar_select(source: str) -> str:
    return f"""SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INT) AS date_key, d AS date,
    CAST(year(d) AS INT) AS year, CAST(quarter(d) AS INT) AS quarter, CAST(month(d) AS INT) AS month,
    monthname(d) AS month_name, CAST(day(d) AS INT) AS day, CAST(isodow(d) AS INT) AS day_of_week,
    dayname(d) AS day_name, CAST(dayofyear(d) AS INT) AS day_of_year,
    CAST(weekofyear(d) AS INT) AS week_of_year, isodow(d) > 5 AS is_weekend,
    d IN ({HOLIDAY_LIST}) AS is_holiday, NOT (isodow(d) > 5 OR d IN ({HOLIDAY_LIST})) AS is_business_day,
    {SEASON.format("month(d)")} AS season, CAST(quarter(d) AS INT) AS fiscal_quarter FROM ({source})"""


def times_select(seed: bool = False) -> str:
    category, period = (SEED_HOUR_CATEGORY, SEED_TIME_PERIOD) if seed else (HOUR_CATEGORY, TIME_PERIOD)
    business = "h BETWEEN 6 AND 17" if seed else "h BETWEEN 8 AND 17"
    return f"""SELECT h + 1 AS time_key, concat(lpad(CAST(h AS VARCHAR), 2, '0'), ':00:00') AS time_value,
    h AS hour, 0 AS minute, {category.format("h")} AS hour_category, {business} AS is_business_hours,
    {period.format("h")} AS time_period FROM (SELECT CAST(range AS INT) AS h FROM range(24))"""


def _merged_causes() -> str:
    attributes = {("NO_DELAY" if row[0] == "ON_TIME" else row[0]): row[3:] for row in SEED_CAUSES}
    members = [*DELAY_CAUSES, next(row[:3] for row in SEED_CAUSES if row[0] == "CANCELLED")]
    rows = []
    for code, name, category in members:
        text, controllable, weight = attributes[code]
        rows.append(
            f"({_text(code)}, {_text(name)}, {_text(category)}, {_text(text)}, {controllable},"
            f" CAST({weight} AS DECIMAL(3,2)))"
        )
    return (
        "SELECT CAST(row_number() OVER (ORDER BY cause_code) AS INT) AS delay_cause_key, * FROM (VALUES "
        + ", ".join(rows)
        + ") AS t(cause_code, cause_name, cause_category, cause_description, is_controllable, severity_weight)"
    )


def _whole(column: str) -> str:
    return f"CAST(coalesce({column}, 0) AS INT)"


_CAUSES = ["air_system", "security", "airline", "late_aircraft", "weather"]
_CAUSE_CODES = ["AIR_SYSTEM", "SECURITY", "CARRIER", "LATE_AIRCRAFT", "WEATHER"]
_MOST = "greatest(" + ", ".join(f"{c}_delay_minutes" for c in _CAUSES) + ")"

PRIMARY_CAUSE = (
    f"CASE WHEN departure_delay_minutes <= 0 THEN 'NO_DELAY' WHEN {_MOST} <= 0 THEN 'UNKNOWN' "
    + " ".join(f"WHEN {c}_delay_minutes = {_MOST} THEN '{code}'" for c, code in zip(_CAUSES, _CAUSE_CODES))
    + " END"
)

SEVERITY = """CASE WHEN is_cancelled THEN 'Cancelled' WHEN departure_delay_minutes <= 0 THEN 'On Time/Early'
  WHEN departure_delay_minutes < 16 THEN 'Minor Delay' WHEN departure_delay_minutes < 61 THEN 'Moderate Delay'
  WHEN departure_delay_minutes < 181 THEN 'Significant Delay' ELSE 'Severe Delay' END"""

_CODES = ("AIRLINE", "ORIGIN_AIRPORT", "DESTINATION_AIRPORT")
_IDENTITY = ", ".join(
    f"upper(trim({c}))" if c in _CODES else f"coalesce(CAST({c} AS VARCHAR), '')"
    for c in (
        "YEAR", "MONTH", "DAY", "AIRLINE", "FLIGHT_NUMBER", "TAIL_NUMBER",
        "ORIGIN_AIRPORT", "DESTINATION_AIRPORT", "SCHEDULED_DEPARTURE",
    )
)

CTES: dict[str, str] = {
    "flights": mapping.flights_sql("duckdb"),
    "airlines": f"""SELECT * FROM ({mapping.airlines_sql()}) n
      WHERE IATA_CODE IN (SELECT upper(trim(AIRLINE)) FROM flights)""",
    "airports": mapping.AIRPORTS_SQL,
    "dim_airline": f"""SELECT CAST(row_number() OVER (ORDER BY IATA_CODE) AS INT) AS airline_key,
      IATA_CODE AS airline_code, trim(AIRLINE) AS airline_name,
      {AIRLINE_TYPE.format("AIRLINE")} AS airline_type FROM airlines""",
    "dim_airport": f"""SELECT CAST(row_number() OVER (ORDER BY IATA_CODE) AS INT) AS airport_key,
      IATA_CODE AS airport_code, AIRPORT AS airport_name, CITY AS city, STATE AS state, COUNTRY AS country,
      CAST(LATITUDE AS DECIMAL(10,5)) AS latitude, CAST(LONGITUDE AS DECIMAL(10,5)) AS longitude,
      {TIMEZONE.format("STATE")} AS timezone, 'Medium' AS airport_size_category FROM airports""",
    "dim_date": calendar_select("SELECT CAST(DATE '2015-01-01' + CAST(range AS INT) AS DATE) AS d FROM range(731)"),
    "dim_time": times_select(),
    "dim_delay_cause": _merged_causes(),
    "cleaned": f"""SELECT md5(concat_ws('|', {_IDENTITY})) AS flight_key, YEAR, MONTH, DAY,
      upper(trim(AIRLINE)) AS airline_code, upper(trim(ORIGIN_AIRPORT)) AS origin_code,
      upper(trim(DESTINATION_AIRPORT)) AS destination_code, coalesce(FLIGHT_NUMBER, 0) AS flight_number,
      coalesce(TAIL_NUMBER, '') AS tail_number, SCHEDULED_DEPARTURE AS scheduled_departure,
      CAST(DEPARTURE_DELAY AS INT) AS reported_departure_delay,
      {_whole("DEPARTURE_DELAY")} AS departure_delay_minutes, {_whole("ARRIVAL_DELAY")} AS arrival_delay_minutes,
      {_whole("SCHEDULED_TIME")} AS scheduled_elapsed_minutes, {_whole("ELAPSED_TIME")} AS actual_elapsed_minutes,
      {_whole("AIR_TIME")} AS air_time_minutes, {_whole("TAXI_OUT")} AS taxi_out_minutes,
      {_whole("TAXI_IN")} AS taxi_in_minutes, {_whole("DISTANCE")} AS distance_miles,
      coalesce(CANCELLED, 0) = 1 AS is_cancelled, coalesce(DIVERTED, 0) = 1 AS is_diverted,
      CANCELLATION_REASON AS cancellation_reason,
      {_whole("AIR_SYSTEM_DELAY")} AS air_system_delay_minutes, {_whole("SECURITY_DELAY")} AS security_delay_minutes,
      {_whole("AIRLINE_DELAY")} AS airline_delay_minutes,
      {_whole("LATE_AIRCRAFT_DELAY")} AS late_aircraft_delay_minutes,
      {_whole("WEATHER_DELAY")} AS weather_delay_minutes
      FROM flights WHERE {PRESENT}""",
    "placed": f"""SELECT c.*, {FLIGHT_DATE} AS flight_date FROM cleaned c WHERE {FLIGHT_DATE} IS NOT NULL""",
    "fact": f"""SELECT p.flight_key,
      CAST(year(flight_date) * 10000 + month(flight_date) * 100 + day(flight_date) AS INT) AS date_key,
      coalesce(a.airline_key, 0) AS airline_key, o.airport_key AS origin_airport_key,
      d.airport_key AS destination_airport_key, coalesce(t.time_key, 0) AS departure_time_key,
      k.delay_cause_key, p.* EXCLUDE (flight_key, YEAR, MONTH, DAY, airline_code, origin_code, destination_code,
        scheduled_departure, flight_date),
      air_system_delay_minutes + security_delay_minutes + airline_delay_minutes
        + late_aircraft_delay_minutes + weather_delay_minutes AS total_delay_minutes,
      {SEVERITY} AS delay_severity_category,
      CAST(year(flight_date) AS INT) AS year, CAST(month(flight_date) AS INT) AS month
      FROM placed p JOIN dim_airport o ON o.airport_code = p.origin_code
      JOIN dim_airport d ON d.airport_code = p.destination_code
      LEFT JOIN dim_airline a ON a.airline_code = p.airline_code
      LEFT JOIN dim_time t ON t.hour = {NEAREST_HOUR.format("p.scheduled_departure")}
      JOIN dim_delay_cause k ON k.cause_code = {PRIMARY_CAUSE}""",
}


def with_star(query: str) -> str:
    """The query with every table of the star schema in scope."""
    return "WITH " + ", ".join(f"{name} AS ({body})" for name, body in CTES.items()) + "\n" + query
