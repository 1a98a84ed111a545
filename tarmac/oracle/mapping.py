"""Flight-shaped rows derived from the TPC-H-like test tables, as SQL both engines run.

Every lineitem row becomes one flight; the carrier, airports, clock, delay and flags are arithmetic on
its columns. Some rows are spoilt on purpose: missing or impossible critical fields, padded lower-case
codes, unmapped carriers and airports, unreadable clocks.
"""

from __future__ import annotations

# The 14 carriers of the reference year.
AIRLINES = [
    ("AA", "American Airlines Inc."),
    ("AS", "Alaska Airlines Inc."),
    ("B6", "JetBlue Airways"),
    ("DL", "Delta Air Lines Inc."),
    ("EV", "Atlantic Southeast Airlines"),
    ("F9", "Frontier Airlines Inc."),
    ("HA", "Hawaiian Airlines Inc."),
    ("MQ", "American Eagle Airlines Inc."),
    ("NK", "Spirit Air Lines"),
    ("OO", "Skywest Airlines Inc."),
    ("UA", "United Air Lines Inc."),
    ("US", "US Airways Inc."),
    ("VX", "Virgin America"),
    ("WN", "Southwest Airlines Co."),
]

_DAYS = {
    "spark": "datediff(CAST(l.l_shipdate AS DATE), DATE '1995-01-01')",
    "duckdb": "datediff('day', DATE '1995-01-01', CAST(l.l_shipdate AS DATE))",
}

# Spark joins in the order written: the short rows of orders meet the customers first, so that the lines, the most
# rows, move once at most.
_JOINED = {
    "duckdb": """lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
      JOIN customer c ON o.o_custkey = c.c_custkey""",
    "spark": """lineitem l JOIN (
        SELECT o_orderkey, substr(o_orderpriority, 1, 1) AS o_orderpriority, c_nationkey
        FROM orders JOIN customer ON o_custkey = c_custkey
      ) o ON l.l_orderkey = o.o_orderkey""",
}
_NATION = {"duckdb": "c.c_nationkey", "spark": "o.c_nationkey"}

_CARRIER = " ".join(f"WHEN {i} THEN '{code}'" for i, (code, _) in enumerate(AIRLINES))


def _hhmm(minute: str) -> str:
    """HHMM text of a minute of the day (0..1439): every full hour adds 40 to the number."""
    return f"lpad(CAST(CAST({minute} + ({minute} - {minute} % 60) * 2 / 3 AS INT) AS STRING), 4, '0')"


def _unless_cancelled(expression: str) -> str:
    return f"CASE WHEN b.cancelled = 1 THEN NULL ELSE {expression} END"


def _double(expression: str) -> str:
    return f"CAST({expression} AS DOUBLE)"


def _cause(lines: str) -> str:
    return _double(f"CASE WHEN b.cancelled = 0 AND b.dly > 15 AND b.ln IN ({lines}) THEN b.dly END")


def flights_sql(engine: str) -> str:
    return f"""
SELECT CASE WHEN b.pk % 5 = 0 THEN 2016 ELSE 2015 END AS YEAR,
  CASE WHEN b.pk % 227 = 0 THEN 2 ELSE CAST(month(b.d) AS INT) END AS MONTH,
  CASE WHEN b.pk % 227 = 0 THEN 30 ELSE CAST(day(b.d) AS INT) END AS DAY,
  CAST(b.day_number % 7 AS INT) + 1 AS DAY_OF_WEEK,
  CASE WHEN b.pk % 211 = 0 THEN NULL WHEN b.pk % 199 = 0 THEN 'ZZ'
       WHEN b.pk % 13 = 0 THEN concat(' ', lower(b.carrier), ' ') ELSE b.carrier END AS AIRLINE,
  b.flight_number AS FLIGHT_NUMBER,
  concat('N', CAST(b.pk AS STRING)) AS TAIL_NUMBER,
  CASE WHEN b.pk % 97 = 0 THEN '10397' ELSE concat('P', CAST(b.o_id AS STRING)) END AS ORIGIN_AIRPORT,
  CASE WHEN b.pk % 223 = 0 THEN NULL ELSE concat('P', CAST(b.d_id AS STRING)) END AS DESTINATION_AIRPORT,
  CASE WHEN b.pk % 101 = 0 THEN NULL WHEN b.pk % 103 = 0 THEN 'abc'
       WHEN b.hh = 0 AND b.mi = 0 THEN '2400' ELSE {_hhmm("b.start_minute")} END AS SCHEDULED_DEPARTURE,
  {_unless_cancelled(_hhmm("b.departure_minute"))} AS DEPARTURE_TIME,
  {_double(_unless_cancelled("b.dly"))} AS DEPARTURE_DELAY,
  {_double(_unless_cancelled("b.taxi_out"))} AS TAXI_OUT,
  {_unless_cancelled(_hhmm("b.off_minute"))} AS WHEELS_OFF,
  {_double("60 + b.route")} AS SCHEDULED_TIME,
  {_double(_unless_cancelled("60 + b.route - b.qty + 20"))} AS ELAPSED_TIME,
  {_double(_unless_cancelled("30 + b.route"))} AS AIR_TIME,
  100 + b.route * 9 AS DISTANCE,
  {_unless_cancelled(_hhmm("b.on_minute"))} AS WHEELS_ON,
  {_double(_unless_cancelled("b.taxi_in"))} AS TAXI_IN,
  {_hhmm("b.due_minute")} AS SCHEDULED_ARRIVAL,
  {_unless_cancelled(_hhmm("b.arrival_minute"))} AS ARRIVAL_TIME,
  {_double(_unless_cancelled("b.arrival_delay"))} AS ARRIVAL_DELAY,
  b.diverted AS DIVERTED, b.cancelled AS CANCELLED,
  CASE WHEN b.cancelled = 1 THEN
    CASE b.prio WHEN '1' THEN 'A' WHEN '2' THEN 'B' WHEN '3' THEN 'C' WHEN '4' THEN 'D' ELSE 'A' END
  END AS CANCELLATION_REASON,
  {_cause("1, 7")} AS AIR_SYSTEM_DELAY,
  {_cause("2")} AS SECURITY_DELAY,
  {_cause("3, 7")} AS AIRLINE_DELAY,
  {_cause("4")} AS LATE_AIRCRAFT_DELAY,
  {_cause("5")} AS WEATHER_DELAY
FROM (
  SELECT y.*, (start_minute + dly + 1440) % 1440 AS departure_minute,
    (start_minute + dly + taxi_out + 1440) % 1440 AS off_minute,
    (start_minute + 60 + route) % 1440 AS due_minute,
    (start_minute + 60 + route + arrival_delay + 1440) % 1440 AS arrival_minute,
    (start_minute + 60 + route + arrival_delay - taxi_in + 1440) % 1440 AS on_minute
  FROM (
  SELECT CAST(DATE '2015-01-01' + CAST(x.days % 365 AS INT) AS DATE) AS d,
    (x.days % 365) + 3 AS day_number, x.hh * 60 + x.mi AS start_minute, x.o_id * 12 + x.d_id AS route,
    5 + x.qty % 20 AS taxi_out, 2 + x.qty % 9 AS taxi_in, x.dly - x.qty + 20 AS arrival_delay, x.*
  FROM (
    SELECT {_DAYS[engine]} AS days, l.l_partkey AS pk, CAST(l.l_linenumber AS INT) AS ln,
      CAST(l.l_quantity AS INT) AS qty,
      CAST(l.l_suppkey % 12 AS INT) AS o_id, CAST({_NATION[engine]} % 12 AS INT) AS d_id,
      CAST(l.l_partkey % 24 AS INT) AS hh, CAST(l.l_orderkey % 60 AS INT) AS mi,
      CAST(l.l_orderkey % 1000000000 AS INT) AS flight_number,
      CASE CAST(l.l_suppkey % 14 AS INT) {_CARRIER} END AS carrier,
      CAST((l.l_partkey * 7 + l.l_orderkey * 13 + l.l_linenumber) % 260 - 40 AS INT) AS dly,
      CASE WHEN l.l_returnflag = 'R' AND l.l_linenumber = 1 THEN 1 ELSE 0 END AS cancelled,
      CASE WHEN l.l_returnflag = 'A' AND l.l_linenumber = 7 THEN 1 ELSE 0 END AS diverted,
      substr(o.o_orderpriority, 1, 1) AS prio
    FROM {_JOINED[engine]}
  ) x ) y
) b"""


def airlines_sql() -> str:
    rows = ", ".join(f"('{code}', '{name}')" for code, name in AIRLINES)
    return f"SELECT * FROM (VALUES {rows}) AS t(IATA_CODE, AIRLINE)"


AIRPORTS_SQL = """
SELECT concat('P', CAST(n_nationkey AS STRING)) AS IATA_CODE, concat(n_name, ' Airport') AS AIRPORT,
  n_name AS CITY,
  CASE n_nationkey % 8 WHEN 0 THEN 'CA' WHEN 1 THEN 'NY' WHEN 2 THEN 'TX' WHEN 3 THEN 'FL'
    WHEN 4 THEN 'IL' WHEN 5 THEN 'WA' WHEN 6 THEN 'OR' ELSE 'CO' END AS STATE,
  'USA' AS COUNTRY,
  CASE WHEN n_nationkey = 11 THEN NULL ELSE CAST(30 + n_nationkey AS DOUBLE) END AS LATITUDE,
  CASE WHEN n_nationkey = 11 THEN NULL ELSE CAST(-80 - n_nationkey AS DOUBLE) END AS LONGITUDE
FROM nation"""

# A table shaped like the racing tables: quoted text, a nullable integer.
CIRCUITS_SQL = r"""
SELECT CAST(c_custkey AS INT) AS circuitId, lower(c_mktsegment) AS circuitRef,
  concat(c_name, ', "', c_mktsegment, '" Circuit') AS name, concat('Nation ', CAST(c_nationkey AS STRING)) AS location,
  CASE WHEN c_nationkey = 3 THEN NULL ELSE 'USA' END AS country,
  CAST(c_nationkey AS DOUBLE) AS lat, CAST(-c_nationkey AS DOUBLE) AS lng,
  CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE CAST(c_custkey % 900 AS INT) END AS alt,
  concat('http://example.org/', c_name) AS url
FROM customer"""

CONSTRUCTORS_SQL = r"""
SELECT CAST(c_custkey AS INT) AS constructorId, lower(c_mktsegment) AS constructorRef,
  concat(c_name, ' "Works", ', n_name) AS name, CASE WHEN c_nationkey = 5 THEN NULL ELSE n_name END AS nationality,
  CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE concat('http://example.org/team/', c_name) END AS url
FROM customer JOIN nation ON c_nationkey = n_nationkey"""
