"""Exploratory aggregates as DuckDB SQL."""

from __future__ import annotations

from tarmac.oracle import star as s
from tarmac.oracle.mapping import AIRLINES
from tarmac.oracle.star import with_star
from tarmac.oracle.views import half_up, pct, std

_CLOCKS = ("SCHEDULED_DEPARTURE", "SCHEDULED_ARRIVAL", "DEPARTURE_TIME", "ARRIVAL_TIME")
_SECONDS = {c: s.SECONDS.format(c) for c in _CLOCKS}


def _clock(column: str) -> str:
    x = f"({_SECONDS[column]})"
    hour, minute = (f"lpad(CAST({part} AS VARCHAR), 2, '0')" for part in (f"{x} // 3600", f"{x} % 3600 // 60"))
    return f"{hour} || ':' || {minute} || ':00'"


_TIMESTAMP = f"""(CAST({s.FLIGHT_DATE} AS TIMESTAMP) + to_seconds({_SECONDS["SCHEDULED_DEPARTURE"]})
  + CASE WHEN {s.NUMBER.format("SCHEDULED_DEPARTURE")} = 2400 THEN INTERVAL 1 DAY ELSE INTERVAL 0 DAY END)"""

EXPLORED = f"""SELECT *, upper(trim(AIRLINE)) AS carrier, upper(trim(ORIGIN_AIRPORT)) AS origin,
  upper(trim(DESTINATION_AIRPORT)) AS destination, {s.FLIGHT_DATE} AS flight_date,
  {_SECONDS["SCHEDULED_DEPARTURE"]} AS departure_seconds, {_SECONDS["SCHEDULED_ARRIVAL"]} AS arrival_seconds,
  TRY_CAST(DEPARTURE_DELAY AS INT) AS delay, TRY_CAST(ARRIVAL_DELAY AS INT) AS arr_delay, {_TIMESTAMP} AS departure_ts
  FROM flights"""

_NEEDED = [
    "carrier", "origin", "destination", "flight_date", "departure_seconds", "arrival_seconds", "delay",
    "arr_delay", "DEPARTURE_TIME", "ARRIVAL_TIME", "SCHEDULED_TIME", "ELAPSED_TIME",
]
ANALYSED = f"SELECT * FROM explored WHERE {' AND '.join(f'{c} IS NOT NULL' for c in _NEEDED)}"


def with_flights(query: str) -> str:
    """The query with the star, ``explored`` and ``analysed`` flights in scope."""
    full = with_star(query)
    head = full[: len(full) - len(query)].rstrip()
    return f"{head}, explored AS ({EXPLORED}), analysed AS ({ANALYSED})\n{query}"


STATS = 'min(delay) AS "min", max(delay) AS "max", count(delay) AS "count", avg(delay) AS mean'

SQL: dict[str, str] = {}
SQL["eda_month_filter"] = "SELECT * FROM flights WHERE MONTH = 1"
SQL["eda_origin_counts"] = """SELECT origin, n AS flights, CASE WHEN n > 1000000 THEN 1000000 WHEN n > 100000
  THEN 100000 WHEN n > 10000 THEN 10000 WHEN n > 1000 THEN 1000 WHEN n > 100 THEN 100 WHEN n > 1 THEN 1 END
  AS size_class FROM (SELECT origin, count(*) AS n FROM explored GROUP BY origin)"""
SQL["eda_flight_date"] = "SELECT flight_date, count(*) AS flights FROM explored GROUP BY 1"
SQL["eda_clock"] = f"""SELECT FLIGHT_NUMBER, TAIL_NUMBER, {_clock("SCHEDULED_DEPARTURE")} AS scheduled_departure,
  {_clock("DEPARTURE_TIME")} AS departure_time, {_clock("SCHEDULED_ARRIVAL")} AS scheduled_arrival,
  {_clock("ARRIVAL_TIME")} AS arrival_time FROM flights"""
SQL["eda_departure_ts"] = "SELECT FLIGHT_NUMBER, TAIL_NUMBER, flight_date, departure_ts FROM explored"
SQL["eda_clean"] = f"""SELECT carrier AS airline, origin, destination, departure_ts AS scheduled_departure,
  {_clock("DEPARTURE_TIME")} AS departure_time, delay, {_clock("SCHEDULED_ARRIVAL")} AS scheduled_arrival,
  {_clock("ARRIVAL_TIME")} AS arrival_time, arr_delay AS arrival_delay, SCHEDULED_TIME AS scheduled_time,
  ELAPSED_TIME AS elapsed_time FROM analysed"""
SQL["eda_airline_stats"] = f"SELECT carrier AS airline, {STATS} FROM analysed GROUP BY 1"
SQL["eda_airline_share"] = f"""SELECT airline, flights,
  {pct("flights", "CAST(sum(flights) OVER () AS BIGINT)")} AS share_pct, greatest(m, 0.0) AS mean_delay
  FROM (SELECT carrier AS airline, count(*) AS flights, avg(delay) AS m FROM analysed GROUP BY 1)"""
SQL["eda_delay_level"] = """SELECT carrier AS airline, CASE WHEN delay <= 5 THEN 0 WHEN delay <= 45 THEN 1 ELSE 2 END
  AS delay_level, count(*) AS flights FROM analysed GROUP BY 1, 2"""
SQL["eda_delay_histogram"] = """SELECT airline, bin, bin * 2.75::DOUBLE + 16.375::DOUBLE AS center,
  coalesce(n, 0) AS n, coalesce(n, 0) / (CAST(total AS DOUBLE) * 2.75::DOUBLE) AS density
  FROM (SELECT carrier AS airline, count(*) AS total FROM analysed WHERE delay BETWEEN 15 AND 180 GROUP BY 1) a
  CROSS JOIN (SELECT CAST(range AS INT) AS bin FROM range(60)) b
  LEFT JOIN (SELECT carrier AS airline, CAST(least((delay - 15) * 4 // 11, 59) AS INT) AS bin, count(*) AS n
    FROM analysed WHERE delay BETWEEN 15 AND 180 GROUP BY 1, 2) c USING (airline, bin)"""


def _project(b: str) -> dict[str, str]:
    """Sums over the bars (lists ``xs`` and ``ys``) with the basis exp(-x / b): those of the best amplitude, and of the
    derivative of the error."""
    e = f"exp(-p[1] / {b})"

    def total(term: str) -> str:
        return f"list_sum(list_transform(list_zip(xs, ys), lambda p: {term}))"

    return {
        "a": f"({total(f'{e} * p[2]')} / {total(f'{e} * {e}')})",
        "error": total(f"power(p[2] - AMPLITUDE * {e}, 2)"),
        "slope": total(f"(p[2] - AMPLITUDE * {e}) * {e} * p[1]"),
    }


# The scale is searched as in variable projection: a grid, then bisection in a recursive query of 60 steps.
_MID = "exp((low + high) / 2)"
_GRID, _HALF = _project("b"), _project("middle")
_LOG_STEP = "(ln(5000.0::DOUBLE) / 199)"
SQL["eda_delay_exp_fit"] = f"""SELECT * FROM (WITH RECURSIVE bars AS (
    SELECT airline, list(center ORDER BY bin) AS xs, list(density ORDER BY bin) AS ys
    FROM ({SQL["eda_delay_histogram"]}) GROUP BY airline),
  grid AS (SELECT *, {_GRID["error"].replace("AMPLITUDE", "a")} AS error FROM (
    SELECT *, {_GRID["a"]} AS a FROM (SELECT *, exp(i * {_LOG_STEP}) AS b FROM bars, range(200) steps(i)))),
  nearest AS (SELECT airline, arg_min(i, (error, i)) AS i FROM grid GROUP BY airline),
  halved(airline, xs, ys, low, high, step) AS (
    SELECT airline, xs, ys, greatest(i - 1, 0) * {_LOG_STEP}, least(i + 1, 199) * {_LOG_STEP}, 0
    FROM bars JOIN nearest USING (airline)
    UNION ALL
    SELECT airline, xs, ys, CASE WHEN up > 0 THEN (low + high) / 2 ELSE low END,
      CASE WHEN up > 0 THEN high ELSE (low + high) / 2 END, step + 1
    FROM (SELECT *, {_HALF["slope"].replace("AMPLITUDE", "a")} * a AS up FROM (
      SELECT *, {_HALF["a"]} AS a FROM (SELECT *, {_MID} AS middle FROM halved WHERE step < 60)))),
  fits AS (SELECT airline, {_HALF["a"]} AS a, middle AS b FROM (SELECT *, {_MID} AS middle FROM halved WHERE step = 60))
  SELECT airline, {half_up("a", 6)} AS a, {half_up("b", 4)} AS b,
    CAST(rank() OVER (ORDER BY fits.a) AS INT) AS large_delay_rank FROM fits)"""
SQL["eda_dep_vs_arr"] = """SELECT carrier AS airline, avg(delay) AS mean_departure_delay,
  avg(arr_delay) AS mean_arrival_delay FROM analysed GROUP BY 1"""
SQL["eda_airport_count"] = "SELECT count(DISTINCT origin) AS airports FROM analysed"
SQL["eda_airports_per_airline"] = """SELECT carrier AS airline, count(DISTINCT origin) AS airports
  FROM analysed GROUP BY 1"""
_LOCATED = "(SELECT IATA_CODE FROM airports WHERE LATITUDE IS NOT NULL AND LONGITUDE IS NOT NULL)"
SQL["eda_route_volume"] = f"""SELECT *, CASE WHEN flights >= 200 THEN '>= 200' WHEN flights >= 100 THEN '100 - 200'
  ELSE '< 100' END AS volume_class FROM (SELECT carrier AS airline, origin, destination, count(*) AS flights
  FROM analysed WHERE origin IN {_LOCATED} AND destination IN {_LOCATED} GROUP BY 1, 2, 3)"""
SQL["eda_airport_carrier_pivot"] = """SELECT origin, carrier AS airline, avg(delay) AS mean_delay
  FROM analysed GROUP BY ALL HAVING avg(delay) IS NOT NULL"""
SQL["eda_route_delay"] = f"""SELECT *, least(mean_delay + 15, std_delay) AS std_min FROM (
  SELECT carrier AS airline, origin || '-' || destination AS route, count(*) AS flights,
    avg(least(delay, 90)) AS mean_delay, {std("least(delay, 90)")} AS std_delay FROM analysed GROUP BY 1, 2)"""
SQL["eda_airport_series"] = """SELECT departure_ts, FLIGHT_NUMBER, TAIL_NUMBER, delay, departure_seconds
  FROM analysed WHERE carrier = 'WN' AND origin = 'P5' AND arr_delay > 0"""
SQL["eda_time_of_day"] = f"SELECT departure_seconds, {STATS} FROM analysed GROUP BY 1"
_DET = "(sxx * szz - sxz * sxz)"
_FIT = f"""my + (szz * sxy - sxz * szy) / {_DET} * (x - mx) + (sxx * szy - sxz * sxy) / {_DET} * (x * x - mz)"""
SQL["eda_quadratic_fit"] = f"""
SELECT departure_seconds, "min", "max", "count", mean, {half_up(_FIT, 6)} AS fit
FROM (SELECT *, departure_seconds / 86400.0::DOUBLE AS x FROM ({SQL["eda_time_of_day"]})) p,
  (SELECT avg(y) AS my, avg(x) AS mx, avg(z) AS mz, var_pop(x) AS sxx, var_pop(z) AS szz, covar_pop(x, z) AS sxz,
    covar_pop(x, y) AS sxy, covar_pop(z, y) AS szy
   FROM (SELECT mean AS y, departure_seconds / 86400.0::DOUBLE AS x, power(departure_seconds / 86400.0::DOUBLE, 2) AS z
     FROM ({SQL["eda_time_of_day"]})))"""
SQL["eda_airport_census"] = f"""SELECT origin, {STATS} FROM analysed WHERE carrier = 'AA' GROUP BY 1
  ORDER BY "count", origin LIMIT 5"""


def oracle(name: str) -> str | None:
    return with_flights(SQL[name]) if name in SQL else None
