"""The KPI views and documented example queries as DuckDB SQL over the star of ``tarmac.oracle.star``."""

from __future__ import annotations

from tarmac.oracle.star import with_star

N = "count(*)"
C = "count(*) FILTER (WHERE NOT is_cancelled)"
DEP, ARR, WX = "departure_delay_minutes", "arrival_delay_minutes", "weather_delay_minutes"
PEAK = "(hour BETWEEN 6 AND 9 OR hour BETWEEN 17 AND 20)"


def cnt(condition: str) -> str:
    return f"count(*) FILTER (WHERE {condition})"


def flown(condition: str) -> str:
    return f"count(*) FILTER (WHERE ({condition}) AND NOT is_cancelled)"


def avg_flown(value: str, extra: str = "TRUE") -> str:
    return f"avg({value}) FILTER (WHERE NOT is_cancelled AND {extra})"


def pct(part: str, whole: str, digits: int = 2) -> str:
    unit = 10**digits
    return f"CAST(({200 * unit} * ({part}) + ({whole})) // nullif(2 * ({whole}), 0) AS DOUBLE) / {unit}.0"


def round_ratio(total: str, n: str, digits: int) -> str:
    unit = 10**digits
    size = f"(({2 * unit} * abs({total}) + ({n})) // nullif(2 * ({n}), 0))"
    return f"CAST(CASE WHEN ({total}) < 0 THEN -{size} ELSE {size} END AS DOUBLE) / {unit}.0"


def round_avg(value: str, digits: int, condition: str = "NOT is_cancelled") -> str:
    keep = f"FILTER (WHERE {condition})"
    return round_ratio(f"sum({value}) {keep}", f"count({value}) {keep}", digits)


def half_up(x: str, digits: int) -> str:
    unit = f"{10**digits}.0::DOUBLE"
    size = f"(floor(abs({x}) * {unit} + 0.5) / {unit})"
    return f"(CASE WHEN ({x}) < 0 THEN -{size} ELSE {size} END + 0.0)"


def std(value: str, condition: str = "TRUE") -> str:
    keep = f"FILTER (WHERE {condition})"
    x = f"CAST({value} AS DOUBLE)"
    n = f"CAST(nullif(count({value}) {keep}, 0) AS DOUBLE)"
    mean = f"(sum({x}) {keep} / {n})"
    variance = f"(sum({x} * {x}) {keep} / {n} - {mean} * {mean})"
    return f"sqrt(CASE WHEN {variance} < 0 THEN 0.0 ELSE {variance} END)"


def big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


ONTIME = flown(f"{DEP} <= 15")
LATE = flown(f"{DEP} > 15")
CANCEL_RATE = pct(cnt("is_cancelled"), N)
FLIGHT = "fact f"
AIRLINE = "JOIN dim_airline USING (airline_key)"
CAUSE = "JOIN dim_delay_cause USING (delay_cause_key)"
ORIGIN = "JOIN dim_airport o ON o.airport_key = f.origin_airport_key"
DESTINATION = "JOIN dim_airport d ON d.airport_key = f.destination_airport_key"
DATE = "JOIN dim_date t ON t.date_key = f.date_key"
HOUR = "JOIN dim_time h ON h.time_key = f.departure_time_key"
MEAN_DEP = f"(CAST(sum({DEP}) FILTER (WHERE NOT is_cancelled) AS DOUBLE) / nullif({C}, 0))"

VIEWS: dict[str, str] = {}

VIEWS["v_carrier_performance"] = f"""
SELECT airline_code, airline_name, airline_type, t.year, t.quarter, t.month, {N} AS total_flights,
  {C} AS completed_flights, {cnt("is_cancelled")} AS cancelled_flights, {cnt("is_diverted")} AS diverted_flights,
  {avg_flown(DEP)} AS avg_departure_delay, {avg_flown(ARR)} AS avg_arrival_delay,
  {ONTIME} AS ontime_departures, {pct(ONTIME, C)} AS ontime_departure_rate,
  {flown(f"{DEP} BETWEEN 16 AND 60")} AS moderate_delays, {flown(f"{DEP} > 60")} AS significant_delays,
  {CANCEL_RATE} AS cancellation_rate, {avg_flown("actual_elapsed_minutes")} AS avg_actual_flight_time,
  avg(scheduled_elapsed_minutes) AS avg_scheduled_flight_time,
  {avg_flown("taxi_out_minutes")} AS avg_taxi_out_time, {avg_flown("taxi_in_minutes")} AS avg_taxi_in_time
FROM {FLIGHT} {AIRLINE} {DATE} GROUP BY ALL"""


def airport_congestion(min_flights: int) -> str:
    return f"""
SELECT airport_code, airport_name, city, state, airport_size_category, t.year, t.quarter, t.month,
  {N} AS total_departures, {C} AS completed_departures, {avg_flown(DEP)} AS avg_departure_delay,
  {LATE} AS delayed_departures, {pct(LATE, C)} AS departure_delay_rate,
  {avg_flown("taxi_out_minutes")} AS avg_taxi_out_time,
  max(taxi_out_minutes) FILTER (WHERE NOT is_cancelled) AS max_taxi_out_time,
  {flown(f"{DEP} > 60")} AS severe_delays, {flown(f"{DEP} > 180")} AS extreme_delays,
  {cnt("is_cancelled")} AS cancelled_departures, {CANCEL_RATE} AS cancellation_rate,
  {cnt("hour BETWEEN 6 AND 9")} AS morning_rush_flights, {cnt("hour BETWEEN 17 AND 20")} AS evening_rush_flights,
  {avg_flown(DEP, "hour BETWEEN 6 AND 9")} AS morning_rush_avg_delay,
  {avg_flown(DEP, "hour BETWEEN 17 AND 20")} AS evening_rush_avg_delay
FROM {FLIGHT} {ORIGIN} {DATE} LEFT {HOUR} GROUP BY ALL HAVING {N} >= {min_flights}"""


def route_optimization(min_flights: int) -> str:
    speed = f"avg(distance_miles) / nullif({avg_flown('air_time_minutes')}, 0.0) * 60"
    return f"""
SELECT o.airport_code || '-' || d.airport_code AS route_code, o.city AS origin_city, o.state AS origin_state,
  d.city AS destination_city, d.state AS destination_state, distance_miles, t.year, t.quarter,
  {N} AS total_flights, count(DISTINCT airline_code) AS airlines_serving_route, {C} AS completed_flights,
  {avg_flown(DEP)} AS avg_departure_delay, {avg_flown(ARR)} AS avg_arrival_delay,
  {avg_flown("actual_elapsed_minutes")} AS avg_flight_time, avg(scheduled_elapsed_minutes) AS scheduled_flight_time,
  {pct(ONTIME, C)} AS ontime_performance_rate, {flown(f"{DEP} > 60")} AS significant_delays,
  {CANCEL_RATE} AS cancellation_rate, {half_up(speed, 0)} AS avg_speed_mph,
  {avg_flown(DEP, "season = 'Winter'")} AS winter_avg_delay, {avg_flown(DEP, "season = 'Summer'")} AS summer_avg_delay,
  {half_up(f"{MEAN_DEP} * {N} / 1000", 2)} AS delay_impact_score
FROM {FLIGHT} {ORIGIN} {DESTINATION} {AIRLINE} {DATE} GROUP BY ALL HAVING {N} >= {min_flights}"""


VIEWS["v_temporal_patterns"] = f"""
SELECT t.year, t.quarter, t.month, day_name, day_of_week, season, is_weekend, is_holiday, hour, hour_category,
  time_period, is_business_hours, {N} AS total_flights, {C} AS completed_flights,
  {avg_flown(DEP)} AS avg_departure_delay, {std(DEP, "NOT is_cancelled")} AS delay_variability,
  {LATE} AS delayed_flights, {pct(LATE, C)} AS delay_rate, {flown(f"{DEP} > 60")} AS severe_delays,
  {flown(f"{DEP} > 180")} AS extreme_delays, {cnt("is_cancelled")} AS cancelled_flights,
  {CANCEL_RATE} AS cancellation_rate, {cnt(f"{WX} > 0")} AS weather_affected_flights,
  avg({WX}) FILTER (WHERE {WX} > 0) AS avg_weather_delay,
  CASE WHEN hour IS NULL OR hour < 6 THEN 'Overnight' WHEN hour < 10 THEN 'Morning Peak'
    WHEN hour < 17 THEN 'Midday' WHEN hour < 21 THEN 'Evening Peak' ELSE 'Late Evening' END AS traffic_period
FROM {FLIGHT} {DATE} LEFT {HOUR} GROUP BY ALL"""


def weather_impact(min_flights: int) -> str:
    seasons = ", ".join(
        f"avg(CASE WHEN season = '{s}' THEN {WX} ELSE 0 END) AS {s.lower()}_avg_weather_delay"
        for s in ("Winter", "Spring", "Summer", "Fall")
    )
    return f"""
SELECT t.year, t.quarter, t.month, season, o.airport_code AS origin_airport, o.city AS origin_city,
  o.state AS origin_state, {N} AS total_flights, {cnt(f"{WX} > 0")} AS weather_affected_flights,
  {pct(cnt(f"{WX} > 0"), N)} AS weather_impact_rate, {big(f"sum({WX})")} AS total_weather_delay_minutes,
  avg({WX}) FILTER (WHERE {WX} > 0) AS avg_weather_delay_when_affected, max({WX}) AS max_weather_delay,
  {big(f"sum({WX})")} AS weather_delays, {big("sum(air_system_delay_minutes)")} AS air_system_delays,
  {big("sum(airline_delay_minutes)")} AS airline_delays,
  {big("sum(late_aircraft_delay_minutes)")} AS late_aircraft_delays,
  {big("sum(security_delay_minutes)")} AS security_delays, {cnt(f"{WX} BETWEEN 1 AND 30")} AS minor_weather_delays,
  {cnt(f"{WX} BETWEEN 31 AND 120")} AS moderate_weather_delays, {cnt(f"{WX} > 120")} AS severe_weather_delays,
  {cnt("is_cancelled AND cancellation_reason = 'B'")} AS weather_cancellations, {seasons},
  avg({ARR} - {DEP}) FILTER (WHERE {WX} > 0) AS avg_recovery_time
FROM {FLIGHT} {DATE} {ORIGIN} GROUP BY ALL HAVING {N} >= {min_flights}"""


VIEWS["v_root_cause_analysis"] = f"""
SELECT cause_code, cause_name, cause_category, is_controllable, severity_weight, airline_code, airline_name,
  airline_type, t.year, t.quarter, {N} AS total_affected_flights, {big(f"sum({DEP})")} AS total_delay_minutes,
  avg({DEP}) AS avg_delay_minutes,
  {pct(N, f"CAST(sum({N}) OVER (PARTITION BY airline_code, t.year, t.quarter) AS BIGINT)")} AS pct_of_airline_delays,
  {cnt(f"{DEP} <= 15")} AS minor_delays, {cnt(f"{DEP} BETWEEN 16 AND 60")} AS moderate_delays,
  {cnt(f"{DEP} BETWEEN 61 AND 180")} AS significant_delays, {cnt(f"{DEP} > 180")} AS severe_delays,
  CAST(sum({DEP}) * 50 AS DOUBLE) AS estimated_delay_cost_usd,
  CASE WHEN is_controllable THEN 'Controllable' ELSE 'External' END AS controllability,
  {round_ratio(f"sum({DEP}) * (CASE WHEN is_controllable THEN 15 ELSE 8 END)", "10000", 2)}
    AS improvement_opportunity_score
FROM {FLIGHT} {CAUSE} {AIRLINE} {DATE} WHERE {DEP} > 0
GROUP BY cause_code, cause_name, cause_category, is_controllable, severity_weight, airline_code, airline_name,
  airline_type, t.year, t.quarter"""

VIEWS["v_severity_classification"] = f"""
SELECT delay_severity_category, airline_code, airline_name, o.airport_code AS origin_airport,
  o.city AS origin_city, t.year, t.quarter, t.month, {N} AS flight_count,
  {pct(N, f"CAST(sum({N}) OVER (PARTITION BY airline_code, t.year, t.quarter) AS BIGINT)")} AS pct_of_airline_flights,
  avg({DEP}) AS avg_departure_delay, avg({ARR}) AS avg_arrival_delay, min({DEP}) AS min_delay,
  max({DEP}) AS max_delay, {std(DEP)} AS delay_std_dev,
  {avg_flown("actual_elapsed_minutes - scheduled_elapsed_minutes")} AS avg_schedule_variance,
  {cnt("is_diverted")} AS diversions, {N} * 150 AS estimated_affected_passengers,
  {big(f"sum({DEP}) * 150")} AS total_passenger_delay_minutes, avg({ARR} - {DEP}) AS avg_airborne_recovery,
  {cnt(f"{ARR} < {DEP}")} AS flights_with_recovery,
  CASE delay_severity_category WHEN 'Cancelled' THEN 'Rebooking Required' WHEN 'Severe Delay' THEN
    'High Rebooking Risk' WHEN 'Significant Delay' THEN 'Moderate Rebooking Risk' ELSE 'Low Rebooking Risk' END
    AS rebooking_risk_category,
  CASE delay_severity_category WHEN 'Cancelled' THEN 'High Cost' WHEN 'Severe Delay' THEN 'High Cost'
    WHEN 'Significant Delay' THEN 'Medium Cost' ELSE 'Low Cost' END AS cost_impact_category
FROM {FLIGHT} {AIRLINE} {ORIGIN} {DATE}
GROUP BY delay_severity_category, airline_code, airline_name, o.airport_code, o.city, t.year, t.quarter, t.month"""


def disruption_analysis(min_flights: int) -> str:
    weighted = f"({cnt('is_cancelled')} * 2.0 + {cnt('is_diverted')} * 1.5 + {cnt(f'{DEP} > 180')})::DOUBLE"
    reasons = ", ".join(
        f"{cnt(f'cancellation_reason = {code!r}')} AS {name}_cancellations"
        for code, name in (("A", "carrier"), ("B", "weather"), ("C", "nas"), ("D", "security"))
    )
    return f"""
SELECT airline_code, airline_name, o.airport_code AS origin_airport, o.city AS origin_city,
  d.airport_code AS destination_airport, d.city AS destination_city, t.year, t.quarter, season, day_name,
  {N} AS total_scheduled_flights, {cnt("NOT is_cancelled AND NOT is_diverted")} AS completed_as_planned,
  {cnt("is_cancelled")} AS cancellations, {cnt("is_diverted")} AS diversions,
  {cnt("is_cancelled OR is_diverted")} AS total_disruptions, {CANCEL_RATE} AS cancellation_rate,
  {pct(cnt("is_diverted"), N)} AS diversion_rate, {pct(cnt("is_cancelled OR is_diverted"), N)} AS disruption_rate,
  {reasons}, avg({DEP}) FILTER (WHERE {DEP} > 0) AS avg_delay_when_delayed, {cnt(f"{DEP} > 180")} AS extreme_delays,
  {cnt(f"{WX} > 60")} AS severe_weather_delays, avg(late_aircraft_delay_minutes) AS avg_late_aircraft_delay,
  {cnt("late_aircraft_delay_minutes > 0")} AS flights_with_late_aircraft,
  {half_up(f"{weighted} * {N} / 10000.0::DOUBLE", 2)} AS disruption_impact_score,
  avg({ARR} - {DEP}) FILTER (WHERE NOT is_cancelled AND {DEP} > 60) AS avg_delay_recovery
FROM {FLIGHT} {AIRLINE} {ORIGIN} {DESTINATION} {DATE} GROUP BY ALL HAVING {N} >= {min_flights}"""


SHARE = f"({ONTIME} * 100.0::DOUBLE / nullif({C}, 0))"

VIEWS["v_airline_monthly_summary"] = f"""
SELECT airline_code, airline_name, airline_type, t.year, t.month, month_name, {N} AS total_flights,
  {C} AS completed_flights, {round_avg(DEP, 1)} AS avg_departure_delay, {pct(ONTIME, C, 1)} AS ontime_performance_pct,
  {CANCEL_RATE} AS cancellation_rate,
  CAST(rank() OVER (PARTITION BY t.year, t.month ORDER BY {SHARE} DESC NULLS LAST) AS INT) AS ontime_rank,
  CAST(rank() OVER (PARTITION BY t.year, t.month ORDER BY {avg_flown(DEP)} NULLS FIRST) AS INT) AS delay_rank
FROM {FLIGHT} {AIRLINE} {DATE} GROUP BY airline_code, airline_name, airline_type, t.year, t.month, month_name"""


def airport_daily_metrics(min_flights: int) -> str:
    return f"""
SELECT airport_code, airport_name, city, state, t.date, day_name, is_weekend, is_holiday, {N} AS daily_departures,
  {C} AS completed_departures, {cnt("is_cancelled")} AS cancelled_departures,
  {round_avg(DEP, 1)} AS avg_departure_delay,
  max({DEP}) FILTER (WHERE NOT is_cancelled) AS max_departure_delay, {flown(f"{DEP} > 60")} AS severe_delays,
  {cnt(f"{WX} > 0")} AS weather_affected_flights, {big(f"sum({WX})")} AS total_weather_delay_minutes,
  {round_avg("taxi_out_minutes", 1)} AS avg_taxi_out_minutes,
  {cnt("hour BETWEEN 6 AND 9")} AS morning_peak_flights, {cnt("hour BETWEEN 17 AND 20")} AS evening_peak_flights
FROM {FLIGHT} {ORIGIN} {DATE} LEFT {HOUR} GROUP BY ALL HAVING {N} >= {min_flights}"""


def hourly_delay_patterns(min_flights: int) -> str:
    return f"""
SELECT hour, hour_category, day_of_week, day_name, is_weekend, {N} AS flights_per_hour,
  {C} AS completed_flights_per_hour, {round_avg(DEP, 1)} AS avg_hourly_delay,
  {half_up(std(DEP, "NOT is_cancelled"), 1)} AS delay_std_dev, {pct(LATE, C, 1)} AS hourly_delay_rate,
  CAST({PEAK} AS INT) AS is_peak_hour
FROM {FLIGHT} {HOUR} {DATE} GROUP BY ALL HAVING {N} >= {min_flights}"""


def top_delayed_routes(min_flights: int, top: int) -> str:
    return f"""
SELECT o.airport_code || '-' || d.airport_code AS route_code,
  o.city || ', ' || o.state || ' → ' || d.city || ', ' || d.state AS route_description, distance_miles,
  {N} AS total_flights, count(DISTINCT airline_code) AS airlines_serving, {round_avg(DEP, 1)} AS avg_departure_delay,
  {LATE} AS delayed_flights, {pct(LATE, C, 1)} AS delay_rate_pct,
  {half_up(f"{MEAN_DEP} * {N} / 100", 1)} AS delay_impact_score, {CANCEL_RATE} AS cancellation_rate
FROM {FLIGHT} {ORIGIN} {DESTINATION} {AIRLINE} GROUP BY ALL HAVING {N} >= {min_flights}
ORDER BY delay_impact_score DESC NULLS LAST, route_code, distance_miles LIMIT {top}"""


def airline_rankings(min_flights: int) -> str:
    cancelled = f"({cnt('is_cancelled')} * 100.0::DOUBLE / {N})"
    return f"""
SELECT airline_code, airline_name, airline_type, {N} AS total_flights, {C} AS completed_flights,
  {round_avg(DEP, 2)} AS avg_departure_delay, {pct(ONTIME, C)} AS ontime_performance_pct,
  {CANCEL_RATE} AS cancellation_rate,
  CAST(rank() OVER (ORDER BY {SHARE} DESC NULLS LAST) AS INT) AS ontime_rank,
  CAST(rank() OVER (ORDER BY {avg_flown(DEP)} NULLS FIRST) AS INT) AS delay_rank,
  CAST(rank() OVER (ORDER BY {cancelled} NULLS FIRST) AS INT) AS cancellation_rank,
  CASE WHEN {SHARE} >= 80 THEN 'Excellent' WHEN {SHARE} >= 70 THEN 'Good' WHEN {SHARE} >= 60 THEN 'Fair'
    ELSE 'Poor' END AS performance_grade
FROM {FLIGHT} {AIRLINE} GROUP BY airline_code, airline_name, airline_type HAVING {N} >= {min_flights}"""


def peak_congestion_times(min_flights: int) -> str:
    score = "flights_per_hour / nullif(avg_hourly_flights, 0.0) * (1 + delay / 60)"
    return f"""
SELECT * EXCLUDE (delay), {half_up(score, 2)} AS congestion_score,
  CASE WHEN flights_per_hour >= avg_hourly_flights * 1.5 THEN 'Peak'
    WHEN flights_per_hour >= avg_hourly_flights * 1.2 THEN 'High'
    WHEN flights_per_hour >= avg_hourly_flights * 0.8 THEN 'Normal' ELSE 'Low' END AS traffic_level
FROM (SELECT *, avg(flights_per_hour) OVER (PARTITION BY airport_code) AS avg_hourly_flights FROM (
  SELECT airport_code, airport_name, city, state, airport_size_category, hour, hour_category, day_of_week, day_name,
    {N} AS flights_per_hour, {round_avg(DEP, 1)} AS avg_departure_delay,
    {round_avg("taxi_out_minutes", 1)} AS avg_taxi_out_minutes,
    max(taxi_out_minutes) FILTER (WHERE NOT is_cancelled) AS max_taxi_out_minutes, {avg_flown(DEP)} AS delay
  FROM {FLIGHT} {ORIGIN} {HOUR} {DATE} GROUP BY ALL HAVING {N} >= {min_flights}))"""


VIEWS["v_executive_dashboard"] = f"""
SELECT 'Overall Performance' AS metric_category, q.*, w.airline_name AS worst_performing_airline
FROM (SELECT t.year, t.quarter, {N} AS total_system_flights, {C} AS completed_flights,
    {cnt("is_cancelled")} AS cancelled_flights, {round_avg(DEP, 2)} AS avg_system_delay,
    {pct(ONTIME, C)} AS system_ontime_performance, {CANCEL_RATE} AS system_cancellation_rate,
    {round_ratio(f"coalesce(sum({DEP}) FILTER (WHERE NOT is_cancelled), 0) * 50", "1000000", 1)}
      AS delay_cost_millions_usd,
    {pct(cnt(f"{WX} > 0"), N)} AS weather_impact_rate,
    {pct(cnt(f"{DEP} > 180 OR is_cancelled"), N)} AS severe_disruption_rate
  FROM {FLIGHT} {DATE} GROUP BY t.year, t.quarter) q
LEFT JOIN (SELECT t.year, t.quarter, airline_name,
    row_number() OVER (PARTITION BY t.year, t.quarter ORDER BY {avg_flown(DEP)} DESC NULLS LAST, airline_name) AS place
  FROM {FLIGHT} {AIRLINE} {DATE} GROUP BY t.year, t.quarter, airline_name) w
  ON w.year = q.year AND w.quarter = q.quarter AND w.place = 1"""


def _trailing(group: str) -> str:
    return (
        f"avg({DEP}) OVER (PARTITION BY {group} ORDER BY t.date, flight_key"
        " ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING)"
    )


VIEWS["v_flight_delay_features"] = f"""
SELECT flight_key, airline_code, airline_type, o.airport_code AS origin_airport, o.state AS origin_state,
  d.airport_code AS destination_airport, d.state AS destination_state, t.month, day_of_week, season, hour,
  hour_category, is_weekend, is_holiday, is_business_hours, CAST(coalesce({PEAK}, FALSE) AS INT) AS is_peak_hour,
  distance_miles, scheduled_elapsed_minutes,
  {_trailing("airline_code, o.airport_code")} AS historical_avg_delay_airline_airport,
  {_trailing("o.airport_code, d.airport_code")} AS historical_avg_delay_route,
  {_trailing("hour, day_of_week")} AS historical_avg_delay_time,
  CAST({WX} > 0 AS INT) AS has_weather_delay, {DEP} AS target_departure_delay,
  CAST({DEP} > 15 AS INT) AS target_is_delayed, is_cancelled AS target_is_cancelled
FROM {FLIGHT} {AIRLINE} {ORIGIN} {DESTINATION} {DATE} LEFT {HOUR}"""

VIEWS["v_historical_delay_trends"] = f"""
SELECT *, {half_up("avg(daily_avg_delay) OVER (ORDER BY date ROWS 6 PRECEDING)", 6)} AS delay_7day_moving_avg,
  {half_up("avg(daily_avg_delay) OVER (ORDER BY date ROWS 29 PRECEDING)", 6)} AS delay_30day_moving_avg,
  CAST(month IN (12, 1, 2) AS INT) AS is_winter, CAST(month IN (6, 7, 8) AS INT) AS is_summer,
  CAST((SELECT min(n.date) FROM dim_date n WHERE n.is_holiday AND n.date >= s.date) - s.date AS INT)
    AS days_to_next_holiday
FROM (SELECT t.date, t.year, t.month, day_of_year, day_of_week, season, {N} AS daily_flights,
    {avg_flown(DEP)} AS daily_avg_delay, {std(DEP, "NOT is_cancelled")} AS daily_delay_std,
    {pct(ONTIME, C)} AS daily_ontime_rate, {CANCEL_RATE} AS daily_cancellation_rate,
    {cnt(f"{WX} > 0")} AS daily_weather_affected_flights, {big(f"sum({WX})")} AS daily_total_weather_delay
  FROM {FLIGHT} {DATE} GROUP BY ALL) s"""


def view_sql(name: str, **options: int) -> str:
    """A view with its thresholds, without the star schema in scope."""
    builders = {
        "v_airport_congestion": (airport_congestion, {"min_flights": 10}),
        "v_route_optimization": (route_optimization, {"min_flights": 50}),
        "v_weather_impact": (weather_impact, {"min_flights": 100}),
        "v_disruption_analysis": (disruption_analysis, {"min_flights": 20}),
        "v_airport_daily_metrics": (airport_daily_metrics, {"min_flights": 5}),
        "v_hourly_delay_patterns": (hourly_delay_patterns, {"min_flights": 100}),
        "v_top_delayed_routes": (top_delayed_routes, {"min_flights": 100, "top": 50}),
        "v_airline_rankings": (airline_rankings, {"min_flights": 1000}),
        "v_peak_congestion_times": (peak_congestion_times, {"min_flights": 50}),
    }
    if name in VIEWS:
        return VIEWS[name]
    build, defaults = builders[name]
    return build(**{**defaults, **options})


def view_oracle(name: str, **options: int) -> str:
    return with_star(view_sql(name, **options))


EXAMPLES = {
    "ex_avg_delay_by_airline": f"SELECT airline_name, avg({DEP}) AS avg_delay FROM {FLIGHT} {AIRLINE} GROUP BY 1",
    "ex_delay_by_origin": f"""SELECT airport_name, city, {N} AS flights, avg({DEP}) AS avg_delay
  FROM {FLIGHT} {ORIGIN} WHERE {DEP} > 0 GROUP BY o.airport_key, airport_name, city""",
    "ex_weather_by_month": f"""SELECT t.month, month_name, {N} AS weather_delays, avg({DEP}) AS avg_delay
  FROM {FLIGHT} {DATE} {CAUSE} WHERE cause_category = 'Weather' GROUP BY ALL""",
    "ex_worst5_airlines": f"""SELECT airline_name, ontime_performance_pct, delay_rank
  FROM ({view_sql("v_airline_rankings")}) ORDER BY ontime_performance_pct, airline_name LIMIT 5""",
    "ex_peak_cells": f"""SELECT airport_code, day_of_week, hour, congestion_score, traffic_level
  FROM ({view_sql("v_peak_congestion_times", min_flights=20)}) WHERE traffic_level = 'Peak'""",
    "ex_weather_by_season": f"""SELECT season,
  {pct("CAST(sum(weather_affected_flights) AS BIGINT)", "CAST(sum(total_flights) AS BIGINT)")} AS weather_impact_rate,
  CAST(sum(total_weather_delay_minutes) AS DOUBLE) / nullif(sum(weather_affected_flights), 0)
    AS avg_weather_delay_when_affected
  FROM ({view_sql("v_weather_impact")}) GROUP BY season""",
    "ex_recent_trends": f"""SELECT date, daily_avg_delay, delay_7day_moving_avg, daily_ontime_rate
  FROM ({view_sql("v_historical_delay_trends")}) WHERE date >= DATE '2015-12-31' - 30""",
}


def example_oracle(name: str) -> str:
    return with_star(EXAMPLES[name])
