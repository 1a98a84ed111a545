"""The documented example queries over the star schema and the views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.functions import kpi
from tarmac.functions.kpi import dep
from tarmac.operators.star import Star
from tarmac.plans import views


def avg_delay_by_airline(star: Star) -> DataFrame:
    grouped = star.fact.groupBy("airline_key").agg(F.avg(dep()).alias("avg_delay"))
    named = views.with_airline(grouped, star, "airline_name")
    return named.drop("airline_key").orderBy(F.desc("avg_delay"), "airline_name")


def delay_by_origin(star: Star) -> DataFrame:
    grouped = (
        star.fact.filter(dep() > 0)
        .groupBy("origin_airport_key")
        .agg(kpi.flights().alias("flights"), F.avg(dep()).alias("avg_delay"))
    )
    named = views.with_airport(grouped, star, "origin", airport_name="airport_name", city="city")
    return named.drop("origin_airport_key").orderBy(F.desc("avg_delay"), "airport_name")


def weather_by_month(star: Star) -> DataFrame:
    weather_key = star.cause.filter("cause_category = 'Weather'").select("delay_cause_key")
    return (
        views.dated(star, "month", "month_name")
        .join(weather_key, "delay_cause_key", "left_semi")
        .groupBy("month", "month_name")
        .agg(kpi.flights().alias("weather_delays"), F.avg(dep()).alias("avg_delay"))
        .orderBy("month")
    )


def worst_airlines(star: Star, n: int = 5) -> DataFrame:
    return (
        views.v_airline_rankings(star)
        .orderBy("ontime_performance_pct", "airline_name")
        .select("airline_name", "ontime_performance_pct", "delay_rank")
        .limit(n)
    )


def peak_cells(star: Star, min_flights: int = 50) -> DataFrame:
    return (
        views.v_peak_congestion_times(star, min_flights)
        .filter("traffic_level = 'Peak'")
        .select("airport_code", "day_of_week", "hour", "congestion_score", "traffic_level")
        .orderBy(F.desc("congestion_score"), "airport_code", "day_of_week", "hour")
    )


def weather_by_season(star: Star, min_flights: int = 100) -> DataFrame:
    """Weather rates per season, recomputed from the sums of the airport months of the weather view."""
    months = views.v_weather_impact(star, min_flights)
    affected, flights = F.sum("weather_affected_flights"), F.sum("total_flights")
    minutes = F.sum("total_weather_delay_minutes")
    return (
        months.groupBy("season")
        .agg(
            kpi.percent(affected, flights, 2).alias("weather_impact_rate"),
            (minutes / F.nullif(affected, F.lit(0))).alias("avg_weather_delay_when_affected"),
        )
        .orderBy(F.desc("weather_impact_rate"), "season")
    )


def recent_trends(star: Star, as_of: str = "2015-12-31", days: int = 30) -> DataFrame:
    since = F.date_sub(F.lit(as_of).cast("date"), days)
    return (
        views.v_historical_delay_trends(star)
        .filter(F.col("date") >= since)
        .select("date", "daily_avg_delay", "delay_7day_moving_avg", "daily_ontime_rate")
        .orderBy("date")
    )
