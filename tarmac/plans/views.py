"""The 17 KPI views over the star schema.

Each view groups the fact by its surrogate keys and narrow calendar attributes and attaches names,
cities and other text afterwards, to the few aggregated rows. The flight rows therefore cross the
network at most once, already pre-aggregated, and skewed keys shrink before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.functions import kpi, rules
from tarmac.functions.kpi import arr, cancelled, dep, is_flown, is_late, is_ontime, weather
from tarmac.functions.measures import Figures, Measures
from tarmac.operators.partials import MONTH
from tarmac.operators.star import Star
from tarmac.operators.trailing import PEERS, with_averages


def flights_of(star: Star) -> DataFrame:
    """Fact rows, the columns of their partition named apart from those of the calendar."""
    return star.fact.withColumnsRenamed(dict(zip(("year", "month"), MONTH)))


def dated(star: Star, *columns: str) -> DataFrame:
    """Fact rows with attributes of their date."""
    return flights_of(star).join(star.date.select("date_key", *columns), "date_key")


def timed(df: DataFrame, star: Star, how: str, *columns: str) -> DataFrame:
    """Add attributes of the departure hour."""
    hours = star.time.select(F.col("time_key").alias("departure_time_key"), *columns)
    return df.join(hours, "departure_time_key", how)


def with_airline(df: DataFrame, star: Star, *columns: str) -> DataFrame:
    return df.join(star.airline.select("airline_key", *columns), "airline_key")


def with_airport(df: DataFrame, star: Star, role: str, **renamed: str) -> DataFrame:
    """Add airport attributes for one role; ``renamed`` maps output name to airport column."""
    key = f"{role}_airport_key"
    picked = [F.col(column).alias(name) for name, column in renamed.items()]
    return df.join(star.airport.select(F.col("airport_key").alias(key), *picked), key)


def summed(star: Star, view: str, rows: DataFrame, keys: list[str], figures: Figures) -> DataFrame:
    """Figures by ``keys`` over the rows that a view looks at, with the help of stored monthly states if the star
    has them: then only the months without valid states are read."""
    if star.partials is not None:
        return star.partials.grouped(view, rows, keys, figures)
    return rows.groupBy(*keys).agg(*figures(Measures()))


def v_carrier_performance(star: Star) -> DataFrame:
    def figures(m: Measures) -> list[Column]:
        return [
            m.flights().alias("total_flights"),
            m.completed().alias("completed_flights"),
            m.count_if(cancelled()).alias("cancelled_flights"),
            m.count_if(F.col("is_diverted")).alias("diverted_flights"),
            m.avg_flown(dep()).alias("avg_departure_delay"),
            m.avg_flown(arr()).alias("avg_arrival_delay"),
            m.flown_count(is_ontime()).alias("ontime_departures"),
            m.flown_rate(is_ontime()).alias("ontime_departure_rate"),
            m.flown_count(dep().between(16, 60)).alias("moderate_delays"),
            m.flown_count(dep() > 60).alias("significant_delays"),
            m.rate(cancelled()).alias("cancellation_rate"),
            m.avg_flown(F.col("actual_elapsed_minutes")).alias("avg_actual_flight_time"),
            m.avg(F.col("scheduled_elapsed_minutes")).alias("avg_scheduled_flight_time"),
            m.avg_flown(F.col("taxi_out_minutes")).alias("avg_taxi_out_time"),
            m.avg_flown(F.col("taxi_in_minutes")).alias("avg_taxi_in_time"),
        ]

    rows = dated(star, "year", "quarter", "month")
    grouped = summed(star, "v_carrier_performance", rows, ["airline_key", "year", "quarter", "month"], figures)
    named = with_airline(grouped, star, "airline_code", "airline_name", "airline_type")
    return named.drop("airline_key")


def v_airport_congestion(star: Star, min_flights: int = 10) -> DataFrame:
    hour = F.col("hour")
    morning, evening = hour.between(6, 9), hour.between(17, 20)
    taxi_out = kpi.flown(F.col("taxi_out_minutes"))

    def figures(m: Measures) -> list[Column]:
        return [
            m.flights().alias("total_departures"),
            m.completed().alias("completed_departures"),
            m.avg_flown(dep()).alias("avg_departure_delay"),
            m.flown_count(is_late()).alias("delayed_departures"),
            m.flown_rate(is_late()).alias("departure_delay_rate"),
            m.avg(taxi_out).alias("avg_taxi_out_time"),
            m.max(taxi_out).alias("max_taxi_out_time"),
            m.flown_count(dep() > 60).alias("severe_delays"),
            m.flown_count(dep() > 180).alias("extreme_delays"),
            m.count_if(cancelled()).alias("cancelled_departures"),
            m.rate(cancelled()).alias("cancellation_rate"),
            m.count_if(morning).alias("morning_rush_flights"),
            m.count_if(evening).alias("evening_rush_flights"),
            m.avg(F.when(morning & is_flown(), dep())).alias("morning_rush_avg_delay"),
            m.avg(F.when(evening & is_flown(), dep())).alias("evening_rush_avg_delay"),
        ]

    rows = timed(dated(star, "year", "quarter", "month"), star, "left", "hour")
    keys = ["origin_airport_key", "year", "quarter", "month"]
    grouped = summed(star, "v_airport_congestion", rows, keys, figures)
    grouped = grouped.filter(F.col("total_departures") >= min_flights)
    return with_airport(
        grouped, star, "origin",
        airport_code="airport_code", airport_name="airport_name", city="city", state="state",
        airport_size_category="airport_size_category",
    ).drop("origin_airport_key")


_ROUTE_KEYS = ["origin_airport_key", "destination_airport_key", "distance_miles"]


def _known_airline(df: DataFrame, star: Star) -> DataFrame:
    """Keep flights whose carrier is in the dimension."""
    return df.join(star.airline.select("airline_key"), "airline_key", "left_semi")


def v_route_optimization(star: Star, min_flights: int = 50) -> DataFrame:
    def figures(m: Measures) -> list[Column]:
        mean_dep = m.sum(kpi.flown(dep())).cast("double") / F.nullif(m.completed(), F.lit(0))
        air_time = F.nullif(m.avg(kpi.flown(F.col("air_time_minutes"))), F.lit(0.0))
        return [
            m.flights().alias("total_flights"),
            m.distinct(F.col("airline_key")).alias("airlines_serving_route"),
            m.completed().alias("completed_flights"),
            m.avg_flown(dep()).alias("avg_departure_delay"),
            m.avg_flown(arr()).alias("avg_arrival_delay"),
            m.avg_flown(F.col("actual_elapsed_minutes")).alias("avg_flight_time"),
            m.avg(F.col("scheduled_elapsed_minutes")).alias("scheduled_flight_time"),
            m.flown_rate(is_ontime()).alias("ontime_performance_rate"),
            m.flown_count(dep() > 60).alias("significant_delays"),
            m.rate(cancelled()).alias("cancellation_rate"),
            kpi.half_up(m.avg(F.col("distance_miles")) / air_time * 60, 0).alias("avg_speed_mph"),
            m.avg(F.when((F.col("season") == "Winter") & is_flown(), dep())).alias("winter_avg_delay"),
            m.avg(F.when((F.col("season") == "Summer") & is_flown(), dep())).alias("summer_avg_delay"),
            kpi.half_up(mean_dep * m.flights() / 1000, 2).alias("delay_impact_score"),
        ]

    rows = _known_airline(dated(star, "year", "quarter", "season"), star)
    keys = [*_ROUTE_KEYS, "year", "quarter"]
    grouped = summed(star, "v_route_optimization", rows, keys, figures)
    grouped = grouped.filter(F.col("total_flights") >= min_flights)
    named = with_airport(
        grouped, star, "origin", _o="airport_code", origin_city="city", origin_state="state"
    )
    named = with_airport(
        named, star, "destination", _d="airport_code", destination_city="city", destination_state="state"
    )
    return (
        named.withColumn("route_code", F.concat("_o", F.lit("-"), "_d"))
        .drop("_o", "_d", "origin_airport_key", "destination_airport_key")
    )


def v_temporal_patterns(star: Star) -> DataFrame:
    day = ["year", "quarter", "month", "day_name", "day_of_week", "season", "is_weekend", "is_holiday"]
    hour = ["hour", "hour_category", "time_period", "is_business_hours"]

    def figures(m: Measures) -> list[Column]:
        return [
            m.flights().alias("total_flights"),
            m.completed().alias("completed_flights"),
            m.avg_flown(dep()).alias("avg_departure_delay"),
            m.stddev_population(kpi.flown(dep())).alias("delay_variability"),
            m.flown_count(is_late()).alias("delayed_flights"),
            m.flown_rate(is_late()).alias("delay_rate"),
            m.flown_count(dep() > 60).alias("severe_delays"),
            m.flown_count(dep() > 180).alias("extreme_delays"),
            m.count_if(cancelled()).alias("cancelled_flights"),
            m.rate(cancelled()).alias("cancellation_rate"),
            m.count_if(weather() > 0).alias("weather_affected_flights"),
            m.avg(F.when(weather() > 0, weather())).alias("avg_weather_delay"),
        ]

    rows = timed(dated(star, *day), star, "left", *hour)
    keys = [*day, *hour]
    grouped = summed(star, "v_temporal_patterns", rows, keys, figures)
    return grouped.withColumn("traffic_period", rules.traffic_period(F.col("hour")))


def v_weather_impact(star: Star, min_flights: int = 100) -> DataFrame:
    affected = weather() > 0

    def figures(m: Measures) -> list[Column]:
        def seasonal(name: str) -> Column:
            return m.avg(F.when(F.col("season") == name, weather()).otherwise(0))

        return [
            m.flights().alias("total_flights"),
            m.count_if(affected).alias("weather_affected_flights"),
            m.rate(affected).alias("weather_impact_rate"),
            m.sum(weather()).alias("total_weather_delay_minutes"),
            m.avg(F.when(affected, weather())).alias("avg_weather_delay_when_affected"),
            m.max(weather()).alias("max_weather_delay"),
            m.sum(weather()).alias("weather_delays"),
            m.sum(F.col("air_system_delay_minutes")).alias("air_system_delays"),
            m.sum(F.col("airline_delay_minutes")).alias("airline_delays"),
            m.sum(F.col("late_aircraft_delay_minutes")).alias("late_aircraft_delays"),
            m.sum(F.col("security_delay_minutes")).alias("security_delays"),
            m.count_if(weather().between(1, 30)).alias("minor_weather_delays"),
            m.count_if(weather().between(31, 120)).alias("moderate_weather_delays"),
            m.count_if(weather() > 120).alias("severe_weather_delays"),
            m.count_if(cancelled() & (F.col("cancellation_reason") == "B")).alias("weather_cancellations"),
            seasonal("Winter").alias("winter_avg_weather_delay"),
            seasonal("Spring").alias("spring_avg_weather_delay"),
            seasonal("Summer").alias("summer_avg_weather_delay"),
            seasonal("Fall").alias("fall_avg_weather_delay"),
            m.avg(F.when(affected, arr() - dep())).alias("avg_recovery_time"),
        ]

    rows = dated(star, "year", "quarter", "month", "season")
    keys = ["year", "quarter", "month", "season", "origin_airport_key"]
    grouped = summed(star, "v_weather_impact", rows, keys, figures)
    grouped = grouped.filter(F.col("total_flights") >= min_flights)
    return with_airport(
        grouped, star, "origin", origin_airport="airport_code", origin_city="city", origin_state="state"
    ).drop("origin_airport_key")


def v_root_cause_analysis(star: Star) -> DataFrame:
    def figures(m: Measures) -> list[Column]:
        return [
            m.flights().alias("total_affected_flights"),
            m.sum(dep()).alias("total_delay_minutes"),
            m.avg(dep()).alias("avg_delay_minutes"),
            m.count_if(dep().between(1, 15)).alias("minor_delays"),
            m.count_if(dep().between(16, 60)).alias("moderate_delays"),
            m.count_if(dep().between(61, 180)).alias("significant_delays"),
            m.count_if(dep() > 180).alias("severe_delays"),
        ]

    rows = dated(star, "year", "quarter").filter(dep() > 0)
    keys = ["delay_cause_key", "airline_key", "year", "quarter"]
    grouped = summed(star, "v_root_cause_analysis", rows, keys, figures)
    named = with_airline(grouped, star, "airline_code", "airline_name", "airline_type").join(
        star.cause.drop("cause_description"), "delay_cause_key"
    )
    airline_quarter = Window.partitionBy("airline_key", "year", "quarter")
    n, minutes, controllable = F.col("total_affected_flights"), F.col("total_delay_minutes"), F.col("is_controllable")
    # tenths of the weight 1.5 or 0.8, to stay in integers
    weight = F.when(controllable, F.lit(15)).otherwise(F.lit(8))
    return named.withColumns(
        {
            "pct_of_airline_delays": kpi.percent(n, F.sum(n).over(airline_quarter), 2),
            "estimated_delay_cost_usd": (minutes * 50).cast("double"),
            "controllability": F.when(controllable, "Controllable").otherwise("External"),
            "improvement_opportunity_score": kpi.rounded_ratio(
                minutes * weight, F.lit(10000).cast("bigint"), 2
            ),
        }
    ).drop("airline_key", "delay_cause_key")


def v_severity_classification(star: Star) -> DataFrame:
    def figures(m: Measures) -> list[Column]:
        return [
            m.flights().alias("flight_count"),
            m.avg(dep()).alias("avg_departure_delay"),
            m.avg(arr()).alias("avg_arrival_delay"),
            m.min(dep()).alias("min_delay"),
            m.max(dep()).alias("max_delay"),
            m.stddev_population(dep()).alias("delay_std_dev"),
            m.avg_flown(F.col("actual_elapsed_minutes") - F.col("scheduled_elapsed_minutes")).alias(
                "avg_schedule_variance"
            ),
            m.count_if(F.col("is_diverted")).alias("diversions"),
            (m.flights() * 150).alias("estimated_affected_passengers"),
            (m.sum(dep()) * 150).alias("total_passenger_delay_minutes"),
            m.avg(arr() - dep()).alias("avg_airborne_recovery"),
            m.count_if(arr() < dep()).alias("flights_with_recovery"),
        ]

    rows = dated(star, "year", "quarter", "month")
    keys = ["delay_severity_category", "airline_key", "origin_airport_key", "year", "quarter", "month"]
    grouped = summed(star, "v_severity_classification", rows, keys, figures)
    named = with_airline(grouped, star, "airline_code", "airline_name")
    named = with_airport(named, star, "origin", origin_airport="airport_code", origin_city="city")
    airline_quarter = Window.partitionBy("airline_key", "year", "quarter")
    n, severity = F.col("flight_count"), F.col("delay_severity_category")
    return named.withColumns(
        {
            "pct_of_airline_flights": kpi.percent(n, F.sum(n).over(airline_quarter), 2),
            "rebooking_risk_category": F.when(severity == "Cancelled", "Rebooking Required")
            .when(severity == "Severe Delay", "High Rebooking Risk")
            .when(severity == "Significant Delay", "Moderate Rebooking Risk")
            .otherwise("Low Rebooking Risk"),
            "cost_impact_category": F.when(severity.isin("Cancelled", "Severe Delay"), "High Cost")
            .when(severity == "Significant Delay", "Medium Cost")
            .otherwise("Low Cost"),
        }
    ).drop("airline_key", "origin_airport_key")


def v_disruption_analysis(star: Star, min_flights: int = 20) -> DataFrame:
    diverted = F.col("is_diverted")
    reason, late = F.col("cancellation_reason"), F.col("late_aircraft_delay_minutes")
    day = ["year", "quarter", "season", "day_name"]

    def figures(m: Measures) -> list[Column]:
        weighted = (
            m.count_if(cancelled()) * 2.0 + m.count_if(diverted) * 1.5 + m.count_if(dep() > 180) * 1.0
        )
        return [
            m.flights().alias("total_scheduled_flights"),
            m.count_if(is_flown() & ~diverted).alias("completed_as_planned"),
            m.count_if(cancelled()).alias("cancellations"),
            m.count_if(diverted).alias("diversions"),
            m.count_if(cancelled() | diverted).alias("total_disruptions"),
            m.rate(cancelled()).alias("cancellation_rate"),
            m.rate(diverted).alias("diversion_rate"),
            m.rate(cancelled() | diverted).alias("disruption_rate"),
            m.count_if(reason == "A").alias("carrier_cancellations"),
            m.count_if(reason == "B").alias("weather_cancellations"),
            m.count_if(reason == "C").alias("nas_cancellations"),
            m.count_if(reason == "D").alias("security_cancellations"),
            m.avg(F.when(dep() > 0, dep())).alias("avg_delay_when_delayed"),
            m.count_if(dep() > 180).alias("extreme_delays"),
            m.count_if(weather() > 60).alias("severe_weather_delays"),
            m.avg(late).alias("avg_late_aircraft_delay"),
            m.count_if(late > 0).alias("flights_with_late_aircraft"),
            kpi.half_up(weighted * m.flights() / 10000.0, 2).alias("disruption_impact_score"),
            m.avg(F.when(is_flown() & (dep() > 60), arr() - dep())).alias("avg_delay_recovery"),
        ]

    rows = dated(star, *day)
    keys = ["airline_key", "origin_airport_key", "destination_airport_key", *day]
    grouped = summed(star, "v_disruption_analysis", rows, keys, figures)
    grouped = grouped.filter(F.col("total_scheduled_flights") >= min_flights)
    named = with_airline(grouped, star, "airline_code", "airline_name")
    named = with_airport(named, star, "origin", origin_airport="airport_code", origin_city="city")
    named = with_airport(
        named, star, "destination", destination_airport="airport_code", destination_city="city"
    )
    return named.drop("airline_key", "origin_airport_key", "destination_airport_key")


def _ontime_share(m: Measures) -> Column:
    """Unrounded on-time percentage of completed flights; null when none was completed."""
    return m.flown_count(is_ontime()) * 100.0 / F.nullif(m.completed().cast("double"), F.lit(0.0))


def v_airline_monthly_summary(star: Star) -> DataFrame:
    def figures(m: Measures) -> list[Column]:
        return [
            m.flights().alias("total_flights"),
            m.completed().alias("completed_flights"),
            m.rounded_avg(kpi.flown(dep()), 1).alias("avg_departure_delay"),
            m.flown_rate(is_ontime(), 1).alias("ontime_performance_pct"),
            m.rate(cancelled()).alias("cancellation_rate"),
            _ontime_share(m).cast("double").alias("_share"),
            m.avg_flown(dep()).alias("_delay"),
        ]

    rows = dated(star, "year", "month", "month_name")
    keys = ["airline_key", "year", "month", "month_name"]
    grouped = summed(star, "v_airline_monthly_summary", rows, keys, figures)
    named = with_airline(grouped, star, "airline_code", "airline_name", "airline_type")
    month = Window.partitionBy("year", "month")
    return named.withColumns(
        {
            "ontime_rank": F.rank().over(month.orderBy(F.desc("_share"))),
            "delay_rank": F.rank().over(month.orderBy(F.asc("_delay"))),
        }
    ).drop("airline_key", "_share", "_delay")


def v_airport_daily_metrics(star: Star, min_flights: int = 5) -> DataFrame:
    hour = F.col("hour")

    def figures(m: Measures) -> list[Column]:
        return [
            m.flights().alias("daily_departures"),
            m.completed().alias("completed_departures"),
            m.count_if(cancelled()).alias("cancelled_departures"),
            m.rounded_avg(kpi.flown(dep()), 1).alias("avg_departure_delay"),
            m.max(kpi.flown(dep())).alias("max_departure_delay"),
            m.flown_count(dep() > 60).alias("severe_delays"),
            m.count_if(weather() > 0).alias("weather_affected_flights"),
            m.sum(weather()).alias("total_weather_delay_minutes"),
            m.rounded_avg(kpi.flown(F.col("taxi_out_minutes")), 1).alias("avg_taxi_out_minutes"),
            m.count_if(hour.between(6, 9)).alias("morning_peak_flights"),
            m.count_if(hour.between(17, 20)).alias("evening_peak_flights"),
        ]

    rows = timed(flights_of(star), star, "left", "hour")
    keys = ["origin_airport_key", "date_key"]
    grouped = summed(star, "v_airport_daily_metrics", rows, keys, figures)
    grouped = grouped.filter(F.col("daily_departures") >= min_flights)
    days = star.date.select("date_key", "date", "day_name", "is_weekend", "is_holiday")
    return with_airport(
        grouped.join(days, "date_key"), star, "origin",
        airport_code="airport_code", airport_name="airport_name", city="city", state="state",
    ).drop("origin_airport_key", "date_key")


def v_hourly_delay_patterns(star: Star, min_flights: int = 100) -> DataFrame:
    group = ["hour", "hour_category", "day_of_week", "day_name", "is_weekend"]

    def figures(m: Measures) -> list[Column]:
        return [
            m.flights().alias("flights_per_hour"),
            m.completed().alias("completed_flights_per_hour"),
            m.rounded_avg(kpi.flown(dep()), 1).alias("avg_hourly_delay"),
            kpi.half_up(m.stddev_population(kpi.flown(dep())), 1).alias("delay_std_dev"),
            m.flown_rate(is_late(), 1).alias("hourly_delay_rate"),
        ]

    rows = timed(dated(star, *group[2:]), star, "inner", *group[:2])
    return (
        summed(star, "v_hourly_delay_patterns", rows, group, figures)
        .filter(F.col("flights_per_hour") >= min_flights)
        .withColumn("is_peak_hour", kpi.in_peak(F.col("hour")).cast("int"))
    )


def v_top_delayed_routes(star: Star, min_flights: int = 100, top: int = 50) -> DataFrame:
    def figures(m: Measures) -> list[Column]:
        mean_dep = m.sum(kpi.flown(dep())).cast("double") / F.nullif(m.completed(), F.lit(0))
        return [
            m.flights().alias("total_flights"),
            m.distinct(F.col("airline_key")).alias("airlines_serving"),
            m.rounded_avg(kpi.flown(dep()), 1).alias("avg_departure_delay"),
            m.flown_count(is_late()).alias("delayed_flights"),
            m.flown_rate(is_late(), 1).alias("delay_rate_pct"),
            kpi.half_up(mean_dep * m.flights() / 100, 1).alias("delay_impact_score"),
            m.rate(cancelled()).alias("cancellation_rate"),
        ]

    rows = _known_airline(flights_of(star), star)
    grouped = summed(star, "v_top_delayed_routes", rows, _ROUTE_KEYS, figures)
    grouped = grouped.filter(F.col("total_flights") >= min_flights)
    named = with_airport(grouped, star, "origin", _oc="airport_code", _ot="city", _os="state")
    named = with_airport(named, star, "destination", _dc="airport_code", _dt="city", _ds="state")
    comma = F.lit(", ")
    return (
        named.withColumns(
            {
                "route_code": F.concat("_oc", F.lit("-"), "_dc"),
                "route_description": F.concat("_ot", comma, "_os", F.lit(" → "), "_dt", comma, "_ds"),
            }
        )
        .drop("_oc", "_ot", "_os", "_dc", "_dt", "_ds", "origin_airport_key", "destination_airport_key")
        .orderBy(F.desc("delay_impact_score"), "route_code", "distance_miles")
        .limit(top)
    )


def v_airline_rankings(star: Star, min_flights: int = 1000) -> DataFrame:
    def figures(m: Measures) -> list[Column]:
        return [
            m.flights().alias("total_flights"),
            m.completed().alias("completed_flights"),
            m.rounded_avg(kpi.flown(dep()), 2).alias("avg_departure_delay"),
            m.flown_rate(is_ontime()).alias("ontime_performance_pct"),
            m.rate(cancelled()).alias("cancellation_rate"),
            _ontime_share(m).alias("_share"),
            m.avg_flown(dep()).alias("_delay"),
            (m.count_if(cancelled()) * 100.0 / m.flights().cast("double")).cast("double").alias("_cancel"),
        ]

    grouped = summed(star, "v_airline_rankings", flights_of(star), ["airline_key"], figures)
    grouped = grouped.filter(F.col("total_flights") >= min_flights)
    share = F.col("_share")
    # The three rankings run over one row per airline.
    return (
        with_airline(grouped, star, "airline_code", "airline_name", "airline_type")
        .withColumns(
            {
                "ontime_rank": F.rank().over(Window.orderBy(F.desc("_share"))),
                "delay_rank": F.rank().over(Window.orderBy(F.asc("_delay"))),
                "cancellation_rank": F.rank().over(Window.orderBy(F.asc("_cancel"))),
                "performance_grade": F.when(share >= 80, "Excellent")
                .when(share >= 70, "Good")
                .when(share >= 60, "Fair")
                .otherwise("Poor"),
            }
        )
        .drop("airline_key", "_share", "_delay", "_cancel")
        .orderBy(F.desc("ontime_performance_pct"), "airline_code")
    )


def v_peak_congestion_times(star: Star, min_flights: int = 50) -> DataFrame:
    taxi_out = kpi.flown(F.col("taxi_out_minutes"))
    day = ["day_of_week", "day_name"]

    def figures(m: Measures) -> list[Column]:
        return [
            m.flights().alias("flights_per_hour"),
            m.rounded_avg(kpi.flown(dep()), 1).alias("avg_departure_delay"),
            m.rounded_avg(taxi_out, 1).alias("avg_taxi_out_minutes"),
            m.max(taxi_out).alias("max_taxi_out_minutes"),
            m.avg_flown(dep()).alias("_delay"),
        ]

    rows = timed(dated(star, *day), star, "inner", "hour", "hour_category")
    keys = ["origin_airport_key", "hour", "hour_category", *day]
    grouped = summed(star, "v_peak_congestion_times", rows, keys, figures)
    grouped = grouped.filter(F.col("flights_per_hour") >= min_flights)
    # At most 24 x 7 cells per airport meet in this window.
    n, usual = F.col("flights_per_hour"), F.col("avg_hourly_flights")
    return (
        with_airport(
            grouped, star, "origin",
            airport_code="airport_code", airport_name="airport_name", city="city", state="state",
            airport_size_category="airport_size_category",
        )
        .withColumn("avg_hourly_flights", F.avg(n).over(Window.partitionBy("origin_airport_key")))
        .withColumns(
            {
                "congestion_score": kpi.half_up(
                    n / F.nullif(usual, F.lit(0.0)) * (1 + F.col("_delay") / 60), 2
                ),
                "traffic_level": F.when(n >= usual * 1.5, "Peak")
                .when(n >= usual * 1.2, "High")
                .when(n >= usual * 0.8, "Normal")
                .otherwise("Low"),
            }
        )
        .drop("origin_airport_key", "_delay")
        .orderBy("airport_code", "day_of_week", "hour")
    )


def v_executive_dashboard(star: Star) -> DataFrame:
    """Quarterly totals and the airline with the highest mean delay of each quarter.

    Both parts come from one aggregation per airline and quarter, which the totals then fold.
    """

    def figures(m: Measures) -> list[Column]:
        return [
            m.flights().alias("n"),
            m.completed().alias("c"),
            m.count_if(cancelled()).alias("x"),
            m.sum(kpi.flown(dep())).alias("dep"),
            m.flown_count(is_ontime()).alias("ontime"),
            m.count_if(weather() > 0).alias("weather"),
            m.count_if((dep() > 180) | cancelled()).alias("severe"),
        ]

    rows = dated(star, "year", "quarter")
    per_airline = summed(star, "v_executive_dashboard", rows, ["year", "quarter", "airline_key"], figures)
    named = per_airline.join(star.airline.select("airline_key", "airline_name"), "airline_key", "left")
    mean_delay = F.col("dep") / F.nullif(F.col("c"), F.lit(0))
    worst = F.max_by(
        "airline_name",
        F.when(F.col("airline_name").isNotNull(), F.struct(mean_delay, F.col("_last_first"))),
    )
    # On equal means the alphabetically first name wins, so names are ranked backwards.
    by_name = Window.partitionBy("year", "quarter").orderBy(F.desc("airline_name"))
    n, c = F.sum("n"), F.sum("c")
    return (
        named.withColumn("_last_first", F.row_number().over(by_name))
        .groupBy("year", "quarter")
        .agg(
            n.alias("total_system_flights"),
            c.alias("completed_flights"),
            F.sum("x").alias("cancelled_flights"),
            kpi.rounded_ratio(F.sum("dep"), c, 2).alias("avg_system_delay"),
            kpi.percent(F.sum("ontime"), c, 2).alias("system_ontime_performance"),
            kpi.percent(F.sum("x"), n, 2).alias("system_cancellation_rate"),
            kpi.rounded_ratio(
                F.coalesce(F.sum("dep"), F.lit(0)) * 50, F.lit(1000000).cast("bigint"), 1
            ).alias("delay_cost_millions_usd"),
            worst.alias("worst_performing_airline"),
            kpi.percent(F.sum("weather"), n, 2).alias("weather_impact_rate"),
            kpi.percent(F.sum("severe"), n, 2).alias("severe_disruption_rate"),
        )
        .withColumn("metric_category", F.lit("Overall Performance"))
        .orderBy("year", "quarter")
    )


def trailed_flights(star: Star) -> DataFrame:
    """What the trailing averages need of the flights of known carriers."""
    flights = flights_of(star).select(
        *MONTH, "flight_key", "date_key", "airline_key", "origin_airport_key", "destination_airport_key",
        "departure_time_key", "distance_miles", "scheduled_elapsed_minutes", "departure_delay_minutes",
        "is_cancelled", (weather() > 0).cast("int").alias("has_weather_delay"),
    )
    return _known_airline(flights, star).join(star.date.select("date_key", "day_of_week"), "date_key")


def v_flight_delay_features(star: Star, rows: int = 30, split_rows: int = 2_000_000) -> DataFrame:
    """One row per flight with the mean delay of the previous ``rows`` flights of three peer groups."""
    # The windows move whole rows, so text is attached after them.
    flights = trailed_flights(star)
    if star.trailing is not None and star.trailing.rows == rows:
        featured = star.trailing.featured(flights, split_rows)
    else:
        featured = with_averages(flights.drop(*MONTH), rows, split_rows)
    days = star.date.select("date_key", "month", "season", "is_weekend", "is_holiday")
    hours = star.time.select(
        F.col("time_key").alias("departure_time_key"), "hour", "hour_category", "is_business_hours"
    )
    named = featured.join(days, "date_key").join(hours, "departure_time_key", "left")
    named = with_airline(named, star, "airline_code", "airline_type")
    named = with_airport(named, star, "origin", origin_airport="airport_code", origin_state="state")
    named = with_airport(
        named, star, "destination", destination_airport="airport_code", destination_state="state"
    )
    return named.select(
        "flight_key", "airline_code", "airline_type", "origin_airport", "origin_state",
        "destination_airport", "destination_state", "month", "day_of_week", "season", "hour", "hour_category",
        "is_weekend", "is_holiday", "is_business_hours",
        F.coalesce(kpi.in_peak(F.col("hour")), F.lit(False)).cast("int").alias("is_peak_hour"),
        "distance_miles", "scheduled_elapsed_minutes",
        *PEERS,
        "has_weather_delay",
        dep().alias("target_departure_delay"),
        (dep() > 15).cast("int").alias("target_is_delayed"),
        cancelled().alias("target_is_cancelled"),
    )


def next_holiday(dates: DataFrame) -> DataFrame:
    """Each date with the first holiday on or after it; one window over the calendar."""
    ahead = Window.orderBy("date").rowsBetween(0, Window.unboundedFollowing)
    holiday = F.when(F.col("is_holiday"), F.col("date"))
    return dates.select("date_key", F.min(holiday).over(ahead).alias("next_holiday"))


def v_historical_delay_trends(star: Star) -> DataFrame:
    def figures(m: Measures) -> list[Column]:
        return [
            m.flights().alias("daily_flights"),
            m.avg_flown(dep()).alias("daily_avg_delay"),
            m.stddev_population(kpi.flown(dep())).alias("daily_delay_std"),
            m.flown_rate(is_ontime()).alias("daily_ontime_rate"),
            m.rate(cancelled()).alias("daily_cancellation_rate"),
            m.count_if(weather() > 0).alias("daily_weather_affected_flights"),
            m.sum(weather()).alias("daily_total_weather_delay"),
        ]

    grouped = summed(star, "v_historical_delay_trends", flights_of(star), ["date_key"], figures)
    calendar = star.date.select(
        "date_key", "date", "year", "month", "day_of_year", "day_of_week", "season"
    ).join(next_holiday(star.date), "date_key")
    # From here on there is one row per calendar day, so a window without partitions is small.
    def moving_average(days_before: int) -> Column:
        frame = Window.orderBy("date").rowsBetween(-days_before, 0)
        return F.avg("daily_avg_delay").over(frame)

    month = F.col("month")
    return (
        grouped.join(calendar, "date_key")
        .withColumns(
            {
                "delay_7day_moving_avg": moving_average(6),
                "delay_30day_moving_avg": moving_average(29),
                "is_winter": month.isin(12, 1, 2).cast("int"),
                "is_summer": month.isin(6, 7, 8).cast("int"),
                "days_to_next_holiday": F.datediff("next_holiday", "date"),
            }
        )
        .drop("date_key", "next_holiday")
        .orderBy("date")
    )


VIEWS = {
    f.__name__: f
    for f in (
        v_carrier_performance, v_airport_congestion, v_route_optimization, v_temporal_patterns,
        v_weather_impact, v_root_cause_analysis, v_severity_classification, v_disruption_analysis,
        v_airline_monthly_summary, v_airport_daily_metrics, v_hourly_delay_patterns,
        v_top_delayed_routes, v_airline_rankings, v_peak_congestion_times, v_executive_dashboard,
        v_flight_delay_features, v_historical_delay_trends,
    )
}


def register_views(star: Star) -> None:
    """Register the star tables and all views as temporary views for ``spark.sql``."""
    names = {"airline": "dim_airline", "airport": "dim_airport", "date": "dim_date", "time": "dim_time"}
    for field, name in names.items():
        getattr(star, field).createOrReplaceTempView(name)
    star.cause.createOrReplaceTempView("dim_delay_cause")
    star.fact.createOrReplaceTempView("fact_flights")
    for name, view in VIEWS.items():
        view(star).createOrReplaceTempView(name)
