"""Dimension builders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarmac.functions import clocks, rules


def _keyed(df: DataFrame, code: str, key: str) -> DataFrame:
    """Surrogate keys 1..n in code order. Dimension members are bounded, one window task is enough."""
    return df.withColumn(key, F.row_number().over(Window.orderBy(code)).cast("int"))


def _first_per_code(df: DataFrame, code: str) -> DataFrame:
    """One row per code: codes are unique in a dimension, so a repeated source row is folded."""
    rest = [c for c in df.columns if c != code]
    return df.groupBy(code).agg(F.min(F.struct(*rest)).alias("_row")).select(code, "_row.*")


def build_airlines(airlines: DataFrame) -> DataFrame:
    members = airlines.select(
        F.upper(F.trim("IATA_CODE")).alias("airline_code"), F.trim("AIRLINE").alias("airline_name")
    )
    members = _first_per_code(members, "airline_code")
    typed = members.withColumn("airline_type", rules.airline_type(F.col("airline_name")))
    return _keyed(typed, "airline_code", "airline_key").select(
        "airline_key", "airline_code", "airline_name", "airline_type"
    )


def build_airports(airports: DataFrame) -> DataFrame:
    members = airports.select(
        F.upper(F.trim("IATA_CODE")).alias("airport_code"),
        F.trim("AIRPORT").alias("airport_name"),
        F.trim("CITY").alias("city"),
        F.trim("STATE").alias("state"),
        F.trim("COUNTRY").alias("country"),
        F.col("LATITUDE").cast("decimal(10,5)").alias("latitude"),
        F.col("LONGITUDE").cast("decimal(10,5)").alias("longitude"),
    )
    members = (
        _first_per_code(members, "airport_code")
        .withColumn("timezone", rules.airport_timezone(F.col("state")))
        .withColumn("airport_size_category", F.lit("Medium"))
    )
    return _keyed(members, "airport_code", "airport_key").select(
        "airport_key", "airport_code", "airport_name", "city", "state", "country",
        "latitude", "longitude", "timezone", "airport_size_category",
    )


def size_by_volume(airports: DataFrame, flights: DataFrame, years: int = 1) -> DataFrame:
    """Airport size class from the departures per year, in place of the constant class."""
    departures = (
        flights.groupBy(F.upper(F.trim("ORIGIN_AIRPORT")).alias("airport_code"))
        .agg(F.count(F.lit(1)).alias("departures"))
    )
    annual = F.coalesce(F.col("departures"), F.lit(0)) / years
    return (
        airports.drop("airport_size_category")
        .join(departures, "airport_code", "left")
        .select(
            "airport_key",
            "airport_code",
            F.coalesce("departures", F.lit(0).cast("bigint")).alias("departures"),
            rules.airport_size(annual).alias("airport_size_category"),
        )
    )


def calendar_columns(date: str, holidays: Sequence[str] | None = None) -> list:
    """The calendar attributes of a date column."""
    d = F.col(date)
    month = F.month(d)
    weekday = clocks.iso_weekday(d)
    weekend = weekday >= 6
    holiday = rules.is_holiday(d, holidays)
    return [
        clocks.date_key(d).alias("date_key"),
        d.alias("date"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        month.alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.dayofmonth(d).alias("day"),
        weekday.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.dayofyear(d).alias("day_of_year"),
        F.weekofyear(d).alias("week_of_year"),
        weekend.alias("is_weekend"),
        holiday.alias("is_holiday"),
        (~(weekend | holiday)).alias("is_business_day"),
        rules.season(month).alias("season"),
        F.quarter(d).alias("fiscal_quarter"),
    ]


def calendar(days: DataFrame, holidays: Sequence[str] | None = None) -> DataFrame:
    """The date dimension of the days from ``first`` to ``last`` (a frame with these two columns).

    Holidays follow their rules in every year unless they are listed.
    """
    every_day = days.select(
        F.explode(F.sequence("first", "last", F.expr("interval 1 day"))).alias("_date")
    )
    return every_day.select(*calendar_columns("_date", holidays))


def build_dates(
    spark: SparkSession,
    start: str = "2015-01-01",
    end: str = "2015-12-31",
    holidays: Sequence[str] | None = None,
) -> DataFrame:
    bounds = spark.range(1).select(
        F.lit(start).cast("date").alias("first"), F.lit(end).cast("date").alias("last")
    )
    return calendar(bounds, holidays)


def calendar_of_years(years: DataFrame, holidays: Sequence[str] | None = None) -> DataFrame:
    """The date dimension of whole calendar years (column ``year``, repeated years count once)."""
    first, last = (F.make_date("year", F.lit(m), F.lit(d)) for m, d in ((1, 1), (12, 31)))
    return calendar(years.select("year").distinct().select(first.alias("first"), last.alias("last")), holidays)


def build_times(spark: SparkSession, taxonomy: str = "standard") -> DataFrame:
    """24 hourly rows, labelled by the standard or the seed taxonomy."""
    if taxonomy == "standard":
        category, business, period = rules.hour_category, rules.is_business_hours, rules.time_period
    elif taxonomy == "seed":
        category, business, period = (
            rules.seed_hour_category, rules.seed_business_hours, rules.seed_time_period,
        )
    else:
        raise ValueError(f"unknown taxonomy {taxonomy!r}")
    hour = F.col("id").cast("int")
    return spark.range(24).select(
        (hour + 1).alias("time_key"),
        F.concat(F.lpad(hour.cast("string"), 2, "0"), F.lit(":00:00")).alias("time_value"),
        hour.alias("hour"),
        F.lit(0).alias("minute"),
        category(hour).alias("hour_category"),
        business(hour).alias("is_business_hours"),
        period(hour).alias("time_period"),
    )


# The delay causes with their names and categories.
DELAY_CAUSES = [
    ("NO_DELAY", "No Delay", "On Time"),
    ("CARRIER", "Carrier Delay", "Carrier"),
    ("WEATHER", "Weather Delay", "Weather"),
    ("AIR_SYSTEM", "Air System Delay", "Air System"),
    ("SECURITY", "Security Delay", "Security"),
    ("LATE_AIRCRAFT", "Late Aircraft Delay", "Late Aircraft"),
    ("UNKNOWN", "Unknown Delay", "Unknown"),
]

# The seeded causes with description, controllability and severity weight.
SEED_CAUSES = [
    ("ON_TIME", "On Time", "None", "Flight departed and arrived on time or early", True, "0.00"),
    ("WEATHER", "Weather Delay", "Weather", "Delays due to weather conditions", False, "1.20"),
    ("CARRIER", "Carrier Delay", "Carrier", "Delays due to airline operations", True, "1.00"),
    ("AIR_SYSTEM", "Air System Delay", "Air System", "Delays due to air traffic control", False, "0.80"),
    ("LATE_AIRCRAFT", "Late Aircraft Delay", "Late Aircraft", "Delays due to previous flight delays", True, "0.90"),
    ("SECURITY", "Security Delay", "Security", "Delays due to security issues", False, "1.10"),
    ("CANCELLED", "Flight Cancelled", "Cancellation", "Flight was cancelled", False, "2.00"),
    ("UNKNOWN", "Unknown Cause", "Unknown", "Delay cause not specified", True, "1.00"),
]


def build_causes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        DELAY_CAUSES, "cause_code string, cause_name string, cause_category string"
    ).coalesce(1)


def build_seed_causes(spark: SparkSession) -> DataFrame:
    rows = spark.createDataFrame(
        SEED_CAUSES,
        "cause_code string, cause_name string, cause_category string, "
        "cause_description string, is_controllable boolean, severity_weight string",
    ).coalesce(1)
    return rows.withColumn("severity_weight", F.col("severity_weight").cast("decimal(3,2)"))


def build_delay_causes(spark: SparkSession) -> DataFrame:
    """All causes with the seeded attributes; the seeded ON_TIME describes NO_DELAY."""
    seeds = build_seed_causes(spark)
    attributes = seeds.select(
        F.when(F.col("cause_code") == "ON_TIME", "NO_DELAY").otherwise(F.col("cause_code")).alias("cause_code"),
        "cause_description",
        "is_controllable",
        "severity_weight",
    )
    cancelled = seeds.filter("cause_code = 'CANCELLED'").select("cause_code", "cause_name", "cause_category")
    members = build_causes(spark).unionByName(cancelled).join(attributes, "cause_code")
    return _keyed(members, "cause_code", "delay_cause_key").select(
        "delay_cause_key", "cause_code", "cause_name", "cause_category",
        "cause_description", "is_controllable", "severity_weight",
    )


def with_unknown_member(dim: DataFrame, key: str, label: str = "Unknown") -> DataFrame:
    """Add the member with key 0 that unmapped fact rows point to."""
    def value(column: str, kind: str):
        if column == key:
            return F.lit(0).cast(kind)
        return F.lit(label if kind == "string" else None).cast(kind)

    unknown = dim.sparkSession.range(1).select(*[value(c, t).alias(c) for c, t in dim.dtypes])
    return dim.unionByName(unknown)


def code_lookup(dim: DataFrame, code: str, key: str) -> DataFrame:
    return dim.select(F.col(code).alias("code"), F.col(key).alias("key"))
