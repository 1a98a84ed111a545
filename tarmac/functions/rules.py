"""Business rules of the star schema as Column expressions.

The word lists, zones, dates and limits below are fixed values: results depend on them exactly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tarmac.functions import clocks

# Name fragments per carrier class, tried in this order.
AIRLINE_TYPES = [
    ("Major", ["AMERICAN", "DELTA", "UNITED", "SOUTHWEST", "JETBLUE"]),
    ("Regional", ["REGIONAL", "EXPRESS", "CONNECTION", "EAGLE", "SKYWEST"]),
    ("Low-Cost", ["SOUTHWEST", "SPIRIT", "FRONTIER", "ALLEGIANT"]),
]

# Time zone per state; every other state is Eastern.
STATE_ZONES = {
    "CA": "America/Los_Angeles",
    "WA": "America/Los_Angeles",
    "OR": "America/Los_Angeles",
    "TX": "America/Chicago",
    "IL": "America/Chicago",
    "NY": "America/New_York",
    "FL": "America/New_York",
}
DEFAULT_ZONE = "America/New_York"

# The holidays, as (month, first day, last day, ISO weekday or None for any).
HOLIDAYS = [
    (1, 1, 1, None),  # New Year
    (5, 25, 31, 1),  # last Monday of May
    (7, 4, 4, None),  # Independence Day
    (9, 1, 7, 1),  # first Monday of September
    (11, 22, 28, 4),  # fourth Thursday of November
    (12, 25, 25, None),  # Christmas
]

# Cause columns in the order that settles ties, with their cause codes.
CAUSE_PRIORITY = [
    ("air_system_delay_minutes", "AIR_SYSTEM"),
    ("security_delay_minutes", "SECURITY"),
    ("airline_delay_minutes", "CARRIER"),
    ("late_aircraft_delay_minutes", "LATE_AIRCRAFT"),
    ("weather_delay_minutes", "WEATHER"),
]


def airline_type(name: Column) -> Column:
    upper = F.upper(name)
    result = F.lit("Other")
    for label, words in reversed(AIRLINE_TYPES):
        hit = F.lit(False)
        for word in words:
            hit = hit | upper.contains(word)
        result = F.when(hit, label).otherwise(result)
    return result


def airport_timezone(state: Column) -> Column:
    zones = F.create_map(*[F.lit(x) for pair in STATE_ZONES.items() for x in pair])
    return F.coalesce(F.try_element_at(zones, state), F.lit(DEFAULT_ZONE))


def airport_size(annual_flights: Column) -> Column:
    return (
        F.when(annual_flights > 50000, "Hub")
        .when(annual_flights >= 10000, "Large")
        .when(annual_flights >= 1000, "Medium")
        .otherwise("Small")
    )


def season(month: Column) -> Column:
    return (
        F.when(month.isin(12, 1, 2), "Winter")
        .when(month.between(3, 5), "Spring")
        .when(month.between(6, 8), "Summer")
        .otherwise("Fall")
    )


def is_holiday(date: Column, holidays: Sequence[str] | None = None) -> Column:
    """Whether a date of any year is a holiday: one of the listed dates, or by the rules without a list."""
    if holidays is not None:
        return date.isin([F.lit(h).cast("date") for h in holidays])
    found = F.lit(False)
    for month, first, last, weekday in HOLIDAYS:
        day = (F.month(date) == month) & F.dayofmonth(date).between(first, last)
        found = found | (day if weekday is None else day & (clocks.iso_weekday(date) == weekday))
    return F.when(date.isNotNull(), found)


def hour_category(hour: Column) -> Column:
    return (
        F.when(hour.between(5, 8), "Early Morning")
        .when(hour.between(9, 11), "Morning")
        .when(hour.between(12, 16), "Afternoon")
        .when(hour.between(17, 20), "Evening")
        .otherwise("Late Night")
    )


def time_period(hour: Column) -> Column:
    return (
        F.when(hour.between(6, 11), "Morning")
        .when(hour.between(12, 17), "Afternoon")
        .when(hour.between(18, 21), "Evening")
        .otherwise("Overnight")
    )


def is_business_hours(hour: Column) -> Column:
    return hour.between(8, 17)


def seed_hour_category(hour: Column) -> Column:
    return (
        F.when(hour.between(5, 7), "Early Morning")
        .when(hour.between(8, 11), "Morning")
        .when(hour.between(12, 17), "Afternoon")
        .when(hour.between(18, 21), "Evening")
        .otherwise("Late Night")
    )


def seed_time_period(hour: Column) -> Column:
    return (
        F.when(hour.between(5, 6), "Early")
        .when(hour.between(7, 11), "Morning")
        .when(hour.between(12, 17), "Afternoon")
        .when(hour.between(18, 21), "Evening")
        .otherwise("Overnight")
    )


def seed_business_hours(hour: Column) -> Column:
    return hour.between(6, 17)


def delay_severity(cancelled: Column, departure_delay: Column) -> Column:
    return (
        F.when(cancelled, "Cancelled")
        .when(departure_delay <= 0, "On Time/Early")
        .when(departure_delay <= 15, "Minor Delay")
        .when(departure_delay <= 60, "Moderate Delay")
        .when(departure_delay <= 180, "Significant Delay")
        .otherwise("Severe Delay")
    )


def total_delay() -> Column:
    total = F.lit(0)
    for name, _ in CAUSE_PRIORITY:
        total = total + F.coalesce(F.col(name), F.lit(0))
    return total


def most_cause_minutes() -> Column:
    """The largest of the five cause columns of a flight."""
    return F.greatest(*[F.coalesce(F.col(name), F.lit(0)) for name, _ in CAUSE_PRIORITY])


def primary_cause(departure_delay: Column, most: Column) -> Column:
    """Cause with the most minutes of a delayed flight; ties go to the earlier one in the list.

    ``most`` is a column that holds ``most_cause_minutes()``, computed once per row.
    """
    result = F.when(departure_delay <= 0, "NO_DELAY").when(most <= 0, "UNKNOWN")
    for name, code in CAUSE_PRIORITY[:-1]:
        result = result.when(F.col(name) == most, code)
    return result.otherwise(CAUSE_PRIORITY[-1][1])


def traffic_period(hour: Column) -> Column:
    return (
        F.when(hour.between(6, 9), "Morning Peak")
        .when(hour.between(17, 20), "Evening Peak")
        .when(hour.between(10, 16), "Midday")
        .when(hour.between(21, 23), "Late Evening")
        .otherwise("Overnight")
    )
