"""Parsing of HHMM clocks and calendar parts. Unparseable input gives null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _div(a: Column, b: int) -> Column:
    return F.call_function("div", a, F.lit(b)).cast("int")


def hhmm_number(clock: Column) -> Column:
    """The clock as an integer 0..9999, null when missing, unparseable or out of range."""
    number = clock.try_cast("double").try_cast("int")
    return F.when(number.between(0, 9999), number)


def nearest_hour(number: Column) -> Column:
    """Hour slot 0..23 closest to a clock number; missing clocks fall to hour 0."""
    rounds_up = (number % 100).between(30, 59).cast("int")
    return F.coalesce((_div(number, 100) + rounds_up) % 24, F.lit(0)).cast("int")


def seconds_of_day(number: Column) -> Column:
    """Seconds since midnight of a clock number; 2400 is midnight, impossible clocks are null."""
    possible = (number <= 2400) & (number % 100 < 60)
    # 100 h + m minutes-as-digits are 60 (100 h + m) - 2400 h seconds
    return F.when(possible, (number * 60 - _div(number, 100) * 2400) % 86400).cast("int")


def clock_text(seconds: Column) -> Column:
    """``HH:MM:SS`` text of the seconds of a day."""
    return F.concat(
        F.lpad(_div(seconds, 3600).cast("string"), 2, "0"),
        F.lit(":"),
        F.lpad(_div(seconds % 3600, 60).cast("string"), 2, "0"),
        F.lit(":00"),
    )


def clock_timestamp(date: Column, number: Column) -> Column:
    """Date and clock number as one timestamp; 2400 is midnight of the next day."""
    day = F.when(number == 2400, F.date_add(date, 1)).otherwise(date)
    seconds = seconds_of_day(number).cast("decimal(18,6)")
    return day.cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)


def calendar_date(year: Column, month: Column, day: Column) -> Column:
    """Date from its parts; an impossible date such as 30 February is null."""
    plausible = year.between(1, 9999) & month.between(1, 12) & day.between(1, 31)
    # Counting days from the first of the month runs into the next month if the day does not exist.
    date = F.when(plausible, F.date_add(F.make_date(year, month, F.lit(1)), day - 1))
    return F.when(F.month(date) == month, date)


def date_key(date: Column) -> Column:
    return (F.year(date) * 10000 + F.month(date) * 100 + F.dayofmonth(date)).cast("int")


def iso_weekday(date: Column) -> Column:
    """1 = Monday .. 7 = Sunday."""
    return (F.weekday(date) + 1).cast("int")
