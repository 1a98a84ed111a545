"""Column builders shared by the KPI views.

Rates and rounded means are computed from integer counts and sums, so a tie such as 12.345 rounds the
same way on every engine and for every partitioning. Standard deviations come from plain sums for the
same reason: the result does not depend on the order in which partial aggregates meet.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dep() -> Column:
    return F.col("departure_delay_minutes")


def arr() -> Column:
    return F.col("arrival_delay_minutes")


def weather() -> Column:
    return F.col("weather_delay_minutes")


def cancelled() -> Column:
    return F.col("is_cancelled")


def is_flown() -> Column:
    return ~F.col("is_cancelled")


def is_late() -> Column:
    return dep() > 15


def is_ontime() -> Column:
    return dep() <= 15


def flights() -> Column:
    return F.count(F.lit(1))


def flown_count(condition: Column) -> Column:
    return F.count_if(condition & is_flown())


def flown(value: Column) -> Column:
    """``value`` of completed flights, null for cancelled ones."""
    return F.when(is_flown(), value)


def avg_flown(value: Column) -> Column:
    return F.avg(flown(value))


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def percent(part: Column, whole: Column, digits: int) -> Column:
    """``round(100 * part / whole, digits)`` on non-negative integers; null when whole is 0."""
    unit = 10**digits
    numerator = part.cast("bigint") * (200 * unit) + whole
    return _div(numerator, F.nullif(whole * 2, F.lit(0).cast("bigint"))).cast("double") / unit


def rounded_ratio(total: Column, n: Column, digits: int) -> Column:
    """``round(total / n, digits)`` on integers, halves away from zero; null when n is 0."""
    unit = 10**digits
    size = _div(F.abs(total) * (2 * unit) + n, F.nullif(n * 2, F.lit(0).cast("bigint")))
    return F.when(total < 0, -size).otherwise(size).cast("double") / unit


def rounded_avg(value: Column, digits: int) -> Column:
    """Rounded mean of an integer column, as an aggregate."""
    return rounded_ratio(F.sum(value), F.count(value), digits)


def half_up(x: Column, digits: int) -> Column:
    """Round a double, halves away from zero, with plain IEEE arithmetic."""
    unit = float(10**digits)
    size = F.floor(F.abs(x) * unit + 0.5).cast("double") / unit
    return F.when(x < 0, -size).otherwise(size) + 0.0


def deviation(n: Column, total: Column, squares: Column) -> Column:
    """Population standard deviation from a count, a sum and a sum of squares."""
    n = F.nullif(n.cast("double"), F.lit(0.0))
    mean = total / n
    variance = squares / n - mean * mean
    return F.sqrt(F.when(variance < 0, F.lit(0.0)).otherwise(variance))


def stddev_population(value: Column) -> Column:
    """Population standard deviation of a minute column, as an aggregate over exact sums."""
    x = value.cast("double")
    return deviation(F.count(value), F.sum(x), F.sum(x * x))


def in_peak(hour: Column) -> Column:
    return hour.between(6, 9) | hour.between(17, 20)
