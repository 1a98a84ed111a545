"""Aggregates of the views, written once and computed in two ways: from rows, or from states of parts of them.

A view states its figures with the methods of ``Measures``. ``Measures`` itself gives plain aggregates over flights.
``States`` gives the same figures over partial results: it lists the aggregates that a part of the flights, such as
a month, has to keep, and merges those of all parts. Sums and counts are of whole minutes and flights, so both ways
give the same digits.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tarmac.functions import kpi


class Measures:
    """Figures of a group of flights."""

    def count(self, value: Column) -> Column:
        return F.count(value)

    def count_if(self, condition: Column) -> Column:
        return F.count_if(condition)

    def sum(self, value: Column) -> Column:
        return F.sum(value)

    def avg(self, value: Column) -> Column:
        return F.avg(value)

    def min(self, value: Column) -> Column:
        return F.min(value)

    def max(self, value: Column) -> Column:
        return F.max(value)

    def distinct(self, value: Column) -> Column:
        """How many values there are of a column with few of them, such as the airlines."""
        return F.count_distinct(value)

    def flights(self) -> Column:
        return self.count(F.lit(1))

    def completed(self) -> Column:
        return self.count_if(kpi.is_flown())

    def flown_count(self, condition: Column) -> Column:
        return self.count_if(condition & kpi.is_flown())

    def avg_flown(self, value: Column) -> Column:
        return self.avg(kpi.flown(value))

    def rounded_avg(self, value: Column, digits: int) -> Column:
        return kpi.rounded_ratio(self.sum(value), self.count(value), digits)

    def rate(self, part: Column, digits: int = 2) -> Column:
        """Share of all flights of the group, in percent."""
        return kpi.percent(self.count_if(part), self.flights(), digits)

    def flown_rate(self, part: Column, digits: int = 2) -> Column:
        """Share of the completed flights of the group, in percent."""
        return kpi.percent(self.flown_count(part), self.completed(), digits)

    def stddev_population(self, value: Column) -> Column:
        """Population standard deviation of a minute column, over exact sums."""
        x = value.cast("double")
        return kpi.deviation(self.count(value), self.sum(x), self.sum(x * x))


#: What a group must keep: a view lists its figures with the methods it is given.
Figures = Callable[[Measures], list[Column]]


class States(Measures):
    """The same figures from kept states; ``kept`` lists the aggregates that make the states."""

    def __init__(self) -> None:
        self.kept: list[Column] = []

    def _keep(self, state: Column) -> Column:
        name = f"state_{len(self.kept)}"
        self.kept.append(state.alias(name))
        return F.col(name)

    def count(self, value: Column) -> Column:
        return F.sum(self._keep(F.count(value)))

    def count_if(self, condition: Column) -> Column:
        return F.sum(self._keep(F.count_if(condition)))

    def sum(self, value: Column) -> Column:
        return F.sum(self._keep(F.sum(value)))

    def avg(self, value: Column) -> Column:
        return self.sum(value).cast("double") / F.nullif(self.count(value).cast("double"), F.lit(0.0))

    def min(self, value: Column) -> Column:
        return F.min(self._keep(F.min(value)))

    def max(self, value: Column) -> Column:
        return F.max(self._keep(F.max(value)))

    def distinct(self, value: Column) -> Column:
        sets = F.collect_list(self._keep(F.collect_set(value)))
        return F.size(F.array_distinct(F.flatten(sets))).cast("long")
