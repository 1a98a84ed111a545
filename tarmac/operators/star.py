"""The star schema as a bundle of DataFrames, and its load into Parquet."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.operators import dims, facts, quality
from tarmac.sources import tables, versions


@dataclass(frozen=True)
class Star:
    airline: DataFrame
    airport: DataFrame
    date: DataFrame
    time: DataFrame
    cause: DataFrame
    fact: DataFrame | None = None
    #: Monthly states under the views (``operators.partials``), if the warehouse keeps them.
    partials: Any = None
    #: Trailing averages and the last flights of every month (``operators.trailing``), if the warehouse keeps them.
    trailing: Any = None

    def dims(self) -> dict[str, DataFrame]:
        return {n: getattr(self, n) for n in ("airline", "airport", "date", "time", "cause")}


# Code and key column of each stored dimension.
DIM_CODES = {
    "airline": ("airline_code", "airline_key"),
    "airport": ("airport_code", "airport_key"),
    "date": ("date_key", "date_key"),
    "time": ("hour", "time_key"),
    "cause": ("cause_code", "delay_cause_key"),
}


def dim_path(warehouse: str, name: str) -> str:
    return f"{warehouse}/dim_{'delay_cause' if name == 'cause' else name}"


def load_dims(
    spark: SparkSession,
    airlines: DataFrame,
    airports: DataFrame,
    warehouse: str,
    start: str | None = None,
    end: str | None = None,
    holidays: Sequence[str] | None = None,
) -> Star:
    """Build the five dimensions and load the members the warehouse does not have yet.

    The calendar starts with the days from ``start`` to ``end``, if both are given; ``extend_dates`` adds the
    years of the loaded flights. Reading them back from files gives Catalyst their true sizes, so it broadcasts a dimension when
    it is below the broadcast threshold and shuffles otherwise; no join carries a broadcast hint.
    """
    no_years = spark.range(0).select(F.col("id").cast("int").alias("year"))
    given = dims.build_dates(spark, start, end, holidays) if start and end else dims.calendar_of_years(no_years)
    built = {
        "airline": dims.build_airlines(airlines),
        "airport": dims.build_airports(airports),
        "date": given,
        "time": dims.build_times(spark),
        "cause": dims.build_delay_causes(spark),
    }
    return Star(
        **{
            name: tables.load_once(spark, dim.coalesce(1), dim_path(warehouse, name), *DIM_CODES[name])
            for name, dim in built.items()
        }
    )


def extend_dates(
    spark: SparkSession, loaded: Star, warehouse: str, holidays: Sequence[str] | None = None
) -> Star:
    """Add the calendar years of the loaded facts that the date dimension lacks.

    Years are a partition column of the fact, so this reads no flights; every day a fact refers to is
    in the dimension afterwards, and days already there stay.
    """
    days = dims.calendar_of_years(loaded.fact.select("year"), holidays)
    dates = tables.load_once(spark, days.coalesce(1), dim_path(warehouse, "date"), *DIM_CODES["date"])
    return replace(loaded, date=dates)


class NothingLoaded(ValueError):
    """A warehouse without a finished load."""


def read_star(spark: SparkSession, warehouse: str) -> Star:
    """The star schema stored in a warehouse folder, with the facts of the last finished load."""
    version = versions.current(spark, warehouse)
    if version is None:
        raise NothingLoaded(warehouse)
    stored = {name: spark.read.parquet(dim_path(warehouse, name)) for name in DIM_CODES}
    return Star(**stored, fact=spark.read.parquet(version.fact))


def load_fact(
    spark: SparkSession, flights: DataFrame, dims: Star, warehouse: str, holidays: Sequence[str] | None = None
) -> Star:
    """Replace the facts, partitioned by year and month, and add the calendar years that they need.

    The new facts and the rejected rows go to folders of their own, and become the valid ones by one row that
    is written when all is there. A load that breaks leaves the former facts as they were. Whether there are rows to
    reject is observed while the facts are written, so a source without any is read once. The counts of the load
    are taken from what was written: they hold also where Spark had to compute rows again.
    """
    version = versions.following(spark, warehouse, versions.FULL)
    listed, seen = quality.observed(quality.with_reason(flights, dims.airport))
    fact = facts.build_fact(listed.filter("reason IS NULL").select(*flights.columns), dims)
    tables.write_fact(fact, version.fact, "overwrite")
    rejected = quality.rejected_rows(flights, dims.airport)
    if not quality.any_rejected(seen):
        rejected = rejected.limit(0)  # an empty table, over what a broken load may have left
    rejected.write.mode("overwrite").parquet(version.quarantine)
    built = replace(dims, fact=spark.read.schema(fact.schema).parquet(version.fact))
    built = extend_dates(spark, built, warehouse, holidays)
    loaded = built.fact.count()  # from the footers of the files
    reasons = quality.reason_counts(spark.read.schema(rejected.schema).parquet(version.quarantine))
    counts = {"read": loaded + sum(reasons.values()), "loaded": loaded, **reasons}
    versions.record(spark, version, versions.FULL, counts)
    return built


def load_star(
    spark: SparkSession, flights: DataFrame, airlines: DataFrame, airports: DataFrame, warehouse: str
) -> Star:
    """Full load: new dimension members, then the whole fact, then the days it needs."""
    return load_fact(spark, flights, load_dims(spark, airlines, airports, warehouse), warehouse)
