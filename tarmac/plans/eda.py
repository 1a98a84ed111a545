"""Exploratory aggregates over raw flights (the typed source, before the star schema).

``explored`` derives the columns all of them use; each function is one declarative plan.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.functions import clocks, kpi


CLOCK_COLUMNS = ["SCHEDULED_DEPARTURE", "DEPARTURE_TIME", "SCHEDULED_ARRIVAL", "ARRIVAL_TIME"]


def explored(flights: DataFrame) -> DataFrame:
    """Raw flights with normalised codes, flight date, and scheduled times in seconds of the day.

    Clocks are parsed in a first step, so that each parse runs once per row.
    """
    date = clocks.calendar_date(F.col("YEAR"), F.col("MONTH"), F.col("DAY"))
    codes = ("AIRLINE", "ORIGIN_AIRPORT", "DESTINATION_AIRPORT")
    parsed = flights.select(
        *[c for c in flights.columns if c not in codes],
        F.upper(F.trim("AIRLINE")).alias("airline"),
        F.upper(F.trim("ORIGIN_AIRPORT")).alias("origin"),
        F.upper(F.trim("DESTINATION_AIRPORT")).alias("destination"),
        date.alias("flight_date"),
        *[clocks.hhmm_number(F.col(c)).alias(f"{c}_number") for c in CLOCK_COLUMNS],
        F.col("DEPARTURE_DELAY").try_cast("int").alias("delay"),
        F.col("ARRIVAL_DELAY").try_cast("int").alias("arr_delay"),
    )
    return parsed.withColumns(
        {
            "departure_seconds": clocks.seconds_of_day(F.col("SCHEDULED_DEPARTURE_number")),
            "arrival_seconds": clocks.seconds_of_day(F.col("SCHEDULED_ARRIVAL_number")),
        }
    )


def _departure_timestamp() -> Column:
    return clocks.clock_timestamp(F.col("flight_date"), F.col("SCHEDULED_DEPARTURE_number"))


def _clock_text(column: str) -> Column:
    return clocks.clock_text(clocks.seconds_of_day(F.col(f"{column}_number")))


def month_filter(flights: DataFrame, month: int = 1) -> DataFrame:
    """Flights of one month; on a month-partitioned table only that partition is read."""
    return flights.filter(F.col("MONTH") == month)


def stats(value: str) -> list[Column]:
    return [
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        F.count(value).alias("count"),
        F.avg(value).alias("mean"),
    ]


# Lower limits of the airport size classes on the map.
SIZE_LIMITS = [1, 100, 1000, 10000, 100000, 1000000]


def origin_counts(flights: DataFrame) -> DataFrame:
    """Flights per origin with the largest size limit strictly below the count."""
    n = F.col("flights")
    size = F.lit(None).cast("int")
    for limit in SIZE_LIMITS:
        size = F.when(n > limit, limit).otherwise(size)
    return flights.groupBy("origin").agg(F.count(F.lit(1)).alias("flights")).withColumn("size_class", size)


def flight_dates(flights: DataFrame) -> DataFrame:
    """Flights per date built from year, month and day; impossible dates are counted under null."""
    return flights.groupBy("flight_date").agg(F.count(F.lit(1)).alias("flights"))


def clock_values(flights: DataFrame) -> DataFrame:
    """The four HHMM clock columns as HH:MM:SS text, with the flight they belong to."""
    return flights.select(
        "FLIGHT_NUMBER", "TAIL_NUMBER", *[_clock_text(c).alias(c.lower()) for c in CLOCK_COLUMNS]
    )


def departure_timestamps(flights: DataFrame) -> DataFrame:
    return flights.select(
        "FLIGHT_NUMBER",
        "TAIL_NUMBER",
        "flight_date",
        _departure_timestamp().alias("departure_ts"),
    )


def clean(flights: DataFrame) -> DataFrame:
    """The eleven analysis columns of flights that have all of them."""
    # A text or timestamp is null where its numbers are, so rows are dropped by these and the others formatted once.
    seconds = {c: clocks.seconds_of_day(F.col(f"{c}_number")) for c in CLOCK_COLUMNS}
    complete = flights.dropna(
        subset=["airline", "origin", "destination", "flight_date", "delay", "arr_delay", "SCHEDULED_TIME", "ELAPSED_TIME"]
    ).filter(reduce(Column.__and__, [s.isNotNull() for s in seconds.values()]))
    return complete.select(
        "airline",
        "origin",
        "destination",
        _departure_timestamp().alias("scheduled_departure"),
        _clock_text("DEPARTURE_TIME").alias("departure_time"),
        "delay",
        _clock_text("SCHEDULED_ARRIVAL").alias("scheduled_arrival"),
        _clock_text("ARRIVAL_TIME").alias("arrival_time"),
        F.col("arr_delay").alias("arrival_delay"),
        F.col("SCHEDULED_TIME").alias("scheduled_time"),
        F.col("ELAPSED_TIME").alias("elapsed_time"),
    )


def analysis_flights(flights: DataFrame) -> DataFrame:
    """Flights the exploration works on: every analysis field present."""
    return flights.dropna(
        subset=[
            "airline", "origin", "destination", "flight_date", "departure_seconds", "arrival_seconds",
            "delay", "arr_delay", "DEPARTURE_TIME", "ARRIVAL_TIME", "SCHEDULED_TIME", "ELAPSED_TIME",
        ]
    )


def airline_stats(flights: DataFrame) -> DataFrame:
    return flights.groupBy("airline").agg(*stats("delay")).orderBy("count", "airline")


def airline_share(flights: DataFrame) -> DataFrame:
    """Percent of all flights and non-negative mean delay per airline."""
    everything = Window.partitionBy()  # over one row per airline
    return (
        flights.groupBy("airline")
        .agg(F.count("delay").alias("flights"), F.avg("delay").alias("_mean"))
        .select(
            "airline",
            "flights",
            kpi.percent(F.col("flights"), F.sum("flights").over(everything), 2).alias("share_pct"),
            F.greatest("_mean", F.lit(0.0)).alias("mean_delay"),
        )
    )


def delay_level(delay: Column) -> Column:
    """0 on time (up to 5 minutes), 1 small (up to 45), 2 large."""
    return F.when(delay > 45, 2).when(delay > 5, 1).otherwise(0)


def delay_levels(flights: DataFrame) -> DataFrame:
    return flights.groupBy("airline", delay_level(F.col("delay")).alias("delay_level")).agg(
        F.count(F.lit(1)).alias("flights")
    )


def delay_histogram(flights: DataFrame, low: int = 15, high: int = 180, bins: int = 60) -> DataFrame:
    """Normalised histogram of delays per airline; the last bin includes the upper limit."""
    delay = F.col("delay")
    index = F.least(F.call_function("div", (delay - low) * bins, F.lit(high - low)).cast("int"), F.lit(bins - 1))
    width = (high - low) / bins
    counted = (
        flights.filter(delay.between(low, high))
        .groupBy("airline", index.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # Every airline gets all bins, also those without flights; the map has at most `bins` entries.
    per_airline = counted.groupBy("airline").agg(
        F.sum("n").alias("_total"), F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("_counts")
    )
    all_bins = F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin")
    n = F.coalesce(F.try_element_at("_counts", F.col("bin")), F.lit(0))
    return per_airline.select("airline", "_total", "_counts", all_bins).select(
        "airline",
        "bin",
        (F.col("bin") * width + (low + width / 2)).alias("center"),
        n.alias("n"),
        (n / (F.col("_total") * width)).alias("density"),
    )


def _decay_fit(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Least-squares a, b of ``a * exp(-x / b)``.

    For a given b the best a is linear, so only b is searched (variable projection): a grid, then bisection for
    the b at which the derivative of the error vanishes, which is known to all digits, unlike a least error.
    """

    def project(b: float) -> tuple[float, np.ndarray, np.ndarray]:
        basis = np.exp(-x / b)
        a = float((basis * y).sum() / (basis * basis).sum())
        return a, basis, y - a * basis

    grid = np.geomspace(1.0, 5000.0, 200)
    at = int(np.argmin([(project(b)[2] ** 2).sum() for b in grid]))
    low, high = np.log(grid[max(at - 1, 0)]), np.log(grid[min(at + 1, len(grid) - 1)])
    for _ in range(60):
        middle = (low + high) / 2
        a, basis, rest = project(float(np.exp(middle)))
        if (rest * basis * x).sum() * a > 0:
            low = middle
        else:
            high = middle
    b = float(np.exp((low + high) / 2))
    return project(b)[0], b


def delay_exp_fit(flights: DataFrame, low: int = 15, high: int = 180, bins: int = 60) -> DataFrame:
    """Exponential decay ``a * exp(-delay / b)`` of the delay density per airline, ranked by a.

    The histogram is aggregated by Spark; each fit then sees one array of ``bins`` densities.
    """
    width = (high - low) / bins
    centers = low + width * (np.arange(bins) + 0.5)
    histogram = delay_histogram(flights, low, high, bins)
    bars = histogram.groupBy("airline").agg(F.collect_list(F.struct("bin", "density")).alias("bars"))

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fits = []
            for airline, pairs in zip(batch["airline"], batch["bars"]):
                density = np.zeros(bins)  # bins without flights have density 0
                for pair in pairs:
                    density[pair["bin"]] = pair["density"]
                fits.append((airline, *_decay_fit(centers, density)))
            yield pd.DataFrame(fits, columns=["airline", "a", "b"])

    fitted = bars.mapInPandas(fit, "airline string, a double, b double")
    return fitted.withColumn("large_delay_rank", F.rank().over(Window.orderBy("a")))


def departure_vs_arrival(flights: DataFrame) -> DataFrame:
    return flights.groupBy("airline").agg(
        F.avg("delay").alias("mean_departure_delay"), F.avg("arr_delay").alias("mean_arrival_delay")
    )


def airport_count(flights: DataFrame) -> DataFrame:
    return flights.agg(F.countDistinct("origin").alias("airports"))


def airports_per_airline(flights: DataFrame) -> DataFrame:
    return flights.groupBy("airline").agg(F.countDistinct("origin").alias("airports"))


def route_volume(flights: DataFrame, airports: DataFrame) -> DataFrame:
    """Flights per airline and route with a volume class; routes need coordinates at both ends."""
    routes = flights.groupBy("airline", "origin", "destination").agg(F.count(F.lit(1)).alias("flights"))
    located = airports.dropna(subset=["LATITUDE", "LONGITUDE"]).select(F.trim("IATA_CODE").alias("code"))
    n = F.col("flights")
    return (
        routes.join(located.withColumnRenamed("code", "origin"), "origin", "left_semi")
        .join(located.withColumnRenamed("code", "destination"), "destination", "left_semi")
        .withColumn("volume_class", F.when(n < 100, "< 100").when(n < 200, "100 - 200").otherwise(">= 200"))
        .select("airline", "origin", "destination", "flights", "volume_class")
        .orderBy("flights", "airline", "origin", "destination")
    )


def airport_carrier_pivot(flights: DataFrame) -> DataFrame:
    """Mean delay matrix, one column for every carrier that occurs in the flights.

    Flights shrink to sums per airport and carrier once, which the list of carriers is taken from too.
    """
    sums = flights.groupBy("origin", "airline").agg(F.sum("delay").alias("s"), F.count("delay").alias("n"))
    mean = F.sum("s") / F.nullif(F.sum("n"), F.lit(0).cast("bigint"))
    return sums.groupBy("origin").pivot("airline").agg(mean)


def route_delay(flights: DataFrame, cap: int = 90) -> DataFrame:
    """Mean and spread of capped delays per airline and route."""
    capped = F.least(F.col("delay"), F.lit(cap))
    return (
        flights.groupBy("airline", F.concat_ws("-", "origin", "destination").alias("route"))
        .agg(
            F.count("delay").alias("flights"),
            F.avg(capped).alias("mean_delay"),
            kpi.stddev_population(capped).alias("std_delay"),
        )
        .withColumn("std_min", F.least(F.col("mean_delay") + 15, F.col("std_delay")))
        .orderBy("airline", "route")
    )


def airport_series(flights: DataFrame, airline: str, origin: str) -> DataFrame:
    """Delays of late-arriving flights of one airline and origin in departure order."""
    chosen = (F.col("airline") == airline) & (F.col("origin") == origin)
    return (
        flights.filter(chosen & (F.col("arr_delay") > 0))
        .select(_departure_timestamp().alias("departure_ts"), "FLIGHT_NUMBER", "TAIL_NUMBER", "delay", "departure_seconds")
        .orderBy("departure_ts", "FLIGHT_NUMBER", "TAIL_NUMBER")
    )


def time_of_day(flights: DataFrame) -> DataFrame:
    return flights.groupBy("departure_seconds").agg(*stats("delay"))


def quadratic_fit(by_time: DataFrame) -> DataFrame:
    """Least-squares parabola of the mean delay over the seconds of the day, as column ``fit``.

    ``by_time`` has one row per clock minute at most, so a window over all of it is small. It attaches
    the covariances to every row, from which the two slopes follow in closed form.
    """
    everything = Window.partitionBy()
    x, z, y = F.col("_x"), F.col("_z"), F.col("mean")
    scaled = by_time.withColumn("_x", F.col("departure_seconds") / 43200.0 - 1.0).withColumn("_z", x * x)
    sums = {
        "_mx": F.avg(x), "_mz": F.avg(z), "_my": F.avg(y),
        "_xx": F.var_pop(x), "_zz": F.var_pop(z), "_xz": F.covar_pop(x, z),
        "_xy": F.covar_pop(x, y), "_zy": F.covar_pop(z, y),
    }
    known = scaled.withColumns({name: total.over(everything) for name, total in sums.items()})
    s = {name: F.col(name) for name in sums}
    determinant = F.nullif(s["_xx"] * s["_zz"] - s["_xz"] * s["_xz"], F.lit(0.0))
    linear = (s["_zz"] * s["_xy"] - s["_xz"] * s["_zy"]) / determinant
    square = (s["_xx"] * s["_zy"] - s["_xz"] * s["_xy"]) / determinant
    fit = s["_my"] + linear * (x - s["_mx"]) + square * (z - s["_mz"])
    return known.withColumn("fit", fit).drop("_x", "_z", *sums)


def airport_census(flights: DataFrame, airline: str = "AA", least: int = 5) -> DataFrame:
    """Delay statistics of the ``least`` least-served origins of one airline."""
    return (
        flights.filter(F.col("airline") == airline)
        .groupBy("origin")
        .agg(*stats("delay"))
        .orderBy("count", "origin")
        .limit(least)
    )
