"""Trailing averages over many loads: what a new month needs of the former ones, without reading them.

A warehouse keeps, for every month, the averages of its flights and the last flights of each peer group (the month's
tails). A load of new months reads their flights and the tails before them. Every month's digest covers the files of
all months up to it: a flight that arrives late changes the averages of flights after it, so from its month on
averages and tails are computed again, from the tails before that month.
"""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarmac.operators import partials
from tarmac.operators.history import needs_split, rows_in_memory, trailing_average
from tarmac.operators.partials import MONTH, Month
from tarmac.operators.star import Star
from tarmac.session import WIDE_WRITES, settings

#: The averages and the keys of their peer groups.
PEERS = {
    "historical_avg_delay_airline_airport": ["airline_key", "origin_airport_key"],
    "historical_avg_delay_route": ["origin_airport_key", "destination_airport_key"],
    "historical_avg_delay_time": ["departure_time_key", "day_of_week"],
}
#: The order of the flights of a group, and the value that is averaged.
ORDER = ["date_key", "flight_key", "departure_delay_minutes"]
KEYS = list(dict.fromkeys(k for keys in PEERS.values() for k in keys))


def with_averages(flights: DataFrame, rows: int, split_rows: int, before: DataFrame | None = None) -> DataFrame:
    """Flights with the mean delay of the ``rows`` flights before each in its three peer groups.

    ``before`` holds the last flights of the groups before all of these (see ``tails``). A group is cut into chunks
    above ``split_rows`` rows, and above those that a task has the memory for.
    """
    # The windows move every row: a key in bytes is half as long and has the same order as its hexadecimal digits.
    flights = flights.withColumn("flight_key", F.unhex("flight_key"))
    before = before if before is None else before.withColumn("flight_key", F.unhex("flight_key"))
    split_rows = min(split_rows, rows_in_memory(flights))
    splits = needs_split(flights, list(PEERS.values()), split_rows)
    featured = flights
    for (name, keys), split in zip(PEERS.items(), splits):
        rest = (*ORDER, name, rows, split_rows, split)
        if before is None:
            featured = trailing_average(featured, flights, keys, *rest)
            continue
        earlier = before.filter(F.col("peer") == name).select(*keys, *ORDER, F.lit(True).alias("_earlier"))
        base = flights.select(*keys, *ORDER).unionByName(earlier.drop("_earlier"))
        both = featured.withColumn("_earlier", F.lit(False)).unionByName(earlier, allowMissingColumns=True)
        featured = trailing_average(both, base, keys, *rest).filter(~F.col("_earlier")).drop("_earlier")
    return featured.withColumn("flight_key", F.lower(F.hex("flight_key")))


def tails(flights: DataFrame, rows: int) -> DataFrame:
    """(peer, fact_year, fact_month, keys, order): the last ``rows`` flights of every peer group in every month.

    Spark limits a rank in each map task already, so a hot group sends ``rows`` flights a task.
    """
    found = []
    for name, keys in PEERS.items():
        backwards = Window.partitionBy(*MONTH, *keys).orderBy(*[F.desc(c) for c in ORDER])
        last = flights.select(*MONTH, *keys, *ORDER).withColumn("_rank", F.row_number().over(backwards))
        last = last.filter(F.col("_rank") <= rows).drop("_rank").withColumn("peer", F.lit(name))
        found.append(last)
    listed = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), found)
    return listed.select("peer", *KEYS, *ORDER, *MONTH)


def chained(fact: DataFrame) -> dict[Month, str]:
    """A digest for each month of the files of all months up to it."""
    digests, last = {}, ""
    for month, files in sorted(partials.signatures(fact).items()):
        last = hashlib.sha256(f"{last} {month} {files}".encode()).hexdigest()
        digests[month] = last
    return digests


@dataclass(frozen=True)
class Trailing:
    """The averages and tails that are valid for a fact, by run, and the months from the first changed one on."""

    spark: SparkSession
    folder: str
    rows: int
    runs: dict[str, list[Month]]
    stale: list[Month]

    def _computed(self, flights: DataFrame, split_rows: int) -> DataFrame:
        """Averages of the stale months, from their flights and the tails of the months before."""
        fresh = flights.filter(partials.of_months(self.stale))
        if not self.runs:
            return with_averages(fresh, self.rows, split_rows)
        like = tails(flights, self.rows).schema
        before = partials.stored(self.spark, f"{self.folder}/tails", self.runs, like)
        # A group's last flights over all earlier months; each has at most ``rows`` of every month.
        backwards = Window.partitionBy("peer", *KEYS).orderBy(*[F.desc(c) for c in ORDER])
        before = before.withColumn("_rank", F.row_number().over(backwards)).filter(F.col("_rank") <= self.rows)
        return with_averages(fresh, self.rows, split_rows, before.drop("_rank"))

    def featured(self, flights: DataFrame, split_rows: int) -> DataFrame:
        """All flights with their averages: stored ones, and those of the stale months computed now."""
        parts = []
        if self.runs:
            like = flights.withColumns({name: F.lit(None).cast("double") for name in PEERS})
            columns = [*[c for c in like.columns if c not in MONTH], *MONTH]
            schema = like.select(*columns).schema
            parts.append(partials.stored(self.spark, f"{self.folder}/averages", self.runs, schema))
        if self.stale or not parts:
            parts.append(self._computed(flights, split_rows))
        return reduce(DataFrame.unionByName, parts).drop(*MONTH)


def _folder(warehouse: str) -> str:
    return f"{warehouse}/trailing"


def attach(spark: SparkSession, star: Star, warehouse: str, rows: int = 30) -> Star:
    """The star whose delay features use the averages that its warehouse keeps."""
    runs, stale = partials.valid_runs(spark, _folder(warehouse), chained(star.fact))
    return replace(star, trailing=Trailing(spark, _folder(warehouse), rows, runs, stale))


def refresh(
    spark: SparkSession, star: Star, flights: DataFrame, warehouse: str, rows: int = 30, split_rows: int = 2_000_000
) -> list[Month]:
    """Keep the averages and tails of all months from the first changed one on, and return these months.

    ``flights`` are the star's flights as the features need them. Flights of earlier months are not read. What is
    written counts when both tables are complete.
    """
    state = attach(spark, star, warehouse, rows).trailing
    if not state.stale:
        return []
    run = uuid.uuid4().hex
    averages = state._computed(flights, split_rows)
    written = averages.write.partitionBy(*MONTH).option("compression", "zstd")
    with settings(spark, **WIDE_WRITES):
        written.parquet(f"{state.folder}/averages/run={run}")
    fresh = flights.filter(partials.of_months(state.stale))
    partials.write(tails(fresh, rows), f"{state.folder}/tails/run={run}")
    partials.record(spark, state.folder, chained(star.fact), state.stale, run)
    return state.stale
