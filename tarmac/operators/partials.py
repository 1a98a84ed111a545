"""Monthly states under the views: what each view needs of a month, kept until the month's files change.

A state is a small aggregate of one month of flights by the keys of a view: counts, sums, sums of squares, extremes,
sets of airlines. States of months merge, so a view by quarter, by weekday or over all time reads them instead of the
flights. A table of valid states names, for every month, the files it was computed from. Files of the fact are never
changed once written, so a month whose list of files is the same has the same state; a view aggregates any other month
from its flights. A load therefore costs the views only the months that it touched.

States are written to a folder of their own run, and count from the moment their rows in the table of states are
written. A refresh that breaks leaves a folder that nobody reads.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tarmac.functions.measures import Figures, Measures, States
from tarmac.operators.merge import in_months
from tarmac.operators.star import Star
from tarmac.sources import tables

#: The partition columns of the fact, as the views name them.
MONTH = ["fact_year", "fact_month"]
Month = tuple[int, int]

TABLE = "seq long, fact_year int, fact_month int, files string, run string"


def signatures(fact: DataFrame) -> dict[Month, str]:
    """A digest of the names of each month's files. Only names are read, which Spark has listed for its scan."""
    names: dict[Month, list[str]] = {}
    for path in fact.inputFiles():
        found = re.search(r"/year=(\d+)/month=(\d+)/", path)
        if found is None:
            raise ValueError(f"not a file of a month: {path}")
        # The folder of the epoch and batch is part of the name, the place of the warehouse is not.
        names.setdefault((int(found[1]), int(found[2])), []).append(path[path.rindex("/epoch=") :])
    return {m: hashlib.sha256("\n".join(sorted(n)).encode()).hexdigest() for m, n in names.items()}


def of_months(months: Iterable[Month]) -> Column:
    """A filter that prunes partitions, of the fact and of the states."""
    return in_months(sorted(months), *MONTH)


def stored(spark: SparkSession, base: str, runs: dict[str, list[Month]], schema: StructType) -> DataFrame:
    """What the runs have written below ``base`` for the months they are valid for."""
    paths = [f"{base}/run={run}" for run in runs]
    rows = spark.read.schema(StructType([*schema, StructField("run", StringType())])).option("basePath", base)
    valid = F.lit(False)
    for run, months in runs.items():
        valid = valid | ((F.col("run") == run) & of_months(months))
    return rows.parquet(*paths).filter(valid).select(*schema.names)


def write(states: DataFrame, path: str) -> None:
    """Write states by month. A month's states are few: one file a month."""
    states.repartition(*MONTH).write.partitionBy(*MONTH).parquet(path)


def _states(rows: DataFrame, keys: list[str], figures: Figures) -> tuple[DataFrame, list[Column]]:
    """The states of all months in ``rows``, and the figures that merge them."""
    states = States()
    merged = figures(states)
    return rows.groupBy(*MONTH, *keys).agg(*states.kept), merged


@dataclass(frozen=True)
class Partials:
    """The states that are valid for a fact: months by run, and the months without a valid state."""

    spark: SparkSession
    folder: str
    runs: dict[str, list[Month]]
    stale: list[Month]

    def grouped(self, view: str, rows: DataFrame, keys: list[str], figures: Figures) -> DataFrame:
        """Figures by ``keys``: stored states, merged with those of the stale months computed now."""
        fresh, merged = _states(rows, keys, figures)
        if not self.runs:
            return rows.groupBy(*keys).agg(*figures(Measures()))
        states = stored(self.spark, f"{self.folder}/{view}", self.runs, fresh.schema)
        if self.stale:
            now, _ = _states(rows.filter(of_months(self.stale)), keys, figures)
            states = states.unionByName(now)
        return states.groupBy(*keys).agg(*merged)


def _folder(warehouse: str) -> str:
    return f"{warehouse}/partials"


def _table(spark: SparkSession, folder: str) -> DataFrame | None:
    path = f"{folder}/_states"
    return spark.read.schema(TABLE).parquet(path) if tables.exists(spark, path) else None


def kept(spark: SparkSession, warehouse: str) -> bool:
    """Whether a warehouse keeps states."""
    return _table(spark, _folder(warehouse)) is not None


def _latest(spark: SparkSession, folder: str) -> list:
    """One row a month: its last state."""
    listed = _table(spark, folder)
    if listed is None:
        return []
    return listed.groupBy(*MONTH).agg(F.max_by(F.struct("seq", "files", "run"), "seq").alias("last")).collect()


def valid_runs(spark: SparkSession, folder: str, now: dict[Month, str]) -> tuple[dict[str, list[Month]], list[Month]]:
    """The months by run whose states below ``folder`` have the digests ``now``, and the other months."""
    runs: dict[str, list[Month]] = {}
    for row in _latest(spark, folder):
        month = (row[MONTH[0]], row[MONTH[1]])
        if now.get(month) == row["last"]["files"]:
            runs.setdefault(row["last"]["run"], []).append(month)
    valid = {m for months in runs.values() for m in months}
    return runs, sorted(set(now) - valid)


def record(spark: SparkSession, folder: str, now: dict[Month, str], months: list[Month], run: str) -> None:
    """The step that makes the states of a run count, for these months."""
    listed = _table(spark, folder)
    last = 0 if listed is None else listed.agg(F.max("seq")).first()[0]
    rows = [(last + 1, *month, now[month], run) for month in months]
    spark.createDataFrame(rows, TABLE).coalesce(1).write.mode("append").parquet(f"{folder}/_states")


def attach(spark: SparkSession, star: Star, warehouse: str) -> Star:
    """The star whose views use the states of its warehouse, for all months whose files have not changed."""
    folder = _folder(warehouse)
    return replace(star, partials=Partials(spark, folder, *valid_runs(spark, folder, signatures(star.fact))))


@dataclass
class _Recorder:
    """Stands in for stored states while the views say what they need."""

    wanted: dict[str, tuple[DataFrame, list[str], Figures]]

    def grouped(self, view: str, rows: DataFrame, keys: list[str], figures: Figures) -> DataFrame:
        self.wanted[view] = (rows, keys, figures)
        return rows.groupBy(*keys).agg(*figures(Measures()))


def refresh(
    spark: SparkSession, star: Star, warehouse: str, views: Iterable[Callable[[Star], DataFrame]]
) -> list[Month]:
    """Compute the states of all months whose files have changed, and return these months.

    Only the flights of these months are read, once a view. The states of a month replace the former ones when
    those of all views are written.
    """
    folder, now = _folder(warehouse), signatures(star.fact)
    _, stale = valid_runs(spark, folder, now)
    if not stale:
        return []
    recorder = _Recorder({})
    for view in views:
        view(replace(star, partials=recorder, trailing=None))
    run = uuid.uuid4().hex
    for view, (rows, keys, figures) in recorder.wanted.items():
        states, _ = _states(rows.filter(of_months(stale)), keys, figures)
        write(states, f"{folder}/{view}/run={run}")
    record(spark, folder, now, stale, run)
    return stale


def remove_old(spark: SparkSession, warehouse: str, name: str = "partials") -> list[str]:
    """Delete the states of runs that are no month's last one; the removed folders."""
    used = {row["last"]["run"] for row in _latest(spark, f"{warehouse}/{name}")}
    system, folder = tables.file_system(spark, f"{warehouse}/{name}")
    removed = []
    for kind in system.listStatus(folder) if used and system.exists(folder) else []:
        for status in system.listStatus(kind.getPath()) if kind.isDirectory() else []:
            run = status.getPath().getName()
            if run.startswith("run=") and run[4:] not in used:
                system.delete(status.getPath(), True)
                removed.append(f"{kind.getPath().getName()}/{run}")
    return sorted(removed)
