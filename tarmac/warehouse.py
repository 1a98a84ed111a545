"""The whole load, from source files to a checked star schema with its views.

    report = load_warehouse(spark, sources, "/data/warehouse")          # full load
    report = load_warehouse(spark, sources, "/data/warehouse", incremental=True)
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession

from tarmac.operators import integrity, quality, star, trailing
from tarmac.operators import partials as monthly
from tarmac.plans import views
from tarmac.sources import files, tables, versions
from tarmac.streaming import ingest


@dataclass(frozen=True)
class Sources:
    airlines: str
    airports: str
    flights: str


class UnreadableSource(ValueError):
    """A source file is missing, unreadable or empty."""


@dataclass(frozen=True)
class LoadReport:
    """``counts`` holds the rows read, loaded and rejected by reason; those of an incremental load cover
    the whole epoch, and ``state`` gives them by batch. ``rejected`` are the rows in quarantine."""

    star: star.Star
    summary: DataFrame
    integrity: DataFrame
    rejected: DataFrame
    batches: list[dict]
    counts: dict[str, int]


def _require_sources(spark: SparkSession, sources: Sources) -> None:
    checked = quality.check_sources(spark, vars(sources)).collect()  # one row per source
    missing = [row.name for row in checked if not row.ok]
    if missing:
        raise UnreadableSource(f"missing or empty sources: {missing}")


class LayoutConflict(ValueError):
    """The warehouse was loaded the other way, fully or incrementally."""


def _require_layout(spark: SparkSession, warehouse: str, incremental: bool) -> None:
    version = versions.current(spark, warehouse)
    if version is not None and version.incremental != incremental:
        raise LayoutConflict(f"{warehouse} was loaded {'fully' if version.kind == versions.FULL else 'incrementally'}")


def load_warehouse(
    spark: SparkSession,
    sources: Sources,
    warehouse: str,
    *,
    incremental: bool = False,
    sample_rows: int | None = None,
    max_files: int | None = None,
    start: str | None = None,
    end: str | None = None,
    holidays: Sequence[str] | None = None,
    keep: int = 2,
    partials: bool = False,
) -> LoadReport:
    """Check the sources, load dimensions and facts, register the views, check the result.

    A full load writes a new version of the facts, which becomes valid when it is complete; until then, and if the
    load breaks, the former one is. An incremental load appends the flight files that arrived
    since the last run, and the rows in quarantine that name airports known by now; its position is kept in
    the warehouse folder. A flight that arrives again is not loaded again. A warehouse is loaded either fully or
    incrementally; the other kind is refused before anything is written. ``sample_rows`` limits a full load
    to the first rows of the flight source. Dimension members are only ever added, so their keys stay valid. The
    calendar covers the years of all loaded flights, and the days from ``start`` to ``end`` if given. The last
    ``keep`` versions of the facts stay on disk. With ``partials``, and from then on, the warehouse keeps the monthly
    states of its views, the trailing averages of its flights and the last flights of each month: a load computes those
    of the months it touched, and the views read no other flights.
    """
    _require_sources(spark, sources)
    _require_layout(spark, warehouse, incremental)
    if incremental and sample_rows:
        raise ValueError("sample_rows applies to full loads")
    airlines = files.read_airlines(spark, sources.airlines)
    airports = files.read_airports(spark, sources.airports)
    loaded = star.load_dims(spark, airlines, airports, warehouse, start, end, holidays)
    batches: list[dict] = []
    if incremental:
        arriving = ingest.open_ingest(spark, sources.flights, loaded, warehouse, max_files)
        arriving.replay()
        batches = arriving.run()
        rejected = arriving.quarantine()
        version = arriving.version
        # Before the first file there are no facts yet.
        facts = arriving.fact() if tables.exists(spark, version.fact) else None
        if facts is None:
            raise UnreadableSource(f"no flight file was loaded from {sources.flights}")
        loaded = star.extend_dates(spark, replace(loaded, fact=facts), warehouse, holidays)
    else:
        flights = files.read_flights(spark, sources.flights)
        if sample_rows:
            flights = files.first_rows(flights, sample_rows)
        loaded = star.load_fact(spark, flights, loaded, warehouse, holidays)
        version = versions.current(spark, warehouse)
        rejected = spark.read.parquet(version.quarantine)
    versions.remove_old(spark, warehouse, keep)
    if partials or monthly.kept(spark, warehouse):
        monthly.refresh(spark, loaded, warehouse, views.VIEWS.values())
        trailing.refresh(spark, loaded, views.trailed_flights(loaded), warehouse)
        for name in ("partials", "trailing"):
            monthly.remove_old(spark, warehouse, name)
        loaded = trailing.attach(spark, monthly.attach(spark, loaded, warehouse), warehouse)
    views.register_views(loaded)
    return LoadReport(
        loaded, quality.fact_summary(loaded.fact), integrity.integrity_report(loaded), rejected, batches,
        row_counts(spark, version),
    )


def row_counts(spark: SparkSession, version: versions.Version) -> dict[str, int]:
    """Rows read, loaded, delivered before and rejected by reason in an epoch, from its table of loads."""
    total: dict[str, int] = {}
    rows = versions.history(spark, version.warehouse).filter(f"epoch = {version.epoch}")
    latest = rows.groupBy("kind", "batch_id").agg({"load_id": "max"}).withColumnRenamed("max(load_id)", "load_id")
    for row in rows.join(latest.select("load_id"), "load_id", "left_semi").select("counts").toLocalIterator():
        for name, count in row["counts"].items():
            total[name] = total.get(name, 0) + count
    return total


def state(spark: SparkSession, warehouse: str) -> DataFrame:
    """What was loaded into a warehouse, and when: loads, batches, replays and resets in order, with their counts."""
    return versions.history(spark, warehouse).orderBy("load_id")


def reset(spark: SparkSession, warehouse: str, keep: int = 1) -> versions.Version:
    """Empty an incremental warehouse: the next load begins with the first file, whatever state the last one left.

    Dimensions stay. The reset is done once its row is written; the folders of older epochs are deleted
    afterwards, and by later calls if that breaks.
    """
    _require_layout(spark, warehouse, True)
    version = ingest.begin(spark, warehouse, versions.RESET)
    versions.remove_old(spark, warehouse, keep)
    return version


def clear(spark: SparkSession, warehouse: str) -> list[str]:
    """Delete all versions of the facts but the valid one."""
    return versions.remove_old(spark, warehouse, keep=1)
