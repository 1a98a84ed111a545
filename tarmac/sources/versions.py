"""What a warehouse has loaded, and which version of its facts is the valid one.

A warehouse keeps a small table of its loads that only ever grows: every finished load appends one row, as one
file, as its last step. Facts and quarantine live in folders of an epoch, and the last row that begins an
epoch names the valid one. So a load that breaks midway leaves a folder that nobody reads, and a reset is one
written number. One loader at a time works on a warehouse; readers need no lock.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tarmac.sources import tables

LOADS = (
    "load_id long, epoch long, kind string, batch_id long, airport_key int, loaded_at timestamp, "
    "counts map<string, long>"
)
#: Kinds of rows that begin an epoch.
FULL, INCREMENTAL, RESET = "full", "incremental", "reset"
BEGIN = (FULL, INCREMENTAL, RESET)
#: Kinds of rows inside an epoch.
BATCH, REPLAY = "batch", "replay"


@dataclass(frozen=True)
class Version:
    """An epoch of a warehouse: where its facts, its rejected rows and the position of its ingestion are kept."""

    warehouse: str
    epoch: int
    kind: str

    @property
    def incremental(self) -> bool:
        return self.kind != FULL

    def _folder(self, name: str) -> str:
        return f"{self.warehouse}/{name}/epoch={self.epoch}"

    @property
    def fact(self) -> str:
        return self._folder("fact_flights")

    @property
    def keys(self) -> str:
        """The keys of the batches' flights, which later batches are compared with."""
        return self._folder("_keys")

    @property
    def quarantine(self) -> str:
        return self._folder("quarantine")

    @property
    def checkpoint(self) -> str:
        return self._folder("_checkpoint")


def _path(warehouse: str) -> str:
    return f"{warehouse}/_loads"


def history(spark: SparkSession, warehouse: str) -> DataFrame:
    """All finished loads, batches, replays and resets of a warehouse."""
    if not tables.exists(spark, _path(warehouse)):
        return spark.createDataFrame([], LOADS)
    return spark.read.schema(LOADS).parquet(_path(warehouse))


def _last(rows: DataFrame) -> Row | None:
    return rows.agg(F.max_by(F.struct("*"), "load_id").alias("row")).first()["row"]


def current(spark: SparkSession, warehouse: str) -> Version | None:
    """The valid version; None before the first finished load."""
    row = _last(history(spark, warehouse).filter(F.col("kind").isin(*BEGIN)))
    return None if row is None else Version(warehouse, row["epoch"], row["kind"])


def following(spark: SparkSession, warehouse: str, kind: str) -> Version:
    """The version that comes next. Its folders may hold what a broken load left there."""
    row = _last(history(spark, warehouse))
    return Version(warehouse, 1 if row is None else row["epoch"] + 1, kind)


def last(spark: SparkSession, version: Version, kind: str) -> Row | None:
    """The last finished row of a kind in a version's epoch."""
    rows = history(spark, version.warehouse)
    return _last(rows.filter((F.col("epoch") == version.epoch) & (F.col("kind") == kind)))


def record(
    spark: SparkSession,
    version: Version,
    kind: str,
    counts: dict[str, int] | None = None,
    batch_id: int | None = None,
    airport_key: int | None = None,
) -> None:
    """Append one row: the step that makes a load count."""
    before = _last(history(spark, version.warehouse))
    load_id = 1 if before is None else before["load_id"] + 1
    row = (load_id, version.epoch, kind, batch_id, airport_key, None, counts or {})
    rows = spark.createDataFrame([row], LOADS).withColumn("loaded_at", F.current_timestamp())
    rows.coalesce(1).write.mode("append").parquet(_path(version.warehouse))


def remove_old(spark: SparkSession, warehouse: str, keep: int = 2) -> list[str]:
    """Delete the folders of all epochs but the last ``keep`` valid ones, and return them.

    Readers of an epoch that is no longer valid are served as long as it is kept.
    """
    begun = history(spark, warehouse).filter(F.col("kind").isin(*BEGIN)).select("epoch")
    epochs = {r.epoch for r in begun.orderBy(F.desc("load_id")).limit(keep).collect()}
    if not epochs:
        return []
    removed = []
    for name in ("fact_flights", "_keys", "quarantine", "_checkpoint"):
        system, folder = tables.file_system(spark, f"{warehouse}/{name}")
        for status in system.listStatus(folder) if system.exists(folder) else []:
            label = status.getPath().getName()
            if label.startswith("epoch=") and int(label[6:]) not in epochs and int(label[6:]) < max(epochs):
                system.delete(status.getPath(), True)
                removed.append(f"{name}/{label}")
    return sorted(removed)
