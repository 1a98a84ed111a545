"""Parquet table sinks: append, load-once dimensions, partitioned facts, table statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarmac.session import COMPILED, settings


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Append rows to a table. An empty frame adds no rows.

    The rebalance hint lets adaptive execution size the output files: a hot partition value is split
    over several tasks and small ones are merged.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def write_fact(fact: DataFrame, path: str, mode: str = "append") -> None:
    """Write flight facts, partitioned by month and sorted for min/max skipping inside files.

    Every task sorts and writes what it has read, so no fact is shuffled; a task writes one file a month it met.
    """
    writer = (
        fact.sortWithinPartitions("year", "month", "date_key", "origin_airport_key")
        .write.mode(mode)
        .option("compression", "zstd")
        .partitionBy("year", "month")
    )
    with settings(fact.sparkSession, **COMPILED):
        writer.parquet(path)


def new_members(existing: DataFrame, incoming: DataFrame, code: str, key: str) -> DataFrame:
    """Rows of ``incoming`` whose code is not loaded yet, with keys that continue the existing ones.

    Keys already handed out never change; a dimension whose code is its key (the date) keeps it.
    Dimensions are bounded by their subject (carriers, airports, days), so numbering the few new
    members in one window is safe.
    """
    fresh = incoming.join(existing.select(code), code, "left_anti")
    if code == key:
        return fresh.select(*existing.columns)
    last_key = existing.agg(F.coalesce(F.max(key), F.lit(0)).alias("last")).scalar()
    number = F.row_number().over(Window.orderBy(code))
    return fresh.withColumn(key, (number + last_key).cast("int")).select(*existing.columns)


def file_system(spark: SparkSession, path: str):
    """The file system of a path and the path, as Spark sees them."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` holds a Parquet table: a folder with at least one finished file."""
    system, folder = file_system(spark, path)
    if not system.exists(folder):
        return False
    found = system.listFiles(folder, True)
    while found.hasNext():
        name = found.next().getPath().toString()
        if name.endswith(".parquet") and "/_temporary/" not in name:
            return True
    return False


def partitions(spark: SparkSession, path: str, column: str) -> list[str]:
    """The values of the first partition column of a table, which need not exist yet."""
    system, folder = file_system(spark, path)
    names = [s.getPath().getName() for s in (system.listStatus(folder) if system.exists(folder) else [])]
    return sorted(name[len(column) + 1 :] for name in names if name.startswith(f"{column}="))


def load_once(spark: SparkSession, incoming: DataFrame, path: str, code: str, key: str) -> DataFrame:
    """Load a dimension idempotently: only members missing from the table at ``path`` are appended."""
    if not exists(spark, path):
        incoming.write.parquet(path)
    else:
        existing = spark.read.schema(incoming.schema).parquet(path)
        new_members(existing, incoming, code, key).write.mode("append").parquet(path)
    return spark.read.schema(incoming.schema).parquet(path)


def table_stats(spark: SparkSession, path: str) -> DataFrame:
    """Rows and size in MB of a Parquet table, the size from file metadata only."""
    df = spark.read.parquet(path)
    files = df.select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("bytes")
    )
    per_file = files.groupBy("path").agg(F.count(F.lit(1)).alias("rows"), F.max("bytes").alias("bytes"))
    return per_file.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("row_count"),
        F.round(F.coalesce(F.sum("bytes"), F.lit(0)) / (1024 * 1024), 2).alias("size_mb"),
    )
