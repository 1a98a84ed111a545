"""Helpers shared by the operators: text input, folds, bounded samples, class components, memory of the workers."""

from __future__ import annotations

import ctypes
import re
from collections.abc import Callable, Iterator
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.session import cut_lineage

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words_of(text: str) -> list[str]:
    """What stands between ASCII white space, with A-Z lower-cased."""
    return WORD.findall(text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass"))


def _trim() -> None:
    """Give memory that is free back to the system, where the C library can."""
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError, TypeError):  # not glibc
        pass


def trimmed(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` over the batches of a task; then the worker, which waits for other tasks, gives its free memory back.

    Without that it keeps about twice what it needs for as long as the executor lives.
    """

    @wraps(run)
    def task(batches):
        yield from run(batches)
        _trim()

    return task


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) with null texts as empty ones."""
    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def fold(id_col: str | Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; null ids count as the empty text."""
    column = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % parts


def bounded_sample(rows: DataFrame, class_col: str, id_col: str, per_class: int) -> DataFrame:
    """About ``per_class`` rows of each class, chosen by a hash of the id; smaller classes whole.

    The classes are counted over all rows, so the sample is the same wherever the rows lie. The share kept
    of a class shrinks as the class grows, which bounds the sample for any size of input.
    """
    counts = {r[0]: r[1] for r in rows.groupBy(class_col).count().collect()}
    draw = F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.lit("sample")), F.lit(1 << 30))
    keep = F.lit(False)
    for value, count in counts.items():
        if value is not None:
            share = min(1.0, per_class / count)
            keep = keep | ((F.col(class_col) == F.lit(value)) & (draw < int(share * (1 << 30))))
    return rows.filter(keep)


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable from each endpoint of ``edges`` (a, b).

    Labels travel along the edges and then jump to the label of their label, so the number of rounds grows
    with the logarithm of the longest path. Every round is written to the shared folder; nothing but the
    count of changed rows reaches the driver. Stars with very many leaves only meet in partial minima and
    in joins whose large keys adaptive execution splits.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = cut_lineage(spark, both.filter("a <> b").distinct(), "edges")
    labels = cut_lineage(
        spark,
        both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m")).select(
            "id", F.least("id", "m").alias("component")
        ),
        "labels",
    )
    while True:
        reached = both.join(labels, both.b == labels.id).groupBy("a").agg(F.min("component").alias("near"))
        spread = labels.join(reached, labels.id == reached.a, "left").select(
            "id", F.least("component", "near").alias("component"), F.col("component").alias("before")
        )
        spread = cut_lineage(spark, spread, "spread")
        target = spread.select(F.col("id").alias("component"), F.col("component").alias("beyond"))
        jumped = spread.join(target, "component", "left").select(
            "id", F.least("component", "beyond").alias("component"), "before"
        )
        jumped = cut_lineage(spark, jumped, "labels")
        changed = jumped.filter("component <> before").limit(1).count()
        labels = jumped.select("id", "component")
        if not changed:
            return labels
