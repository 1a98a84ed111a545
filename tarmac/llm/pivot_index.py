"""Near-duplicate embeddings by a pivot-permutation index.

Every vector is described by its nearest reference points, nearest first. Inverted lists lead from reference
points to vectors; two vectors are candidates where they share at least ``shared`` of their ``nearest``
points. To count shared points without walking through whole lists, the lists are kept by combinations
of ``shared`` points: a pair that shares enough meets in the list of its smallest common combination.
Every candidate is verified by its cosine in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm.common import components
from tarmac.session import cut_lineage


def unit_vector(values) -> np.ndarray | None:
    """The vector scaled to length one; None if it is null, zero or has a component that is no finite number."""
    if values is None or not len(values):
        return None
    x = np.asarray(values)
    if x.dtype == object:
        if any(v is None for v in x):
            return None
    x = x.astype(np.float64)
    if not np.isfinite(x).all():
        return None
    x = x / max(np.abs(x).max(), 1e-300)
    length = np.sqrt(x @ x)
    return x / length if length > 0 else None


def prepare(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, node, unit): the digest of the vector and its unit vector; null for rows that link with nothing."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            units = [unit_vector(v) for v in batch["v"]]
            raw = [None if u is None else u.tobytes() for u in units]
            yield pd.DataFrame({
                "vec_id": batch["i"].astype("Int64").array,
                "node": [None if r is None else sha256(r).hexdigest()[:32] for r in raw], "unit": raw,
            })

    rows = vectors.select(F.col(id_col).alias("i"), F.col(vector_col).alias("v"))
    return rows.mapInPandas(run, "vec_id long, node string, unit binary")


@dataclass
class Index:
    """Reference points (independent sets), the number of nearest points and how many must be shared."""

    points: list[np.ndarray]
    nearest: int
    shared: int

    def describe(self, units: np.ndarray) -> list[np.ndarray]:
        """For each set of points, the nearest ones of every vector, nearest first."""
        found = []
        for points in self.points:
            cosines = np.round(units @ points.T, 12)
            found.append(np.argsort(-cosines, axis=1, kind="stable")[:, : self.nearest])
        return found


def build(distinct: DataFrame, count: int, factor: float, nearest: int, shared: int, tables: int) -> Index:
    """Take ``factor`` times the cube root of ``count`` vectors, chosen by their digest, as reference points.

    The number of combinations, and with it of lists, then grows with the number of vectors, so lists keep
    their length. This sample is all of the vectors that the driver sees.
    """
    size = int(max(nearest + 2, round(factor * count ** (1 / 3))))
    points = []
    for t in range(tables):
        rows = distinct.orderBy(F.xxhash64("node", F.lit(t)), "node").select("unit").limit(size).collect()
        chosen = [np.frombuffer(r["unit"]) for r in rows]
        draw = np.random.default_rng(t)
        while len(chosen) < size:  # a small table is short of points: add random directions
            point = draw.normal(size=len(chosen[0]))
            chosen.append(point / np.linalg.norm(point))
        points.append(np.stack(chosen))
    return Index(points, nearest, shared)


def postings(distinct: DataFrame, index: Index) -> DataFrame:
    """(node, unit, copies, near, lists): the nearest points in all sets and the lists of each vector.

    A list's number spells its set and its points in order, which are below 2**17.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        chosen = np.array(list(combinations(range(index.nearest), index.shared)))
        for batch in batches:
            if not len(batch):
                continue
            near = index.describe(np.stack([np.frombuffer(u) for u in batch["unit"]]))
            lists = []
            for t, points in enumerate(near):
                picked = np.sort(points, axis=1)[:, chosen].astype(np.int64)
                number = np.full(picked.shape[:2], t, np.int64)
                for place in range(picked.shape[2]):
                    number = number << 17 | picked[:, :, place]
                lists.append(number)
            out = batch[["node", "unit", "copies"]].copy()
            out["near"] = list(np.hstack(near).astype(np.int32))
            out["lists"] = list(np.hstack(lists))
            yield out

    schema = "node string, unit binary, copies long, near array<int>, lists array<long>"
    return distinct.select("node", "unit", "copies").mapInPandas(run, schema)


def _verify(index: Index, least: float):
    """Checks the pairs of each row's vectors: (node, links, root) for every vector with a link, where root is the
    smallest node its links reach within the row."""
    low = (1 << 17) - 1

    def pairs(row) -> list[tuple[str, int, str]]:
        nodes = np.array(row.nodes, object)
        units = np.frombuffer(b"".join(row.units)).reshape(len(nodes), -1)
        linked = units @ units.T >= least
        np.fill_diagonal(linked, False)
        if row.here != row.there:
            side = np.array(row.sides)
            linked &= side[:, None] != side[None, :]
        if not linked.any():
            return []
        # A pair counts only in the first list in which it meets.
        t, last = row.list >> 17 * index.shared, row.list & low
        near = np.stack([np.asarray(n) for n in row.near])
        for earlier in range(t + 1):
            own = near[:, earlier * index.nearest : (earlier + 1) * index.nearest]
            held = np.zeros((len(nodes), len(index.points[earlier])), np.float32)
            np.put_along_axis(held, own, 1, axis=1)
            if earlier == t:
                linked &= np.rint(held[:, : last + 1] @ held[:, : last + 1].T) == index.shared
            else:
                linked &= np.rint(held @ held.T) < index.shared
        links = linked @ np.array(row.copies, np.int64)
        order = np.argsort(nodes, kind="stable")
        rank = np.empty(len(nodes), np.int64)
        rank[order] = np.arange(len(nodes))
        root = rank.copy()
        while True:
            reached = np.where(linked, root[None, :], len(nodes)).min(axis=1)
            nearer = np.minimum(root, reached)
            if (nearer == root).all():
                break
            root = nearer
        return [(nodes[i], int(links[i]), nodes[order[root[i]]]) for i in np.flatnonzero(links)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [p for row in batch.itertuples(index=False) for p in pairs(row)]
            yield pd.DataFrame(found, columns=["node", "links", "root"])

    return run


def near_vectors(
    spark: SparkSession,
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    least: float = 0.95,
    factor: float = 3.5,
    nearest: int = 5,
    shared: int = 3,
    tables: int = 3,
    block: int = 256,
) -> DataFrame:
    """Link vectors with a cosine of ``least`` or more: (vec_id, n_links, component_id, kept) for every row.

    n_links counts the other rows linked directly, component_id is the smallest vec_id that links reach, and
    kept tells whether that is the row itself. Null, zero or empty vectors and such with null or non-finite
    components link with nothing, nor do vectors of another length than most; a null id counts in others'
    links but is nobody's component. Equal vectors are one class and counted by their number; they are never
    paired. Lists longer than ``block`` are dealt in blocks whose pairs are separate rows, so a task holds two
    blocks at most. Found pairs are exact; pairs that share fewer than ``shared`` points in all sets are missed.
    More ``tables`` of points find more; with two, 0.936 of the links of a large, loose group were found.
    """
    rows = cut_lineage(spark, prepare(vectors, id_col, vector_col), "units")
    size = rows.filter("unit IS NOT NULL").groupBy(F.length("unit").alias("bytes")).count()
    common = size.orderBy(F.desc("count"), "bytes").first()
    usable = rows.filter(F.col("unit").isNotNull() & (F.length("unit") == (common["bytes"] if common else 0)))
    distinct = usable.groupBy("node").agg(
        F.first("unit").alias("unit"), F.count("*").alias("copies"), F.min("vec_id").alias("first_id")
    )
    distinct = cut_lineage(spark, distinct, "distinct")
    count = distinct.count()
    if not count:
        alone = rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
        return alone.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))

    index = build(distinct, count, factor, nearest, shared, tables)
    described = cut_lineage(spark, postings(distinct, index), "described")
    entries = described.select("node", F.explode("lists").alias("list"))
    sizes = entries.groupBy("list").count().filter("count > 1")
    sizes = cut_lineage(spark, sizes, "lists")
    blocks = F.ceil(F.col("count") / block).cast("int")
    met = entries.join(sizes, "list").withColumn("blocks", blocks)
    met = met.withColumn("side", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.select("node", "list", "side", F.least("side", "other").alias("here"), F.greatest("side", "other").alias("there"))
    met = cut_lineage(spark, met, "met")
    full = met.join(described.drop("lists"), "node")
    groups = full.groupBy("list", "here", "there").agg(
        *[F.collect_list(c).alias(n) for c, n in
          (("node", "nodes"), ("unit", "units"), ("copies", "copies"), ("near", "near"), ("side", "sides"))]
    )
    found = groups.filter(F.size("nodes") > 1).mapInPandas(_verify(index, least), "node string, links long, root string")
    found = cut_lineage(spark, found, "found")

    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    edges = found.filter("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))
    reach = components(spark, edges.distinct()).withColumnRenamed("id", "node")
    classes = distinct.select("node", "copies", "first_id").join(links, "node", "left").join(reach, "node", "left")
    classes = classes.withColumn("component", F.coalesce("component", "node"))
    smallest = classes.groupBy("component").agg(F.min("first_id").alias("component_id"))
    classes = cut_lineage(spark, classes.join(smallest, "component").select("node", "copies", "links", "component_id"), "classes")
    result = rows.drop("unit").join(classes, "node", "left")
    others = F.coalesce(F.col("links"), F.lit(0)) + F.coalesce(F.col("copies") - 1, F.lit(0))
    component = F.when(F.col("vec_id").isNull(), None).otherwise(F.coalesce("component_id", "vec_id"))
    return result.select(
        "vec_id", others.cast("long").alias("n_links"), component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
