"""Packing token pieces into sequences as a cutting-stock problem, solved by column generation.

The lengths of all pieces form a histogram of bounded size. A linear program chooses how often to use each
pattern (how many pieces of each length class share a sequence); new patterns are priced by a knapsack over
the dual prices until none improves the program. The whole parts of the solution become sequences, the few
pieces left by rounding are packed best fit first, and Spark assigns the pieces, ranked within their class,
to the places of the patterns.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarmac.llm.common import texts, trimmed
from tarmac.session import TEXT_BATCHES, cut_lineage, settings

Pattern = tuple[tuple[int, int], ...]  # (class, pieces of it) pairs


def knapsack(prices: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable multiset of sizes 1..len(prices) within ``capacity``: its value and counts."""
    best = np.zeros(capacity + 1)
    take = np.zeros(capacity + 1, np.int64)
    for room in range(1, capacity + 1):
        size = min(room, len(prices))
        gain = prices[:size] + best[room - size : room][::-1]
        at = int(gain.argmax())
        best[room], take[room] = (gain[at], at + 1) if gain[at] > best[room - 1] + 1e-12 else (best[room - 1], 0)
    counts = np.zeros(len(prices), np.int64)
    room = capacity
    while room > 0:
        if take[room]:
            counts[take[room] - 1] += 1
            room -= take[room]
        else:
            room -= 1
    return float(best[capacity]), counts


def _times(matrix: np.ndarray, vector: np.ndarray) -> np.ndarray:
    """Matrix by vector without the threaded BLAS, whose threads can stand still in a driver that runs Spark."""
    return np.einsum("ij,j->i", matrix, vector)


def _inverse(columns: np.ndarray) -> np.ndarray:
    """By elimination with row pivots, in element-wise steps for the same reason."""
    n = len(columns)
    work = np.hstack([columns.astype(float), np.eye(n)])
    for i in range(n):
        pivot = i + int(np.abs(work[i:, i]).argmax())
        if pivot != i:
            work[[i, pivot]] = work[[pivot, i]]
        work[i] /= work[i, i]
        factor = work[:, i].copy()
        factor[i] = 0
        work -= factor[:, None] * work[i]
    return work[:, n:]


def column_generation(demand: np.ndarray, capacity: int, gap: float = 1e-3) -> list[tuple[float, np.ndarray]]:
    """(use, counts by size) of the patterns of a basic solution for ``demand`` pieces of sizes 1, 2, ...

    Patterns are priced between the program's dual prices and the best feasible prices so far, at first those
    in proportion to size, which keeps the prices from swinging; where such a price finds no column, the
    dual prices themselves are used. Stops when they price no pattern below its cost, or when the program is
    within ``gap`` of the bound that the feasible prices give.
    """
    sizes = np.flatnonzero(demand) + 1
    if not len(sizes):
        return []
    need = demand[sizes - 1].astype(float)
    columns = np.diag((capacity // sizes).astype(float))
    inverse = np.diag(1 / np.diag(columns))
    use = _times(inverse, need)
    prices = np.zeros(len(demand))
    center = sizes / capacity
    bound, step = (need * center).sum(), 0
    for step in range(1, 50 * len(sizes) + 1):
        if use.sum() <= (1 + gap) * bound:
            break
        dual = inverse.sum(axis=0)
        for weight in (0.8, 0.0):
            mixed = np.maximum(weight * center + (1 - weight) * dual, 0)
            prices[sizes - 1] = mixed
            value, counts = knapsack(prices, capacity)
            if value > 0 and (need * mixed).sum() / max(value, 1) > bound:
                center = mixed / max(value, 1)
                bound = (need * center).sum()
            entering = counts[sizes - 1].astype(float)
            if (dual * entering).sum() > 1 + 1e-9:
                break
        else:
            break
        direction = _times(inverse, entering)
        positive = direction > 1e-9
        if not positive.any():
            break
        ratio = np.full(len(use), np.inf)
        ratio[positive] = np.maximum(use[positive], 0) / direction[positive]
        out = int(ratio.argmin())
        columns[:, out] = entering
        if step % 200:
            row = inverse[out] / direction[out]
            inverse -= direction[:, None] * row
            inverse[out] = row
            use = use - direction * ratio[out]
            use[out] = ratio[out]
        else:  # against the growth of rounding errors
            inverse = _inverse(columns)
            use = _times(inverse, need)
    found = []
    for u, column in zip(use, columns.T):
        counts = np.zeros(len(demand), np.int64)
        counts[sizes - 1] = column.astype(np.int64)
        found.append((float(u), counts))
    return found


def best_fit(left: np.ndarray, capacity: int) -> list[Pattern]:
    """Pack the pieces that rounding left over, largest first, each into the fullest sequence with room."""
    rooms: list[list[list[int]]] = [[] for _ in range(capacity + 1)]
    for size in range(len(left), 0, -1):
        for _ in range(int(left[size - 1])):
            room = next((r for r in range(size, capacity) if rooms[r]), capacity)
            bin_ = rooms[room].pop() if room < capacity else []
            bin_.append(size)
            rooms[room - size].append(bin_)
    bins = (b for r in rooms for b in r)
    return [tuple(sorted({s: b.count(s) for s in b}.items())) for b in bins]


@dataclass
class Plan:
    """Sequences by pattern, and for every class the ranks that go to each pattern."""

    patterns: list[tuple[Pattern, int]]
    sequences: int = 0
    slots: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=dict)

    def __post_init__(self):
        rows: dict[int, list[tuple[int, int, int]]] = {}
        filled: dict[int, int] = {}
        for pattern, copies in self.patterns:
            for size, times in pattern:
                rows.setdefault(size, []).append((filled.get(size, 0), self.sequences, times))
                filled[size] = filled.get(size, 0) + times * copies
            self.sequences += copies
        self.slots = {s: tuple(np.array(x, np.int64) for x in zip(*r)) for s, r in rows.items()}

    def sequence_of(self, size: int, ranks: np.ndarray) -> np.ndarray:
        first, base, times = self.slots[size]
        at = np.searchsorted(first, ranks, side="right") - 1
        return base[at] + (ranks - first[at]) // times[at]


def plan(demand: np.ndarray, capacity: int) -> Plan:
    """Whole numbers of patterns that use every piece exactly once."""
    left = demand.astype(np.int64).copy()
    chosen: dict[Pattern, int] = {}
    for use, counts in sorted(column_generation(left, capacity), key=lambda x: -x[0]):
        used = np.flatnonzero(counts)
        copies = min([int(use + 1e-6), *(left[used] // counts[used])]) if len(used) else 0
        if copies > 0:
            pattern = tuple((int(i) + 1, int(counts[i])) for i in used)
            chosen[pattern] = chosen.get(pattern, 0) + copies
            left -= copies * counts
    for pattern in best_fit(left, capacity):
        chosen[pattern] = chosen.get(pattern, 0) + 1
    return Plan(sorted(chosen.items()))


def cut(
    docs: DataFrame,
    encoder: Callable[[], Callable[[str], bytes]],
    capacity: int = 2048,
    end_id: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Encode every text and cut it: (doc_id, start, length, ids_crc32, doc_tokens).

    Every piece but a document's last has ``capacity`` ids. ``encoder`` makes, in each task, a function from a
    text to its ids as little-endian unsigned 32-bit integers.
    """
    end = np.array([end_id], "<u4").tobytes()
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]

    @trimmed
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder()
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"].array, batch["text"]):
                raw = encode(text) + end
                for at in range(0, len(raw), 4 * capacity):
                    piece = raw[at : at + 4 * capacity]
                    rows.append((doc_id, at // 4, len(piece) // 4, zlib.crc32(piece), len(raw) // 4))
            out = pd.DataFrame(rows, columns=names)
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    schema = ", ".join(f"{n} long" for n in names)
    return texts(docs, id_col, text_col).mapInPandas(run, schema)


def pack(
    spark: SparkSession, pieces: DataFrame, capacity: int = 2048, width: int = 8, rows_per_rank: int = 1000
) -> DataFrame:
    """Give every piece (``length`` of 1 to ``capacity``) a place: its columns, sequence_id and offset.

    Lengths are planned in classes of ``width`` ids, rounded up, so the program has ``capacity / width`` rows for
    any input, and a piece wastes less than ``width`` ids. Pieces are ranked by a hash within parts of about
    ``rows_per_rank`` rows of their class; no group larger than that, or than one sequence, meets in a task.
    Repeated pieces are packed as often as they occur; no pieces give no rows.
    """
    with settings(spark, **TEXT_BATCHES):
        pieces = cut_lineage(spark, pieces, "pieces")
    size = F.ceil(F.col("length") / width).cast("int")
    counted = {r[0]: r[1] for r in pieces.groupBy(size).count().collect()}
    units = -(-capacity // width)
    demand = np.array([counted.get(i + 1, 0) for i in range(units)])
    packing = plan(demand, units)

    parts = F.element_at(F.array(*[F.lit(max(1, int(-(-n // rows_per_rank)))) for n in demand]), F.col("size"))
    part = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), parts)
    sized = pieces.withColumn("size", size).withColumn("part", part)
    counts = sized.groupBy("size", "part").count()
    before = F.sum("count").over(Window.partitionBy("size").orderBy("part")) - F.col("count")
    counts = counts.select("size", "part", before.alias("before"))
    order = Window.partitionBy("size", "part").orderBy("doc_id", "start", "ids_crc32")
    ranked = sized.withColumn("rank", F.row_number().over(order)).join(counts, ["size", "part"])
    ranked = ranked.withColumn("rank", F.col("before") + F.col("rank") - 1).drop("before", "part")

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch = batch.copy()
            batch["sequence_id"] = np.int64(0)
            for key, at in batch.groupby("size").indices.items():
                ranks = batch["rank"].to_numpy()[at]
                batch.iloc[at, batch.columns.get_loc("sequence_id")] = packing.sequence_of(int(key), ranks)
            yield batch.drop(columns=["size", "rank"])

    schema = ", ".join([f"`{c}` {t}" for c, t in pieces.dtypes] + ["sequence_id long"])
    placed = ranked.select(*pieces.columns, "size", "rank").mapInPandas(place, schema)
    inside = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "doc_id", "start", "ids_crc32")
    filled = F.sum("length").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("length")
    return placed.withColumn("offset", filled)
