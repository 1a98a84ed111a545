"""Least squares over all airports, with and without a ridge penalty, from one table of sums.

The model has a one-hot column for every airport, times as fractions of the day, and for order 2 their
products and a slope per airport and time (``models.one_hot_stages``). Two airports never meet in a product, so the
normal matrix is a block for each airport and a border of the few common columns. One aggregation gives the
sums of an airport's products; they hold all that any order up to 2 and any penalty needs. Each airport's block is
eliminated by itself, what the eliminations leave of the border adds up to a system of at most six unknowns
(the Schur complement), and its solution gives each airport's part. All penalties go through these steps together.

A penalty ``alpha`` applies to centred columns of unit length: it adds ``alpha`` times n times the column's variance to
the diagonal. A one-hot column stands twice in the penalised order 2 vector, which halves its penalty. The plain
fit (alpha 0) has no intercept besides the airports, and no common linear term where every airport has its own slope.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import combinations_with_replacement

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.plans.fitting import SECONDS_PER_DAY
from tarmac.session import cut_lineage

#: Below this share of the uncentred sums a sum of squares counts as zero.
TINY = 1e-9


def columns(times: Sequence[str]) -> list[Column]:
    """One, the times, their products and the target, in the order of the sums."""
    t = [F.col(c) / SECONDS_PER_DAY for c in times]
    return [F.lit(1.0), *t, *[a * b for a, b in combinations_with_replacement(t, 2)], F.col("mean")]


def airport_sums(train: DataFrame, times: Sequence[str]) -> DataFrame:
    """(airport_id, g): for every airport the sums of all products of two columns."""
    z = columns(times)
    return train.groupBy("airport_id").agg(
        F.array(*[F.sum(a * b) for a, b in combinations_with_replacement(z, 2)]).alias("g")
    )


def _matrix(flat: Sequence[float], size: int) -> np.ndarray:
    out = np.zeros((size, size))
    upper = np.triu_indices(size)
    out[upper] = flat
    out.T[upper] = flat
    return out


def _inverse(block: np.ndarray, scale: float) -> np.ndarray:
    """Inverse of a one- or two-rowed block; directions in which an airport's times do not vary get zero."""
    trace = float(np.trace(block))
    if trace <= TINY * scale:
        return np.zeros_like(block)
    if len(block) == 1:
        return 1 / block
    det = float(block[0, 0] * block[1, 1] - block[0, 1] * block[1, 0])
    if det <= TINY * trace * trace:
        return block / trace**2
    return np.array([[block[1, 1], -block[0, 1]], [-block[1, 0], block[0, 0]]]) / det


@dataclass(frozen=True)
class Penalty:
    """An order and a penalty, over training rows with the sums ``total``."""

    order: int
    alpha: float
    total: np.ndarray
    times: int

    def _spread(self, first: float | np.ndarray, second: float | np.ndarray) -> float | np.ndarray:
        """n times the variance of a column with these sums of values and squares, times alpha."""
        return self.alpha * np.maximum(second - first * first / self.total[0, 0], 0)

    @property
    def used(self) -> np.ndarray:
        """Which common columns (one, times, products) this model has."""
        out = np.ones(len(self.total) - 1, bool)
        out[1 + self.times :] = self.order == 2
        if self.alpha == 0:
            out[0] = False
            out[1 : 1 + self.times] = self.order == 1
        return out

    def eliminate(self, g: np.ndarray) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
        """Take an airport's own columns out of its sums: the diagonal of its one-hot column, the sums without that
        column, the inverse of its block of slopes, and the sums without the slopes."""
        one = g[0, 0] + self._spread(g[0, 0], g[0, 0]) / self.order
        left = g - np.outer(g[0], g[0]) / one
        own = slice(1, 1 + self.times)
        if self.order == 1:
            return one, left, np.zeros((self.times, self.times)), left
        block = left[own, own] + np.diag(self._spread(g[0, own], np.diag(g)[own]))
        inverse = _inverse(block, float(np.diag(g)[own].sum()))
        return one, left, inverse, left - left[:, own] @ inverse @ left[own]

    def common(self, border: np.ndarray) -> np.ndarray:
        """The common coefficients from the sum of what the airports leave; zero for columns not in the model."""
        used = np.flatnonzero(self.used)
        first, second = self.total[0, :-1], np.diag(self.total)[:-1]
        penalty = self._spread(first, second)
        penalty[0] = 0
        system = border[np.ix_(used, used)] + np.diag(penalty[used])
        out = np.zeros(len(self.used))
        out[used] = np.linalg.lstsq(system, border[used, -1], rcond=1e-13)[0]
        return out

    def own(self, g: np.ndarray, common: np.ndarray) -> tuple[float, np.ndarray]:
        """An airport's level and slopes."""
        one, left, inverse, _ = self.eliminate(g)
        own = slice(1, 1 + self.times)
        slopes = inverse @ (left[own, -1] - left[own, :-1] @ common)
        return float((g[0, -1] - g[0, :-1] @ common - g[0, own] @ slopes) / one), slopes


@dataclass(frozen=True)
class Family:
    """Fits of several orders and penalties on the same rows."""

    times: tuple[str, ...]
    models: list[tuple[int, float]]
    common: list[list[float]]
    #: (airport_id, own): for each model the airport's level and slopes.
    airports: DataFrame
    #: For each model the level and slopes of an airport that training did not see.
    unseen: list[list[float]]

    def _predictions(self, rows: DataFrame) -> DataFrame:
        """Add ``_all``, the predictions of all models."""
        t = [F.col(c) / SECONDS_PER_DAY for c in self.times]
        shared = [F.lit(1.0), *t, *[a * b for a, b in combinations_with_replacement(t, 2)]]
        known = rows.join(self.airports, "airport_id", "left")
        own = F.coalesce("own", F.array(*[F.array(*map(F.lit, u)) for u in self.unseen]))
        every = []
        for i, c in enumerate(self.common):
            value = F.lit(0.0)
            for weight, column in zip(c, shared):
                value = value + float(weight) * column
            mine = F.get(F.col("_own"), F.lit(i))
            for j, column in enumerate([F.lit(1.0), *t]):
                value = value + F.get(mine, F.lit(j)) * column
            every.append(value)
        return known.withColumn("_own", own).withColumn("_all", F.array(*every)).drop("own", "_own")

    def predict(self, rows: DataFrame, order: int, alpha: float) -> DataFrame:
        at = self.models.index((order, alpha))
        return self._predictions(rows).withColumn("prediction", F.get("_all", F.lit(at))).drop("_all")

    def scores(self, rows: DataFrame) -> list[tuple[int, float, float]]:
        """(order, alpha, mean squared error) of every model, in one pass over the rows."""
        errors = [F.avg(F.pow(F.get("_all", F.lit(i)) - F.col("mean"), 2)) for i in range(len(self.models))]
        found = self._predictions(rows).agg(F.array(*errors)).first()[0]
        return [(order, alpha, error) for (order, alpha), error in zip(self.models, found)]

    def model(self, order: int, alpha: float) -> Model:
        return Model(self, order, alpha)


@dataclass(frozen=True)
class Model:
    """One member of a family."""

    family: Family
    order: int
    alpha: float

    def predict(self, rows: DataFrame) -> DataFrame:
        """Add ``prediction``; an airport unseen in training has no level of its own under a penalty, and that of an
        average airport without one."""
        return self.family.predict(rows, self.order, self.alpha)


def fit(train: DataFrame, times: Sequence[str], orders: Sequence[int], alphas: Sequence[float]) -> Family:
    """Fit every order and penalty. One pass over the rows; then two over one row per airport."""
    spark, width = train.sparkSession, len(columns(times))
    sums = cut_lineage(spark, airport_sums(train, times), "airport-sums")
    flat = sums.agg(F.array(*[F.sum(F.get("g", F.lit(i))) for i in range(width * (width + 1) // 2)])).first()[0]
    if flat[0] is None:
        raise ValueError("no rows to fit")
    total = _matrix(flat, width)
    models = [(order, float(alpha)) for order in orders for alpha in alphas]
    penalties = [Penalty(order, alpha, total, len(times)) for order, alpha in models]

    def border(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        left = [np.zeros((width, width)) for _ in penalties]
        for batch in batches:
            for g in batch["g"]:
                g = _matrix(g, width)
                for i, p in enumerate(penalties):
                    left[i] += p.eliminate(g)[3]
        rows = [(i, j, float(x)) for i, m in enumerate(left) for j, x in enumerate(m[np.triu_indices(width)])]
        yield pd.DataFrame(rows, columns=["model", "place", "x"])

    parts = sums.select("g").mapInPandas(border, "model int, place int, x double")
    added = parts.groupBy("model", "place").agg(F.sum("x").alias("x")).collect()  # a small system for each model
    borders = np.zeros((len(models), width * (width + 1) // 2))
    for row in added:
        borders[row["model"], row["place"]] = row["x"]
    common = [p.common(_matrix(b, width)) for p, b in zip(penalties, borders)]

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            own = []
            for g in batch["g"]:
                found = [p.own(_matrix(g, width), c) for p, c in zip(penalties, common)]
                own.append([[level, *slopes] for level, slopes in found])
            yield pd.DataFrame({"airport_id": batch["airport_id"], "own": own})

    airports = cut_lineage(
        spark, sums.mapInPandas(solve, "airport_id string, own array<array<double>>"), "airport-effects"
    )
    average = [
        F.array(*[F.avg(F.get(F.get("own", F.lit(i)), F.lit(j))) for j in range(1 + len(times))])
        for i in range(len(models))
    ]
    middle = airports.agg(F.array(*average)).first()[0]
    unseen = [m if alpha == 0 else [0.0] * len(m) for m, (_, alpha) in zip(middle, models)]
    return Family(tuple(times), models, [c.tolist() for c in common], airports, unseen)
