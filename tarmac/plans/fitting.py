"""Polynomial least squares from triangular factors, for all airline and airport pairs at once.

The time of day is scaled to [-1, 1] and expanded in Chebyshev polynomials. The rows (T_0, ..., T_n, y) of a group of
points are reduced to the triangular factor of their QR decomposition: at most nine rows that have the same
length as the points for every combination of the columns. Factors merge: the factor of several factors on top of each
other is that of all their points. So a fold's training factor is merged from the other folds', the leading
block of a factor gives the fit of every lower order, and the squared error of a fit on a group is the squared length of its
factor times (coefficients, -1). Nothing is subtracted from anything larger, as with differences of power sums.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SECONDS_PER_DAY = 86400.0


def factor(rows: np.ndarray) -> np.ndarray:
    """The triangular factor of some rows, or of factors on top of each other; fewer rows stay as they are."""
    return rows if len(rows) <= 1 else np.linalg.qr(rows, mode="r")


def design(seconds: np.ndarray, y: np.ndarray, order: int) -> np.ndarray:
    """One row (T_0, ..., T_order, y) for each point."""
    x = np.asarray(seconds, float) / (SECONDS_PER_DAY / 2) - 1.0
    return np.column_stack([np.polynomial.chebyshev.chebvander(x, order), np.asarray(y, float)])


def points(by_time: DataFrame, keys: Sequence[str], **marks: Column) -> DataFrame:
    """(keys, points): the points of every group in time order, with further columns ``marks``.

    A group has one point a minute, 1440 at most.
    """
    marked = by_time.select(*keys, "departure_seconds", "mean", *[c.alias(name) for name, c in marks.items()])
    point = F.struct("departure_seconds", "mean", *marks)
    return marked.groupBy(*keys).agg(F.sort_array(F.collect_list(point)).alias("points"))


def rows_of(found: Sequence[dict], order: int) -> np.ndarray:
    """The design of a group's points."""
    return design([p["departure_seconds"] for p in found], [p["mean"] for p in found], order)


def solve(n: int, r: np.ndarray, order: int) -> np.ndarray:
    """Coefficients of the polynomial of an order up to that of the factor ``r`` of ``n`` points.

    With too few points for the order, the highest order they determine is fitted and the remaining
    coefficients are 0.
    """
    k = min(order, n - 1)
    c = np.linalg.lstsq(r[: k + 1, : k + 1], r[: k + 1, -1], rcond=1e-14)[0]
    return np.pad(c, (0, order - k))


def squared_error(c: np.ndarray, r: np.ndarray) -> float:
    """Sum of squared errors of coefficients ``c`` on the points of a factor."""
    return float(((r[:, : len(c)] * c).sum(axis=1) - r[:, -1]) ** 2 @ np.ones(len(r)))


def power_coefficients(c: np.ndarray) -> np.ndarray:
    """Chebyshev coefficients over scaled time as powers of the fraction of the day."""
    scaled = np.polynomial.chebyshev.cheb2poly(c)
    shifted = np.polynomial.polynomial.Polynomial(scaled)(np.polynomial.polynomial.Polynomial([-1.0, 2.0]))
    return np.pad(shifted.coef, (0, max(0, len(c) - len(shifted.coef))))


def per_group(
    sums: DataFrame, keys: Sequence[str], schema: str, solve_row: Callable[[dict], list[dict]]
) -> DataFrame:
    """Apply ``solve_row`` to each row of sums, in Arrow batches, keeping the partitioning as it is."""
    key_schema = ", ".join(f"{c} {t}" for c, t in sums.dtypes if c in keys)
    columns = [part.split()[0] for part in f"{key_schema}, {schema}".split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [
                {**{k: record[k] for k in keys}, **result}
                for record in batch.to_dict("records")
                for result in solve_row(record)
            ]
            yield pd.DataFrame(out, columns=columns)

    return sums.mapInPandas(run, f"{key_schema}, {schema}")
