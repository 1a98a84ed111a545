"""Delay models: mean delay by time of day, per airport, over all airports, and by route times.

The reduction from flights to mean delays is one grouped aggregation. Models of single airports are
fitted for all airline and airport pairs at once (``tarmac.plans.fitting``); models over all airports
use Spark ML pipelines.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import combinations_with_replacement

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Interaction, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.functions import kpi
from tarmac.plans import eda, fitting, ridge

EXTREME_MINUTES = 60
LARGE_ERROR_MINUTES = 15


# --- reduction -------------------------------------------------------------------------------------


def time_split(flights: DataFrame, cutoff: str = "2015-01-23") -> tuple[DataFrame, DataFrame]:
    """Flights before and after the cut-off day; the day itself is in neither."""
    day = F.lit(cutoff).cast("date")
    return flights.filter(F.col("flight_date") < day), flights.filter(F.col("flight_date") > day)


def split_summary(flights: DataFrame, cutoff: str = "2015-01-23") -> DataFrame:
    train, test = time_split(flights, cutoff)
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return both.groupBy("part", "airline").agg(
        F.count(F.lit(1)).alias("flights"),
        F.min("flight_date").alias("first_date"),
        F.max("flight_date").alias("last_date"),
        F.avg("delay").alias("mean_delay"),
    )


def without_extremes(flights: DataFrame, limit: int = EXTREME_MINUTES) -> DataFrame:
    return flights.filter(F.col("delay") < limit)


def mean_delay_by_time(flights: DataFrame, remove_extremes: bool = False) -> DataFrame:
    """Delay statistics per airline, origin and scheduled second of the day."""
    kept = without_extremes(flights) if remove_extremes else flights
    return kept.groupBy("airline", "origin", "departure_seconds").agg(*eda.stats("delay"))


def merged_delays(flights: DataFrame) -> DataFrame:
    """Mean delays below one hour of every airline and origin, in one aggregation."""
    return (
        mean_delay_by_time(flights, remove_extremes=True)
        .select("airline", F.col("origin").alias("airport_id"), "departure_seconds", "mean")
        .dropna()
    )


def hash_split(
    df: DataFrame, identity: Sequence[str], train_tenths: int = 7, seed: int = 0
) -> tuple[DataFrame, DataFrame]:
    """Random train and test parts that depend only on the row's identity and the seed.

    Unlike a sampled split it does not change when a lost partition is computed again.
    """
    return df.filter(_bucket(identity, F.lit(seed)) < train_tenths), df.filter(
        _bucket(identity, F.lit(seed)) >= train_tenths
    )


def _bucket(identity: Sequence[str], seed: Column) -> Column:
    text = F.concat_ws("|", seed.cast("string"), *[F.col(c).cast("string") for c in identity])
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint"), F.lit(10))


# --- one airline, one airport ------------------------------------------------------------------------


def _line(prefix: str = "") -> list[Column]:
    """Least-squares line of the mean delay over hours; a single point gives a flat line."""
    hours, y = F.col("departure_seconds") / 3600.0, F.col("mean")
    slope = F.coalesce(F.regr_slope(y, hours), F.lit(0.0))
    intercept = F.coalesce(F.regr_intercept(y, hours), F.avg(y))
    return [
        F.count(y).alias(f"{prefix}points"),
        slope.alias(f"{prefix}slope"),
        intercept.alias(f"{prefix}intercept"),
    ]


def linear_fit(by_time: DataFrame) -> DataFrame:
    return by_time.groupBy("airline", "origin").agg(*_line())


def outlier_effect(flights: DataFrame) -> DataFrame:
    """The line of every airport with and without delays of an hour and more."""
    with_all = mean_delay_by_time(flights).groupBy("airline", "origin").agg(*_line("all_"))
    trimmed = mean_delay_by_time(flights, True).groupBy("airline", "origin").agg(*_line("trimmed_"))

    def at_noon(prefix: str) -> Column:
        return F.col(f"{prefix}intercept") + F.col(f"{prefix}slope") * 12

    return with_all.join(trimmed, ["airline", "origin"]).withColumn(
        "noon_difference", at_noon("all_") - at_noon("trimmed_")
    )


PAIR = ["airline", "origin"]


def poly_fit(by_time: DataFrame, order: int = 2, method: str = "all", seed: int = 0) -> DataFrame:
    """Polynomial of the mean delay over the fraction of the day, per airline and airport.

    ``method`` 'all' trains and tests on all points; 'split' trains on 70 % and tests on the rest.
    """
    train = F.lit(True) if method == "all" else _bucket([*PAIR, "departure_seconds"], F.lit(seed)) < 7

    def fit(row: dict) -> list[dict]:
        design = fitting.rows_of(row["points"], order)
        chosen = np.array([p["train"] for p in row["points"]])
        if not chosen.any():
            return []
        tested = design if method == "all" else design[~chosen]
        c = fitting.solve(int(chosen.sum()), fitting.factor(design[chosen]), order)
        return [
            {
                "train_points": int(chosen.sum()),
                "test_points": len(tested),
                "coefficients": fitting.power_coefficients(c).tolist(),
                "mse": fitting.squared_error(c, fitting.factor(tested)) / len(tested) if len(tested) else None,
            }
        ]

    schema = "train_points bigint, test_points bigint, coefficients array<double>, mse double"
    return fitting.per_group(fitting.points(by_time, PAIR, train=train), PAIR, schema, fit)


def predict_poly(by_time: DataFrame, fits: DataFrame) -> DataFrame:
    """Add the prediction of the pair's polynomial; pairs without a fit get none."""
    x = F.col("departure_seconds") / fitting.SECONDS_PER_DAY
    value = F.aggregate(F.reverse("coefficients"), F.lit(0.0), lambda acc, c: acc * x + c)
    joined = by_time.join(fits.select(*PAIR, "coefficients"), PAIR)
    return joined.withColumn("prediction", value).drop("coefficients")


def with_fold(by_time: DataFrame, folds: int) -> DataFrame:
    """Contiguous folds in time order; a pair has at most 1440 points, one per minute."""
    in_order = Window.partitionBy(*PAIR).orderBy("departure_seconds")
    return by_time.withColumn("fold", F.ntile(folds).over(in_order))


def poly_cv(by_time: DataFrame, max_order: int = 7, folds: int = 10) -> DataFrame:
    """Mean test error of contiguous k-fold cross-validation for orders 1..max_order, per pair.

    Every fold is reduced to its triangular factor once; the training factor of a fold is merged from those of the
    other folds. Pairs with fewer points than folds are left out.
    """
    pairs = fitting.points(with_fold(by_time, folds), PAIR, fold=F.col("fold"))

    def validate(row: dict) -> list[dict]:
        design = fitting.rows_of(row["points"], max_order)
        design[:, -1] -= design[0, -1]  # errors are the same at any level, and keep their digits near 0
        fold = np.array([p["fold"] for p in row["points"]])
        if len(fold) < folds:
            return []
        parts = [fitting.factor(design[fold == f]) for f in range(1, folds + 1)]
        errors = np.zeros((max_order, folds))
        for held, (r, n) in enumerate(zip(parts, np.bincount(fold)[1:])):
            others = fitting.factor(np.concatenate([x for i, x in enumerate(parts) if i != held]))
            for order in range(1, max_order + 1):
                c = fitting.solve(len(fold) - n, others, order)
                errors[order - 1, held] = fitting.squared_error(c, r) / n
        return [
            {"polynomial_order": order, "points": len(fold), "mse": float(errors[order - 1].mean())}
            for order in range(1, max_order + 1)
        ]

    return fitting.per_group(pairs, PAIR, "polynomial_order int, points bigint, mse double", validate)


def split_bias(by_time: DataFrame, splits: int = 40, max_order: int = 3) -> DataFrame:
    """For each random split the best order and its error, per airline and airport.

    Every point takes part in all splits, as training or test point, and carries its part in each of them.
    """
    train = F.transform(
        F.sequence(F.lit(1), F.lit(splits)), lambda split: _bucket([*PAIR, "departure_seconds"], split) < 7
    )

    def choose(row: dict) -> list[dict]:
        design = fitting.rows_of(row["points"], max_order)
        chosen = np.array([list(p["train"]) for p in row["points"]])
        found = []
        for split in range(splits):
            part = chosen[:, split]
            if part.all() or not part.any():
                continue
            r, tested = fitting.factor(design[part]), fitting.factor(design[~part])
            errors = [
                fitting.squared_error(fitting.solve(int(part.sum()), r, k), tested) / int((~part).sum())
                for k in range(1, max_order + 1)
            ]
            best = int(np.argmin(errors))
            found.append(
                {"split": split + 1, "best_order": best + 1, "best_mse": errors[best], "mse_by_order": errors}
            )
        return found

    schema = "split int, best_order int, best_mse double, mse_by_order array<double>"
    return fitting.per_group(fitting.points(by_time, PAIR, train=train), PAIR, schema, choose)


def eval_holdout(flights: DataFrame, cutoff: str = "2015-01-23", order: int = 2) -> DataFrame:
    """Error of the fitted polynomials on the period after the cut-off, per airline and airport."""
    train, test = time_split(flights, cutoff)
    fits = poly_fit(mean_delay_by_time(train, True), order)
    scored = predict_poly(mean_delay_by_time(test, True), fits)
    error = F.avg(F.pow(F.col("prediction") - F.col("mean"), F.lit(2.0)))
    return (
        scored.groupBy(*PAIR)
        .agg(F.count(F.lit(1)).alias("points"), error.alias("mse"))
        .withColumn("rmse_minutes", F.sqrt("mse"))
    )


# --- one airline, all airports -----------------------------------------------------------------------


def airport_index(merged: DataFrame) -> DataFrame:
    """(airport_id, airport_index): labels numbered alphabetically from 0."""
    indexer = StringIndexer(inputCol="airport_id", outputCol="airport_index", stringOrderType="alphabetAsc")
    labels = indexer.fit(merged).transform(merged)
    return labels.select("airport_id", F.col("airport_index").cast("int")).distinct()


def _scaled(df: DataFrame, times: Sequence[str]) -> DataFrame:
    """Times as fractions of the day, and their pairwise products."""
    fraction = {c: F.col(c) / fitting.SECONDS_PER_DAY for c in times}
    pairs = combinations_with_replacement(times, 2)
    return df.withColumns({f"_{c}": x for c, x in fraction.items()}).withColumns(
        {f"_{a}*{b}": F.col(f"_{a}") * F.col(f"_{b}") for a, b in pairs}
    )


def one_hot_stages(times: Sequence[str], order: int, regularised: bool) -> list:
    """Alphabetic index, one-hot airport and the feature vector of a degree 1 or 2 polynomial.

    Airports unseen in training are all zeros in the one-hot part. Of the degree 2 expansion, products
    of two different one-hot columns are always 0 and are left out; the square of a one-hot column is
    the column itself, and a ridge penalty sees it as a second copy, so the regularised vector holds
    the one-hot part twice. A plain fit gets a basis of the same space without repetitions, and no
    intercept, because the one-hot columns already sum to it.
    """
    if order not in (1, 2):
        raise ValueError("order must be 1 or 2")
    indexer = StringIndexer(
        inputCol="airport_id", outputCol="_index", stringOrderType="alphabetAsc", handleInvalid="keep"
    )
    # 'keep' adds one index for unseen labels; dropping the last category turns it into zeros.
    encoder = OneHotEncoder(inputCols=["_index"], outputCols=["_airport"], dropLast=True)
    linear = [f"_{c}" for c in times]
    if order == 1:
        assembler = VectorAssembler(inputCols=["_airport", *linear], outputCol="features")
        return [indexer, encoder, assembler]
    products = [f"_{a}*{b}" for a, b in combinations_with_replacement(times, 2)]
    crossed = [Interaction(inputCols=["_airport", c], outputCol=f"_airport{c}") for c in linear]
    again = VectorAssembler(inputCols=["_airport"], outputCol="_airport_squared")
    parts = ["_airport", "_airport_squared", *linear] if regularised else ["_airport"]
    parts += [c.getOutputCol() for c in crossed] + products
    return [indexer, encoder, again, *crossed, VectorAssembler(inputCols=parts, outputCol="features")]


def _regression(label_std: float, alpha: float) -> LinearRegression:
    """Plain least squares for alpha 0, else ridge on centred columns of unit length.

    Spark standardises columns to unit deviation and averages the loss, so penalty ``alpha`` on unit
    columns is ``alpha`` times the deviation of the label here.
    """
    return LinearRegression(
        featuresCol="features",
        labelCol="mean",
        predictionCol="prediction",
        elasticNetParam=0.0,
        regParam=alpha * label_std,
        fitIntercept=alpha > 0,
        standardization=True,
        solver="auto",  # normal equations up to 4096 features, else L-BFGS on the same objective
    )


@dataclass(frozen=True)
class DelayModel:
    """A fitted regression of mean delays on one-hot airport and times."""

    pipeline: PipelineModel
    times: tuple[str, ...]
    order: int
    alpha: float

    @property
    def airports(self) -> list[str]:
        return list(self.pipeline.stages[0].labels)

    def _average_airport(self) -> Column:
        """What a plain fit without intercept predicts for an average airport beyond the time terms."""
        weights = self.pipeline.stages[-1].coefficients.toArray()
        k = len(self.airports)
        effect = F.lit(float(weights[:k].mean()))
        if self.order == 2:
            for position, name in enumerate(self.times, start=1):
                slope = float(weights[position * k : (position + 1) * k].mean())
                effect = effect + slope * F.col(f"_{name}")
        return effect

    def score(self, encoded: DataFrame) -> DataFrame:
        """Predictions for rows that already carry the feature vector."""
        scored = self.pipeline.stages[-1].transform(encoded)
        if self.alpha > 0:
            return scored
        unseen = F.col("_index") >= len(self.airports)
        shift = F.when(unseen, self._average_airport()).otherwise(0.0)
        return scored.withColumn("prediction", F.col("prediction") + shift)

    def predict(self, df: DataFrame) -> DataFrame:
        """Add ``prediction``; an airport unseen in training is treated as an average one."""
        encode = PipelineModel(self.pipeline.stages[:-1])
        return self.score(encode.transform(_scaled(df, self.times))).select(*df.columns, "prediction")


DEPARTURE = ("departure_seconds",)
DEPARTURE_ARRIVAL = ("departure_seconds", "arrival_seconds")


def fit_delays(
    train: DataFrame, times: Sequence[str] = DEPARTURE, order: int = 1, alpha: float = 0.0
) -> DelayModel:
    label_std = train.agg(F.stddev_pop("mean")).first()[0] or 0.0
    stages = [*one_hot_stages(times, order, alpha > 0), _regression(label_std, alpha)]
    return DelayModel(Pipeline(stages=stages).fit(_scaled(train, times)), tuple(times), order, alpha)


def one_hot(merged: DataFrame) -> DataFrame:
    """Airport index, seconds and the sparse one-hot feature vector of each row."""
    stages = one_hot_stages(DEPARTURE, 1, regularised=True)
    fitted = Pipeline(stages=stages).fit(_scaled(merged, DEPARTURE))
    encoded = fitted.transform(_scaled(merged, DEPARTURE))
    return encoded.select(
        "airport_id", "departure_seconds", "mean", F.col("_index").cast("int").alias("airport_index"), "features"
    )


def _squared_error() -> Column:
    return F.pow(F.col("prediction") - F.col("mean"), F.lit(2.0))


def mse(scored: DataFrame) -> DataFrame:
    return scored.agg(
        F.count(F.lit(1)).alias("points"),
        F.avg(_squared_error()).alias("mse"),
        F.sqrt(F.avg(_squared_error())).alias("rmse_minutes"),
    )


def large_error_share(scored: DataFrame, minutes: int = LARGE_ERROR_MINUTES) -> DataFrame:
    """Percentage of predictions that are off by more than ``minutes``."""
    off = F.abs(F.col("prediction") - F.col("mean")) > minutes
    return scored.agg(
        F.count(F.lit(1)).alias("points"),
        kpi.percent(F.count_if(off), F.count(F.lit(1)), 2).alias("large_error_pct"),
    )


def residual_terms(scored: DataFrame, at_least: float = 1e4) -> DataFrame:
    """Predictions whose squared error exceeds ``at_least``."""
    terms = scored.withColumn("squared_error", _squared_error())
    return terms.filter(F.col("squared_error") > at_least).select(
        "airport_id", "departure_seconds", "squared_error", "prediction", "mean"
    )


def predicted_vs_observed(scored: DataFrame) -> DataFrame:
    """Regression line and correlation of the prediction against the observation."""
    p, y = F.col("prediction"), F.col("mean")
    return scored.agg(
        F.count(F.lit(1)).alias("points"),
        F.regr_slope(p, y).alias("slope"),
        F.regr_intercept(p, y).alias("intercept"),
        F.corr(p, y).alias("correlation"),
    )


def split_merged(merged: DataFrame, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    identity = [c for c in merged.columns if c not in ("mean", "weekday")]
    return hash_split(merged, identity, 7, seed)


def split_eval(merged: DataFrame, order: int = 2, alpha: float = 0.0, seed: int = 0) -> DataFrame:
    """Training and test error of one 70/30 split."""
    train, test = split_merged(merged, seed)
    model = fit_delays(train, DEPARTURE, order, alpha)
    parts = [
        mse(model.predict(part)).withColumn("part", F.lit(name)) for name, part in (("train", train), ("test", test))
    ]
    return parts[0].unionByName(parts[1])


ALPHAS = [tenths / 10 for tenths in range(0, 20, 2)]


@dataclass(frozen=True)
class GridResult:
    """Test error of every order and penalty, and the best pair."""

    scores: list[tuple[int, float, float]]

    @property
    def best(self) -> tuple[int, float, float]:
        return min(self.scores, key=lambda score: score[2])

    def to_frame(self, spark) -> DataFrame:
        rows = [(*score, score == self.best) for score in self.scores]
        return spark.createDataFrame(rows, "polynomial_order int, alpha double, mse double, is_best boolean")


def grid_search(
    merged: DataFrame,
    times: Sequence[str] = DEPARTURE,
    orders: Sequence[int] = (1, 2),
    alphas: Sequence[float] = tuple(ALPHAS),
    seed: int = 0,
) -> GridResult:
    """Fit every order and penalty on 70 % of the rows and score it on the rest.

    All fits come from one aggregation of the training rows, all scores from one pass over the rest.
    """
    train, test = split_merged(merged, seed)
    return GridResult(sorted(ridge.fit(train, times, orders, alphas).scores(test)))


def refit_best(merged: DataFrame, grid: GridResult, times: Sequence[str] = DEPARTURE) -> ridge.Model:
    """The best order and penalty, fitted on all training rows."""
    order, alpha, _ = grid.best
    return fit_ridge(merged, times, order, alpha)


def fit_ridge(train: DataFrame, times: Sequence[str] = DEPARTURE, order: int = 1, alpha: float = 0.0) -> ridge.Model:
    """One order and penalty from the sums of each airport."""
    return ridge.fit(train, times, [order], [alpha]).model(order, float(alpha))


# --- departure and arrival times ---------------------------------------------------------------------


def dep_arr_features(flights: DataFrame, limit: int = EXTREME_MINUTES) -> DataFrame:
    """Mean delay and weekday (Monday 0) per airline, departure second, arrival second and origin."""
    return (
        without_extremes(flights, limit)
        .groupBy("airline", "departure_seconds", "arrival_seconds", F.col("origin").alias("airport_id"))
        .agg(F.avg("delay").alias("mean"), F.avg(F.weekday("flight_date")).alias("weekday"))
    )


def route_time_model(train: DataFrame, test: DataFrame) -> tuple[ridge.Model, GridResult, DataFrame]:
    """Ridge on one-hot origin, departure and arrival time; the errors on the later period."""
    grid = grid_search(train, DEPARTURE_ARRIVAL)
    model = refit_best(train, grid, DEPARTURE_ARRIVAL)
    return model, grid, model.predict(test)
