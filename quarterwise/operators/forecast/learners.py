"""Pooled regressors over the whole panel: one model per target and fold, not per company.

Values are standardised per series, so companies of any size share one model. The training rows are
one table, partitioned by target and fold, so a fit reads its own rows only. Forests train in Spark
ML, the support vector machine by sums over partitions. All learners of a target and fold then
predict in one pass: each is a column of the same rows. Boosting works on blocks of series, see
`boosting`.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle, inheritable_thread_target
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterwise.operators.forecast.accuracy import array_deviation, deviation, error_sums, error_totals
from quarterwise.operators.forecast.boosting import LAGS, SEED, BoostedLearner
from quarterwise.operators.forecast.closed_form import model_struct
from quarterwise.sources.durable import durable, staged_table

# Executors need not have this package installed: its task functions travel by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FEATURES = (
    "lag1", "lag2", "lag3", "lag4", "trail_mean", "trail_std", "season_sin", "season_cos", "time_index",
)
KEYS = ("company_id", "last_date", "target", "fold")
PARALLEL_FITS = 8
#: Training rows of a partition: a fit passes over them hundreds of times, so tasks should not be tiny.
FIT_ROWS = 250_000


def feature_columns(t: str, recent: str = "recent") -> list[str]:
    """Feature expressions of the row at index ``t``; ``recent`` holds the values before it."""
    values = [f"{recent}[{i}]" for i in range(LAGS)]
    mean = f"(({' + '.join(values)}) / {LAGS})"
    squares = " + ".join(f"({v} - {mean}) * ({v} - {mean})" for v in values)
    angle = f"({2 * math.pi!r}D * ({t} % 4) / 4)"
    lags = [f"{values[LAGS - k]} AS lag{k}" for k in range(1, LAGS + 1)]
    return [
        *lags,
        f"{mean} AS trail_mean",
        f"sqrt(({squares}) / {LAGS}) + 1e-9D / scale AS trail_std",
        f"sin({angle}) AS season_sin",
        f"cos({angle}) AS season_cos",
        f"cast({t} AS double) / n AS time_index",
    ]


def standardised_folds(folds: DataFrame) -> DataFrame:
    """Adds the training mean and std of each fold (1 for a constant series) and z values."""
    return (
        folds.withColumn("center", F.expr("aggregate(ys, 0D, (acc, y) -> acc + y) / n"))
        .withColumn("scale", F.expr(f"coalesce(nullif({array_deviation('ys', 'center', 'n')}, 0D), 1D)"))
        .withColumn("zs", F.expr("transform(ys, y -> (y - center) / scale)"))
    )


def training_rows(folds: DataFrame) -> DataFrame:
    """Long panel: one row per series, fold and index from the fifth value on."""
    point = f"struct(t AS t, slice(zs, t - {LAGS - 1}, {LAGS}) AS recent, zs[t] AS label, ys[t] AS y)"
    points = f"inline(transform(sequence({LAGS}, n - 1), t -> {point}))"
    kept = (*KEYS, "n", "center", "scale")
    long = folds.selectExpr(*kept, points)
    return long.selectExpr(*kept, "t", "label", "y", *feature_columns("t"))


@dataclass
class Learner:
    """A Spark ML regressor, made once a session is there, and its label."""

    label: str
    make: Callable[[], object]
    inputs: Sequence[str] = FEATURES

    def vectors(self, df: DataFrame) -> DataFrame:
        return VectorAssembler(inputCols=list(self.inputs), outputCol="features").transform(df)

    def fit(self, rows: DataFrame):
        return self.make().fit(self.vectors(rows))

    def predict(self, model, rows: DataFrame, out: str = "z_hat") -> DataFrame:
        return model.transform(self.vectors(rows)).withColumnRenamed("prediction", out).drop("features")


@dataclass(frozen=True)
class KernelModel:
    """Inputs are scaled by (mean, deviation); the value is the bias and a weighted sum of kernels at the landmarks."""

    scaling: list[tuple[float, float]]
    landmarks: np.ndarray
    weights: np.ndarray
    bias: float

    def kernels(self, inputs: np.ndarray) -> np.ndarray:
        """Radial basis kernel between rows and landmarks; the width is the number of inputs, whose variance is 1."""
        mean, deviation = np.array(self.scaling).T
        x = (inputs - mean) / deviation
        distance = (x * x).sum(1)[:, None] + (self.landmarks * self.landmarks).sum(1) - 2 * x @ self.landmarks.T
        return np.exp(-np.maximum(distance, 0.0) / x.shape[1])

    def value(self, inputs: np.ndarray) -> np.ndarray:
        return self.kernels(inputs) @ self.weights + self.bias


@dataclass
class KernelLearner(Learner):
    """Support vector regression: radial basis kernel, epsilon-insensitive loss, on landmarks of the data.

    The landmarks are the training rows with the lowest hashes, so they follow the data and depend on
    no partitioning; functions are sums of kernels at them (Nystroem). The loss max(0, |e| - epsilon) is
    bounded above by weighted squares that touch it at the last errors, so each round is a weighted
    least squares fit whose normal equations are sums over partitions, and never makes the loss worse.
    """

    size: int = 64
    cost: float = 100.0
    epsilon: float = 0.1
    rounds: int = 12

    def fit(self, rows: DataFrame) -> KernelModel:
        moments = rows.agg(*[f(c).alias(f"{f.__name__}_{c}") for c in self.inputs for f in (F.avg, F.stddev_pop)]).first()
        scaling = [(moments[f"avg_{c}"] or 0.0, moments[f"stddev_pop_{c}"] or 1.0) for c in self.inputs]
        place = F.xxhash64(*[k for k in (*KEYS, "t") if k in rows.columns], *self.inputs)
        first = rows.orderBy(place, *self.inputs).select(*self.inputs).limit(self.size)
        mean, deviation = np.array(scaling).T
        landmarks = (np.array([list(r) for r in first.collect()], float).reshape(-1, len(self.inputs)) - mean) / deviation
        model = KernelModel(scaling, landmarks, np.zeros(len(landmarks)), 0.0)
        # penalising the function's norm is penalising plain weights after this change of basis
        size, vectors = np.linalg.eigh(model.kernels(landmarks * deviation + mean))
        kept = size > 1e-8 * size.max()
        basis = vectors[:, kept] / np.sqrt(size[kept])
        width = basis.shape[1] + 1
        penalty = np.diag([1.0] * (width - 1) + [1e-9])
        for _ in range(self.rounds):
            sums = self.sums(rows, model, basis)
            left, right = sums[: width * width].reshape(width, width), sums[width * width :]
            solved = np.linalg.solve(left + penalty, right)
            model = KernelModel(scaling, landmarks, basis @ solved[:-1], float(solved[-1]))
        return model

    def sums(self, rows: DataFrame, model: KernelModel, basis: np.ndarray) -> np.ndarray:
        """Normal equations of the next round: one pass, added up by position, the driver gets the sums."""
        inputs, cost, epsilon = list(self.inputs), self.cost, self.epsilon

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((basis.shape[1] + 1) * (basis.shape[1] + 2))
            for batch in batches:
                x = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in inputs]).reshape(batch.num_rows, -1)
                y = batch.column("label").to_numpy(zero_copy_only=False)
                miss = y - model.value(x)
                above, below = (cost / (2 * np.maximum(np.abs(miss + side), 1e-3)) for side in (-epsilon, epsilon))
                weight = above + below
                target = y + epsilon * (below - above) / weight
                phi = np.column_stack([model.kernels(x) @ basis, np.ones(len(x))])
                left = phi.T @ (phi * weight[:, None])
                total += np.concatenate([left.ravel(), phi.T @ (weight * target)])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["at", "part"])

        parts = rows.select(*inputs, "label").mapInArrow(partial, "at long, part double")
        added = parts.groupBy("at").agg(F.sum("part").alias("part")).toPandas()
        return added.sort_values("at")["part"].to_numpy()

    def predict(self, model: KernelModel, rows: DataFrame, out: str = "z_hat") -> DataFrame:
        def kernel(x: pd.DataFrame) -> pd.Series:
            return pd.Series(model.value(x.to_numpy(float)))

        return rows.withColumn(out, F.pandas_udf(kernel, "double")(F.struct(*self.inputs)))


def random_forest(trees: int = 200, depth: int = 4) -> Learner:
    def make():
        return RandomForestRegressor(
            numTrees=trees, maxDepth=depth, minInstancesPerNode=2, featureSubsetStrategy="sqrt", seed=SEED
        )

    return Learner(f"RandomForest(n={trees},depth={depth})", make)


def gradient_boosting(rounds: int = 300, rate: float = 0.05) -> BoostedLearner:
    return BoostedLearner(f"GradientBoosting(n={rounds},lr={rate})", rounds, rate)


def kernel_regression(size: int = 64, cost: float = 100.0) -> KernelLearner:
    return KernelLearner(f"SVR(RBF,C={cost:g})", lambda: None, size=size, cost=cost)


LEARNERS: dict[str, Learner | BoostedLearner] = {
    "random_forest": random_forest(),
    "gradient_boosting": gradient_boosting(),
    "svr": kernel_regression(),
}


Fitted = dict[str, tuple[Learner, object]]


def recursive_forecasts(fitted: Fitted, folds: DataFrame, horizon: int) -> DataFrame:
    """The keys and a column forecast_<name> for each learner.

    Each prediction becomes the newest of the four values the next one sees. All series and learners
    advance together: no shuffle, no loop over series. The generator of each step materialises the
    new state; as a plain projection it would be inlined into the next step, several times
    over, and the predictions with it.
    """
    carried = (*KEYS, "n", "center", "scale", "actual")
    state = folds.selectExpr(
        *carried,
        *[f"slice(zs, -{LAGS}, {LAGS}) AS recent_{m}" for m in fitted],
        *[f"cast(array() AS array<double>) AS path_{m}" for m in fitted],
    )
    moved = ", ".join(
        f"concat(slice(recent_{m}, 2, {LAGS - 1}), array(hat_{m})) AS recent_{m}, concat(path_{m}, array(hat_{m})) AS path_{m}" for m in fitted
    )
    for step in range(horizon):
        for m, (learner, model) in fitted.items():
            state = learner.predict(model, state.selectExpr("*", *feature_columns(f"(n + {step})", f"recent_{m}")), f"hat_{m}").drop(*FEATURES)
        state = state.selectExpr(*carried, f"inline(array(struct({moved})))")
    return state.selectExpr(*KEYS, "actual", *[f"transform(path_{m}, z -> z * scale + center) AS forecast_{m}" for m in fitted])


def in_sample(fitted: Fitted, rows: DataFrame, paths: bool) -> DataFrame:
    """The keys and, for each learner, error sums sums_<name> and the fitted path path_<name> of every series."""
    for m, (learner, model) in fitted.items():
        rows = learner.predict(model, rows, f"hat_{m}")
    pairs = rows.selectExpr(*KEYS, "t", "y", *[f"hat_{m} * scale + center AS hat_{m}" for m in fitted])
    sums = [f"{error_totals('y', f'hat_{m}')} AS sums_{m}" for m in fitted]
    listed = [f"sort_array(collect_list(struct(t, hat_{m}))).hat_{m} AS path_{m}" for m in fitted if paths]
    return pairs.groupBy(*KEYS).agg(*map(F.expr, [*sums, *listed]))


def add_learner_models(
    folds: DataFrame, horizon: int, learners: dict[str, Learner | BoostedLearner], positions: dict[str, int], fitted: bool = False
) -> DataFrame:
    """Model-layout rows of the pooled learners; the folds are written to the checkpoint folder once."""
    staged = durable(standardised_folds(folds))
    parts = []
    pooled = {m: f for m, f in learners.items() if isinstance(f, Learner)}
    if pooled:
        parts.append(_pooled_models(staged, horizon, pooled, positions, fitted))
    for m, f in learners.items():
        if isinstance(f, BoostedLearner):
            parts.append(_boosted_models(staged, horizon, f, m, positions[m], fitted))
    return reduce(DataFrame.unionByName, parts)


def _layout(name: str, position: int, label: str, forecast: str, sums: str, path: str | None) -> str:
    shown = path and f"concat(array_repeat(cast(NULL AS double), {LAGS}), {path})"
    return model_struct(name, position, label, forecast, deviation(f"{sums}.e", f"{sums}.sq", f"{sums}.n"), sums, shown)


def _boosted_models(staged: DataFrame, horizon: int, learner: BoostedLearner, name: str, position: int, fitted: bool) -> DataFrame:
    found = staged.select(*KEYS, "actual", "ys").join(learner.forecasts(staged, horizon), list(KEYS))
    pairs = f"zip_with(slice(ys, {LAGS + 1}, size(path)), path, (a, f) -> struct(a AS actual, f AS fitted))"
    found = found.selectExpr(*KEYS, "actual", f"inline(array(struct(forecast, path, {error_sums(pairs)} AS sums)))")
    return found.select(*KEYS, "actual", F.expr(f"inline(array({_layout(name, position, learner.label, 'forecast', 'sums', fitted and 'path' or None)}))"))


def _pooled_models(staged: DataFrame, horizon: int, learners: dict[str, Learner], positions: dict[str, int], fitted: bool) -> DataFrame:
    """Rows of the learners that have one model per target and fold.

    The training rows are written once, too: a fit runs many small jobs, and each would otherwise ship
    the whole upstream plan to its tasks. They are sorted inside their files, so a fit with a
    fixed seed sees them in the same order every time. The driver gets the number of rows of each
    target and fold, four at most, to size the partitions of a fit.
    """
    laid_out = training_rows(staged).repartition("company_id").sortWithinPartitions("company_id", "target", "fold", "t")
    rows = staged_table(laid_out, "target", "fold")
    sizes = {(r["target"], r["fold"]): r["count"] for r in rows.groupBy("target", "fold").count().collect()}

    def own(df: DataFrame, group: tuple[str, str]) -> DataFrame:
        return df.where((F.col("target") == group[0]) & (F.col("fold") == group[1]))

    def fit(job: tuple[tuple[str, str], str]) -> object:
        group, name = job
        return learners[name].fit(own(rows, group).coalesce(max(1, math.ceil(sizes[group] / FIT_ROWS))))

    jobs = [(group, m) for m in learners for group in sorted(sizes)]
    with ThreadPoolExecutor(PARALLEL_FITS) as pool:
        models = dict(zip(jobs, pool.map(inheritable_thread_target(staged.sparkSession)(fit), jobs)))

    ahead, behind = [], []
    for group in sorted(sizes):
        ready = {m: (learners[m], models[group, m]) for m in learners}
        ahead.append(recursive_forecasts(ready, own(staged, group), horizon))
        behind.append(in_sample(ready, own(rows, group), fitted))
    joined = reduce(DataFrame.unionByName, ahead).join(reduce(DataFrame.unionByName, behind), list(KEYS))
    results = [_layout(m, positions[m], f.label, f"forecast_{m}", f"sums_{m}", f"path_{m}" if fitted else None) for m, f in learners.items()]
    return joined.select(*KEYS, "actual", F.expr(f"inline(array({', '.join(results)}))"))
