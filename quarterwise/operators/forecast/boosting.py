"""Gradient boosting of blocks of series: one model for some hundred series of a target and fold.

Boosting is hundreds of rounds, each of which needs the one before. As Spark jobs over the whole panel
the rounds wait for the scheduler far longer than they compute, so here Spark deals the series
into blocks of a bounded number and a task runs all rounds of its block. Work and memory of a task do not
grow with the panel, blocks do not wait for each other, and nothing passes through the driver.
"""

from __future__ import annotations

import math
import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterwise.sources.durable import dealt_by

# Executors need not have this package installed: its task functions travel by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

LAGS = 4
SEED = 42
_RESULT = "company_id long, last_date date, target string, fold string, forecast array<double>, path array<double>"


def inputs_at(recent: np.ndarray, t: np.ndarray, n: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """The nine inputs of rows whose last four values are `recent`, oldest first, at index t of a series of n."""
    angle = 2 * math.pi * (t % 4) / 4
    spread = recent.std(axis=1) + 1e-9 / scale
    return np.column_stack([recent[:, ::-1], recent.mean(axis=1), spread, np.sin(angle), np.cos(angle), t / n])


def best_splits(binned: np.ndarray, residual: np.ndarray, node: np.ndarray, nodes: int, bins: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(feature, last bin on the left) of the split of each node that lowers the squared error most; feature -1 where none does."""
    features = binned.shape[1]
    place = ((node[:, None] * features + np.arange(features)) * bins + binned).ravel()
    shape = (nodes, features, bins)
    count = np.bincount(place, minlength=nodes * features * bins).reshape(shape).cumsum(2)
    total = np.bincount(place, np.repeat(residual, features), nodes * features * bins).reshape(shape).cumsum(2)
    right_count, right_total = count[:, :, -1:] - count, total[:, :, -1:] - total
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = total**2 / count + right_total**2 / right_count - total[:, :, -1:] ** 2 / count[:, :, -1:]
    gain = np.where((count >= least) & (right_count >= least), gain, -1.0).reshape(nodes, -1)
    best = gain.argmax(axis=1)
    useful = gain[np.arange(nodes), best] > 1e-12
    return np.where(useful, best // bins, -1), best % bins


@dataclass(frozen=True)
class Boosted:
    """Trees in heap order: split feature (-1: a leaf), threshold, and the leaf's value, one row a tree."""

    start: float
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def predict(self, x: np.ndarray) -> np.ndarray:
        trees = np.arange(len(self.feature))
        node = np.zeros((len(x), len(trees)), np.int64)
        while True:
            feature = self.feature[trees, node]
            if (feature < 0).all():
                return self.start + self.value[trees, node].sum(axis=1)
            right = np.take_along_axis(x, np.maximum(feature, 0), axis=1) > self.threshold[trees, node]
            node = np.where(feature >= 0, 2 * node + 1 + right, node)


@dataclass
class BoostedLearner:
    """Squared loss, trees of a fixed depth on binned inputs, each grown on a drawn share of the block's rows."""

    label: str
    rounds: int = 300
    rate: float = 0.05
    depth: int = 3
    share: float = 0.8
    bins: int = 64
    least: int = 2
    #: Series of a block, about.
    series: int = 250

    def fit(self, x: np.ndarray, y: np.ndarray, seed: list[int]) -> tuple[Boosted, np.ndarray]:
        """The model of one block, and its values at the block's rows."""
        rng = np.random.default_rng(seed)
        cuts = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins + 1)[1:-1])) for c in x.T]
        binned = np.column_stack([np.searchsorted(k, c, "left") for k, c in zip(cuts, x.T)])
        slots = 2 ** (self.depth + 1) - 1
        feature = np.full((self.rounds, slots), -1)
        threshold, value = np.zeros((self.rounds, slots)), np.zeros((self.rounds, slots))
        fitted = np.full(len(y), y.mean())
        for k in range(self.rounds):
            drawn = rng.random(len(y)) < self.share
            residual = y - fitted
            node = np.zeros(len(y), np.int64)
            for level in range(self.depth):
                first = 2**level - 1
                here = node >= first
                grow = here & drawn
                split, last = best_splits(binned[grow], residual[grow], node[grow] - first, first + 1, self.bins, self.least)
                feature[k, first : 2 * first + 1] = split
                for i in np.flatnonzero(split >= 0):
                    threshold[k, first + i] = cuts[split[i]][last[i]]
                at = node[here] - first
                moved = split[at] >= 0
                right = binned[here, np.maximum(split[at], 0)] > last[at]
                node[here] = np.where(moved, 2 * node[here] + 1 + right, node[here])
            sums, counts = np.bincount(node[drawn], residual[drawn], slots), np.bincount(node[drawn], minlength=slots)
            value[k] = self.rate * sums / np.maximum(counts, 1)
            fitted += value[k][node]
        return Boosted(float(y.mean()), feature, threshold, value), fitted

    def forecasts(self, staged: DataFrame, horizon: int) -> DataFrame:
        """(keys, forecast, path) of every series, in its own units: `path` holds the fitted values from the fifth on."""
        counts = staged.groupBy("target", "fold").agg(F.ceil(F.count(F.lit(1)) / self.series).alias("blocks"))
        rows = staged.join(counts, ["target", "fold"]).withColumn("block", F.pmod(F.xxhash64("company_id"), F.col("blocks")))
        by = ["target", "fold", "block"]
        kept = rows.select("company_id", "last_date", *by, "n", "center", "scale", "zs")
        return dealt_by(kept, *by).groupBy(*by).applyInArrow(_of_block(self, horizon), _RESULT)


def _of_block(learner: BoostedLearner, horizon: int):
    def run(block: pa.Table) -> pa.Table:
        block = block.sort_by("company_id").combine_chunks()
        n, center, scale = (block[c].to_numpy().astype(float) for c in ("n", "center", "scale"))
        series = [z.values.to_numpy() if hasattr(z, "values") else np.array(z.as_py()) for z in block["zs"]]
        owner = np.repeat(np.arange(len(series)), [len(z) - LAGS for z in series])
        t = np.concatenate([np.arange(LAGS, len(z)) for z in series])
        recent = np.concatenate([np.lib.stride_tricks.sliding_window_view(z, LAGS)[:-1] for z in series])
        y = np.concatenate([z[LAGS:] for z in series])
        model, fitted = learner.fit(inputs_at(recent, t, n[owner], scale[owner]), y, [SEED, block["block"][0].as_py()])
        state, ahead = np.array([z[-LAGS:] for z in series]), []
        for step in range(horizon):
            ahead.append(model.predict(inputs_at(state, n + step, n, scale)))
            state = np.column_stack([state[:, 1:], ahead[-1]])
        forecast = np.column_stack(ahead) * scale[:, None] + center[:, None]
        ends = np.concatenate([[0], np.cumsum([len(z) - LAGS for z in series])]).astype(np.int32)
        path = pa.ListArray.from_arrays(pa.array(ends), pa.array(fitted * scale[owner] + center[owner]))
        return block.select(["company_id", "last_date", "target", "fold"]).append_column("forecast", pa.array(list(forecast))).append_column("path", path)

    return run
