"""Isolation forest per company (Liu, Ting, Zhou 2008) as a Spark job.

Every draw is a hash: a tree's sample holds the rows with the lowest MD5 of company, tree and
date, a node's feature and threshold come from the MD5 of company, tree and node. Path lengths
are counted in whole millionths, so their sums do not depend on order. The same forest grows on
any partitioning, and in any engine that has MD5.

A company is dealt out in blocks of a bounded number of rows. Rows that may belong to a tree's
sample, found by their hash alone before any shuffle, go to every block of their company, which
grows the forest from them and scores its own rows. A company no longer than a sample is one
block in which every row is in every tree; that is the same rule, not another path. Trees
live in heap order (children of node i are 2i+1 and 2i+2), so numpy grows all trees of a block at once.
"""

from __future__ import annotations

import sys
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterwise.functions.quantiles import group_quantiles
from quarterwise.sources.durable import dealt_by, durable

FEATURES = ("revenue", "expenses", "profit", "operating_cost")
TREES = 100
SAMPLE = 256
CONTAMINATION = 0.08
MIN_ROWS = 6
#: Rows that a block scores, about.
BLOCK_ROWS = 4_096
#: Path lengths are counted in these parts of an edge.
UNIT = 1_000_000

# Executors need not have this package installed: its task functions travel by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_PATHS = "company_id long, date date, rows_n long, path long, " + ", ".join(f"{f} double" for f in FEATURES)
_EULER = 0.5772156649015329


def mean_depth(n: np.ndarray) -> np.ndarray:
    """Expected depth of an unsuccessful search among n points, c(n) of the paper, in units."""
    n = np.asarray(n, dtype=float)
    big = np.maximum(n, 3.0)
    general = 2.0 * (np.log(big - 1.0) + _EULER) - 2.0 * (big - 1.0) / big
    return np.round(np.where(n > 2, general, np.where(n == 2, 1.0, 0.0)) * UNIT).astype(np.int64)


def depth_limit(sample_n: int) -> int:
    """The logarithm of the sample size to base 2, rounded up."""
    return max(1, (sample_n - 1).bit_length())


def draws(company: int, tree: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two numbers below 2**32 for each node: the first eight bytes of MD5 over `company:tree:node`."""
    found = b"".join(md5(f"{company}:{t}:{n}".encode()).digest()[:8] for t, n in zip(tree.tolist(), node.tolist()))
    pair = np.frombuffer(found, ">u4").reshape(-1, 2).astype(np.int64)
    return pair[:, 0], pair[:, 1]


def grow(company: int, points: np.ndarray, tree: np.ndarray, depth: int, trees: int):
    """All trees level by level: split feature (-1 in a leaf), threshold, rows per node."""
    slots = 2 ** (depth + 1) - 1
    feature = np.full(trees * slots, -1, dtype=np.int64)
    threshold = np.zeros(trees * slots)
    size = np.zeros(trees * slots, dtype=np.int64)
    node = np.zeros(len(tree), dtype=np.int64)
    for level in range(depth + 1):
        order = np.argsort(tree * slots + node, kind="stable")
        points, tree, node = points[order], tree[order], node[order]
        ids, start, rows = np.unique(tree * slots + node, return_index=True, return_counts=True)
        size[ids] = rows
        if level == depth or not len(ids):
            break
        low = np.minimum.reduceat(points, start)
        span = np.maximum.reduceat(points, start) - low
        uneven = np.cumsum(span > 0, axis=1)
        split = uneven[:, -1] > 0
        first, second = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
        first[split], second[split] = draws(company, ids[split] // slots, ids[split] % slots)
        wanted = (first * uneven[:, -1] >> 32) + 1
        drawn = (uneven >= wanted[:, None]).argmax(axis=1)
        each = np.arange(len(ids))
        cut = low[each, drawn] + second / 2.0**32 * span[each, drawn]
        feature[ids[split]] = drawn[split]
        threshold[ids[split]] = cut[split]
        owner = np.repeat(each, rows)
        right = points[np.arange(len(points)), drawn[owner]] > cut[owner]
        live = split[owner]
        points, tree = points[live], tree[live]
        node = 2 * node[live] + 1 + right[live]
    return feature, threshold, size


def path_lengths(points: np.ndarray, feature, threshold, size, depth: int, trees: int) -> np.ndarray:
    """Length of each row's path, summed over the trees, in units."""
    base = np.arange(trees) * (2 ** (depth + 1) - 1)
    row = np.arange(len(points))[:, None]
    node = np.zeros((len(points), trees), dtype=np.int64)
    steps = np.zeros((len(points), trees), dtype=np.int64)
    for _ in range(depth):
        chosen = feature[base + node]
        inner = chosen >= 0
        right = points[row, np.maximum(chosen, 0)] > threshold[base + node]
        node = np.where(inner, 2 * node + 1 + right, node)
        steps += inner
    return (steps * UNIT + mean_depth(size[base + node])).sum(axis=1)


def _sampled(lists: pa.ListArray, date: np.ndarray, trees: int, sample: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, tree) of the `sample` lowest draws of each tree, from draws 2**32 * tree + hash per row."""
    count = np.diff(lists.offsets.to_numpy())
    row, code = np.repeat(np.arange(len(lists)), count), lists.flatten().to_numpy()
    order = np.lexsort((date[row], code))
    row, tree = row[order], code[order] >> 32
    rank = np.arange(len(tree)) - np.searchsorted(tree, tree)
    return row[rank < sample], tree[rank < sample]


def _scored(trees: int, sample: int):
    def score(block: pa.Table) -> pa.Table:
        block = block.combine_chunks()
        points = np.column_stack([block[f].to_numpy() for f in FEATURES])
        rows_n, company = block["rows_n"][0].as_py(), block["company_id"][0].as_py()
        if rows_n <= sample:
            row, tree = np.tile(np.arange(len(points)), trees), np.repeat(np.arange(trees), len(points))
        else:
            date = block["date"].cast(pa.int32()).to_numpy()
            row, tree = _sampled(block["drawn"].combine_chunks(), date, trees, sample)
        depth = depth_limit(min(rows_n, sample))
        own = block["own"].to_numpy()
        path = path_lengths(points[own], *grow(company, points[row], tree, depth, trees), depth, trees)
        kept = block.filter(block["own"]).select(["company_id", "date", "rows_n", *FEATURES])
        return kept.add_column(3, "path", pa.array(path, pa.int64()))

    return score


def blocks(records: DataFrame, trees: int, sample: int, block_rows: int) -> DataFrame:
    """Rows with their company's length, dealt by block; `drawn` holds 2**32 * tree + hash where a row may be in a sample.

    About twice the sample passes the hash test of a tree; that fewer than the sample do has a chance below 1e-35.
    """
    rows = records.select("company_id", "date", *FEATURES).dropna()
    lengths = rows.groupBy("company_id").agg(F.count(F.lit(1)).alias("rows_n")).where(F.col("rows_n") >= MIN_ROWS)
    staged = rows.join(lengths, "company_id")

    def draw(t: Column) -> Column:
        digits = F.substring(F.md5(F.concat_ws(":", "company_id", t, "date").cast("binary")), 1, 8)
        return F.shiftleft(t, 32) + F.conv(digits, 16, 10).cast("bigint")

    every = F.transform(F.sequence(F.lit(0).cast("bigint"), F.lit(trees - 1).cast("bigint")), draw)
    likely = F.filter(every, lambda d: d.bitwiseAND(F.lit(2**32 - 1)) < F.lit((2 * sample + 64) * 2**32) / F.col("rows_n"))
    drawn = F.when(F.col("rows_n") > sample, likely)
    count = F.ceil(F.col("rows_n") / block_rows)
    home = F.pmod(F.xxhash64("date"), count)
    places = F.when((F.size("drawn") > 0) | (F.col("rows_n") <= sample), F.sequence(F.lit(0).cast("bigint"), count - 1)).otherwise(F.array(home))
    dealt = staged.withColumn("drawn", drawn).withColumn("home", home).withColumn("block", F.explode(places))
    return dealt.withColumn("own", F.col("block") == F.col("home")).drop("home")


def isolation_scores(records: DataFrame, trees: int = TREES, sample: int = SAMPLE, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(company_id, date, rows_n, path, score, features) of every row of the companies with enough rows.

    The score is 2 ** (-mean path length / c(sample)), near 1 for rows that are easy to isolate.
    """
    dealt = dealt_by(blocks(records, trees, sample, block_rows), "company_id", "block")
    paths = dealt.groupBy("company_id", "block").applyInArrow(_scored(trees, sample), _PATHS)
    n = F.least("rows_n", F.lit(sample))
    usual = F.round((2 * (F.log(n - 1) + _EULER) - 2 * (n - 1) / n) * UNIT)
    return paths.withColumn("score", F.pow(F.lit(2.0), -(F.col("path") / (trees * usual))))


def isolation_forest_anomalies(records: DataFrame, contamination: float = CONTAMINATION, **forest: int) -> DataFrame:
    """The most isolated 8 % of a company's rows, named after their most unusual metric.

    Shorter paths than the quantile of the company's paths, which is the same as higher scores.
    """
    scored = durable(isolation_scores(records, **forest))
    cuts = group_quantiles(scored, ["company_id"], "path", [contamination])
    usual = [f(m).alias(f"{m}_{name}") for m in FEATURES for name, f in (("mean", F.avg), ("std", F.stddev_pop))]
    cuts = cuts.join(scored.groupBy("company_id").agg(*usual), "company_id")
    deviations = {m: F.abs(F.col(m) - F.col(f"{m}_mean")) / (F.col(f"{m}_std") + 1e-9) for m in FEATURES}
    return (
        scored.join(cuts, "company_id")
        .where(F.col("path") < F.col("quantiles")[0])
        .withColumn("top", dominant_metric(deviations))
        .select(
            "company_id",
            "date",
            F.col("top.metric").alias("metric"),
            F.round("top.value", 2).alias("value"),
            F.round("score", 3).alias("z_score"),
            F.lit("WARNING").alias("severity"),
            F.lit("IsolationForest").alias("method"),
        )
    )


def dominant_metric(deviations: dict) -> object:
    """Struct (metric, value) of the largest deviation; the first metric wins ties."""
    candidates = [
        F.struct(dev.alias("dev"), F.lit(-i).alias("first"), F.lit(m).alias("metric"), F.col(m).alias("value"))
        for i, (m, dev) in enumerate(deviations.items())
    ]
    return F.array_max(F.array(*candidates))
