import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarterwise import schema
from quarterwise.functions.quantiles import group_quantiles
from quarterwise.operators import anomaly, isolation
from quarterwise.plans import reports
from tests.conftest import quarter, row


def spike(n, at, value, base=100.0):
    return [value if k == at else base + (k % 3) for k in range(n)]


def test_zscore_needs_four_rows_and_some_spread(series):
    df = series({1: spike(12, 5, 500), 2: [1, 1, 900], 3: [5] * 10})
    flags = anomaly.zscore_anomalies(df, ["revenue"]).collect()
    assert [(r["company_id"], r["date"], r["severity"]) for r in flags] == [(1, quarter(5), "SEVERE")]
    values = np.array(spike(12, 5, 500), float)
    assert flags[0]["z_score"] == round((500 - values.mean()) / values.std(), 3)


def test_iqr_fence_matches_linear_quartiles(series):
    values = spike(9, 4, 130)
    flags = anomaly.iqr_anomalies(series({1: values, 2: [5] * 8}), ["revenue"]).collect()
    assert [(r["company_id"], r["value"]) for r in flags] == [(1, 130.0)]


def test_debt_flags_use_all_companies(records):
    rows = [row(1, quarter(0), liabilities=450.0), row(1, quarter(1), liabilities=375.0), row(2, quarter(0), assets=0.0), row(2, quarter(1))]
    out = {r["date"]: r for r in anomaly.debt_risk_flags(records(rows)).collect()}
    ratios = np.array([0.9, 0.75, 0.4])
    assert {d: (r["value"], r["severity"]) for d, r in out.items()} == {quarter(0): (0.9, "SEVERE"), quarter(1): (0.75, "WARNING")}
    assert out[quarter(0)]["z_score"] == round((0.9 - ratios.mean()) / ratios.std(ddof=1), 3)


def test_most_severe_flag_survives(spark):
    d = quarter(0)
    rows = [
        (1, d, "revenue", 1.0, 2.1, "WARNING", "IQR"),
        (1, d, "revenue", 1.0, 2.2, "WARNING", "Z-Score"),
        (1, d, "profit", 1.0, 0.6, "WARNING", "IsolationForest"),
        (1, d, "profit", 1.0, 3.5, "SEVERE", "Z-Score"),
    ]
    flags = spark.createDataFrame(rows, "company_id long, date date, metric string, value double, z_score double, severity string, method string")
    kept = {r["metric"]: r["z_score"] for r in anomaly.keep_most_severe(flags).collect()}
    assert kept == {"revenue": 2.2, "profit": 3.5}


def test_summaries(spark, companies):
    rows = [(1, quarter(0), "revenue", 1.0, 3.2, "SEVERE"), (1, quarter(1), "expenses", 1.0, 2.2, "WARNING"), (9, quarter(0), "profit", 1.0, 2.0, "WARNING")]
    flags = spark.createDataFrame(rows, schema.ANOMALY_FLAGS)
    assert [tuple(r) for r in anomaly.anomaly_summary(flags, companies).collect()] == [(1, 2, 1, "expenses, revenue", "Alpha Corp")]
    assert tuple(anomaly.severity_totals(flags).first()) == (3, 1, 2)
    assert anomaly.severe_flags(flags).count() == 1


def draw(*parts):
    digest = hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()
    return int(digest[:8], 16), int(digest[8:16], 16)


def plain_paths(company, rows, trees=100, sample=256):
    """Path length of each (date, point) over all trees, by recursion over lists of rows."""
    n = min(len(rows), sample)
    limit = math.ceil(math.log2(n))
    usual = lambda k: 0 if k < 2 else 1_000_000 if k == 2 else round((2 * (math.log(k - 1) + np.euler_gamma) - 2 * (k - 1) / k) * 1e6)
    total = dict.fromkeys((d for d, _ in rows), 0)

    def split(tree, node, depth, inside, every):
        spans = [] if depth == limit or not inside else [f for f in range(4) if max(p[f] for _, p in inside) > min(p[f] for _, p in inside)]
        if not spans:
            for d, _ in every:
                total[d] += depth * 1_000_000 + usual(len(inside))
            return
        first, second = draw(company, tree, node)
        f = spans[first * len(spans) >> 32]
        low, high = min(p[f] for _, p in inside), max(p[f] for _, p in inside)
        cut = low + second / 2**32 * (high - low)
        for side in (0, 1):
            split(tree, 2 * node + 1 + side, depth + 1, *([r for r in part if (r[1][f] > cut) == side] for part in (inside, every)))

    for tree in range(trees):
        chosen = sorted(rows, key=lambda r: (draw(company, tree, r[0])[0], r[0]))[:sample]
        split(tree, 0, 0, chosen, rows)
    return total


@pytest.mark.parametrize("n, sample, block", [(6, 256, 4096), (24, 256, 4096), (24, 256, 7), (60, 16, 4096), (60, 16, 10), (17, 16, 4096), (16, 16, 5)])
def test_paths_equal_a_plain_forest_at_any_length_and_block(series, n, sample, block):
    rng = np.random.default_rng(n)
    df = series({3: (100 + rng.normal(size=n)).round(3).tolist()})
    rows = [(r["date"], tuple(r[f] for f in isolation.FEATURES)) for r in df.collect()]
    got = isolation.isolation_scores(df, trees=20, sample=sample, block_rows=block).collect()
    assert {r["date"]: r["path"] for r in got} == plain_paths(3, rows, 20, sample) and len(got) == n
    usual = int(isolation.mean_depth(min(n, sample)))
    assert all(r["score"] == pytest.approx(2 ** (-r["path"] / (20 * usual))) for r in got)


def test_a_company_longer_than_the_default_sample(series):
    rng = np.random.default_rng(7)
    for n in (256, 257, 300):
        df = series({-4: (100 + rng.normal(size=n)).tolist()})
        rows = [(r["date"], tuple(r[f] for f in isolation.FEATURES)) for r in df.collect()]
        got = isolation.isolation_scores(df, trees=3).collect()
        assert {r["date"]: r["path"] for r in got} == plain_paths(-4, rows, 3)


def test_tied_rows_are_one_leaf(series):
    assert {r["path"] for r in isolation.isolation_scores(series({1: [50.0] * 9})).collect()} == {100 * int(isolation.mean_depth(9))}


def test_mean_depth_of_the_paper():
    assert isolation.mean_depth(np.array([0, 1, 2])).tolist() == [0, 0, 1_000_000]
    assert isolation.mean_depth(256) == 10_244_771


def test_isolation_finds_outliers_in_short_and_long_companies(series):
    rng = np.random.default_rng(1)
    short, long = (100 + rng.normal(size=24)).tolist(), (100 + rng.normal(size=300)).tolist()
    short[7], long[150] = 400.0, 400.0
    df = series({1: short, 2: long, 3: [1, 2, 3, 4, 5]})
    scores = isolation.isolation_scores(df).collect()
    assert len(scores) == 324 and len({(r["company_id"], r["date"]) for r in scores}) == 324
    for company, at in ((1, 7), (2, 150)):
        top = max((r for r in scores if r["company_id"] == company), key=lambda r: r["score"])
        assert top["date"] == quarter(at) and top["score"] > 0.7
    flags = isolation.isolation_forest_anomalies(df)
    counts = {r["company_id"]: r["count"] for r in flags.groupBy("company_id").count().collect()}
    assert counts == {1: 2, 2: 24}
    again = isolation.isolation_scores(df.repartition(3), block_rows=50).collect()
    assert sorted((r["company_id"], r["date"], r["score"]) for r in again) == sorted((r["company_id"], r["date"], r["score"]) for r in scores)


def test_group_quantiles_equal_percentile(spark):
    rng = np.random.default_rng(2)
    values = {
        "normal": rng.normal(size=700), "equal": np.full(50, 3.5), "single": np.array([7.0]), "two": np.array([-1.0, 2.0]),
        "close": 1e6 + rng.random(900), "wild": np.concatenate([[1e300, -1e300], rng.random(200)]), "ints": rng.integers(-5, 5, 400).astype(float),
    }
    rows = [(k, float(v)) for k, vs in values.items() for v in vs] + [("normal", None), ("none", None)]
    df = spark.createDataFrame(rows, "name string, x double").repartition(5)
    wanted = [0.0, 0.08, 0.25, 0.5, 0.75, 1.0]
    got = {r["name"]: r["quantiles"] for r in group_quantiles(df, ["name"], "x", wanted).collect()}
    exact = df.groupBy("name").agg(F.expr(f"percentile(x, array({', '.join(f'{p}D' for p in wanted)}))").alias("q")).where("q is not null").collect()
    assert got == {r["name"]: r["q"] for r in exact} and set(got) == set(values)


def test_quantiles_combine_before_the_shuffle(spark):
    plan = group_quantiles(spark.range(9).selectExpr("id % 2 as k", "id * 1.0D as x"), ["k"], "x", [0.5])._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "percentile" not in plan and "SortAggregate" not in plan


def test_timeline_shows_expenses_only_where_flagged(spark, series):
    df = series({1: [10, 11], 2: [20, 21]})
    rows = [(1, quarter(1), "expenses", 6.6, 2.2, "WARNING"), (2, quarter(0), "revenue", 20.0, 2.2, "SEVERE")]
    out = reports.anomaly_timeline(df, spark.createDataFrame(rows, schema.ANOMALY_FLAGS)).collect()
    assert sorted({(r["company_id"], r["metric"]) for r in out}) == [(1, "expenses"), (1, "revenue"), (2, "revenue")]
    assert sum(r["flagged"] for r in out) == 2
