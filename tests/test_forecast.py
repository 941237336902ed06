import datetime as dt

import numpy as np
import pytest

from quarterwise.operators.forecast import engine, learners, selection
from quarterwise.operators.forecast import series as ts
from quarterwise.operators.forecast.accuracy import error_metrics
from tests.conftest import quarter, row

RNG = np.random.default_rng(3)
WAVY = [100 + 3 * t + 12 * np.sin(t) + RNG.normal() for t in range(24)]


def one(df, model, fitted=True, horizon=4):
    table = engine.series_models(df, horizon, [model], fitted=fitted)
    return table.where("target = 'revenue' and fold = 'full'").first()


def errors(actual, fitted):
    miss = np.abs(np.asarray(actual) - fitted)
    return round(miss.mean(), 2), round(float(np.sqrt((miss**2).mean())), 2), round(float((miss / np.abs(actual)).mean() * 100), 2)


def residuals(d, phi, theta):
    e = np.zeros(len(d))
    for t in range(len(d)):
        e[t] = d[t] - (phi * d[t - 1] + theta * e[t - 1] if t else 0.0)
    return e


def test_polynomial_is_least_squares(series):
    got = one(series({1: WAVY}), "polynomial")
    fit = np.poly1d(np.polyfit(range(24), WAVY, 2))
    assert np.allclose(got["fitted"], fit(range(24)))
    assert np.allclose(got["forecast"], fit(range(24, 28)))
    assert (got["mae"], got["rmse"], got["mape"]) == errors(WAVY, fit(range(24)))
    sigma = np.std(np.array(WAVY) - fit(range(24)))
    assert np.allclose(got["upper"], got["forecast"] + 1.96 * sigma * np.sqrt(range(1, 5)))


def test_seasonal_recovers_trend_times_factor(series):
    values = [(100 + 2 * t) * (1.2, 0.9, 1.0, 0.9)[t % 4] for t in range(24)]
    got = one(series({1: values}), "seasonal")
    line = np.poly1d(np.polyfit(range(24), values, 1))
    factor = [np.mean([values[t] / line(t) for t in range(24) if t % 4 == q]) for q in range(4)]
    assert np.allclose(got["forecast"], [line(t) * factor[t % 4] for t in range(24, 28)])
    assert got["mape"] < 3


def test_holt_recurrence(series):
    level, trend, fitted = WAVY[0], WAVY[1] - WAVY[0], [WAVY[0]]
    for y in WAVY[1:]:
        fitted.append(level + trend)
        before, level = level, 0.3 * y + 0.7 * (level + trend)
        trend = 0.1 * (level - before) + 0.9 * trend
    got = one(series({1: WAVY}), "holt")
    assert np.allclose(got["fitted"], fitted)
    assert np.allclose(got["forecast"], [level + k * trend for k in range(1, 5)])


def test_arima_beats_a_dense_grid(series):
    d = np.diff(WAVY)
    grid = np.linspace(-0.999, 0.999, 81)
    dense = min((float((residuals(d, p, q) ** 2).sum()), p, q) for p in grid for q in grid)
    got = one(series({1: WAVY}), "arima")
    fitted = np.array(got["fitted"])
    e = d - np.diff(fitted)
    assert (e**2).sum() <= dense[0] * (1 + 1e-4)
    steps = np.diff([WAVY[-1], *got["forecast"]])
    phi = steps[1] / steps[0]
    assert np.allclose(steps, steps[0] * phi ** np.arange(4))
    assert np.allclose(got["upper"], got["forecast"] + 1.96 * np.std(e) * np.sqrt(range(1, 5)))
    assert (got["mae"], got["rmse"], got["mape"]) == errors(WAVY[1:], fitted[1:])


def test_length_limits(series):
    df = series({n: WAVY[:n] for n in (7, 8, 11, 12)})
    folds = ts.with_folds(ts.training_series(df)).where("target = 'revenue'")
    assert sorted((r["company_id"], r["fold"], r["n"]) for r in folds.collect()) == [
        (8, "full", 8), (11, "full", 11), (12, "full", 12), (12, "held_out", 8),
    ]
    out = engine.run_all_forecasts(df, models=["arima", "holt"])
    rows = out.groupBy("company_id", "model_used").count().collect()
    assert sorted(r["company_id"] for r in rows) == [8, 11, 12] and all(r["count"] == 4 for r in rows)
    assert {r["company_id"]: r["model_used"] for r in rows if r["company_id"] < 12} == {8: "ARIMA(1,1,1)", 11: "ARIMA(1,1,1)"}


def test_constant_and_zero_series(series):
    out = engine.series_models(series({1: [50] * 12, 2: [0] * 12}), models=["arima", "seasonal", "polynomial", "holt"])
    for r in out.where("target = 'revenue' and fold = 'full'").collect():
        assert np.allclose(r["forecast"], 50.0 if r["company_id"] == 1 else 0.0), r["model"]
        assert r["mape"] == (0.0 if r["company_id"] == 1 else None)
    assert engine.run_all_forecasts(series({2: [0] * 12}), models=["arima", "holt"]).count() == 4


def test_future_dates_start_after_the_last_quarter(records):
    rows = [row(1, quarter(k)) for k in range(8)] + [row(2, quarter(k)) for k in range(7)] + [row(2, dt.date(2020, 11, 20))]
    out = engine.run_all_forecasts(records(rows), 2, ["holt"]).orderBy("company_id", "forecast_date").collect()
    expected = [dt.date(2021, 1, 1), dt.date(2021, 4, 1)]
    assert [r["forecast_date"] for r in out] == expected * 2


def model_rows(spark, *models):
    """(position, fold, forecast, mape, actual) tuples in the model layout."""
    rows = [
        (1, "revenue", dt.date(2020, 10, 1), fold, actual, p, f"m{p}", f"M{p}", fc, [x - 1 for x in fc], [x + 1 for x in fc], 1.0, 1.0, mape, None)
        for p, fold, fc, mape, actual in models
    ]
    layout = "company_id long, target string, last_date date, fold string, actual array<double>, position int, model string, label string, forecast array<double>, lower array<double>, upper array<double>, mae double, rmse double, mape double, fitted array<double>"
    return spark.createDataFrame(rows, layout)


def test_first_model_wins_ties_and_ensemble_needs_an_edge(spark):
    held = [(0, "held_out", [90.0], 5.0, [100.0]), (1, "held_out", [110.0], 5.0, [100.0])]
    table = model_rows(spark, (0, "full", [10.0], 9.6, None), (1, "full", [20.0], 9.6, None), *held)
    best = selection.best_forecasts(table).first()
    assert (best["model_name"], best["wf_mape"], best["mae"]) == ("m0", 10.0, 1.0)
    table = model_rows(spark, (0, "full", [10.0], 4.0, None), (1, "full", [20.0], 12.0, None), *held)
    best = selection.best_forecasts(table).first()
    assert (best["model_name"], best["label"]) == ("ensemble", "Ensemble(m0:0.75 | m1:0.25)")
    assert np.isclose(best["forecast"][0], 12.5) and best["mape"] == 8.0 and best["mae"] is None
    assert selection.best_forecasts(table, fair=True).first()["model_name"] == "ensemble"


def test_ensemble_without_usable_errors_is_the_plain_mean(spark):
    table = model_rows(spark, (0, "full", [10.0, 4.0], 0.0, None), (1, "full", [20.0, 8.0], None, None))
    row = selection.with_ensemble(selection.per_series(table)).first()["ensemble"]
    assert (row["forecast"], row["label"], row["mape"]) == ([15.0, 6.0], "Ensemble(simple_avg)", None)
    assert np.allclose(row["lower"], [13.8, 5.52]) and np.allclose(row["upper"], [16.2, 6.48])
    assert selection.best_forecasts(table).first()["model_name"] == "m0"


def test_error_metrics_skip_zero_actuals(spark):
    df = spark.createDataFrame([("a", 0.0, 1.0), ("a", 10.0, 8.0), ("b", 0.0, 0.0)], "k string, y double, p double")
    out = {r["k"]: (r["mae"], r["rmse"], r["mape"]) for r in error_metrics(df, "y", "p", "k").collect()}
    assert out == {"a": (1.5, 1.58, 20.0), "b": (0.0, 0.0, None)}


def test_fitted_and_forecast_feed(series):
    out = engine.fitted_and_forecast(series({1: WAVY}), models=["polynomial", "holt"])
    assert {r["kind"]: r["count"] for r in out.groupBy("kind").count().collect()} == {"actual": 24, "actual_profit": 24, "fitted": 24, "forecast": 4}


def test_unknown_model(series):
    with pytest.raises(ValueError, match="prophet"):
        engine.run_all_forecasts(series({1: WAVY}), models=["prophet"])


SMALL = {
    "random_forest": learners.random_forest(trees=20),
    "gradient_boosting": learners.gradient_boosting(rounds=5, rate=0.3),
    "svr": learners.kernel_regression(),
}


def test_learners_beat_the_last_value_on_seasonal_series(series):
    factor = (1.3, 0.8, 1.0, 0.9)
    values = {c: [(50 * c + t) * factor[t % 4] * (1 + 0.01 * RNG.normal()) for t in range(28)] for c in range(1, 13)}
    df = series(values)
    table = engine.series_models(df, models=list(SMALL), learners=SMALL, fitted=True)
    scored = selection.with_held_out_error(table).where("target = 'revenue'").collect()
    naive = np.mean([abs(v[24 + k] - v[23]) / v[24 + k] for v in values.values() for k in range(4)]) * 100
    assert len(scored) == 12 * 2 * len(SMALL)
    for model in SMALL:
        held = [r["wf_mape"] for r in scored if r["model"] == model and r["fold"] == "held_out"]
        assert np.mean(held) < naive, model
    full = next(r for r in scored if r["fold"] == "full")
    assert len(full["forecast"]) == 4 and full["fitted"][:4] == [None] * 4 and len(full["fitted"]) == 28
    assert full["lower"][3] < full["forecast"][3] < full["upper"][3]


def test_learners_on_constant_and_short_series(series):
    learned = {m: SMALL[m] for m in ("random_forest", "svr")}
    table = engine.series_models(series({1: [50] * 9, 2: [80] * 8}), models=list(learned), learners=learned)
    rows = table.where("target = 'revenue'").collect()
    assert len(rows) == 4 and {r["fold"] for r in rows} == {"full"}
    for r in rows:
        assert np.allclose(r["forecast"], 50.0 if r["company_id"] == 1 else 80.0)


def test_forest_is_reproducible(series):
    df = series({c: [10 * c + 5 * np.sin(t + c) for t in range(20)] for c in range(1, 7)})
    forest = {"random_forest": SMALL["random_forest"]}
    runs = [
        engine.run_all_forecasts(df.repartition(n), models=["random_forest"], learners=forest).orderBy("company_id", "forecast_date").collect()
        for n in (1, 3)
    ]
    assert runs[0] == runs[1] and len(runs[0]) == 24


def test_recursion_plan_does_not_repeat_predictions(series):
    folds = learners.standardised_folds(ts.with_folds(ts.training_series(series({1: WAVY}))))
    rows = learners.training_rows(folds)
    ready = {m: (SMALL[m], SMALL[m].fit(rows)) for m in ("svr", "random_forest")}
    plan = learners.recursive_forecasts(ready, folds, 4)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("kernel(") == 4
    assert "Join" not in learners.in_sample(ready, rows, True)._jdf.queryExecution().optimizedPlan().toString()


def test_learners_join_once_for_all_models_and_folds(series):
    df = series({c: [10 * c + 5 * np.sin(t + c) for t in range(20)] for c in range(1, 4)})
    pooled = {m: SMALL[m] for m in ("random_forest", "svr")}
    plan = engine.series_models(df, models=list(pooled), learners=pooled)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1


@pytest.mark.parametrize("level", [0.0, 1e8, 1e9])
def test_scale_of_high_levels(spark, level):
    ys = [level + (k * 7 % 5) * 0.5 for k in range(24)]
    folds = spark.createDataFrame([(1, ys, 24)], "company_id long, ys array<double>, n int")
    row = learners.standardised_folds(folds).first()
    assert row["scale"] == pytest.approx(np.std([y - level for y in ys]), rel=1e-6)
    assert np.std(row["zs"]) == pytest.approx(1)


def test_a_missing_profit_does_not_shorten_revenue(records):
    rows = [row(1, quarter(k), revenue=100.0 + k, profit=None if k in (3, 19) else 40.0) for k in range(20)]
    got = {r["target"]: r for r in ts.training_series(records(rows)).collect()}
    assert len(got["revenue"]["ys"]) == 20 and got["revenue"]["last_date"] == quarter(19)
    assert len(got["profit"]["ys"]) == 18 and got["profit"]["last_date"] == quarter(18)


def panel_rows(series, companies=4):
    return learners.training_rows(learners.standardised_folds(ts.with_folds(ts.training_series(series({k: [v + k for v in WAVY] for k in range(companies)})))))


def test_kernel_inputs_are_scaled(series):
    rows = panel_rows(series)
    scaling = learners.kernel_regression().fit(rows).scaling
    moments = rows.selectExpr(*[f"avg({c})" for c in learners.FEATURES], *[f"stddev_pop({c})" for c in learners.FEATURES]).first()
    n = len(learners.FEATURES)
    assert [m for m, _ in scaling] == pytest.approx(list(moments[:n])) and [s for _, s in scaling] == pytest.approx([m or 1.0 for m in moments[n:]])


def kernel_loss(learner, model, x, y):
    beta = model.weights
    gram = model.kernels(model.landmarks * np.array(model.scaling)[:, 1] + np.array(model.scaling)[:, 0])
    miss = np.abs(y - model.value(x))
    return 0.5 * beta @ gram @ beta + learner.cost * np.maximum(miss - learner.epsilon, 0).sum()


def test_rounds_lower_the_epsilon_insensitive_loss_and_outliers_pull_little(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, len(learners.FEATURES)))
    y = np.sin(x[:, 0]) + 0.5 * x[:, 1]
    spoiled = np.where(np.arange(300) % 20 == 0, y + 30, y)
    rows = spark.createDataFrame([(*map(float, a), float(b)) for a, b in zip(x, spoiled)], ", ".join(f"{c} double" for c in learners.FEATURES) + ", label double")
    losses = []
    for rounds in (1, 2, 4, 8, 12):
        learner = learners.kernel_regression()
        learner.rounds = rounds
        losses.append(kernel_loss(learner, learner.fit(rows), x, spoiled))
    assert all(b <= a * (1 + 1e-6) for a, b in zip(losses, losses[1:])) and losses[-1] < 0.98 * losses[0]
    clean = np.arange(300) % 20 != 0
    fitted = learner.fit(rows.repartition(7)).value(x)
    assert np.median(np.abs(fitted - y)[clean]) < 0.3


def test_a_fit_depends_on_no_partitioning(series):
    rows = panel_rows(series)
    one, other = (learners.kernel_regression().fit(rows.repartition(n)) for n in (1, 5))
    assert np.allclose(one.landmarks, other.landmarks) and np.allclose(one.weights, other.weights, rtol=1e-4, atol=1e-4)
