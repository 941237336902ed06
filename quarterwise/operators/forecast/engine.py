"""Forecast tables for all companies in one job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterwise.operators.forecast.closed_form import CLOSED_FORM
from quarterwise.operators.forecast.learners import LEARNERS, BoostedLearner, Learner, add_learner_models
from quarterwise.operators.forecast.selection import best_forecasts, held_result, per_series, with_ensemble
from quarterwise.operators.forecast.series import HORIZON, future_quarters, training_series, with_folds
from quarterwise.sources.durable import durable

DEFAULT_MODELS = ("arima", "random_forest", "gradient_boosting", "svr")
DOCUMENTED_MODELS = ("seasonal", "polynomial", "holt")
SERIES_FIELDS = ("company_id", "last_date", "target", "fold", "actual")


def model_table(
    folds: DataFrame,
    horizon: int = HORIZON,
    models: Sequence[str] = DEFAULT_MODELS,
    learners: dict[str, Learner | BoostedLearner] | None = None,
    fitted: bool = False,
) -> DataFrame:
    """One row per series, fold and model, in the model layout.

    Closed-form models are columns of the fold row until a generator splits them up.
    Learners are fitted here (Spark jobs run) and joined in by union; both then start from
    a checkpoint, so the series are built once.
    """
    learners = LEARNERS if learners is None else learners
    unknown = [m for m in models if m not in CLOSED_FORM and m not in learners]
    if unknown:
        raise ValueError(f"Unknown models: {unknown}. Available: {[*CLOSED_FORM, *learners]}")
    parts = []
    closed = [m for m in models if m in CLOSED_FORM]
    pooled = {m: learners[m] for m in models if m in learners}
    if closed and pooled:
        folds = durable(folds)
    if closed:
        staged = folds
        for name in closed:
            staged = CLOSED_FORM[name](staged, horizon, models.index(name), fitted)
        parts.append(staged.select(*SERIES_FIELDS, F.inline(F.array(*closed))))
    if pooled:
        positions = {m: models.index(m) for m in pooled}
        parts.append(add_learner_models(folds, horizon, pooled, positions, fitted))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def series_models(records: DataFrame, horizon: int = HORIZON, models: Sequence[str] = DEFAULT_MODELS, **options) -> DataFrame:
    return model_table(with_folds(training_series(records), horizon), horizon, models, **options)


def forecast_rows(winners: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """Stored layout: revenue and profit side by side, bounds and quality of the revenue model."""

    def of(target: str) -> Column:
        result = F.struct("forecast", "lower", "upper", "label", "mae", "mape")
        return F.any_value(F.when(F.col("target") == target, result), ignoreNulls=True)

    both = winners.groupBy("company_id").agg(
        F.max("last_date").alias("last_date"), of("revenue").alias("rev"), of("profit").alias("prof")
    )
    return both.select("company_id", "rev", "prof", F.posexplode(future_quarters("last_date", horizon)).alias("k", "forecast_date")).select(
        "company_id",
        "forecast_date",
        F.round(F.get("rev.forecast", "k"), 2).alias("predicted_revenue"),
        F.round(F.get("prof.forecast", "k"), 2).alias("predicted_profit"),
        F.round(F.get("rev.lower", "k"), 2).alias("lower_bound"),
        F.round(F.get("rev.upper", "k"), 2).alias("upper_bound"),
        F.col("rev.label").alias("model_used"),
        F.col("rev.mae").alias("mae"),
        F.col("rev.mape").alias("mape"),
    )


def run_all_forecasts(
    records: DataFrame,
    horizon: int = HORIZON,
    models: Sequence[str] = DEFAULT_MODELS,
    learners: dict[str, Learner | BoostedLearner] | None = None,
    fair: bool = False,
) -> DataFrame:
    """``horizon`` rows for every company with at least eight quarters."""
    table = series_models(records, horizon, models, learners=learners)
    return forecast_rows(best_forecasts(table, fair), horizon)


def forecast_company(records: DataFrame, company_id: int, horizon: int = HORIZON, **options) -> DataFrame:
    return run_all_forecasts(records.where(F.col("company_id") == company_id), horizon, **options)


def fitted_and_forecast(
    records: DataFrame,
    horizon: int = HORIZON,
    models: Sequence[str] = DEFAULT_MODELS,
    learners: dict[str, Learner | BoostedLearner] | None = None,
) -> DataFrame:
    """Chart feed: the revenue series with fitted and forecast points of its winner, and the profit history."""
    histories = training_series(records)
    revenue = with_folds(histories.where(F.col("target") == "revenue"), horizon)
    return chart_feed(histories, model_table(revenue, horizon, models, learners, fitted=True), horizon)


def forecast_results(
    records: DataFrame,
    horizon: int = HORIZON,
    models: Sequence[str] = DEFAULT_MODELS,
    learners: dict[str, Learner | BoostedLearner] | None = None,
    fair: bool = False,
) -> dict[str, DataFrame]:
    """Forecast rows, chart feed and model comparison, all from one stored table of fitted models."""
    histories = durable(training_series(records))
    table = durable(model_table(with_folds(histories, horizon), horizon, models, learners, fitted=True))
    return {
        "forecasts": forecast_rows(best_forecasts(table, fair), horizon),
        "feed": chart_feed(histories, table, horizon),
        "comparison": model_comparison(table),
    }


def chart_feed(histories: DataFrame, table: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """The feed from the series and a model table with fitted paths."""
    series = histories.where(F.col("target") == "revenue")
    winners = best_forecasts(table.where(F.col("target") == "revenue")).drop("last_date")
    profits = histories.where(F.col("target") == "profit").select("company_id", F.col("dates").alias("profit_dates"), F.col("ys").alias("profits"))
    joined = series.join(winners, ["company_id", "target"]).join(profits, "company_id", "left")

    def points(kind: str, dates: Column, values: Column, lower: Column, upper: Column) -> Column:
        zipped = F.arrays_zip(dates.alias("date"), values.alias("value"), lower.alias("lower"), upper.alias("upper"))
        return F.transform(
            zipped,
            lambda p: F.struct(
                F.lit(kind).alias("kind"), p["date"].alias("date"), p["value"].alias("value"), p["lower"].alias("lower"), p["upper"].alias("upper")
            ),
        )

    none = F.array().cast("array<double>")
    feed = F.concat(
        points("actual", F.col("dates"), F.col("ys"), none, none),
        points("actual_profit", F.coalesce("profit_dates", F.array().cast("array<date>")), F.coalesce("profits", none), none, none),
        points("fitted", F.col("dates"), F.col("fitted"), none, none),
        points("forecast", future_quarters("last_date", horizon), F.col("forecast"), F.col("lower"), F.col("upper")),
    )
    return joined.select("company_id", "model_name", F.col("label").alias("model"), "mae", "mape", F.inline(feed)).where(
        F.col("value").isNotNull()
    )


def model_comparison(table: DataFrame) -> DataFrame:
    """All models of every series with in-sample and held-out error, the ensemble last."""
    shown = ("model", "label", "forecast", "lower", "upper", "mape")
    row = "struct<model: string, label: string, forecast: array<double>, lower: array<double>, upper: array<double>, mape: double, wf_mape: double>"
    listed = f"struct({', '.join(f'm.{f}' for f in shown)}, {held_result('m.model')}.wf_mape AS wf_mape)"
    own = f"struct('ensemble' AS model, {', '.join(f'ensemble.{f}' for f in shown[1:])}, ensemble_wf_mape AS wf_mape)"
    everything = (
        f"concat(transform(full, m -> cast({listed} AS {row})), "
        f"array_compact(array(CASE WHEN ensemble IS NOT NULL THEN cast({own} AS {row}) END)))"
    )
    return with_ensemble(per_series(table)).selectExpr("company_id", "target", f"inline({everything})")
