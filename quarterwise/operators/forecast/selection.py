"""Ensemble weights and the choice of a winner, from the long model table.

The model table has one row per (company, target, fold, model) with arrays over the
horizon; a group is at most twice the number of models.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterwise.operators.forecast.accuracy import held_out_mape
from quarterwise.operators.forecast.series import FULL, HELD_OUT

MODEL_FIELDS = ("position", "model", "label", "forecast", "lower", "upper", "mae", "rmse", "mape", "fitted")
ENSEMBLE_EDGE = 0.95
SIMPLE_BAND = 0.08
NO_SCORE = 9999.0


def with_held_out_error(models: DataFrame) -> DataFrame:
    """Adds ``wf_mape``: the error on the held-out rows, NULL on the full fold."""
    return models.withColumn("wf_mape", F.expr(held_out_mape("actual", "forecast")))


def per_series(models: DataFrame) -> DataFrame:
    """One row per series: the full and the held-out results as arrays in model order."""

    def of(fold: str, name: str):
        result = f"struct({', '.join(MODEL_FIELDS)}, actual, wf_mape)"
        return F.expr(f"sort_array(collect_list(CASE WHEN fold = '{fold}' THEN {result} END)) AS {name}")

    return (
        with_held_out_error(models)
        .groupBy("company_id", "target")
        .agg(F.max("last_date").alias("last_date"), of(FULL, "full"), of(HELD_OUT, "held"))
    )


def held_result(model: str) -> str:
    """The held-out result of a model, NULL if there is none."""
    return f"get(filter(held, h -> h.model = {model}), 0)"


def _combined(models: str, field: str, weight: str) -> str:
    """Weighted sum over the models, step by step; ``weight`` is an expression in m."""
    steps = f"sequence(0, size(get({models}, 0).forecast) - 1)"
    return f"transform({steps}, k -> aggregate({models}, 0D, (acc, m) -> acc + {weight} * get(m.{field}, k)))"


def _valid(results: str) -> str:
    """The results whose mape can serve as a weight, each with that weight."""
    return f"filter({results}, m -> m.mape > 0D)"


def _ensemble(valid: str, results: str) -> str:
    """Average weighted by 1 / mape; without a usable mape, the plain mean +- 8 %."""
    total = f"aggregate({valid}, 0D, (t, v) -> t + 1D / v.mape)"
    weight = f"((1D / m.mape) / {total})"
    label = f"array_join(transform({valid}, m -> concat(m.model, ':', cast(round({weight}, 2) AS decimal(4,2)))), ' | ')"
    weighted = (
        f"struct(concat('Ensemble(', {label}, ')') AS label, "
        + "".join(f"{_combined(valid, f, weight)} AS {f}, " for f in ("forecast", "lower", "upper"))
        + f"aggregate({valid}, 0D, (acc, m) -> acc + m.mape) / size({valid}) AS mape, "
        f"array_min(transform({valid}, m -> struct(m.mape AS mape, m.position AS position, m.fitted AS fitted))).fitted AS fitted)"
    )
    mean = _combined(results, "forecast", f"(1D / size({results}))")
    plain = (
        f"struct('Ensemble(simple_avg)' AS label, {mean} AS forecast, "
        f"transform({mean}, f -> f * {1 - SIMPLE_BAND}D) AS lower, transform({mean}, f -> f * {1 + SIMPLE_BAND}D) AS upper, "
        f"cast(NULL AS double) AS mape, get({results}, 0).fitted AS fitted)"
    )
    return f"CASE WHEN size({results}) < 2 THEN NULL WHEN size({valid}) > 0 THEN {weighted} ELSE {plain} END"


def with_ensemble(series: DataFrame) -> DataFrame:
    """Adds ``ensemble`` (NULL with fewer than two models) and its held-out error."""
    out = series.withColumns({"full_valid": F.expr(_valid("full")), "held_valid": F.expr(_valid("held"))})
    out = out.withColumns(
        {
            "ensemble": F.expr(_ensemble("full_valid", "full")),
            "held_ensemble": F.expr(_ensemble("held_valid", "held")),
        }
    )
    error = held_out_mape("get(held, 0).actual", "held_ensemble.forecast")
    return out.withColumn("ensemble_wf_mape", F.expr(error))


def best_forecasts(models: DataFrame, fair: bool = False) -> DataFrame:
    """The winning model of each series.

    Smallest held-out error first, the earlier model among equals; a series too short to
    hold rows out takes its first model. The ensemble replaces the winner when its mape is
    more than 5 % better: its in-sample mape by default, its held-out one when ``fair``.
    """
    error = f"{held_result('m.model')}.wf_mape"
    scored = f"struct(coalesce({error}, {NO_SCORE}D) AS score, m.position AS position, {error} AS wf_mape, m AS result)"
    ensemble_error = "ensemble_wf_mape" if fair else "ensemble.mape"
    bar = f"if(best.wf_mape = 0D, {NO_SCORE}D, best.wf_mape) * {ENSEMBLE_EDGE}D"
    chosen = (
        with_ensemble(per_series(models))
        .withColumn("best", F.expr(f"array_min(transform(full, m -> {scored}))"))
        .withColumn("won", F.expr(f"coalesce({ensemble_error} < {bar}, false)"))
    )
    picked = [f"if(won, ensemble.{f}, best.result.{f}) AS {f}" for f in ("label", "forecast", "lower", "upper", "mape", "fitted")]
    single = [f"if(won, NULL, best.result.{f}) AS {f}" for f in ("mae", "rmse")]
    return chosen.selectExpr(
        "company_id",
        "target",
        "last_date",
        "if(won, 'ensemble', best.result.model) AS model_name",
        "best.wf_mape AS wf_mape",
        *picked,
        *single,
    )
