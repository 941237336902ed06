"""Forecast error measures, on columns and inside array folds.

The functions that return text build Spark SQL expressions. A fold has dozens of terms;
as text it reaches the JVM in one call and is parsed there, instead of one call per term.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NO_ERRORS = "0D AS e, 0D AS abs, 0D AS sq, 0D AS pct, 0D AS n, 0D AS n_pct"


def percentage_error(actual: str, predicted: str) -> str:
    """|a - p| / |a|, NULL where the actual value is 0."""
    return f"abs(({actual} - {predicted}) / nullif({actual}, 0D))"


def add_error(acc: str, actual: str, fitted: str) -> str:
    """Struct fields of the running sums after one more pair."""
    miss = f"({actual} - {fitted})"
    return (
        f"{acc}.e + {miss} AS e, {acc}.abs + abs({miss}) AS abs, {acc}.sq + {miss} * {miss} AS sq, "
        f"{acc}.pct + coalesce({percentage_error(actual, fitted)}, 0D) AS pct, "
        f"{acc}.n + 1D AS n, {acc}.n_pct + if({actual} <> 0D, 1D, 0D) AS n_pct"
    )


def error_sums(pairs: str) -> str:
    """Sums over an array of structs (actual, fitted)."""
    return f"aggregate({pairs}, struct({NO_ERRORS}), (acc, p) -> struct({add_error('acc', 'p.actual', 'p.fitted')}))"


def error_totals(actual: str, fitted: str) -> str:
    """The same sums as an aggregate over rows."""
    miss = f"({actual} - {fitted})"
    return (
        f"struct(sum({miss}) AS e, sum(abs({miss})) AS abs, sum({miss} * {miss}) AS sq, "
        f"coalesce(sum({percentage_error(actual, fitted)}), 0D) AS pct, "
        f"cast(count(1) AS double) AS n, cast(count_if({actual} <> 0D) AS double) AS n_pct)"
    )


def deviation(total: str, squares: str, n: str) -> str:
    """Population standard deviation from sums of errors, whose mean is small against their spread.

    Not for levels: there the two terms cancel. See `array_deviation`.
    """
    return f"sqrt(greatest({squares} / {n} - ({total} / {n}) * ({total} / {n}), 0D))"


def array_deviation(values: str, mean: str, n: str) -> str:
    """Population standard deviation of an array around its mean."""
    return f"sqrt(aggregate({values}, 0D, (acc, y) -> acc + (y - {mean}) * (y - {mean})) / {n})"


def metric_fields(sums: str) -> str:
    """mae, rmse and mape to 2 places; mape NULL when every actual value is 0."""
    return (
        f"round({sums}.abs / {sums}.n, 2) AS mae, round(sqrt({sums}.sq / {sums}.n), 2) AS rmse, "
        f"round({sums}.pct / nullif({sums}.n_pct, 0D) * 100, 2) AS mape"
    )


def band(forecast: str, sigma: str, side: str) -> str:
    """Lower (-) or upper (+) 95 % bound; the width grows with the root of the step."""
    return f"transform({forecast}, (f, i) -> f {side} 1.96D * {sigma} * sqrt(cast(i + 1 AS double)))"


def held_out_mape(actual: str, forecast: str) -> str:
    """Unrounded mean percentage error of a forecast, NULL without usable actual values."""
    errors = f"array_compact(zip_with({actual}, {forecast}, (a, p) -> {percentage_error('a', 'p')}))"
    return f"aggregate({errors}, 0D, (acc, e) -> acc + e) / nullif(size({errors}), 0) * 100"


def error_metrics(df: DataFrame, actual: str, predicted: str, *keys: str) -> DataFrame:
    """mae, rmse and mape per group of a long frame of pairs."""
    miss = f"({actual} - {predicted})"
    return df.groupBy(*keys).agg(
        F.expr(f"round(avg(abs({miss})), 2) AS mae"),
        F.expr(f"round(sqrt(avg({miss} * {miss})), 2) AS rmse"),
        F.expr(f"round(avg({percentage_error(actual, predicted)}) * 100, 2) AS mape"),
    )
