"""Models with a closed form or a short recurrence, as array expressions.

Each ``add_*`` takes the fold frame and appends one struct column in the model layout.
Intermediate results are referenced several times by the next projection, which keeps
Spark from inlining, and so repeating, a fold.

Fitted paths of the two recurrences are only built when asked for: appending to an array
costs the square of its length, while forecasts and errors need one linear fold.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterwise.operators.forecast.accuracy import (
    NO_ERRORS,
    add_error,
    band,
    deviation,
    error_sums,
    metric_fields,
)

ALPHA, BETA = 0.3, 0.1
EDGE = 0.999
COARSE_STEP, FINE_STEP, FINEST_STEP = 0.05, 0.005, 0.0005


def model_struct(
    name: str, position: int, label: str, forecast: str, sigma: str, sums: str, fitted: str | None
) -> str:
    """The model layout shared by every forecaster."""
    return (
        f"struct({position} AS position, '{name}' AS model, '{label}' AS label, {forecast} AS forecast, "
        f"{band(forecast, sigma, '-')} AS lower, {band(forecast, sigma, '+')} AS upper, {metric_fields(sums)}, "
        f"cast({fitted or 'NULL'} AS array<double>) AS fitted)"
    )


def _staged(df: DataFrame, **columns: str) -> DataFrame:
    """One projection per column, each seeing the ones before it."""
    for name, text in columns.items():
        df = df.withColumn(name, F.expr(text))
    return df


def _sigma(sums: str) -> str:
    return deviation(f"{sums}.e", f"{sums}.sq", f"{sums}.n")


def _pairs(fitted_at: Callable[[str], str]) -> str:
    return f"transform(ys, (y, i) -> struct(y AS actual, {fitted_at('i')} AS fitted))"


def _path(fitted_at: Callable[[str], str], wanted: bool) -> str | None:
    return f"transform(ys, (y, i) -> {fitted_at('i')})" if wanted else None


def _ahead(fitted_at: Callable[[str], str], horizon: int) -> str:
    return f"transform(sequence(1, {horizon}), j -> {fitted_at('(n + j - 1)')})"


# Least squares on the time index. Centring the index makes its odd moments vanish, which
# leaves a closed form without a linear solve.


def _centred(i: str) -> str:
    return f"(cast({i} AS double) - (cast(n AS double) - 1D) / 2D)"


def _with_moments(folds: DataFrame) -> DataFrame:
    if "moments" in folds.columns:
        return folds
    terms = f"transform(ys, (y, i) -> struct(y AS y, {_centred('i')} AS u))"
    added = (
        "struct(acc.y + p.y AS y, acc.uy + p.u * p.y AS uy, acc.u2 + p.u * p.u AS u2, "
        "acc.u2y + p.u * p.u * p.y AS u2y, acc.u4 + p.u * p.u * p.u * p.u AS u4)"
    )
    zero = "struct(0D AS y, 0D AS uy, 0D AS u2, 0D AS u2y, 0D AS u4)"
    return _staged(folds, moments=f"aggregate({terms}, {zero}, (acc, p) -> {added})")


def add_polynomial(folds: DataFrame, horizon: int, position: int, fitted: bool = False) -> DataFrame:
    """Degree-2 curve on the time index."""
    m, n = "moments", "cast(n AS double)"
    bend = f"(({n} * {m}.u2y - {m}.u2 * {m}.y) / ({n} * {m}.u4 - {m}.u2 * {m}.u2))"

    def at(i: str) -> str:
        u = _centred(i)
        return f"(curve.a + curve.b * {u} + curve.c * {u} * {u})"

    return _staged(
        _with_moments(folds),
        curve=f"struct({bend} AS c, {m}.uy / {m}.u2 AS b, ({m}.y - {bend} * {m}.u2) / {n} AS a)",
        curve_errors=error_sums(_pairs(at)),
        curve_ahead=_ahead(at, horizon),
        polynomial=model_struct(
            "polynomial", position, "Polynomial(degree=2)", "curve_ahead", _sigma("curve_errors"), "curve_errors", _path(at, fitted)
        ),
    )


def add_seasonal(folds: DataFrame, horizon: int, position: int, fitted: bool = False) -> DataFrame:
    """Linear trend times the mean ratio to it of every fourth row."""

    def trend(i: str) -> str:
        return f"(moments.y / n + moments.uy / moments.u2 * {_centred(i)})"

    def factor(q: int) -> str:
        hits = f"filter(ratios, p -> p.q = {q} AND p.r IS NOT NULL)"
        added = "struct(acc.s + p.r AS s, acc.n + 1D AS n)"
        mean = f"aggregate({hits}, struct(0D AS s, 0D AS n), (acc, p) -> {added}, acc -> acc.s / nullif(acc.n, 0D))"
        return f"coalesce({mean}, 1D)"

    def at(i: str) -> str:
        return f"({trend(i)} * get(factors, {i} % 4))"

    ratios = f"transform(ys, (y, i) -> struct(i % 4 AS q, y / nullif({trend('i')}, 0D) AS r))"
    return _staged(
        _with_moments(folds),
        ratios=ratios,
        factors=f"array({', '.join(factor(q) for q in range(4))})",
        season_errors=error_sums(_pairs(at)),
        season_ahead=_ahead(at, horizon),
        seasonal=model_struct(
            "seasonal", position, "SeasonalTrend(4)", "season_ahead", _sigma("season_errors"), "season_errors", _path(at, fitted)
        ),
    )


# Recurrences


def add_holt(folds: DataFrame, horizon: int, position: int, fitted: bool = False) -> DataFrame:
    """Double exponential smoothing, started from the first two rows."""
    ahead = "(acc.level + acc.trend)"
    level = f"({ALPHA}D * y + {1 - ALPHA}D * {ahead})"
    trend = f"({BETA}D * ({level} - acc.level) + {1 - BETA}D * acc.trend)"
    path0, path = (", array(ys[0]) AS path", f", concat(acc.path, array({ahead})) AS path") if fitted else ("", "")
    zero = f"struct(ys[0] AS level, ys[1] - ys[0] AS trend, {NO_ERRORS}{path0})"
    step = f"struct({level} AS level, {trend} AS trend, {add_error('acc', 'y', ahead)}{path})"
    return _staged(
        folds,
        holt_state=f"aggregate(slice(ys, 2, n - 1), {zero}, (acc, y) -> {step})",
        holt_ahead=f"transform(sequence(1, {horizon}), j -> holt_state.level + j * holt_state.trend)",
        holt=model_struct(
            "holt",
            position,
            f"Holt(alpha={ALPHA},beta={BETA})",
            "holt_ahead",
            _sigma("holt_state"),
            "holt_state",
            "holt_state.path" if fitted else None,
        ),
    )


def _clamped(x: str) -> str:
    return f"greatest(least({x}, {EDGE}D), -{EDGE}D)"


def _best_coefficients(thetas: list[str]) -> str:
    """Struct (ssr, theta, phi) with the least squared residuals over a grid of theta.

    For a fixed theta the residuals are linear in phi: e[t] = a[t] - phi * a[t-1] with
    a[t] = d[t] - theta * a[t-1]. So the best phi is a ratio of two sums, and the search has
    one dimension instead of two.
    """
    a = "(d - theta * acc.a)"
    step = f"struct({a} AS a, acc.aa + {a} * {a} AS aa, acc.ab + {a} * acc.a AS ab)"
    lagged = "(acc.aa - acc.a * acc.a)"
    phi = _clamped(f"coalesce(acc.ab / nullif({lagged}, 0D), 0D)")
    ssr = f"acc.aa - 2D * {phi} * acc.ab + {phi} * {phi} * {lagged}"
    fold = (
        f"aggregate(changes, struct(0D AS a, 0D AS aa, 0D AS ab), (acc, d) -> {step}, "
        f"acc -> struct({ssr} AS ssr, theta AS theta, {phi} AS phi))"
    )
    return f"array_min(transform(array({', '.join(thetas)}), theta -> {fold}))"


def _around(theta: str, step: float) -> list[str]:
    return [_clamped(f"{theta} + {k * step!r}D") for k in range(-10, 11)]


def add_arima(folds: DataFrame, horizon: int, position: int, fitted: bool = False) -> DataFrame:
    """ARIMA(1,1,1) by conditional least squares.

    Three nested grids of theta, the last with a step of 0.0005, each with its best phi.
    The fitted path starts at the first value and accumulates the fitted changes.
    """
    resid = "(d - fit.phi * acc.prev - fit.theta * acc.resid)"
    actual, level = "(acc.actual + d)", f"(acc.level + (d - {resid}))"
    path0, path = (", array(ys[0]) AS path", f", concat(acc.path, array({level})) AS path") if fitted else ("", "")
    zero = (
        "struct(0D AS prev, 0D AS resid, 0D AS resid_sum, 0D AS resid_sq, "
        f"ys[0] AS actual, ys[0] AS level, {NO_ERRORS}{path0})"
    )
    step = (
        f"struct(d AS prev, {resid} AS resid, acc.resid_sum + {resid} AS resid_sum, "
        f"acc.resid_sq + {resid} * {resid} AS resid_sq, {actual} AS actual, {level} AS level, "
        f"{add_error('acc', actual, level)}{path})"
    )
    first_change = "fit.phi * arima_state.prev + fit.theta * arima_state.resid"
    ahead0 = f"struct({first_change} AS change, element_at(ys, -1) AS level, cast(array() AS array<double>) AS path)"
    moved = (
        "struct(fit.phi * acc.change AS change, acc.level + acc.change AS level, "
        "concat(acc.path, array(acc.level + acc.change)) AS path)"
    )
    return _staged(
        folds,
        coarse=_best_coefficients([f"{k * COARSE_STEP!r}D" for k in range(-19, 20)]),
        fine=_best_coefficients(_around("coarse.theta", FINE_STEP)),
        fit=_best_coefficients(_around("fine.theta", FINEST_STEP)),
        arima_state=f"aggregate(changes, {zero}, (acc, d) -> {step})",
        arima_ahead=f"aggregate(sequence(1, {horizon}), {ahead0}, (acc, j) -> {moved}, acc -> acc.path)",
        arima=model_struct(
            "arima",
            position,
            "ARIMA(1,1,1)",
            "arima_ahead",
            deviation("arima_state.resid_sum", "arima_state.resid_sq", "arima_state.n"),
            "arima_state",
            "arima_state.path" if fitted else None,
        ),
    )


CLOSED_FORM: dict[str, Callable[..., DataFrame]] = {
    "arima": add_arima,
    "seasonal": add_seasonal,
    "polynomial": add_polynomial,
    "holt": add_holt,
}
