"""Series as ordered arrays, one row per company, target and fold.

Grouping is by company, and a company has one row per calendar date, so an array holds at
most one value per date. Everything after the grouping is row-local: folds, fits and
forecasts add no exchange.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterwise.sources.durable import dealt_by

TARGETS = ("revenue", "profit")
MIN_ROWS = 8
HORIZON = 4
FULL, HELD_OUT = "full", "held_out"


def training_series(records: DataFrame, targets: Sequence[str] = TARGETS) -> DataFrame:
    """(company_id, last_date, target, dates, ys) of the series with enough history.

    Every target has its own series: a missing profit does not shorten the revenue.
    """
    known = F.coalesce(*[F.col(t) for t in targets]).isNotNull()
    points = F.sort_array(F.collect_list(F.struct("date", *targets))).alias("points")
    grouped = dealt_by(records.select("company_id", "date", *targets).where(known), "company_id").groupBy("company_id").agg(points)

    def own(target: str) -> Column:
        return F.filter("points", lambda p: p[target].isNotNull())

    per_target = [F.struct(F.lit(t).alias("target"), own(t)["date"].alias("dates"), own(t)[t].alias("ys")) for t in targets]
    series = grouped.select("company_id", F.inline(F.array(*per_target))).where(F.size("ys") >= MIN_ROWS)
    return series.select("company_id", F.element_at("dates", -1).alias("last_date"), "target", "dates", "ys")


def changes(ys: Column) -> Column:
    """Every value but the first less the one before it."""
    n = F.size(ys)
    return F.zip_with(F.slice(ys, 2, n - 1), F.slice(ys, 1, n - 1), lambda now, before: now - before)


def _fold(name: str, ys: Column, actual: Column) -> Column:
    """The generator materialises these, so no later projection recomputes them."""
    return F.struct(
        F.lit(name).alias("fold"),
        F.size(ys).alias("n"),
        ys.alias("ys"),
        changes(ys).alias("changes"),
        actual.alias("actual"),
    )


def with_folds(series: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """The full series, and the series without its last ``horizon`` rows if that is long enough.

    ``actual`` is what the held-out fold has to predict.
    """
    kept = F.size("ys") - horizon
    full = _fold(FULL, F.col("ys"), F.lit(None).cast("array<double>"))
    held = _fold(HELD_OUT, F.slice("ys", 1, kept), F.slice("ys", kept + 1, horizon))
    folds = F.array(full, F.when(kept >= MIN_ROWS, held))
    return series.select("company_id", "last_date", "target", F.inline(F.array_compact(folds)))


def future_quarters(last_date: Column | str, horizon: int = HORIZON) -> Column:
    """Array of the next quarter starts after a date."""
    start = F.trunc(last_date, "quarter")
    return F.transform(F.sequence(F.lit(1), F.lit(horizon)), lambda k: F.add_months(start, 3 * k))
