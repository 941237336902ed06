"""Window expressions over one company's rows.

A validated frame has one row per (company_id, date), so a window partition holds at most
one row per calendar date however large the input is. That bound is what makes a
``partitionBy(company_id)`` window safe for a company that dominates the raw data. All
expressions below share the same partitioning, so Spark plans one exchange for them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quarterwise.functions.scalars import over_nonzero

KEY = ("company_id",)


def ordered(keys: Sequence[str] = KEY, order: str = "date") -> WindowSpec:
    return W.partitionBy(*keys).orderBy(order)


def whole(keys: Sequence[str] = KEY) -> WindowSpec:
    return W.partitionBy(*keys)


def growth(col: str, digits: int = 4, keys: Sequence[str] = KEY, order: str = "date") -> Column:
    """Change against the previous row, NULL after a zero; the sign flips after a negative."""
    previous = F.lag(col, 1).over(ordered(keys, order))
    return F.round(over_nonzero(F.col(col), previous) - 1, digits)


def trailing_mean(col: str, rows: int, digits: int = 2) -> Column:
    return F.round(F.avg(col).over(ordered().rowsBetween(-(rows - 1), 0)), digits)


def trailing_mean_of_rounded(col: str, rows: int, digits: int = 2, places: int = 4) -> Column:
    """Trailing mean of values with few decimals, summed in DECIMAL.

    Such means often end in a 5 exactly where they are rounded; a sum without rounding
    error makes that step reproducible.
    """
    w = ordered().rowsBetween(-(rows - 1), 0)
    total = F.sum(F.col(col).cast(f"decimal(28,{places})")).over(w).cast("double")
    return F.round(total / F.nullif(F.count(col).over(w), F.lit(0)), digits)


def fill_both_ways(col: str) -> Column:
    """Last known value, else the next known one, else 0."""
    w = ordered()
    back = F.last(col, ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, 0))
    ahead = F.first(col, ignorenulls=True).over(w.rowsBetween(0, W.unboundedFollowing))
    return F.coalesce(back, ahead, F.lit(0.0))


def running_sum(col: Column | str, keys: Sequence[str] = KEY, order: str = "date") -> Column:
    return F.sum(col).over(ordered(keys, order).rowsBetween(W.unboundedPreceding, 0))


def standardised(col: str, keys: Sequence[str] = KEY) -> Column:
    """(v - mean) / population std of the series; NULL for a constant series."""
    w = whole(keys)
    return over_nonzero(F.col(col) - F.avg(col).over(w), F.stddev_pop(col).over(w))
