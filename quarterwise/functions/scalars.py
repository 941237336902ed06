"""Row-level column expressions, all JVM-side built-ins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def over_nonzero(num: Column | str, den: Column | str) -> Column:
    """num / den, NULL where the denominator is zero."""
    return _c(num) / F.nullif(_c(den), F.lit(0.0))


def ratio(num: Column | str, den: Column | str, digits: int = 4) -> Column:
    return F.round(over_nonzero(num, den), digits)


def percent(fraction: Column | str) -> Column:
    return F.round(_c(fraction) * 100, 2)


def finite(col: Column | str) -> Column:
    """NULL for +-infinity and NaN, for frames that come from elsewhere."""
    c = _c(col)
    return F.when((F.abs(c) == float("inf")) | F.isnan(c), None).otherwise(c)


def year_of(date: Column | str) -> Column:
    return F.year(_c(date)).cast("bigint")


def quarter_of(date: Column | str) -> Column:
    return F.quarter(_c(date)).cast("bigint")


def year_text(date: Column | str) -> Column:
    return F.date_format(_c(date), "yyyy")


def quarter_label(date: Column | str, sep: str = "-") -> Column:
    """2022-Q2, or 2022 Q2 with a blank separator."""
    return F.concat(F.year(_c(date)), F.lit(f"{sep}Q"), F.quarter(_c(date)))


def iso_date(date: Column | str) -> Column:
    return F.date_format(_c(date), "yyyy-MM-dd")


def severity(score: Column, severe_above: float) -> Column:
    return F.when(score > severe_above, F.lit("SEVERE")).otherwise(F.lit("WARNING"))


def first_word(text: Column | str) -> Column:
    return F.split_part(_c(text), F.lit(" "), F.lit(1))


def name_or_id(name: Column | str, company_id: Column | str, prefix: str = "Co ") -> Column:
    return F.coalesce(_c(name), F.concat(F.lit(prefix), _c(company_id).cast("string")))


def amount_label(amount: Column | str) -> Column:
    """Axis label: £1.2M from a million up, £12k from a thousand up, £7 below."""
    v = _c(amount)
    return (
        F.when(F.abs(v) >= 1e6, F.format_string("£%.1fM", v / 1e6))
        .when(F.abs(v) >= 1e3, F.format_string("£%.0fk", v / 1e3))
        .otherwise(F.format_string("£%.0f", v))
    )


def company_caption(*parts: Column | str) -> Column:
    """'Name (Sector)' or 'Name (Sector, Country)'."""
    name, *rest = (_c(p) for p in parts)
    return F.concat(name, F.lit(" ("), F.concat_ws(", ", *rest), F.lit(")"))


def exact_sum(col: Column | str, digits: int = 4) -> Column:
    """Aggregate sum of values already rounded to ``digits`` places, in DECIMAL.

    Lossless for such values, so it does not depend on the order of partial sums.
    """
    return F.sum(_c(col).cast(f"decimal(28,{digits})"))


def mean_of_rounded(col: Column | str, digits: int = 4) -> Column:
    return exact_sum(col, digits).cast("double") / F.nullif(F.count(_c(col)), F.lit(0))
