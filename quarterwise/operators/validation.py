"""Checks and repairs that turn raw rows into one typed row per company and date.

Duplicates are resolved by an aggregate, not a ranking window: it combines on the map side, so
a key whose copies make up a third of the input reaches the reducer as one row per task. Where
rows have an id, every column is taken by ``min_by`` with one fixed-width order for all of them,
so rows of numbers and dates meet in a hash table and are never sorted. Spark sorts for text
columns, which a hash aggregate cannot hold; validation therefore reads numbers first.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterwise import schema
from quarterwise.functions.series import fill_both_ways

RECORD_KEY = ("company_id", "date")


def first_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key: the one with the lowest values, columns in order."""
    rest = [c for c in df.columns if c not in keys]
    kept = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("kept"))
    return kept.select(*[F.col(c) if c in keys else F.col(f"kept.{c}") for c in df.columns])


#: Bits of a row's hash below its id: together they fit a DECIMAL(38).
_HASH_BITS = 62


def _row_order(ident: str, columns: Sequence[str]) -> Column:
    """The row's id, null first, then a hash of the row: one number, equal only for equal rows."""
    number = F.coalesce(F.col(ident).cast("decimal(19,0)"), F.lit(Decimal(-(2**63) - 1)))
    row = F.shiftrightunsigned(F.xxhash64(*columns), 64 - _HASH_BITS).cast("decimal(19,0)")
    return (number * F.lit(Decimal(2**_HASH_BITS)) + row).cast("decimal(38,0)")


def first_by_id(df: DataFrame, keys: Sequence[str], ident: str) -> DataFrame:
    """One row per key: the one with the lowest id, a null id before all; of rows that share it, any one, but always the same."""
    rest = [c for c in df.columns if c not in keys]
    ordered = df.withColumn("_order", _row_order(ident, rest))
    kept = ordered.groupBy(*keys).agg(*[F.min_by(c, "_order").alias(c) for c in rest])
    return kept.select(*df.columns)


def drop_duplicate_records(df: DataFrame) -> DataFrame:
    """First row of each (company_id, date): by record_id where there is one, else the lowest values."""
    return first_by_id(df, RECORD_KEY, "record_id") if "record_id" in df.columns else first_per_key(df, RECORD_KEY)


def drop_incomplete_records(df: DataFrame) -> DataFrame:
    return df.dropna(subset=["company_id", "date", "revenue"])


#: What a plain decimal cannot have. The cast alone would also read `12d`, `0x1p3` and the like.
NOT_IN_NUMBERS = r"[^0-9eE.+\s-]"


def to_number(col: Column | str) -> Column:
    """A double; 0 for a missing or unreadable value."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(F.when(~c.cast("string").rlike(NOT_IN_NUMBERS), c.try_cast("double")), F.lit(0.0))


def coerce_measures(df: DataFrame, columns: Sequence[str] = tuple(schema.MEASURES)) -> DataFrame:
    return df.withColumns({c: to_number(c) for c in columns})


def parse_date(df: DataFrame, strict: bool = True) -> DataFrame:
    """``date`` as DateType. An unreadable date raises, or becomes NULL when not strict."""
    c = F.col("date")
    return df.withColumn("date", c.cast("date") if strict else c.try_cast("date"))


def rejected_dates(df: DataFrame) -> DataFrame:
    """Rows whose date cannot be read, for use with ``strict=False``."""
    return df.where(F.col("date").isNotNull() & F.col("date").try_cast("date").isNull())


def _typed_keys(df: DataFrame, strict_dates: bool) -> DataFrame:
    typed = parse_date(schema.require_columns(df, schema.RECORD_REQUIRED), strict_dates)
    keys = [c for c in ("record_id", "company_id") if c in typed.columns]
    return typed.withColumns({c: F.col(c).cast("bigint") for c in keys})


def _numbers(typed: DataFrame) -> DataFrame:
    """Numeric measures, and whether the row gives a revenue."""
    return coerce_measures(typed.withColumn("_given", F.col("revenue").isNotNull()))


def validate_financial_records(df: DataFrame, strict_dates: bool = True) -> DataFrame:
    """Required columns, one row per key, no missing key or revenue, numeric measures.

    Rows without a key can never survive, so they go before the shuffle. A first
    duplicate without revenue takes its key with it: the later copies are already gone.
    Text becomes numbers before duplicates meet, with a mark for a revenue that is missing.
    """
    rows = _numbers(_typed_keys(df, strict_dates).dropna(subset=list(RECORD_KEY)))
    return drop_duplicate_records(rows).where("_given").drop("_given")


def validation_report(df: DataFrame, strict_dates: bool = True) -> DataFrame:
    """One row: rows read, kept and dropped by `validate_financial_records`.

    Two aggregates over the raw rows, the first of which combines copies map-side.
    """
    rows = _numbers(_typed_keys(df, strict_dates))
    rest = [c for c in rows.columns if c not in RECORD_KEY]
    given = F.min_by("_given", _row_order("record_id", rest)) if "record_id" in rest else F.min(F.struct(*rest))["_given"]
    keyed = F.col("company_id").isNotNull() & F.col("date").isNotNull()
    per_key = rows.groupBy(*RECORD_KEY).agg(F.count(F.lit(1)).alias("n"), given.alias("given"))
    counted = per_key.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows_read"), F.count_if(keyed & F.col("given")).alias("rows_kept"))
    return counted.withColumn("rows_dropped", F.col("rows_read") - F.col("rows_kept"))


def validate_companies(df: DataFrame) -> DataFrame:
    return first_per_key(schema.require_columns(df, schema.COMPANY_REQUIRED), ["company_id"])


def fill_missing_measures(df: DataFrame, columns: Sequence[str] = tuple(schema.MEASURES)) -> DataFrame:
    """Carry the last value forward, then the next one back, then 0; within a company."""
    return df.withColumns({c: fill_both_ways(c) for c in columns})


def clamp_balances(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.greatest(F.col(c), F.lit(0.0)) for c in ("assets", "liabilities")})


def clean_financial_records(df: DataFrame) -> DataFrame:
    """Dates, one row per key, gaps filled, negative balances set to 0."""
    return clamp_balances(fill_missing_measures(drop_duplicate_records(parse_date(df))))
