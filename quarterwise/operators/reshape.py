"""Small relational building blocks shared by reports and charts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterwise.functions.scalars import name_or_id


def of_company(df: DataFrame, *company_ids: int) -> DataFrame:
    """Rows of the given companies; the predicate reaches the Parquet scan."""
    return df.where(F.col("company_id").isin(*company_ids))


def renamed(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Select, reorder and rename in one projection: {column: shown name}."""
    return df.select(*[F.col(c).alias(shown) for c, shown in names.items()])


def long_metrics(df: DataFrame, ids: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Wide to long: one row per id and metric."""
    return df.unpivot(list(ids), list(metrics), "metric", "value")


def with_company(df: DataFrame, companies: DataFrame, *columns: str) -> DataFrame:
    """Inner join that adds company columns. Rows of unknown companies are left out.

    The join strategy is left to Spark: it broadcasts the companies only when their
    measured size is under the broadcast threshold.
    """
    return df.join(companies.select("company_id", *columns), "company_id")


def with_label(df: DataFrame, companies: DataFrame, name: str = "company") -> DataFrame:
    """Left join that adds a display name, 'Co <id>' for an unknown company."""
    named = companies.select("company_id", "company_name")
    return (
        df.join(named, "company_id", "left")
        .withColumn(name, name_or_id("company_name", "company_id"))
        .drop("company_name")
    )


def company_id_of(companies: DataFrame, name: str) -> DataFrame:
    """Name to id lookup."""
    return companies.where(F.col("company_name") == name).select("company_id")


def flag_points(flags: DataFrame, records: DataFrame, metrics: Sequence[str] = ("revenue", "expenses")) -> DataFrame:
    """Flags with the recorded value at their date; NULL when that date has no record."""
    recorded = long_metrics(records, ["company_id", "date"], metrics).withColumnRenamed("value", "recorded")
    marked = flags.where(F.col("metric").isin(*metrics)).select("company_id", "date", "metric", "severity")
    return marked.join(recorded, ["company_id", "date", "metric"], "left")


def top_row(df: DataFrame, by: str) -> DataFrame:
    """The row with the largest value, lowest company_id among equals."""
    return df.orderBy(F.desc_nulls_last(by), "company_id").limit(1)
