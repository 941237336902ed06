"""CSV in and out. Files are read as text with a fixed schema: no inference pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarterwise import schema

# The texts that dataframe CSV readers treat as missing.
MISSING_TEXTS = (
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def _read_text(spark: SparkSession, path: str) -> DataFrame:
    """Every column as string, named by the header, missing texts as NULL."""
    reader = spark.read.option("header", True).option("inferSchema", False)
    raw = reader.csv(path)
    return raw.select(
        *[F.when(~F.col(f"`{c}`").isin(*MISSING_TEXTS), F.col(f"`{c}`")).alias(c) for c in raw.columns]
    )


def read_companies(spark: SparkSession, path: str) -> DataFrame:
    """Company dimension; the key becomes a long."""
    raw = schema.require_columns(_read_text(spark, path), schema.COMPANY_REQUIRED)
    return raw.select(
        F.col("company_id").cast("bigint"), "company_name", "sector", "country"
    )


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Quarterly figures as text; `operators.validation` turns them into typed columns."""
    return _read_text(spark, path)


def write_csv(df: DataFrame, path: str, order: Sequence[str] = ()) -> str:
    """Directory of CSV parts with a header; ranges of ``order`` when given."""
    out = df.orderBy(*order) if order else df
    shown = [
        F.date_format(f.name, "yyyy-MM-dd").alias(f.name) if isinstance(f.dataType, T.DateType) else F.col(f"`{f.name}`")
        for f in out.schema.fields
    ]
    out.select(*shown).write.mode("overwrite").option("header", True).csv(path)
    return path
