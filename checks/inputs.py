"""Frames the checks start from, all derived from the tables of the data folder."""

from __future__ import annotations

from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import anomaly_sql, sql  # noqa: F401  (the flags' stages)
from quarterwise.operators.anomaly import run_anomaly_detection
from quarterwise.operators.features import compute_kpis
from quarterwise.operators.forecast.engine import forecast_results, run_all_forecasts
from quarterwise.operators.forecast.learners import gradient_boosting, kernel_regression, random_forest
from quarterwise.operators.kpi import full_analytics
from quarterwise.sources import retail
from quarterwise.sources.durable import durable

T = TypeVar("T")
CLOSED = ("arima", "seasonal", "polynomial", "holt")
LEARNERS = {
    "random_forest": random_forest(),
    "gradient_boosting": gradient_boosting(),
    "svr": kernel_regression(),
}

companies = retail.companies
records = retail.financial_records


def kpis(spark: SparkSession, d: str) -> DataFrame:
    return compute_kpis(records(spark, d))


_STORED: dict[tuple[str, str, str], object] = {}


def stored(name: str, spark: SparkSession, d: str, make: Callable[[], T]) -> T:
    """What the queries after a step share, made once a session and folder, as the step would store it."""
    key = (name, spark.sparkContext.applicationId, d)
    if key not in _STORED:
        _STORED[key] = make()
    return _STORED[key]


def flags(spark: SparkSession, d: str) -> DataFrame:
    """Stored flags of all detectors."""
    return stored("flags", spark, d, lambda: durable(run_anomaly_detection(records(spark, d))))


def forecasts(spark: SparkSession, d: str) -> DataFrame:
    """Stored forecasts of the closed-form models, which SQL can express."""
    return stored("closed", spark, d, lambda: durable(run_all_forecasts(records(spark, d), models=CLOSED)))


def default_results(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """Forecasts, chart feed and comparison of the default models, from one stored model table."""
    return stored("default", spark, d, lambda: forecast_results(records(spark, d)))


def default_forecasts(spark: SparkSession, d: str) -> DataFrame:
    return stored("forecasts", spark, d, lambda: durable(default_results(spark, d)["forecasts"]))


def analytics(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    return stored("analytics", spark, d, lambda: full_analytics(records(spark, d), companies(spark, d)))


def with_stranger(df: DataFrame) -> DataFrame:
    """The rows, and company 0's once more under an id that no company has."""
    return df.unionByName(df.where("company_id = 0").withColumn("company_id", F.lit(-1).cast("bigint")))


for _table in ("records", "flags"):
    sql.stage(f"{_table}_with_stranger", f"  select * from {_table} union all select * replace (-1 as company_id) from {_table} where company_id = 0", _table)


def filings(spark: SparkSession, d: str) -> DataFrame:
    """Every order line as a raw text filing: copies of keys, gaps, junk, negative balances."""
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")

    def text(name: str, places: int = 4):
        amount = F.col(name).cast("decimal(18,0)") / retail.UNITS
        return amount.cast(f"decimal(18,{places})").cast("string")

    return retail.lines(spark, d).select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("string").alias("record_id"),
        F.col("company_id").cast("string").alias("company_id"),
        F.date_format("date", "yyyy-MM-dd").alias("date"),
        F.when(flag == "R", None).when((flag == "N") & (status == "F"), "pending").otherwise(text("revenue")).alias("revenue"),
        text("expenses", 2).alias("expenses"),
        text("profit").alias("profit"),
        F.when(status == "F", text("operating_cost")).alias("operating_cost"),
        F.when((flag == "A") & (status == "O"), "n/a").otherwise(F.concat(F.lit("-"), text("assets", 2))).alias("assets"),
        F.when((flag == "R") & (status == "F"), F.concat(text("liabilities", 2), F.lit("d"))).otherwise(text("liabilities", 2)).alias("liabilities"),
    )


sql.stage(
    "filings",
    """  select cast(l_orderkey * 8 + l_linenumber as varchar) as record_id, cast(company_id as varchar) as company_id,
    strftime(date, '%Y-%m-%d') as date,
    case when l_returnflag = 'R' then null when l_returnflag = 'N' and l_linestatus = 'F' then 'pending'
      else cast(revenue as varchar) end as revenue,
    cast(expenses as varchar) as expenses, cast(profit as varchar) as profit,
    case when l_linestatus = 'F' then cast(operating_cost as varchar) end as operating_cost,
    case when l_returnflag = 'A' and l_linestatus = 'O' then 'n/a' else cast(-assets as varchar) end as assets,
    cast(liabilities as varchar) || case when l_returnflag = 'R' and l_linestatus = 'F' then 'd' else '' end as liabilities
  from lines""",
    "lines",
)


def gaps(spark: SparkSession, d: str) -> DataFrame:
    """The panel with missing figures where debt is high or the margin low."""
    r = records(spark, d)
    debt, low = F.col("liabilities") > 0.7 * F.col("assets"), F.col("expenses") > 0.5 * F.col("revenue")
    return r.withColumns(
        {
            "revenue": F.when(debt, None).otherwise(F.col("revenue")),
            "profit": F.when(low, None).otherwise(F.col("profit")),
            "assets": F.when(low, None).otherwise(-F.col("assets")),
        }
    )


sql.stage(
    "gaps",
    """  select company_id, date, case when liabilities > 0.7::double * assets then null else revenue end as revenue, expenses,
    case when expenses > 0.5::double * revenue then null else profit end as profit, operating_cost,
    case when expenses > 0.5::double * revenue then null else -assets end as assets, liabilities
  from records""",
    "records",
)
