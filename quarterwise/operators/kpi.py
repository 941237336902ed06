"""Summaries and comparisons built on the KPI frame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quarterwise.functions.scalars import (
    exact_sum,
    mean_of_rounded,
    over_nonzero,
    percent,
    quarter_of,
    year_of,
)
from quarterwise.functions.series import ordered
from quarterwise.operators.features import compute_kpis
from quarterwise.schema import KPI_RESULTS
from quarterwise.sources.durable import durable

KPI_COLUMNS = KPI_RESULTS.fieldNames()


def kpi_results(kpis: DataFrame) -> DataFrame:
    """The stored subset of the KPI frame."""
    return kpis.select(*KPI_COLUMNS)


def last_known(col: str, order: str = "date") -> Column:
    """Aggregate: the latest non-null value of a column."""
    return F.max_by(col, F.when(F.col(col).isNotNull(), F.col(order)))


def latest_per_company(df: DataFrame) -> DataFrame:
    """One row per company: each column's last non-null value."""
    rest = [c for c in df.columns if c != "company_id"]
    return df.groupBy("company_id").agg(*[last_known(c).alias(c) for c in rest])


def company_summary(records: DataFrame, companies: DataFrame, kpis: DataFrame | None = None) -> DataFrame:
    """One row per company, best average profit margin first.

    The grouping reuses the exchange of the growth window. Pass ``kpis`` to share a KPI
    frame that is already there.
    """
    kpis = compute_kpis(records) if kpis is None else kpis
    per_company = kpis.groupBy("company_id").agg(
        F.round(F.sum("revenue"), 0).alias("total_revenue"),
        percent(mean_of_rounded("profit_margin")).alias("avg_profit_margin"),
        percent(mean_of_rounded("expense_ratio")).alias("avg_expense_ratio"),
        percent(mean_of_rounded("return_on_assets")).alias("avg_roa"),
        percent(mean_of_rounded("revenue_growth")).alias("avg_revenue_growth"),
        F.round(last_known("profit"), 0).alias("latest_profit"),
        F.count("date").alias("quarters"),
    )
    named = companies.select("company_id", "company_name", "sector", "country")
    return per_company.join(named, "company_id", "left").orderBy(F.desc_nulls_last("avg_profit_margin"), "company_id")


def sector_comparison(records: DataFrame, companies: DataFrame, kpis: DataFrame | None = None) -> DataFrame:
    """One row per sector, best average profit margin first.

    Quarters are summed per company before the join, so the sector key, of which there
    are few, only ever sees one row per company.
    """
    kpis = compute_kpis(records) if kpis is None else kpis
    ratios = {"profit_margin": "avg_profit_margin", "expense_ratio": "avg_expense_ratio", "return_on_assets": "avg_roa"}
    per_company = kpis.groupBy("company_id").agg(
        F.sum("revenue").alias("revenue"),
        *[exact_sum(r).alias(f"{r}_sum") for r in ratios],
        *[F.count(r).alias(f"{r}_n") for r in ratios],
    )
    means = [
        percent(over_nonzero(F.sum(f"{r}_sum").cast("double"), F.sum(f"{r}_n"))).alias(name) for r, name in ratios.items()
    ]
    return (
        per_company.join(companies.select("company_id", "sector"), "company_id", "left")
        .where(F.col("sector").isNotNull())
        .groupBy("sector")
        .agg(*means, F.sum("revenue").alias("total_revenue"), F.count(F.lit(1)).alias("companies"))
        .orderBy(F.desc_nulls_last("avg_profit_margin"), "sector")
    )


def latest_kpi_snapshot(records: DataFrame, companies: DataFrame, kpis: DataFrame | None = None) -> DataFrame:
    """Latest known figures of every company, KPIs in percent."""
    kpis = compute_kpis(records) if kpis is None else kpis
    shown = ["profit_margin", "operating_ratio", "expense_ratio", "return_on_assets", "revenue_growth"]
    return (
        latest_per_company(kpis)
        .join(companies.select("company_id", "company_name", "sector"), "company_id")
        .withColumns({c: percent(c) for c in shown})
    )


def yoy_growth(records: DataFrame) -> DataFrame:
    """Revenue against the same quarter of the previous year.

    A window over the years of a company's quarter: one scan, one exchange, and a partition of a
    few rows. It expects one row per company and quarter.
    """
    dated = records.select("company_id", "date", year_of("date").alias("year"), quarter_of("date").alias("quarter"), "revenue")
    year_before = W.partitionBy("company_id", "quarter").orderBy("year").rangeBetween(-1, -1)
    change = over_nonzero(F.col("revenue") - F.col("prev_revenue"), "prev_revenue")
    return dated.withColumn("prev_revenue", F.first("revenue").over(year_before)).withColumn("yoy_growth", F.round(change, 4))


def annual_growth(records: DataFrame) -> DataFrame:
    """Annual revenue and its change on the year before."""
    annual = records.groupBy("company_id", year_of("date").alias("year")).agg(
        F.round(F.sum("revenue"), 0).alias("annual_revenue")
    )
    before = F.lag("annual_revenue", 1).over(ordered(order="year"))
    change = over_nonzero(F.col("annual_revenue") - before, before)
    return annual.withColumn("growth", F.round(change, 4))


def compare_profit(records: DataFrame, company_a: int, company_b: int) -> DataFrame:
    """Profit of two companies side by side, a row for every date either one has.

    One scan with both keys pushed down instead of a full outer join of two.
    """
    if company_a == company_b:
        raise ValueError("Choose two different companies.")

    def profit_of(company: int) -> Column:
        return F.max(F.when(F.col("company_id") == company, F.col("profit"))).alias(f"profit_co{company}")

    pair = records.where(F.col("company_id").isin(company_a, company_b))
    return pair.groupBy("date").agg(profit_of(company_a), profit_of(company_b)).orderBy("date")


def quarter_card(kpis: DataFrame) -> DataFrame:
    """Latest quarter of each company against the one before it.

    A company with one quarter is compared with itself and shows no change.
    """
    w = ordered()
    newest_first = W.partitionBy("company_id").orderBy(F.desc("date"))

    def previous(col: str) -> Column:
        return F.coalesce(F.lag(col, 1).over(w), F.when(F.row_number().over(w) == 1, F.col(col)))

    staged = kpis.withColumns(
        {
            "prev_revenue": previous("revenue"),
            "prev_profit": previous("profit"),
            "age": F.row_number().over(newest_first),
        }
    ).where(F.col("age") == 1)
    profit_base = F.greatest(F.abs("prev_profit"), F.lit(1.0))
    return staged.select(
        "company_id",
        "date",
        "revenue",
        F.round(over_nonzero(F.col("revenue") - F.col("prev_revenue"), "prev_revenue") * 100, 1).alias("revenue_change_pct"),
        "profit",
        F.round((F.col("profit") - F.col("prev_profit")) / profit_base * 100, 1).alias("profit_change_pct"),
        F.round(F.col("profit_margin") * 100, 1).alias("profit_margin_pct"),
        F.round(F.col("expense_ratio") * 100, 1).alias("expense_ratio_pct"),
    )


def full_analytics(records: DataFrame, companies: DataFrame, kpis: DataFrame | None = None) -> dict[str, DataFrame]:
    """The KPI frame and everything derived from it.

    The KPI frame holds the records too. It is written once, here unless the caller passes a stored
    one, and all five results read nothing else of the records.
    """
    kpis = durable(compute_kpis(records)) if kpis is None else kpis
    return {
        "kpi_data": kpis,
        "company_summary": company_summary(kpis, companies, kpis),
        "sector_comparison": sector_comparison(kpis, companies, kpis),
        "yoy_growth": yoy_growth(kpis),
        "latest_snapshot": latest_kpi_snapshot(kpis, companies, kpis),
    }
